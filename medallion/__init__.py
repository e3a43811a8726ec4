"""medallion — layered (bronze / silver / gold) tables and a configurable operator library on PySpark.

Everything is expressed with the public DataFrame, SQL and Structured Streaming APIs; Catalyst plans the work.
Sub-packages:

* ``sources``    file streams with schema persistence and rescue, table / SQL / metric-view sources, master data
* ``operators``  split filter, prepare chain, joins, aggregates, unique, windows, CDC, quality, sets, classify
* ``functions``  column-level helpers (brackets, ages, JSON paths, null-safe compares)
* ``sinks``      versioned Parquet tables (overwrite / append by name / merge / refresh) and file exports
* ``streaming``  append flows, incremental runs, stream-to-CDC merges, expectations in ``foreachBatch``
* ``plans``      canvas node-graph runner, the HR application and the queries registered for the driver
"""

from medallion.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
