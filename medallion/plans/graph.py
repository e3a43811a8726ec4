"""Canvas node-graph runner (entry point B): nodes in topological order → ``{"node.port": DataFrame}``.

A node is ``Node(id, op, config, inputs)`` where ``inputs`` maps an input port to ``"node.port"`` (or a list
of them).  Running a graph only builds lazy DataFrames; nothing executes until a sink or a caller acts.
Disabled nodes receive and emit ``limit(0)`` frames that keep their schemas (P18).  Row counts per output
port (P19) are observed on the pass that a sink makes anyway (``Counts``); ``row_counts`` counts ports by a job of its
own, with a scan for each.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from medallion.operators.aggregate import aggregate
from medallion.operators.classify import classify
from medallion.operators.filter import disable, split_counts, split_filter
from medallion.operators.join import join
from medallion.operators.prepare import prepare
from medallion.operators.sqlnode import expression_select, run_sql, table_function
from medallion.operators.unique import unique
from medallion.sources.files import read_files
from medallion.sources.tables import table_source


@dataclass
class Node:
    id: str
    op: str
    config: dict = field(default_factory=dict)
    inputs: dict = field(default_factory=dict)
    disabled: bool = False


def _source(spark, cfg, inputs):
    if "dataframe" in cfg:
        return {"data": cfg["dataframe"]}
    if cfg.get("file_source"):
        files = dict(cfg["file_source"])
        return {"data": read_files(spark, files.get("path"), files.get("format") or "parquet",
                                   **(files.get("options") or {}))}
    ts = cfg.get("table_source") or {}
    return {"data": table_source(spark, ts.get("tableName"), ts.get("isExpression", False),
                                 ts.get("metricView"), cfg.get("measures"))}


def _filter(spark, cfg, inputs):
    return split_filter(inputs["data"], cfg.get("condition", ""))


def _join(spark, cfg, inputs):
    dfs = [inputs[p] for p in ("left", "right") if inputs.get(p) is not None] + list(inputs.get("data") or [])
    return join(dfs, cfg.get("join_type"), bool(cfg.get("match_case", False)), cfg.get("conditions"),
                cfg.get("columns"))


def _sql(spark, cfg, inputs):
    views = dict(zip(cfg.get("sources") or [], inputs.get("data") or []))
    return {"result": run_sql(spark, cfg.get("query", ""), views, cfg.get("parameters"))}


def _aggregate(spark, cfg, inputs):
    return {"aggregated_data": aggregate(inputs["data"], cfg.get("group_bys"), cfg.get("aggregations"))}


def _unique(spark, cfg, inputs):
    sort = [((s.get("columnExpr") or {}).get("expr"), s.get("sortBy", "ASC")) for s in cfg.get("sort_expressions") or []
            if isinstance(s, dict)]
    return {"unique_data": unique(inputs["data"], cfg.get("columns"), cfg.get("unique_by_all_columns", True), sort)}


def _prepare(spark, cfg, inputs):
    return {"prepared_data": prepare(inputs["data"], cfg.get("actions"))}


def _ai(spark, cfg, inputs):
    df = inputs["data"]
    if cfg.get("tvf_sql"):
        return {"ai_data": table_function(spark, cfg["tvf_sql"], df, cfg.get("placeholder", "__input__"))}
    if cfg.get("classify"):
        c = cfg["classify"]
        df = classify(df, c["column"], c["patterns"], c.get("target", "category_json"), c.get("default"))
    return {"ai_data": expression_select(df, cfg.get("expressions"), cfg.get("keep_all_columns", True))}


def _output(spark, cfg, inputs):
    """Write the input and return what was written, read back.

    ``sink``: any callable; ``table`` + ``root``: a versioned table with ``mode`` overwrite / append /
    merge (``keys`` required) / view (materialized-view refresh); ``path`` + ``format`` csv / json: a file
    export (``mode`` overwrite / append, optional ``split_by``).
    """
    from medallion.sinks import export
    from medallion.sinks.tables import Catalog, validate_table_name
    df = inputs["data"]
    if cfg.get("sink") is not None:
        cfg["sink"](df)
        return {"data": df}
    mode = cfg.get("mode", "overwrite")
    if cfg.get("table"):
        name = validate_table_name(cfg["table"])
        t = Catalog(spark, cfg["root"]).table(name)
        if mode in ("overwrite", "view"):
            t.overwrite(df, comment=cfg.get("comment"), properties=cfg.get("properties"))
        elif mode == "append":
            t.append(df)
        elif mode == "merge":
            if not cfg.get("keys"):
                raise ValueError("output: merge needs 'keys'")
            t.merge(df, cfg["keys"])
        else:
            raise ValueError(f"output: unsupported table mode {mode!r}")
        return {"data": t.read()}
    if cfg.get("path"):
        fmt = cfg.get("format", "csv")
        if cfg.get("split_by"):
            export.export_split(df, cfg["path"], cfg["split_by"], fmt=fmt, mode=mode)
        elif fmt == "csv":
            export.export_csv(df, cfg["path"], mode=mode, single_file=bool(cfg.get("single_file")))
        elif fmt == "json":
            export.export_json(df, cfg["path"], mode=mode, single_file=bool(cfg.get("single_file")))
        else:
            raise ValueError(f"output: unsupported format {fmt!r}")
        reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
        return {"data": reader.format(fmt).load(cfg["path"])}
    raise ValueError("output: configure a 'table', a 'path' or a 'sink'")


OPS = {"source": _source, "filter": _filter, "join": _join, "sql": _sql, "aggregate": _aggregate,
       "unique": _unique, "prepare": _prepare, "ai_function": _ai, "output": _output}


def toposort(nodes: list[Node]) -> list[Node]:
    """Order nodes so every input is produced before it is used (Kahn's algorithm over node ids)."""
    by_id = {n.id: n for n in nodes}

    def deps(n):
        refs = []
        for ref in n.inputs.values():
            refs.extend(ref if isinstance(ref, list) else [ref])
        return {r.split(".", 1)[0] for r in refs if r.split(".", 1)[0] in by_id}

    pending = {n.id: deps(n) for n in nodes}
    order = []
    while pending:
        ready = [i for i in by_id if i in pending and not pending[i]]
        if not ready:
            raise ValueError(f"node graph has a cycle among {sorted(pending)}")
        for i in ready:
            order.append(by_id[i])
            del pending[i]
        for d in pending.values():
            d.difference_update(ready)
    return order


class Counts:
    """Rows of the nodes' ports, counted by whatever job runs over them.  A split filter counts both of its ports where
    the rows come in, so the excluded ones are known although nobody reads them."""

    def __init__(self):
        self.seen: dict[str, Observation] = {}

    def _observation(self, node: Node) -> Observation:
        self.seen[node.id] = Observation(f"ports_{node.id}")
        return self.seen[node.id]

    def incoming(self, node: Node, inputs: dict) -> dict:
        if node.op != "filter" or node.disabled:
            return inputs
        return {**inputs, "data": split_counts(inputs["data"], node.config.get("condition"), self._observation(node))}

    def outgoing(self, node: Node, out: dict) -> dict:
        if node.op == "filter" and not node.disabled or node.op in ("output", "source") or len(out) != 1:
            return out
        port, df = next(iter(out.items()))
        return {port: df.observe(self._observation(node), F.count(F.lit(1)).alias(port))}

    def rows(self) -> list[tuple[str, str, int]]:
        """(node, port, rows), once a job has run."""
        return [(node, port, int(n)) for node, seen in self.seen.items() for port, n in seen.get.items()]


def run_graph(spark: SparkSession, nodes: list[Node], sort: bool = True, counts: Counts | None = None) -> dict[str, DataFrame]:
    ctx: dict[str, DataFrame] = {}
    nodes = toposort(nodes) if sort else nodes

    def resolve(ref):
        if isinstance(ref, list):
            return [resolve(r) for r in ref]
        if ref not in ctx:
            raise KeyError(f"input {ref!r} is not produced by an earlier node")
        return ctx[ref]

    for node in nodes:
        fn = OPS.get(node.op)
        if fn is None:
            raise ValueError(f"node {node.id}: unknown operator {node.op!r}; known: {sorted(OPS)}")
        inputs = {port: resolve(ref) for port, ref in node.inputs.items()}
        if node.disabled:
            inputs = disable(inputs)
        if counts is not None:
            inputs = counts.incoming(node, inputs)
        out = fn(spark, node.config, inputs)
        if node.disabled:
            out = disable(out)
        if counts is not None:
            out = counts.outgoing(node, out)
        for port, df in out.items():
            ctx[f"{node.id}.{port}"] = df
    return ctx


def observe_ports(ctx: dict[str, DataFrame], ports: list[str]) -> dict:
    """Attach a row-count ``Observation`` to each port (P19 without a second scan): the counts are filled
    by whatever action later consumes the port (a sink write), and read with ``obs.get["rows"]``."""
    out = {}
    for ref in ports:
        obs = Observation(f"rows_{ref.replace('.', '_')}")
        ctx[ref] = ctx[ref].observe(obs, F.count(F.lit(1)).alias("rows"))
        out[ref] = obs
    return out


def row_counts(ctx: dict[str, DataFrame], ports: list[str]) -> DataFrame:
    """``(node, port, rows)`` for the given ``"node.port"`` names, as one union of global counts."""
    parts = []
    for ref in ports:
        node, port = ref.split(".", 1)
        parts.append(ctx[ref].agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(node).alias("node"), F.lit(port).alias("port"), "rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)
