"""Table functions in Python (X4): a seasonal forecaster of each group, called from SQL over a partitioned table.

``seasonal_forecast(TABLE(t) PARTITION BY (g) ORDER BY (step), season, horizon)`` reads a group's steps (whole numbers, in
order) and values and gives, for the next ``horizon`` steps, the mean of all earlier values at the same place in the
season.  The table argument is partitioned by Spark, so each group is a task's matter and only a season of sums and counts
is held, however long the group is.  Missing steps and NULL values are left out; a place never seen has no forecast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="group_value string, step long, forecast double")
class SeasonalForecast:
    def __init__(self):
        self.group, self.last, self.sums, self.counts = None, None, {}, {}

    def eval(self, row, season: int, horizon: int):
        self.group, self.last, self.season, self.horizon = row[0], row[1], season, horizon
        if row[2] is not None:
            place = row[1] % season
            self.sums[place] = self.sums.get(place, 0.0) + float(row[2])
            self.counts[place] = self.counts.get(place, 0) + 1

    def terminate(self):
        if self.last is not None:
            for step in range(self.last + 1, self.last + 1 + self.horizon):
                place = step % self.season
                n = self.counts.get(place)
                yield self.group, step, (self.sums[place] / n if n else None)


def seasonal_forecast(spark: SparkSession, df: DataFrame, group: str, step: str, value: str, season: int,
                      horizon: int) -> DataFrame:
    """(``group``, ``step``, ``forecast``) of the next ``horizon`` steps of each group."""
    spark.udtf.register("seasonal_forecast", SeasonalForecast)
    rows = df.selectExpr(f"CAST(`{group}` AS STRING) AS g", f"CAST(`{step}` AS BIGINT) AS s", f"CAST(`{value}` AS DOUBLE) AS v")
    found = spark.sql("SELECT * FROM seasonal_forecast(TABLE(SELECT g, s, v FROM {rows}) PARTITION BY (g) ORDER BY (s), "
                      f"{int(season)}, {int(horizon)})", rows=rows.where("s IS NOT NULL"))
    return found.selectExpr(f"group_value AS `{group}`", f"step AS `{step}`", "forecast")
