"""Counts that are kept up to date while groups of rows (games) arrive, and arrive again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.schemas import c, ddl

ROWS, BATCH = "_rows", "batch"


class CountLog:
    """Rows counted per key in a growing table of differences.

    A batch writes one folder: the counts of its rows, less what earlier batches
    had counted for the groups that it brings again. So the sum over all folders
    is the count of the latest form of every group, whatever the batches were; a
    batch reads the older rows of its own groups only and rewrites nothing. A
    batch that is run again replaces its folder and changes nothing, as long as no
    later one has run. Numbers must grow from batch to batch.

    ``group`` is one of the ``keys``; missing keys are keys like others. Every
    row is counted before it is shuffled.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Mapping[str, str], group: str):
        self.spark, self.folder, self.keys, self.group = spark, folder, dict(keys), group
        self._schema = ddl(self.keys | {ROWS: "BIGINT", BATCH: "INT"})
        spark.createDataFrame([], self._schema).write.mode("ignore").partitionBy(BATCH).parquet(folder)

    def differences(self) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(self.folder)

    def _sums(self, df: DataFrame, by) -> DataFrame:
        return df.groupBy(*[c(k) for k in by]).agg(F.sum(ROWS).alias(ROWS)).where(F.col(ROWS) != 0)

    def apply(self, rows: DataFrame, groups: DataFrame, number: int) -> None:
        """Count ``rows`` as batch ``number``. ``groups`` names, in its column ``group``, all groups of the batch, also those left without a row."""
        keys = [c(k) for k in self.keys]
        new = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))
        brought = groups.select(c(self.group).alias("_group")).distinct()
        before = self.differences().where(F.col(BATCH) < number).drop(BATCH).join(brought, F.expr(f"`{self.group}` <=> _group"), "left_semi")
        less = self._sums(before, self.keys).withColumn(ROWS, -F.col(ROWS))
        self._sums(new.unionByName(less), self.keys).sortWithinPartitions(c(self.group)).write.mode("overwrite").parquet(
            f"{self.folder}/{BATCH}={number}"
        )

    def counts(self) -> DataFrame:
        """``keys`` but the group, and ``_rows``."""
        return self._sums(self.differences(), [k for k in self.keys if k != self.group])

    def compacted(self, folder: str, number: int) -> CountLog:
        """The same counts as one batch ``number``, the last one so far, in a new folder."""
        out = CountLog(self.spark, folder, self.keys, self.group)
        self._sums(self.differences(), self.keys).sortWithinPartitions(c(self.group)).write.mode("overwrite").parquet(f"{folder}/{BATCH}={number}")
        return out
