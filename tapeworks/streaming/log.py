"""A keyed table that micro-batches write to: a base and a folder for each batch since, merged when it is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.functions import versions
from tapeworks.functions.common import top1


class Log:
    """Rows by key, of which the first in ``order`` counts; ``order`` may not depend on batches, so how rows are dealt to batches changes nothing.

    A batch writes a folder of its own number, and one that is run again replaces it. compact() merges the base and
    all batches into a new base and moves a pointer to it, so readers and a compaction that fails meet whole tables.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str], *order: Column):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), list(keys), order
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def write(self, rows: DataFrame, epoch: int) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/batches/batch={epoch}")

    def _base(self) -> tuple[DataFrame | None, int]:
        """The base, and the last batch that it has."""
        known = versions.current(f"{self.path}/base")
        return (None, -1) if known is None else (self.spark.read.schema(self.schema).parquet(known["path"]), int(known["version"]))

    def _batches(self, after: int, before: int | None) -> DataFrame:
        empty = self.spark.createDataFrame([], self.schema)
        if not versions.is_there(f"{self.path}/batches"):
            return empty
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{self.path}/batches").where(F.col("batch") > after)
        return (rows if before is None else rows.where(F.col("batch") < before)).select(*self.schema.names)

    def rows(self, before: int | None = None) -> DataFrame:
        """The table, or what it was ``before`` a batch; bases that have later batches are left out of that by replaying none."""
        base, last = self._base()
        rows = self._batches(last, before)
        return top1(rows if base is None else base.unionByName(rows), self.keys, *self.order)

    def compact(self, epoch: int, every: int = 16, keep: Column | None = None) -> bool:
        """Once ``every`` batches up to ``epoch`` aren't in the base: makes a base of the table up to it, of the rows where ``keep`` is true."""
        _, last = self._base()
        if epoch - last < every:
            return False
        path = f"{self.path}/base/{epoch}"
        rows = self.rows(epoch + 1)
        (rows if keep is None else rows.where(keep)).write.mode("overwrite").parquet(path)
        versions.publish(f"{self.path}/base", path, str(epoch))
        return True
