"""Keyed, idempotent writes: which row of a key survives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.common import upsert


def upsert_latest(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], keep_existing: bool = False) -> DataFrame:
    """The incoming row of a key, or the existing one with keep_existing; within a side the row of greatest seq."""
    side = F.asc("_new") if keep_existing else F.desc("_new")
    return upsert(existing, incoming, keys, side, F.desc("seq"))


def upsert_priority(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], sources: DataFrame) -> DataFrame:
    """The row of the best source, then the incoming one, then the last fetched, then by source and value."""
    rank = lambda df: df.join(sources, "source_code", "left").withColumn("priority", F.coalesce("priority", F.lit(100)))
    return upsert(rank(existing), rank(incoming), keys, F.desc("priority"), F.desc("_new"), F.desc("fetched_at"), F.asc("source_code"), F.desc("value")).drop("priority")


def debt_terms_latest(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Terms of the latest filing; an older one that arrives later changes nothing."""
    return upsert(existing, incoming, ["security_id"], F.desc("as_of"), F.desc("_new"), F.asc("maturity_date"), F.asc("coupon_rate"))


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Overwrites those partitions of a Parquet table that ``df`` has rows of, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """A read model written as Parquet and read back with the time of its refresh."""
    df.withColumn("refreshed_at", F.current_timestamp()).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
