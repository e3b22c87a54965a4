"""A table of bars laid out for its readers: partitioned by grain and year, bucketed by security.

Charts and prunes read the partitions they need; joins and aggregates by security read buckets and need no exchange. Writes
overwrite the partitions they touch and no others.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.common import upsert
from tapeworks.functions.scratch import stored

KEY, COLUMNS, BUCKETS = ["security_id", "grain", "date"], ["security_id", "date", "close", "grain", "year"], 32


def _laid_out(bars: DataFrame) -> DataFrame:
    return bars.withColumn("year", F.year("date")).select(*COLUMNS)


def create_bars(bars: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Makes ``table`` at ``path`` of bars (security_id, grain, date, close), one for each KEY. Returns the table."""
    rows = _laid_out(bars).repartition(buckets, "security_id")
    writer = rows.write.format("parquet").partitionBy("grain", "year").bucketBy(buckets, "security_id").sortBy("security_id", "date")
    # an option of the table, so that every later insert keeps to its partitions
    writer.option("path", path).option("partitionOverwriteMode", "dynamic").saveAsTable(table)
    return bars.sparkSession.table(table)


def _within(parts: list) -> Column:
    """Rows of these (grain, year)s, as a condition on partition columns."""
    by_grain: dict[str, list[int]] = {}
    for grain, year in parts:
        by_grain.setdefault(grain, []).append(year)
    out = F.lit(False)
    for grain, years in sorted(by_grain.items()):
        out |= (F.col("grain") == grain) & F.col("year").isin(sorted(years))
    return out


def _overwrite(rows: DataFrame, table: str, buckets: int) -> None:
    """Replaces the partitions that ``rows`` has. Rows are stored first, as the table is read to make them."""
    stored(rows, "bars").repartition(buckets, "security_id").select(*COLUMNS).write.insertInto(table, overwrite=True)


def upsert_bars(new: DataFrame, table: str, buckets: int = BUCKETS) -> None:
    """Writes new bars over stored ones of the same KEY; of repeats in ``new`` the greatest close. Reads and writes only partitions that ``new`` has.

    The driver gets the grains and years of ``new`` and no rows.
    """
    new = stored(_laid_out(new), "new_bars")
    parts = [(r["grain"], r["year"]) for r in new.select("grain", "year").distinct().collect()]
    if parts:
        old = new.sparkSession.table(table).where(_within(parts)).select(*COLUMNS)
        _overwrite(upsert(old, new, KEY, F.desc("_new"), F.desc("close")).select(*COLUMNS), table, buckets)


def prune_bars(spark: SparkSession, table: str, asof: dt.date, days: int = 400, grain: str = "daily", buckets: int = BUCKETS) -> None:
    """Drops bars of a grain older than ``days``: whole years as partitions, and of the year in which the limit lies what is older."""
    limit = asof - dt.timedelta(days)
    rows = spark.table(table).where((F.col("grain") == grain) & (F.col("year") == limit.year))
    _overwrite(rows.where(F.col("date") >= F.lit(limit)), table, buckets)
    years = [r["year"] for r in spark.table(table).where(F.col("grain") == grain).select("year").distinct().collect()]
    kept = set() if rows.where(F.col("date") >= F.lit(limit)).isEmpty() else {limit.year}
    for year in sorted(y for y in years if y <= limit.year and y not in kept):
        # an external table's partition is forgotten before its files are, so readers never list half of it
        spark.sql(f"alter table {table} drop if exists partition (grain = '{grain}', year = {year})")


def latest_bars(spark: SparkSession, table: str, grain: str = "daily") -> DataFrame:
    """(security_id, date, close) of each security's newest bar of a grain: an aggregate over buckets, without an exchange."""
    rows = spark.table(table).where(F.col("grain") == grain).groupBy("security_id").agg(F.max(F.struct("date", "close")).alias("b"))
    return rows.select("security_id", "b.date", "b.close")
