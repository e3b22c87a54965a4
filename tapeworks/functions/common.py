"""Plan fragments that many operators share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.scans import scanned
from tapeworks.functions.scratch import stored


def round4(x: Column) -> Column:
    """A double rounded half away from zero to four decimals, as a decimal would be."""
    return F.round(x.cast("decimal(28,10)"), 4).cast("double")


def ratio(a: Column, b: Column) -> Column:
    """a / b as doubles; null where b is null or 0."""
    b = b.cast("double")
    return a.cast("double") / F.when(b != 0, b)


def top1(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in a total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def ranked(df: DataFrame, group: str, by: str) -> DataFrame:
    """``df`` with rank (least place of equals, from 1) of ``by`` within ``group``, and group_size.

    A rank is that within a range of the order plus the sizes of the ranges before, so that no group, however
    few there are, is sorted in one task. Equal values lie in one range.
    """
    # stored, as ranges are drawn by a sample and must be the same for the sizes and the ranks
    rows = stored(df.repartitionByRange(group, by).withColumn("range", F.spark_partition_id()), "ranges")
    sizes = rows.groupBy(group, "range").agg(F.count("*").alias("n"))
    ranges = Window.partitionBy(group)
    earlier = F.sum("n").over(ranges.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col(group).alias("_group"), F.col("range").alias("_range"), F.coalesce(earlier, F.lit(0)).alias("_earlier"), F.sum("n").over(ranges).alias("group_size"))
    rows = rows.withColumn("rank", F.rank().over(Window.partitionBy(group, "range").orderBy(by)))
    rows = rows.join(sizes, rows[group].eqNullSafe(sizes["_group"]) & (rows["range"] == sizes["_range"]))
    return rows.withColumn("rank", F.col("rank") + F.col("_earlier")).drop("range", "_group", "_range", "_earlier")


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Both tables with one row for each key: the first in ``order``, which may use the column _new (1: incoming)."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return top1(both, keys, *order).drop("_new")


def asof(points: DataFrame, steps: DataFrame, keys: Sequence[str], at: str, since: str, values: Sequence[str], segments: bool = False) -> DataFrame:
    """``points`` with ``values`` of the last step of the same keys whose ``since`` is not after ``at``.

    One shuffle on the keys and one running window: no row meets more than one step, however long the
    history. With ``segments`` a key's rows are scanned in ranges, for keys that have a large share of all rows. Of steps with equal ``since`` the caller keeps one.
    """
    own = points.select("*", F.lit(1).alias("_point"), F.lit(None).cast(steps.select(F.struct(*values)).schema[0].dataType).alias("_step"), F.col(at).alias("_at"))
    other = steps.select(*keys, F.col(since).alias("_at"), F.struct(*values).alias("_step"), F.lit(0).alias("_point"))
    both = own.unionByName(other, allowMissingColumns=True)
    if segments:
        both = scanned(both, keys, ["_at", "_point"], last=["_step"]).withColumn("_step", F.col("last__step")).where("_point = 1")
    else:
        running = Window.partitionBy(*keys).orderBy("_at", "_point").rowsBetween(Window.unboundedPreceding, 0)
        both = both.withColumn("_step", F.last("_step", ignorenulls=True).over(running)).where("_point = 1")
    return both.select(*points.columns, *[F.col(f"_step.{v}").alias(v) for v in values])


def daily(steps: DataFrame, key: str, since: str, until: dt.date | None) -> DataFrame:
    """Each step of a small table repeated for every day until the next of its key, in column date: for few keys with
    many points, of which an as-of window would put all points of a key into one task. Up to ``until``; null: none."""
    following = F.lead(since).over(Window.partitionBy(key).orderBy(since))
    rows = steps.withColumn("_last", F.least(F.coalesce(F.date_sub(following, 1), F.lit(until)), F.lit(until)))
    rows = rows.where(F.col("_last") >= F.col(since)).withColumn("date", F.explode(F.sequence(since, "_last")))
    return rows.drop("_last", since)


def optional_filters(df: DataFrame, lists: dict[str, Sequence | None], ranges: dict[str, tuple] | None = None) -> DataFrame:
    """Rows whose columns are in the given lists and ranges; None is no filter."""
    for name, values in lists.items():
        if values is not None:
            df = df.where(F.col(name).isin(list(values)))
    for name, (least, most) in (ranges or {}).items():
        if least is not None:
            df = df.where(F.col(name) >= least)
        if most is not None:
            df = df.where(F.col(name) <= most)
    return df


def dual_filter(df: DataFrame, label: str, code: str, values: Sequence | None) -> DataFrame:
    """Rows whose label or stable code is among ``values``."""
    return df if values is None else df.where(F.col(label).isin(list(values)) | F.col(code).isin(list(values)))


def learn_codes(known: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Codes of ``seen`` that the lookup ``known`` lacks."""
    return seen.select(key).where(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")
