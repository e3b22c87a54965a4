"""Places, running values and neighbours in an order, without one task for all rows of a key.

Rows are dealt in ranges of (key, order), each range is scanned by itself, and what the ranges before bring, one row
for each range and key in it, is joined to it. So a key with a third of all rows is in as many tasks as its rows fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.scratch import stored

#: monotonically_increasing_id() has the partition above these bits and the row below them.
_BITS = 33


def _same(names: Sequence[str], others: Sequence[str]) -> list[Column]:
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(names, others, strict=True)]


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with _pos (place in the group from 0), _size (rows of the group), and for a ``group`` also _group (its
    place among the groups) and _groups (how many there are). Nulls come first.

    ``order`` should be total; rows that it leaves equal take places in any order.
    """
    keys = [*group, *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    # stored, as ranges are drawn by a sample and must be the same for sizes and places
    ranged = stored(ranged, "ranges").withColumn("_range", F.shiftright("_id", _BITS)).withColumn("_row", F.col("_id").bitwiseAND((1 << _BITS) - 1))
    parts = ranged.groupBy(*group, "_range").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    within = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_n").over(within.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("_before", before).withColumn("_size", F.sum("_n").over(within))
    own, added = [f"_k{i}" for i in range(len(group))], ["_size"]
    if group:
        parts = stored(parts, "parts")
        groups = numbered(parts.select(*group).distinct(), [], group)
        groups = groups.select(*[F.col(g).alias(k) for g, k in zip(group, own)], F.col("_pos").alias("_group"), F.col("_size").alias("_groups"))
        parts = parts.join(groups, _same(group, own)).drop(*own)
        added += ["_group", "_groups"]
    parts = parts.select(*[F.col(g).alias(k) for g, k in zip(group, own)], F.col("_range").alias("_r"), "_first", "_before", *added)
    out = ranged.join(parts, [F.col("_range") == F.col("_r"), *_same(group, own)])
    return out.select(*rows.columns, (F.col("_row") - F.col("_first") + F.col("_before")).alias("_pos"), *added)


def scanned(rows: DataFrame, keys: Sequence[str], order: Sequence[str], last: Sequence[str] = (), total: Sequence[str] = (), previous: Sequence[str] = ()) -> DataFrame:
    """``rows`` with, in the ``order`` of each key, last_<c> (the last value so far that isn't null), total_<c> (the sum so far)
    and previous_<c> (the value of the row before) for the columns named."""
    ranged = stored(rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    place = F.struct(*order)
    own = Window.partitionBy("_range", *keys).orderBy(*order)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    here = [F.last(c, ignorenulls=True).over(upto).alias(f"last_{c}") for c in last] + [F.sum(c).over(upto).alias(f"total_{c}") for c in total]
    here += [F.lag(c).over(own).alias(f"previous_{c}") for c in previous] + [F.row_number().over(own).alias("_row")]
    ends = ranged.groupBy("_range", *keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"last_{c}") for c in last], *[F.sum(c).alias(f"total_{c}") for c in total], *[F.max_by(F.struct(c), place).alias(f"previous_{c}") for c in previous], F.lit(1).alias("_one")
    )
    by_range = Window.partitionBy(*keys).orderBy("_range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_k{i}" for i in range(len(keys))]
    brought = ends.select(
        F.col("_range").alias("_r"), *[F.col(k).alias(n) for k, n in zip(keys, names)], *[F.last(f"last_{c}", ignorenulls=True).over(earlier).alias(f"_last_{c}") for c in last],
        *[F.sum(f"total_{c}").over(earlier).alias(f"_total_{c}") for c in total], *[F.lag(f"previous_{c}").over(by_range)[c].alias(f"_previous_{c}") for c in previous],
    )
    out = ranged.select("*", *here).join(brought, [F.col("_range") == F.col("_r"), *_same(keys, names)])
    summed = lambda c: F.when(F.col(f"total_{c}").isNull() & F.col(f"_total_{c}").isNull(), F.lit(None)).otherwise(F.coalesce(f"total_{c}", F.lit(0)) + F.coalesce(f"_total_{c}", F.lit(0)))
    return out.select(
        *rows.columns, *[F.coalesce(f"last_{c}", f"_last_{c}").alias(f"last_{c}") for c in last], *[summed(c).alias(f"total_{c}") for c in total],
        *[F.when(F.col("_row") == 1, F.col(f"_previous_{c}")).otherwise(F.col(f"previous_{c}")).alias(f"previous_{c}") for c in previous],
    )


def blocks_with_halo(rows: DataFrame, group: Sequence[str], order: Sequence[str], halo: int, size: int) -> DataFrame:
    """``rows`` with _block, runs of ``size`` rows of a group in order, and with _own false the ``halo`` rows on either side of each block that are of its neighbours.

    A window over (group, _block) sees all of ``halo`` rows around each row whose _own is true. ``size`` is ``halo`` at least.
    """
    placed = numbered(rows, group, order)
    block, at = F.floor(F.col("_pos") / size), F.col("_pos") % size
    last = F.floor((F.col("_size") - 1) / size)
    copies = F.array_compact(F.array(
        F.struct(block.alias("_block"), F.lit(True).alias("_own")), F.when((at < halo) & (block > 0), F.struct((block - 1).alias("_block"), F.lit(False).alias("_own"))),
        F.when((at >= size - halo) & (block < last), F.struct((block + 1).alias("_block"), F.lit(False).alias("_own"))),
    ))
    return placed.select(*rows.columns, F.inline(copies))
