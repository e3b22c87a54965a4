"""Price bars, discontinuities, price and total returns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.common import top1
from tapeworks.functions.scans import scanned
from tapeworks.functions.scratch import stored

#: Periods and the days back to their anchors.
PERIOD_DAYS = {"1w": 7, "1m": 30, "3m": 91, "6m": 182, "1y": 365, "3y": 1095, "5y": 1826}
#: A close more than so many times the one before, or less than its inverse, breaks a series.
BREAK_RATIO = 5
FRESH_DAYS = 10


def price_bars(bars: DataFrame) -> DataFrame:
    """Bars of a finite close above 0; dividends above 0 and splits above 0 and other than 1, else null."""
    close = F.col("close")
    good = bars.where((close > 0) & ~F.isnan(close) & (close < float("inf")))
    return good.withColumn("dividend", F.when(F.col("dividend") > 0, F.col("dividend"))).withColumn(
        "split_ratio", F.when((F.col("split_ratio") > 0) & (F.col("split_ratio") != 1), F.col("split_ratio"))
    )


def corporate_actions(bars: DataFrame) -> DataFrame:
    """(series_id, ex_date, kind, value): up to two rows of a bar."""
    split = F.when(F.col("split_ratio").isNotNull() & (F.col("split_ratio") != 1), F.struct(F.lit("split").alias("kind"), F.col("split_ratio").alias("value")))
    paid = F.when(F.col("dividend") > 0, F.struct(F.lit("dividend").alias("kind"), F.col("dividend").alias("value")))
    return bars.select("series_id", F.col("date").alias("ex_date"), F.inline(F.array_compact(F.array(split, paid))))


def _with_previous(bars: DataFrame, segments: bool = False) -> DataFrame:
    """Bars with prev and prev_date of the bar before, and broke, their date if they jumped from it; ``segments`` scans a series in ranges of its dates."""
    if segments:
        bars = scanned(bars, ["series_id"], ["date"], previous=["close", "date"]).withColumnsRenamed({"previous_close": "prev", "previous_date": "prev_date"})
    else:
        by_date = Window.partitionBy("series_id").orderBy("date")
        bars = bars.withColumn("prev", F.lag("close").over(by_date)).withColumn("prev_date", F.lag("date").over(by_date))
    jump = (F.col("close") > BREAK_RATIO * F.col("prev")) | (F.col("prev") > BREAK_RATIO * F.col("close"))
    return bars.withColumn("broke", F.when(jump, F.col("date")))


def comparable_from(bars: DataFrame, segments: bool = False) -> DataFrame:
    """(series_id, comparable_from): the date of the last bar that jumped, or of the first bar; segments: as in total_returns()."""
    rows = _with_previous(bars, segments)
    return rows.groupBy("series_id").agg(F.coalesce(F.max("broke"), F.min("date")).alias("comparable_from"))


def _anchors(asof: dt.date) -> dict[str, Column]:
    day = F.lit(asof)
    out = {p: F.date_sub(day, d) for p, d in PERIOD_DAYS.items()}
    return out | {"ytd": F.lit(dt.date(asof.year - 1, 12, 31))}


def _percent(x: Column) -> Column:
    """A fraction as a percentage of four decimals, halves up."""
    return F.floor(x * 1e6 + 0.5).cast("double") / 1e4


def _returns(rows: DataFrame, level: str, asof: dt.date, must_move: bool) -> DataFrame:
    """rows: series_id, date, close, prev, prev_date, broke, ``level`` and prev_level, its value at the bar before. One aggregation finds all anchors."""
    day = F.lit(asof)
    rows = rows.where(F.col("date") <= day)
    newest = F.struct("date", F.col(level).alias("v"), "close", "prev_date")
    at = {p: F.max(F.when(F.col("date") <= d, F.struct("date", F.col(level).alias("v"), "close"))) for p, d in _anchors(asof).items()}
    # the newest date at which the close changed: an anchor before it has been moved from
    rows = rows.withColumn("changed", F.when(F.col("close") != F.col("prev"), F.col("date")))
    agg = rows.groupBy("series_id").agg(
        F.max(newest).alias("last"), F.max(F.struct("date", F.col("prev_date").alias("d"), F.col("prev_level").alias("v"))).alias("before"),
        F.max("broke").alias("broke"), F.max("changed").alias("changed"), F.count("*").alias("n"), *[a.alias(p) for p, a in at.items()],
    )
    fresh = (F.col("n") >= 2) & (F.col("last.date") >= F.date_sub(day, FRESH_DAYS)) & (F.col("last.v") > 0)

    def anchor(period: str, date: Column, v: Column) -> Column:
        """A period's anchor, without a value where the rules leave it out."""
        stays = F.col("broke").isNull() | (date >= F.col("broke"))
        if must_move:
            stays &= F.col("changed") > date
        return F.struct(F.lit(period).alias("period"), F.when(stays, v).alias("v"))

    every = F.array(anchor("1d", F.col("before.d"), F.col("before.v")), *[anchor(p, F.col(f"{p}.date"), F.col(f"{p}.v")) for p in at])
    out = agg.where(fresh).select("series_id", "last", F.inline(every)).where("v is not null")
    return out.select("series_id", "period", _percent(F.col("last.v") / F.col("v") - 1).alias("pct"), F.col("last.date").alias("as_of"))


def price_returns(bars: DataFrame, asof: dt.date, segments: bool = False) -> DataFrame:
    """series_id, period, change_pct, as_of. A period is left out if its anchor is missing, lies before a break,
    or if no close since differs from the anchor's; a series if it has fewer than two bars or none of late. segments: as in total_returns()."""
    rows = _with_previous(bars, segments).withColumn("prev_level", F.col("prev"))
    return _returns(rows, "close", asof, True).withColumnRenamed("pct", "change_pct")


def total_returns(bars: DataFrame, asof: dt.date, segments: bool = False) -> DataFrame:
    """As price_returns over the index that dividends are reinvested in; a period that didn't move is kept.

    With ``segments`` a series is scanned in ranges of its dates, for series that have a large share of all bars.
    """
    rows = _with_previous(bars, segments)
    step = F.when(F.col("prev").isNotNull(), F.log((F.col("close") + F.coalesce("dividend", F.lit(0.0))) / F.col("prev"))).otherwise(F.lit(0.0))
    rows = rows.withColumn("step", step)
    if segments:
        rows = scanned(rows, ["series_id"], ["date"], total=["step"]).withColumn("level", F.exp("total_step"))
        before = F.exp(F.col("total_step") - F.col("step"))
    else:
        by_date = Window.partitionBy("series_id").orderBy("date")
        rows = rows.withColumn("level", F.exp(F.sum("step").over(by_date.rowsBetween(Window.unboundedPreceding, 0))))
        before = F.lag("level").over(by_date)
    rows = rows.withColumn("prev_level", F.when(F.col("prev").isNotNull(), before))
    return _returns(rows, "level", asof, False).withColumnRenamed("pct", "total_return_pct")


def performance(bars: DataFrame, universe: DataFrame, asof: dt.date, ttl_days: int = 1) -> DataFrame:
    """Returns by (scope, scope_id, period). universe: scope, scope_id, series_id, retired."""
    price, total = price_returns(bars, asof), total_returns(bars, asof).drop("as_of")
    out = price.join(total, ["series_id", "period"], "left").join(universe.where("not retired"), "series_id")
    return out.select("scope", "scope_id", "period", "change_pct", "total_return_pct", "as_of", F.date_add("as_of", ttl_days).alias("stale_after"), F.lit("derived").alias("source"))


def downsample(bars: DataFrame, asof: dt.date, days: int = 90) -> DataFrame:
    """Daily bars of the last ``days``, before them the first of each epoch week; the newest bar is always kept."""
    week = F.floor(F.unix_date("date") * 86400 / 604800)
    old = F.col("date") < F.date_sub(F.lit(asof), days)
    rank = F.row_number().over(Window.partitionBy("series_id", "old", "week").orderBy("date"))
    newest = F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("date")))
    rows = bars.withColumn("old", old).withColumn("week", F.when(old, week)).withColumn("r", rank).withColumn("last", newest)
    return rows.where("not old or r = 1 or last = 1").select("series_id", "date", "close")


def price_series(security: DataFrame, curated: DataFrame) -> DataFrame:
    """Both series (symbol, grain, date, close), those of securities first where both have a bar."""
    both = security.withColumn("p", F.lit(1)).unionByName(curated.withColumn("p", F.lit(2)))
    return top1(both, ["symbol", "grain", "date"], F.asc("p"), F.asc("close")).drop("p")


def prune_prices(bars: DataFrame, asof: dt.date, days: int = 400) -> DataFrame:
    """Without daily bars older than ``days``; weekly ones stay."""
    return bars.where((F.col("grain") != "daily") | (F.col("date") >= F.date_sub(F.lit(asof), days)))


def price_plan(series: DataFrame, asof: dt.date, batch: int, window_days: int) -> DataFrame:
    """series: symbol, last_date. (symbol, batch, start): what to fetch from when.

    Series never fetched, or not within the window, start at its begin; others go in batches of like dates. A
    series' rank is its rank in its range of the order plus the sizes of the ranges before, so no task has them all.
    """
    begin = F.date_sub(F.lit(asof), window_days)
    full = F.col("last_date").isNull() | (F.col("last_date") < begin)
    order = [F.asc_nulls_first("last_date"), F.asc_nulls_first("symbol")]
    # stored, as ranges are drawn by a sample and must be the same for the sizes and the ranks
    rows = stored(series.withColumn("full", full).repartitionByRange("full", *order).withColumn("range", F.spark_partition_id()), "price_ranges")
    sizes = rows.groupBy("full", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("full").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("full", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    rank = F.row_number().over(Window.partitionBy("full", "range").orderBy(*order))
    rows = rows.withColumn("rank", rank).join(sizes, ["full", "range"]).withColumn("batch", F.ceil((F.col("rank") + F.col("earlier")) / batch).cast("long"))
    start = F.when(F.col("full"), begin).otherwise(F.min("last_date").over(Window.partitionBy("full", "batch")))
    return rows.select("symbol", "full", "batch", start.alias("start"))
