"""Macro indicators and sector return tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import rules
from tapeworks.functions.common import top1


def macro_points(rows: DataFrame) -> DataFrame:
    """rows: indicator_code, date, seq, body (JSON). A rate with a maturity has that as dimension; else value, rate, close or the first number."""
    get = lambda k: F.get_json_object("body", f"$.{k}")
    fields = F.map_values(F.from_json("body", "map<string,string>"))
    first = F.get(F.array_compact(F.transform(fields, lambda x: x.try_cast("double"))), 0)
    value = F.coalesce(*[rules.number(get(k)) for k in ("value", "rate", "close")], first)
    out = rows.select("indicator_code", F.col("date").alias("as_of"), F.coalesce(get("maturity"), F.lit("")).alias("dimension"), value.alias("value"), "seq")
    return top1(out.where("value is not null"), ["indicator_code", "as_of", "dimension"], F.asc("seq")).drop("seq")


def macro_current(observations: DataFrame, indicators: DataFrame) -> DataFrame:
    """The latest of each enabled indicator and dimension, fractions as percentages."""
    rows = top1(observations, ["indicator_code", "dimension"], F.desc("as_of"))
    rows = rows.join(indicators.where("enabled").withColumnRenamed("code", "indicator_code"), "indicator_code")
    return rows.select(F.col("indicator_code").alias("code"), "name", "category", "country_iso2", "unit", "frequency", "dimension", rules.on_read(F.col("value"), F.col("value_is_fraction")).alias("value"), "as_of", "fetched_at")


def macro_dedupe(indicators: DataFrame) -> DataFrame:
    """Codes of enabled fred series that another enabled provider covers for the same country and category."""
    topics = ["inflation", "labour", "growth"]
    fred = indicators.where(F.col("enabled") & (F.col("provider") == "fred") & F.col("category").isin(topics)).alias("a")
    other = indicators.where(F.col("enabled") & (F.col("provider") != "fred")).alias("b")
    same = F.col("a.country_iso2").eqNullSafe(F.col("b.country_iso2")) & (F.col("a.category") == F.col("b.category"))
    return fred.join(other, same, "left_semi").select("code")


def sector_unpivot(wide: DataFrame, labels: DataFrame, periods: list[str]) -> DataFrame:
    """Wide sector returns in fractions to (sector_id, period, change_pct); unknown labels are left out."""
    long = wide.unpivot(["label"], periods, "period", "v").where("v is not null")
    return long.join(labels, "label").select("sector_id", "period", (F.floor(F.col("v") * 1e6 + 0.5) / 1e4).cast("double").alias("change_pct"))


def unmapped_labels(wide: DataFrame, labels: DataFrame, periods: list[str]) -> DataFrame:
    """(label, dropped): labels that sector_unpivot() leaves out, and how many values with them."""
    long = wide.unpivot(["label"], periods, "period", "v").where("v is not null")
    return long.join(labels, "label", "left_anti").groupBy("label").agg(F.count("*").alias("dropped"))
