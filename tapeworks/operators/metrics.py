"""Statements to metric series, trailing sums, and ratios for each bar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions import rules
from tapeworks.functions.common import asof, daily, ratio, round4, top1
from tapeworks.functions.scans import scanned

DERIVED_PRIORITY = 50


def ttm(metrics: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Sums of four consecutive quarters of flow metrics: four rows that span 370 days at most. catalogue: metric_code, is_flow."""
    year = Window.partitionBy("security_id", "metric_code").orderBy("as_of").rowsBetween(-3, 0)
    rows = metrics.where(F.col("period_type") == "quarter").join(catalogue.where("is_flow").select("metric_code"), "metric_code", "left_semi")
    rows = rows.select("*", F.sum("value").over(year).alias("total"), F.count("*").over(year).alias("n"), F.min("as_of").over(year).alias("first"))
    full = rows.where((F.col("n") == 4) & (F.datediff("as_of", "first") <= 370))
    return full.select("security_id", "metric_code", F.lit("ttm").alias("period_type"), "as_of", F.col("total").alias("value"), "currency_code", F.lit("derived").alias("source_code"))


def fiscal_periods(metrics: DataFrame, sources: DataFrame, gap_days: int = 7) -> DataFrame:
    """One row of each run of dates that follow each other within ``gap_days``: the best source's, then the latest."""
    key = ["security_id", "metric_code", "period_type"]
    by_date = Window.partitionBy(*key).orderBy("as_of", "source_code")
    rows = metrics.withColumn("gap", F.datediff("as_of", F.lag("as_of").over(by_date)))
    starts = F.when(F.col("gap") <= gap_days, 0).otherwise(1)
    rows = rows.withColumn("run", F.sum(starts).over(by_date.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(sources, "source_code", "left")
    return top1(rows, [*key, "run"], F.desc_nulls_last("priority"), F.desc("as_of"), F.asc("source_code")).drop("gap", "run", "priority")


def metric_series(metrics: DataFrame, sources: DataFrame, catalogue: DataFrame, symbols: DataFrame) -> DataFrame:
    """Clustered series with names and symbols; securities without a symbol are left out."""
    rows = fiscal_periods(metrics, sources).join(catalogue, "metric_code").join(symbols, "security_id")
    return rows.select("symbol", "security_id", "metric_code", "metric_name", "category", "unit", "is_derived", "period_type", "as_of", F.col("value").cast("double").alias("value"), "currency_code", "source_code")


def statement_metrics(statements: DataFrame, fields: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Numbers of JSON payloads by the (source, statement, field) control table; texts and other types are no numbers.

    A row for each source of a key: which source's stays is upsert_priority's business; with ``keep``, columns of statements, for each
    value of these too. ``payload`` is parsed once to a map, and the control table joins its keys.
    """
    rows = statements.select("security_id", "statement", "source_code", "period_ending", rules.period_type(F.col("period_type")).alias("period_type"), "currency_code", *keep, F.explode(F.from_json("payload", "map<string,variant>")).alias("field", "v"))
    rows = rows.join(fields, ["source_code", "statement", "field"])
    kind = F.schema_of_variant("v")
    rows = rows.where((kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"))
    value = F.try_variant_get("v", "$", "decimal(28,4)")
    rows = rows.select("security_id", "metric_code", "period_type", F.col("period_ending").alias("as_of"), value.alias("value"), "currency_code", "source_code", *keep, "field")
    return top1(rows, ["security_id", "metric_code", "period_type", "as_of", "source_code", *keep], F.asc("field")).drop("field")


def _codes(metrics: DataFrame, codes: list[str], reported: str) -> DataFrame:
    """Value and currency of each code by (security, period type, date), where no source has reported ``reported``; of several sources' values the greatest."""
    key = ["security_id", "period_type", "as_of"]
    own = F.max(F.when((F.col("metric_code") == reported) & (F.col("source_code") != "derived"), True))
    parts = [F.max(F.when(F.col("metric_code") == c, F.struct("value", "currency_code"))).alias(c) for c in codes]
    return metrics.where(F.col("metric_code").isin(*codes, reported)).groupBy(*key).agg(own.alias("_reported"), *parts).where("_reported is null")


def free_cash_flow(metrics: DataFrame) -> DataFrame:
    """Operating cash flow less capital expenditure, of either sign, in the former's currency, where none is reported."""
    rows = _codes(metrics, ["operating_cash_flow", "capital_expenditure"], "free_cash_flow").where("operating_cash_flow is not null and capital_expenditure is not null")
    flow, spent = F.col("operating_cash_flow"), F.col("capital_expenditure")
    return rows.select("security_id", "period_type", "as_of", flow["currency_code"].alias("currency_code"), (flow["value"] - F.abs(spent["value"])).cast("double").alias("value"))


def total_debt(metrics: DataFrame) -> DataFrame:
    """Long-term debt plus short-term debt if any, in the former's currency, where none is reported."""
    rows = _codes(metrics, ["long_term_debt", "short_term_debt"], "total_debt").where("long_term_debt is not null")
    long, short = F.col("long_term_debt"), F.col("short_term_debt")
    return rows.select("security_id", "period_type", "as_of", long["currency_code"].alias("currency_code"), (long["value"] + F.coalesce(short["value"], F.lit(0))).cast("double").alias("value"))


def xbrl_resolve(facts: DataFrame, concepts: DataFrame) -> DataFrame:
    """One value for each (security, metric, period type, end): the best concept's, then the one filed last.

    Flows must last a year or a quarter as their period says; instants have no start.
    """
    kind = F.when(F.col("fp") == "FY", "annual").when(F.col("fp").startswith("Q"), "quarter").otherwise("annual")
    days = F.datediff("end", "start")
    rows = facts.join(concepts, ["taxonomy", "concept"]).withColumn("period_type", kind)
    fits = F.col("start").isNull() | F.when(F.col("period_type") == "annual", days.between(300, 400)).otherwise(days.between(80, 100))
    rows = top1(rows.where(fits & ((F.col("unit") == F.col("want_unit")) | F.col("want_unit").isNull())), ["security_id", "metric_code", "period_type", "end"], F.desc("priority"), F.desc("filed"), F.desc("val"))
    return rows.select("security_id", "metric_code", "period_type", F.col("end").alias("as_of"), F.col("val").alias("value"), "concept")


def metric_asof(bars: DataFrame, metrics: DataFrame, codes: list[str], prefix: str = "", segments: bool = False) -> DataFrame:
    """Bars with the value of each code that was the latest at their date; segments: as in asof()."""
    for code in codes:
        steps = metrics.where(F.col("metric_code") == code).select("security_id", F.col("as_of").alias("_since"), F.col("value").cast("double").alias(f"{prefix}{code}"))
        bars = asof(bars, steps, ["security_id"], "date", "_since", [f"{prefix}{code}"], segments)
    return bars


def ratio_series(bars: DataFrame, metrics: DataFrame, securities: DataFrame, rates: DataFrame, reporting: DataFrame, asof: dt.date | None = None, segments: bool = False) -> DataFrame:
    """Valuation ratios of each bar: flows by trailing sums, stocks by the last quarter, both currencies at the bar's date.

    bars: security_id, symbol, grain, date, close. metrics may have currency_code: the report currency is the metrics' own
    (the last by name, if they differ), else that of ``reporting``. A ratio is null on a missing rate, and so are
    those by or of earnings and cash flow that aren't positive. Bars before any metric give no row. All codes carry forward in one pass over a security's history, in ranges of it with ``segments``. Rates hold
    until ``asof``, today by default; later bars aren't converted.
    """
    flows = ["eps_diluted", "revenue", "net_income", "free_cash_flow"]
    stocks = ["total_equity", "total_assets", "shares"]
    steps = metrics.where((F.col("metric_code").isin(flows) & (F.col("period_type") == "ttm")) | (F.col("metric_code").isin(stocks) & (F.col("period_type") == "quarter")))
    if "currency_code" not in steps.columns:
        steps = steps.withColumn("currency_code", F.lit(None).cast("string"))
    known = F.struct(F.col("value").cast("double").alias("value"), "currency_code")
    wide = steps.groupBy("security_id", F.col("as_of").alias("date")).agg(*[F.max(F.when(F.col("metric_code") == c, known)).alias(c) for c in flows + stocks])
    both = bars.withColumn("_bar", F.lit(1)).unionByName(wide.withColumn("_bar", F.lit(0)), allowMissingColumns=True)
    if segments:
        rows = scanned(both, ["security_id"], ["date", "_bar"], last=flows + stocks).select(*bars.columns, "_bar", *[F.col(f"last_{c}").alias(c) for c in flows + stocks]).where("_bar = 1").drop("_bar")
    else:
        running = Window.partitionBy("security_id").orderBy("date", "_bar").rowsBetween(Window.unboundedPreceding, 0)
        rows = both.select(*bars.columns, "_bar", *[F.last(c, ignorenulls=True).over(running).alias(c) for c in flows + stocks]).where("_bar = 1").drop("_bar")
    rows = rows.where(" or ".join(f"{c} is not null" for c in flows + stocks))
    rows = rows.select(*bars.columns, F.greatest(*[F.col(c)["currency_code"] for c in flows + stocks]).alias("_own"), *[F.col(c)["value"].alias(c) for c in flows + stocks])
    rows = rows.join(securities.select("security_id", F.col("currency_code").alias("quote_currency")), "security_id", "left").join(reporting, "security_id", "left")
    rows = rows.withColumn("report_currency", F.coalesce("_own", "report_currency"))
    # few currencies have all bars, so rates are laid out by day and joined on both
    for side in ("report", "quote"):
        fx = rates.select(F.col("currency_code").alias(f"{side}_currency"), F.col("as_of").alias("_since"), F.col("usd_per_unit").alias(f"{side}_rate"))
        rows = rows.join(daily(fx, f"{side}_currency", "_since", asof or dt.date.today()), [f"{side}_currency", "date"], "left")
        rows = rows.withColumn(f"{side}_rate", F.when(F.col(f"{side}_currency") == "USD", F.lit(1.0)).otherwise(F.col(f"{side}_rate")))
    same = F.coalesce(F.col("report_currency") == F.col("quote_currency"), F.lit(False))
    factor = F.when(same, F.lit(1.0)).when(F.col("quote_rate") > 0, F.col("report_rate") / F.col("quote_rate"))
    rows = rows.withColumn("factor", factor)
    cap = F.col("close") * F.when(F.col("shares") > 0, F.col("shares"))

    def per(a: Column, b: Column) -> Column:
        return round4(a / F.when(b > 0, b))

    conv = {c: F.col(c) * F.col("factor") for c in flows + stocks}
    return rows.select(
        "symbol", "security_id", "date", "grain", "close", "report_currency", "quote_currency",
        factor.isNotNull().alias("currency_comparable"), (factor.isNotNull() & ~same).alias("fx_converted"),
        per(F.col("close"), conv["eps_diluted"]).alias("pe_ratio"), per(cap, conv["revenue"]).alias("ps_ratio"), per(cap, conv["total_equity"]).alias("pb_ratio"), per(cap, conv["free_cash_flow"]).alias("price_to_fcf"),
        round4(100 * ratio(F.when(conv["eps_diluted"] > 0, conv["eps_diluted"]), F.col("close"))).alias("earnings_yield_pct"),
        round4(100 * ratio(F.when(conv["free_cash_flow"] > 0, conv["free_cash_flow"]), cap)).alias("fcf_yield_pct"),
        round4(100 * F.col("net_income") / F.when(F.col("revenue") > 0, F.col("revenue"))).alias("net_margin_pct"),
        round4(100 * F.col("net_income") / F.when(F.col("total_equity") > 0, F.col("total_equity"))).alias("roe_pct"),
        round4(100 * F.col("net_income") / F.when(F.col("total_assets") > 0, F.col("total_assets"))).alias("roa_pct"),
    )


def pending_metrics(statements: DataFrame, derived: DataFrame) -> DataFrame:
    """Statements whose key and payload haven't been derived: a changed payload is pending again."""
    key = ["security_id", "statement", "period_ending", "period_type"]
    rows = statements.withColumn("payload_hash", F.sha2("payload", 256))
    return rows.join(derived, [*key, "payload_hash"], "left_anti").select(*key)


def pending_ttm(metrics: DataFrame, derived: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Series of flow metrics whose newest quarter was fetched after their newest trailing sum."""
    key = ["security_id", "metric_code"]
    rows = metrics.where(F.col("period_type") == "quarter").join(catalogue.where("is_flow").select("metric_code"), "metric_code", "left_semi")
    quarters = rows.groupBy(*key).agg(F.max("fetched_at").alias("q"), F.count("*").alias("n"))
    done = derived.groupBy(*key).agg(F.max("fetched_at").alias("d"))
    return quarters.where("n >= 4").join(done, key, "left").where("d is null or q > d").select(*key)


def promote_from_raw(securities: DataFrame, fundamentals: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Market cap where there is none and the payload has a positive number; quote currency likewise if it is three capitals.

    The reporting currency is the payload's text in capitals if that makes three letters, else it stays as it was,
    null where ``securities`` has no such column. With ``known`` (currency_code), a quote currency must be one of these.
    """
    v = F.parse_json("raw")
    raw = fundamentals.select("security_id", F.try_variant_get(v, "$.marketCap", "double").alias("cap"), F.try_variant_get(v, "$.currency", "string").alias("cur"), F.schema_of_variant(F.try_variant_get(v, "$.currency", "variant")).alias("kind"))
    rows = securities.join(raw, "security_id", "left")
    quoted = F.when(F.col("cur").rlike("^[A-Z]{3}$"), F.col("cur"))
    if known is not None:
        rows = rows.join(known.select(F.col("currency_code").alias("cur"), F.lit(True).alias("listed")).distinct(), "cur", "left")
        quoted = F.when(F.col("listed"), quoted)
    told = F.when((F.col("kind") == "STRING") & F.upper("cur").rlike("^[A-Z]{3}$"), F.upper("cur"))
    reporting = F.coalesce(told, F.col("reporting_currency")) if "reporting_currency" in securities.columns else told
    cap = F.coalesce(F.col("market_cap").cast("double"), F.when(F.col("cap") > 0, F.col("cap")))
    return rows.select("security_id", cap.alias("market_cap"), F.coalesce("currency_code", quoted).alias("currency_code"), reporting.alias("reporting_currency"))


def fundamentals_current(fundamentals: DataFrame, securities: DataFrame, symbols: DataFrame) -> DataFrame:
    """Ratios with symbol and quote currency; a security without a symbol has a null one."""
    return fundamentals.join(securities.select("security_id", "currency_code"), "security_id").join(symbols.select("security_id", "symbol"), "security_id", "left")


def statement_current(statements: DataFrame, securities: DataFrame, symbols: DataFrame) -> DataFrame:
    """Statements with symbol, effective country, quote and reporting currency."""
    sec = securities.select("security_id", F.coalesce("operating_country_iso2", "country_iso2").alias("country"), F.col("currency_code").alias("quote_currency"))
    rows = statements.join(sec, "security_id").join(symbols, "security_id", "left")
    return rows.select("security_id", "symbol", "statement", "period_ending", "period_type", "country", "quote_currency", rules.reporting_currency(F.col("currency_code"), F.col("quote_currency"), F.col("country")).alias("reporting_currency"))
