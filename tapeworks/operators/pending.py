"""What has not been computed yet, or is stale: one operator over a standing row for each security, and a table of its instances."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks that a change of the symbol voids: what was asked by it and failed.
SYMBOL_KEYED = (
    "industry", "profile", "profile_detail", "performance", "fundamentals", "statements", "prices", "quarters", "provider_country",
    "corporate_actions", "dividends", "price_history", "share_stats", "estimates",
)


def _tried(what: str, days: int = 30) -> str:
    """No try failed in the last ``days``: a mark that is older, or none."""
    return f"(missing['{what}'] is null or missing['{what}'] < date_sub(asof, {days}))"


def _asked(what: str, days: int) -> str:
    return f"(asked['{what}'] is null or asked['{what}'] < date_sub(asof, {days}))"


@dataclass(frozen=True)
class Backlog:
    """A condition on the standing row, the columns to ask by, and the facts that it reads.

    held: the least fund weight, where securities that no fund holds are left out. first: what comes before weight in the order.
    """

    where: str
    columns: tuple[str, ...]
    facts: tuple[str, ...] = ()
    held: float | None = None
    first: str | None = None


_EQUITY = "security_type_code = 'equity'"
_PRICED = ("symbol", "coalesce(own, symbol) as fetch_symbol")
_FETCH = ("fetch_symbol as symbol",)

#: Days after which what was done is stale, and fund weights from which it is done at all.
INSTANCES: dict[str, Backlog] = {
    "ticker": Backlog(f"{_EQUITY} and isin is not null and ticker is null and {_tried('ticker')}", ("isin", "name")),
    "local_symbol": Backlog(f"{_EQUITY} and isin is not null and own is null and country_iso2 <> 'US' and {_tried('local_symbol')}", ("country_iso2", "isin")),
    "home_symbol": Backlog(
        f"{_EQUITY} and isin is not null and country_iso2 is not null and {_tried('home_symbol')} and (fetch_symbol is null or missing['industry'] is not null or missing['profile'] is not null or missing['performance'] is not null)",
        ("isin", "country_iso2", "fetch_symbol as current_symbol"), first="fetch_symbol is null",
    ),
    "profile": Backlog(
        f"{_EQUITY} and fetch_symbol is not null and ((tagged is null and {_tried('profile')}) or (operating_country_iso2 is null and drillable is null and {_tried('provider_country')}))",
        ("fetch_symbol as symbol", "name", "case when tagged is null then 'sector' else 'country' end as want"), ("tagged", "drillable"),
    ),
    "profile_detail": Backlog(f"{_EQUITY} and fetch_symbol is not null and has_profile is null and {_tried('profile_detail')}", _FETCH, ("has_profile",)),
    "industry": Backlog(f"sector_id is not null and has_industry is null and fetch_symbol is not null and {_tried('industry')}", ("fetch_symbol as symbol", "sector_id"), ("sector", "has_industry")),
    "performance": Backlog(f"fetch_symbol is not null and fresh is null and {_tried('performance')}", ("served as symbol", "fetch_symbol"), ("performance",)),
    "prices": Backlog(f"{_EQUITY} and symbol is not null and (last_date is null or last_date < date_sub(asof, 2)) and {_tried('prices')}", (*_PRICED, "last_date"), ("bars",)),
    "price_history": Backlog(f"{_EQUITY} and symbol is not null and coalesce(weekly, 0) = 0 and {_tried('price_history')}", _PRICED, ("bars",)),
    "fundamentals": Backlog(f"{_EQUITY} and fetch_symbol is not null and has_fundamentals is null and {_tried('fundamentals')}", _FETCH, ("has_fundamentals",)),
    "statements": Backlog(
        f"{_EQUITY} and fetch_symbol is not null and {_tried('statements')} and (statements is null or (with_currency = 0 and ticker is not null and {_tried('statement_currency')}))",
        ("fetch_symbol as symbol", "ticker as us_ticker", "case when statements is null then 'missing' else 'no_currency' end as want"), ("statements",),
    ),
    "quarters": Backlog(f"{_EQUITY} and cik is null and fetch_symbol is not null and annual > 0 and quarterly = 0 and {_tried('quarters')}", _FETCH, ("statements",)),
    "xbrl": Backlog(f"{_EQUITY} and cik is not null and {_asked('xbrl', 30)} and {_tried('xbrl')}", ("cik",)),
    "corporate_actions": Backlog(f"{_EQUITY} and upper(ticker) = upper(symbol) and (last_action is null or last_action <= date_sub(asof, 30)) and {_tried('corporate_actions')}", ("ticker as symbol",), ("actions",)),
    "dividends": Backlog(f"{_EQUITY} and symbol is not null and (last_dividend is null or last_dividend <= date_sub(asof, 30)) and {_tried('dividends')}", _PRICED, ("actions",)),
    "share_stats": Backlog(f"{_EQUITY} and symbol is not null and (stats_at is null or stats_at <= date_sub(asof, 7)) and {_tried('share_stats')}", _PRICED, ("stats",)),
    "news": Backlog(f"{_EQUITY} and symbol is not null and {_asked('news', 7)}", _PRICED),
    "insider": Backlog(f"{_EQUITY} and cik is not null and {_asked('insider', 7)}", ("cik",)),
    "filings": Backlog(f"{_EQUITY} and cik is not null and {_asked('filings', 7)}", ("cik",)),
    "management": Backlog(f"{_EQUITY} and fetch_symbol is not null and {_asked('management', 180)}", _FETCH, held=0.5),
    "eps_history": Backlog(f"{_EQUITY} and ticker not like '%.%' and us_listed is not null and {_asked('eps_history', 90)}", ("ticker as symbol",), ("us_listed",), held=1.0),
    "symbol_repair": Backlog(
        f"{_EQUITY} and symbol is not null and (missing['prices'] is not null or missing['price_history'] is not null or missing['performance'] is not null) and {_tried('symbol_repair')}", _PRICED
    ),
}


def entities(securities: DataFrame, identifiers: DataFrame, provider: DataFrame, symbols: DataFrame) -> DataFrame:
    """A row for each security, and for each of its ISINs and tickers: what backlogs test and ask by.

    own is the provider's symbol, symbol the one that the security is served under; fetch_symbol and served fall back from these to the ticker.
    """
    of = lambda kind: identifiers.where(F.col("kind") == kind).select("security_id", F.col("value").alias(kind))
    rows = securities.select("security_id", "name", "security_type_code", "country_iso2", "operating_country_iso2", "cik")
    for other in (of("isin"), of("ticker"), provider.select("security_id", F.col("symbol").alias("own")), symbols.select("security_id", "symbol")):
        rows = rows.join(other, "security_id", "left")
    return rows.withColumn("fetch_symbol", F.coalesce("own", "ticker")).withColumn("served", F.coalesce("symbol", "own", "ticker"))


def _latest(rows: DataFrame, at: str, name: str) -> DataFrame:
    """(security_id, name): a map from what to its latest date. There are as many whats as backlogs."""
    last = rows.groupBy("security_id", "what").agg(F.max(at).alias("at"))
    return last.groupBy("security_id").agg(F.map_from_entries(F.collect_list(F.struct("what", "at"))).alias(name))


def bar_facts(bars: DataFrame) -> DataFrame:
    return bars.groupBy("security_id").agg(F.max("date").alias("last_date"), F.count(F.when(F.col("grain") == "weekly", 1)).alias("weekly"))


def statement_facts(statements: DataFrame) -> DataFrame:
    of = lambda p: F.count(F.when(F.col("period_type") == p, 1))
    return statements.groupBy("security_id").agg(F.count("*").alias("statements"), F.count("currency_code").alias("with_currency"), of("annual").alias("annual"), of("quarter").alias("quarterly"))


def action_facts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("security_id").agg(F.max("as_of").alias("last_action"), F.max(F.when(F.col("kind") == "dividend", F.col("as_of"))).alias("last_dividend"))


def there(rows: DataFrame, name: str, key: str = "security_id") -> DataFrame:
    """(key, name): true for each key that has a row."""
    return rows.select(key).distinct().withColumn(name, F.lit(True))


#: Facts that aren't joined by security.
_FACT_KEYS = {"performance": "served", "drillable": "country_iso2"}


def pending(name: str, rows: DataFrame, marks: DataFrame, asked: DataFrame, weights: DataFrame, asof: dt.date, facts: dict[str, DataFrame] | None = None) -> DataFrame:
    """The backlog ``name`` of INSTANCES: security_id, what to ask by, best_weight, the greatest fund weight first, then by id.

    rows: entities(). marks: security_id, what, marked_at of failed tries. asked: security_id, what, asked_at. weights:
    security_id, best_weight. facts: by name the tables that INSTANCES says it reads, with one row for each key;
    no others are joined.
    """
    job = INSTANCES[name]
    rows = rows.join(weights, "security_id", "left" if job.held is None else "inner")
    if "missing[" in job.where:
        rows = rows.join(_latest(marks, "marked_at", "missing"), "security_id", "left")
    if "asked[" in job.where:
        rows = rows.join(_latest(asked, "asked_at", "asked"), "security_id", "left")
    for fact in job.facts:
        rows = rows.join((facts or {})[fact], _FACT_KEYS.get(fact, "security_id"), "left")
    rows = rows.withColumn("asof", F.lit(asof)).where(job.where).withColumn("best_weight", F.coalesce("best_weight", F.lit(0.0)))
    if job.held is not None:
        rows = rows.where(F.col("best_weight") >= job.held)
    order = [F.desc("best_weight"), F.asc("security_id")]
    if job.first:
        order.insert(0, F.expr(job.first).desc())
    return rows.orderBy(*order).selectExpr("security_id", *job.columns, "best_weight")


def pending_fx_history(currencies: DataFrame, rates: DataFrame, marks: DataFrame, asof: dt.date, days: int = 90, again_days: int = 30) -> DataFrame:
    """Currencies other than USD without a rate older than ``days``, unless a try failed in the last again_days. marks: currency_code, marked_at."""
    old = rates.where(F.col("as_of") < F.date_sub(F.lit(asof), days)).select("currency_code")
    tried = marks.where(F.col("marked_at") >= F.date_sub(F.lit(asof), again_days)).select("currency_code")
    return currencies.where("currency_code <> 'USD'").join(old, "currency_code", "left_anti").join(tried, "currency_code", "left_anti").select("currency_code")


def clear_marks(marks: DataFrame, changed: DataFrame, symbol_keyed: list[str]) -> DataFrame:
    """Marks without those that were keyed by a symbol which has changed since."""
    gone = changed.select("security_id", "changed_at")
    rows = marks.join(gone, "security_id", "left")
    stale = F.col("what").isin(symbol_keyed) & F.col("changed_at").isNotNull() & (F.col("changed_at") > F.col("marked_at"))
    return rows.where(~F.coalesce(stale, F.lit(False))).select(*marks.columns)


def clear_contradicted(marks: DataFrame, bars: DataFrame, asof: dt.date, days: int = 5) -> DataFrame:
    """Marks without failed performance of securities that have a bar of the last ``days``: a mark is no evidence against data."""
    recent = bars.where(F.col("date") >= F.date_sub(F.lit(asof), days)).select("security_id", F.lit("performance").alias("what")).distinct()
    return marks.join(recent, ["security_id", "what"], "left_anti").select(*marks.columns)


def listing_counts(counters: DataFrame, listings: DataFrame) -> DataFrame:
    """Counters that disagree with the rows counted, with both numbers."""
    n = listings.groupBy("exch_code").agg(F.count("*").alias("actual"))
    rows = counters.join(n, "exch_code", "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    return rows.where(~F.col("stored").eqNullSafe(F.col("actual"))).select("exch_code", "stored", "actual")


def retract_periods(performance: DataFrame, produced: DataFrame) -> DataFrame:
    """Performance without periods that a refreshed scope no longer produces; other scopes stay."""
    refreshed = produced.select("scope_id").distinct()
    gone = performance.join(refreshed, "scope_id", "left_semi").join(produced, ["scope_id", "period"], "left_anti").select("scope_id", "period")
    return performance.join(gone, ["scope_id", "period"], "left_anti")
