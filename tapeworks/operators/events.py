"""Earnings, insiders, filings, officers and news."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import rules
from tapeworks.functions.common import ratio, round4, top1


#: Columns that make up the key of a trade: the same owner may trade twice a day, at two prices or in two kinds of security.
TRADE_KEY = ("security_id", "transaction_date", "owner_name", "direction", "security_type", "shares", "price")


def insider_keyed(trades: DataFrame) -> DataFrame:
    """Trades with a date, keyed by a hash of what tells two trades apart; of repeats the row of least other columns stays.

    A column of the key that ``trades`` lacks counts as empty.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) if c in trades.columns else F.lit("") for c in TRADE_KEY]
    rows = trades.where("transaction_date is not null").withColumn("trade_key", F.sha2(F.concat_ws("|", *parts), 256))
    return top1(rows, ["trade_key"], *[F.asc_nulls_last(c) for c in trades.columns])


def insider_summary(trades: DataFrame, asof: dt.date, days: int = 90) -> DataFrame:
    """Trades of the last ``days`` by security. net_shares is 0 where there are neither buys nor sells."""
    rows = trades.where(F.col("transaction_date") >= F.date_sub(F.lit(asof), days))
    buy, sell = F.col("direction") == "Acquisition", F.col("direction") == "Disposition"
    total = lambda side: F.coalesce(F.sum(F.when(side, F.col("shares"))), F.lit(0))
    return rows.groupBy("security_id").agg(
        F.count(F.when(buy, 1)).alias("buys"), F.count(F.when(sell, 1)).alias("sells"), F.countDistinct(F.when(buy, F.col("owner_name"))).alias("buyers"), F.countDistinct(F.when(sell, F.col("owner_name"))).alias("sellers"),
        (total(buy) - total(sell)).cast("double").alias("net_shares"), F.max("transaction_date").alias("latest"), F.count("*").alias("trades"),
    )


def earnings_load(calendar: DataFrame, symbols: DataFrame) -> DataFrame:
    """Calendar rows with symbol and date; unknown symbols stay, with a null id."""
    return calendar.where("symbol is not null and report_date is not null").join(symbols, "symbol", "left")


def earnings_surprise(calendar: DataFrame, metrics: DataFrame, asof: dt.date) -> DataFrame:
    """Actual diluted quarterly EPS of reports up to ``asof`` against consensus; the quarter may end a week around its month.

    Meeting the consensus is a beat. surprise_pct is over the consensus's size, null where that is 0.
    """
    eps = metrics.where("metric_code = 'eps_diluted' and period_type = 'quarter'").select("security_id", F.col("as_of").alias("period_end_date"), F.col("value").alias("actual"))
    # the months that a quarter's end is within a week of, two at most: an equal join, so a security's reports don't meet all of its quarters
    near = F.array_distinct(F.transform(F.array(F.lit(-7), F.lit(7)), lambda d: F.trunc(F.date_add("period_end_date", d), "month")))
    eps = eps.select("*", F.explode(near).alias("month"))
    rows = calendar.where(F.col("eps_consensus").isNotNull() & (F.col("report_date") <= F.lit(asof))).withColumn("month", F.to_date("period_ending", "yyyy-MM")).join(eps, ["security_id", "month"])
    diff = F.col("actual") - F.col("eps_consensus")
    pct = F.round((100 * ratio(diff, F.abs("eps_consensus"))).cast("decimal(28,10)"), 2).cast("double")
    return rows.select(
        "security_id", "symbol", "report_date", "period_ending", "period_end_date", F.col("eps_consensus").cast("double").alias("expected"), F.col("actual").cast("double").alias("actual"),
        diff.cast("double").alias("surprise"), pct.alias("surprise_pct"), (diff >= 0).alias("beat"),
    )


def next_earnings(calendar: DataFrame, asof: dt.date) -> DataFrame:
    """The nearest upcoming report of each security, else its latest past one."""
    rows = calendar.where("security_id is not null").withColumn("upcoming", F.col("report_date") >= F.lit(asof))
    rows = top1(rows, ["security_id"], F.desc("upcoming"), F.abs(F.datediff("report_date", F.lit(asof))).asc(), F.asc("symbol"), F.asc("report_date"))
    number = lambda c: F.col(c).cast("double").alias(c)
    return rows.select("security_id", "symbol", "report_date", number("eps_consensus"), number("eps_previous"), "num_estimates", "reporting_time", "period_ending", "upcoming", "as_of")


def prune_earnings(calendar: DataFrame, asof: dt.date, days: int = 90) -> DataFrame:
    """A calendar and no archive: reports of the last ``days`` and to come."""
    return calendar.where(F.col("report_date") >= F.date_sub(F.lit(asof), days))


def filings(rows: DataFrame, symbols: DataFrame) -> DataFrame:
    return rows.where("accession is not null").join(symbols, "security_id", "left").select("security_id", "symbol", "accession", "form", "filed", rules.filing_kind(F.col("form")).alias("kind"))


def officer_clean(officers: DataFrame, asof: dt.date) -> DataFrame:
    """Pay above 0, birth years after 1900, ages above 0; else null."""
    return officers.where("name is not null").select(
        "security_id", "name", "title", F.when(F.col("pay") > 0, F.col("pay")).alias("pay"), F.when(F.col("born") > 1900, F.col("born")).alias("born"),
        F.when(F.lit(asof.year) - F.col("born") > 0, F.when(F.col("born") > 1900, F.lit(asof.year) - F.col("born"))).alias("age"), *(["fiscal_year"] if "fiscal_year" in officers.columns else []),
    )


def leadership(officers: DataFrame, securities: DataFrame) -> DataFrame:
    """Officers with the CEO flag and the currency of their pay. officers: security_id, name, title, pay, age, fiscal_year."""
    sec = securities.select("security_id", "currency_code", F.coalesce("operating_country_iso2", "country_iso2").alias("country"), "filed_currency")
    pay_currency = rules.reporting_currency(F.col("filed_currency"), F.col("currency_code"), F.col("country"))
    return officers.join(sec, "security_id").select("security_id", "name", "title", "pay", "age", "fiscal_year", rules.is_ceo(F.col("title")).alias("is_ceo"), pay_currency.alias("pay_currency"))


def news_split(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articles, links): both without repeats, from rows that have url, date, title and security."""
    good = articles.where("url is not null and published_at is not null and title is not null and security_id is not null")
    one = top1(good, ["url"], F.asc("published_at"), F.asc("title")).select("url", "published_at", "title", "source", *(["summary"] if "summary" in articles.columns else []))
    return one, good.select("url", "security_id").distinct()


def security_news(articles: DataFrame, links: DataFrame, symbols: DataFrame) -> DataFrame:
    """Articles of the securities that have a symbol."""
    return links.join(articles, "url").join(symbols.where("symbol is not null"), "security_id").select("security_id", "symbol", "url", "title", "source", "summary", "published_at")


def prune_news(articles: DataFrame, links: DataFrame, asof: dt.date, days: int = 90) -> tuple[DataFrame, DataFrame]:
    """Articles of the last ``days``, and the links that still have an article."""
    kept = articles.where(F.col("published_at") >= F.date_sub(F.lit(asof), days))
    return kept, links.join(kept, "url", "left_semi")
