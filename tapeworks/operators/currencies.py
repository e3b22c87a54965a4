"""Exchange rates, market caps in USD, and which currency a security is in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions import rules
from tapeworks.functions.common import round4, top1

IMPOSSIBLE_CAP = 2e12


def fx_current(rates: DataFrame) -> DataFrame:
    """The latest rate of each currency."""
    return top1(rates, ["currency_code"], F.desc("as_of"), F.desc("usd_per_unit"))


def fx_subunits(rates: DataFrame) -> DataFrame:
    """Rates with those of minor currencies appended: the rate of the major one, divided."""
    minor = rates.sparkSession.createDataFrame(list(rules.SUBUNITS), "minor string, currency_code string, per int")
    added = rates.join(minor, "currency_code").select(F.col("minor").alias("currency_code"), "as_of", (F.col("usd_per_unit") / F.col("per")).alias("usd_per_unit"), F.col("currency_code").alias("derived_from"))
    return rates.select("currency_code", "as_of", "usd_per_unit", F.lit(None).cast("string").alias("derived_from")).unionByName(added)


def fx_history(rates: DataFrame, least_points: int = 8) -> DataFrame:
    """Plausible rates with those of minor currencies; has_history says whether a currency has enough of them."""
    good = fx_subunits(rates.where(rules.plausible_rate(F.col("usd_per_unit"))))
    points = F.count("*").over(Window.partitionBy("currency_code"))
    return good.withColumn("has_history", points >= least_points)


def market_cap_usd(securities: DataFrame, rates: DataFrame) -> DataFrame:
    """Caps at the latest rate; USD passes through, and without a rate the cap is null."""
    fx = fx_current(rates).select("currency_code", "usd_per_unit", F.col("as_of").alias("fx_as_of"))
    rate = F.when(F.col("currency_code") == "USD", F.lit(1.0)).otherwise(F.col("usd_per_unit"))
    return securities.join(fx, "currency_code", "left").select(
        "security_id", F.col("market_cap").alias("market_cap_native"), "currency_code", round4(F.col("market_cap").cast("double") * rate).alias("market_cap_usd"), "fx_as_of"
    )


def venue_currency(securities: DataFrame, least: int = 5, share: float = 0.6) -> DataFrame:
    """Of each venue suffix the currency that most of its securities have, if they are enough and agree."""
    known = securities.where("currency_code is not null").withColumn("suffix", rules.suffix(F.col("symbol"))).where("suffix <> ''")
    counts = known.groupBy("suffix", "currency_code").agg(F.count("*").alias("agreeing"))
    counts = counts.withColumn("securities", F.sum("agreeing").over(Window.partitionBy("suffix")))
    best = top1(counts, ["suffix"], F.desc("agreeing"), F.asc("currency_code"))
    return best.where((F.col("securities") >= least) & (F.col("agreeing") > share * F.col("securities"))).select("suffix", F.col("currency_code").alias("quote_currency"), "agreeing", "securities")


def currency_repair(securities: DataFrame, venues: DataFrame) -> DataFrame:
    """Securities that claim an impossible cap in USD on a venue of another currency: previous and repaired code."""
    claims = securities.where((F.col("currency_code") == "USD") & (F.col("market_cap") > IMPOSSIBLE_CAP)).withColumn("suffix", rules.suffix(F.col("symbol")))
    return claims.join(venues.where("quote_currency <> 'USD'"), "suffix").select("security_id", F.col("currency_code").alias("previous"), F.col("quote_currency").alias("repaired"), "suffix")


def security_currency(securities: DataFrame, listings: DataFrame) -> DataFrame:
    """The currency of the primary listing, else of the security, and which it was."""
    primary = listings.where("is_primary").select("security_id", F.col("currency_code").alias("listed"), F.col("exch_code").alias("venue"))
    return securities.join(primary, "security_id", "left").select(
        "security_id", F.coalesce("listed", "currency_code").alias("currency_code"),
        F.when(F.col("listed").isNotNull(), "listing").when(F.col("currency_code").isNotNull(), "security").alias("source"), "venue",
    )
