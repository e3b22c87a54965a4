"""Funds, what they hold, and what their holdings say about securities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.common import ratio, round4, top1


def holdings_current(holdings: DataFrame) -> DataFrame:
    """Rows at each fund's latest date."""
    latest = holdings.groupBy("fund_symbol").agg(F.max("as_of").alias("as_of"))
    return holdings.join(latest, ["fund_symbol", "as_of"])


def best_node(nodes: DataFrame, sources: DataFrame, level: int) -> DataFrame:
    """(security_id, node_id): each security's node of a level, by source priority, then date."""
    ranked = nodes.where(F.col("level") == level).join(sources, "source_code", "left")
    return top1(ranked, ["security_id"], F.desc_nulls_last("priority"), F.desc("as_of"), "node_id").select("security_id", "node_id")


def _weights(rows: DataFrame, bucket: str) -> DataFrame:
    out = rows.groupBy("fund_symbol", bucket).agg(F.sum("weight").alias("weight"), F.max("as_of").alias("as_of"))
    total = F.sum("weight").over(Window.partitionBy("fund_symbol"))
    return out.select("fund_symbol", bucket, F.col("weight").cast("double").alias("weight"), round4(100 * ratio(F.col("weight"), total)).alias("weight_pct"), "as_of")


def _outside(holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """Current holdings without a fund's holding of itself."""
    own = funds.select("fund_symbol", F.col("security_id").alias("own_id"))
    held = holdings_current(holdings).join(own, "fund_symbol", "left")
    return held.where(~F.col("security_id").eqNullSafe(F.col("own_id"))).drop("own_id")


def fund_sector_weight(holdings: DataFrame, funds: DataFrame, securities: DataFrame, nodes: DataFrame, sources: DataFrame) -> DataFrame:
    """Each fund's equity weight by sector, with the share of its equities."""
    equities = securities.where("security_type_code = 'equity'").select("security_id")
    held = _outside(holdings, funds).join(equities, "security_id").join(best_node(nodes, sources, 1), "security_id", "left")
    return _weights(held.withColumn("sector_id", F.coalesce("node_id", F.lit("unclassified"))), "sector_id")


def fund_country_weight(holdings: DataFrame, funds: DataFrame, securities: DataFrame) -> DataFrame:
    """Each fund's weight by country: where a company operates, then where it is filed, then XX."""
    place = securities.select("security_id", F.coalesce("operating_country_iso2", "country_iso2", F.lit("XX")).alias("country_iso2"))
    return _weights(_outside(holdings, funds).join(place, "security_id"), "country_iso2")


def fund_holdings(holdings: DataFrame, funds: DataFrame, securities: DataFrame, symbols: DataFrame) -> DataFrame:
    """What each fund holds."""
    return _outside(holdings, funds).join(securities, "security_id").join(symbols, "security_id", "left").select(
        "fund_symbol", "security_id", "name", "symbol", "country_iso2", "security_type_code", "currency_code",
        F.col("weight").cast("double").alias("weight"), F.col("market_value").cast("double").alias("market_value"), "as_of",
    )


def security_funds(holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """Which funds hold each security."""
    named = funds.select("fund_symbol", F.col("name").alias("fund_name"), F.col("kind").alias("fund_kind"), "represents_code")
    return _outside(holdings, funds).join(named, "fund_symbol").select(
        "security_id", "fund_symbol", "fund_name", "fund_kind", "represents_code", F.col("weight").cast("double").alias("weight"), "as_of"
    )


def merge_lots(lots: DataFrame) -> DataFrame:
    """One row for each (fund, security, date); amounts add, null only if all are."""
    return lots.groupBy("fund_symbol", "security_id", "as_of").agg(F.sum("weight").alias("weight"), F.sum("market_value").alias("market_value"))


def max_weight(holdings: DataFrame) -> DataFrame:
    """(security_id, best_weight): the greatest current weight that any fund gives a security."""
    return holdings_current(holdings).groupBy("security_id").agg(F.max("weight").cast("double").alias("best_weight"))


def type_from_filing(holdings: DataFrame, securities: DataFrame) -> DataFrame:
    """Types of securities of type 'other' on whose filed category all holdings agree."""
    from tapeworks.functions.rules import asset_type

    agreed = holdings.groupBy("security_id").agg(F.countDistinct("asset_category").alias("kinds"), F.max("asset_category").alias("category")).where("kinds = 1")
    untyped = securities.where("security_type_code = 'other'").select("security_id")
    return untyped.join(agreed, "security_id").select("security_id", asset_type(F.col("category"), F.lit(None).cast("string")).alias("security_type_code")).where("security_type_code <> 'other'")


def derive_classifications(holdings: DataFrame, funds: DataFrame, securities: DataFrame) -> DataFrame:
    """(security_id, what, code, as_of): a sector tag of an equity for each sector whose fund holds it, and the country of a
    country fund for a security without a filed one. A fund's holding of itself counts for nothing.

    Of several country funds the one of greatest weight decides, then the first by symbol.
    """
    held = _outside(holdings, funds).join(funds.where("represents_code is not null").select("fund_symbol", "kind", "represents_code"), "fund_symbol").join(
        securities.select("security_id", "security_type_code", "country_iso2"), "security_id"
    )
    sector = held.where("kind = 'sector' and security_type_code = 'equity'").groupBy("security_id", F.col("represents_code").alias("code")).agg(F.max("as_of").alias("as_of"))
    country = top1(held.where("kind = 'country' and country_iso2 is null"), ["security_id"], F.desc("weight"), F.asc("fund_symbol"))
    return sector.select("security_id", F.lit("sector").alias("what"), "code", "as_of").unionByName(
        country.select("security_id", F.lit("country").alias("what"), F.col("represents_code").alias("code"), "as_of")
    )


def sector_constituents(holdings: DataFrame, funds: DataFrame, securities: DataFrame, nodes: DataFrame, sources: DataFrame, symbols: DataFrame) -> DataFrame:
    """One row for each (sector, security), with the industry below that sector and the weight in the sector's fund."""
    ranked = nodes.join(sources, "source_code", "left")
    order = (F.desc_nulls_last("priority"), F.desc("as_of"), F.asc("node_id"))
    member = top1(ranked.where("level = 1"), ["node_id", "security_id"], F.desc_nulls_last("priority"), F.desc("as_of")).select("security_id", F.col("node_id").alias("sector_id"))
    industry = top1(ranked.where("level = 2"), ["security_id", "parent_id"], *order).select("security_id", F.col("parent_id").alias("sector_id"), F.col("node_id").alias("industry"))
    held = holdings_current(holdings).join(funds.where("kind = 'sector'").select("fund_symbol", F.col("represents_code").alias("sector_id")), "fund_symbol")
    held = top1(held, ["sector_id", "security_id"], F.desc("weight"), F.asc("fund_symbol")).select("sector_id", "security_id", F.col("weight").cast("double").alias("weight"), "fund_symbol", F.col("market_value").cast("double").alias("market_value"), "as_of")
    return (
        member.join(securities.select("security_id", "name", "country_iso2", "market_cap", "currency_code"), "security_id")
        .join(symbols, "security_id", "left").join(industry, ["security_id", "sector_id"], "left").join(held, ["sector_id", "security_id"], "left")
        .select("sector_id", "security_id", "name", "symbol", "country_iso2", "industry", "weight", "fund_symbol", "market_cap", "currency_code", "market_value", "as_of")
    )


def country_sector_performance(holdings: DataFrame, funds: DataFrame, securities: DataFrame, nodes: DataFrame, sources: DataFrame, symbols: DataFrame, performance: DataFrame) -> DataFrame:
    """Fund-weighted returns of the sectors of each country: of equities with a symbol that a fund of their own country holds, once each.

    A company's country is where it operates, else where it is filed. Of several funds of a country that of
    greatest weight counts. weight_covered is the weight of what has a row of the period.
    """
    effective = F.coalesce("operating_country_iso2", "country_iso2").alias("country_iso2")
    sec = securities.where("security_type_code = 'equity'").select("security_id", effective).join(symbols.where("symbol is not null").select("security_id"), "security_id")
    sec = sec.join(best_node(nodes, sources, 1).withColumnRenamed("node_id", "sector_id"), "security_id")
    own = funds.where("kind = 'country'").select("fund_symbol", F.col("represents_code").alias("country_iso2"))
    held = holdings_current(holdings).where("weight > 0").select("fund_symbol", "security_id", "weight").join(own, "fund_symbol")
    held = top1(sec.join(held, ["security_id", "country_iso2"]), ["security_id"], F.desc("weight"), F.asc("fund_symbol"))
    w, c, t = F.col("weight"), F.col("change_pct").cast("decimal(18,4)"), F.col("total_return_pct").cast("decimal(18,4)")
    out = held.join(performance, "security_id").groupBy("country_iso2", "sector_id", "period").agg(
        F.sum(w * c).alias("wc"), F.sum(w).alias("w"), F.sum(F.when(t.isNotNull(), w * t)).alias("wt"), F.sum(F.when(t.isNotNull(), w)).alias("tw"),
        F.count("*").alias("constituents"), F.count(t).alias("total_return_constituents"), F.min("fund_symbol").alias("fund_symbol"), F.max("as_of").alias("as_of"),
    )
    return out.select(
        "country_iso2", "sector_id", "period", round4(ratio(F.col("wc"), F.col("w"))).alias("change_pct"), round4(ratio(F.col("wt"), F.col("tw"))).alias("total_return_pct"),
        "constituents", "total_return_constituents", round4(F.col("w")).alias("weight_covered"), "fund_symbol", "as_of",
    )


def fund_ingest(filed: DataFrame, known: DataFrame, stored: DataFrame) -> DataFrame:
    """Holdings of filings resolved to securities, lots of one security added up, and written over what is stored.

    filed: holding_id, fund_symbol, as_of, weight, market_value, isin, cusip, figi. A (fund, security, date) that is filed
    again replaces its stored row, and other rows stay; holdings without a valid identifier are left out.
    """
    from tapeworks.operators.identity import resolve_securities

    ids = resolve_securities(filed, known).select("holding_id", "security_id")
    new = merge_lots(filed.join(ids, "holding_id").select("fund_symbol", "security_id", "as_of", "weight", "market_value"))
    kept = stored.join(new, ["fund_symbol", "security_id", "as_of"], "left_anti")
    return kept.select(new.columns).unionByName(new)


def ingest_report(filed: DataFrame, known: DataFrame) -> DataFrame:
    """(fund_symbol, as_of, filed, holdings, securities_added, skipped) of fund_ingest(): what a filing held, what it became, and what was left out."""
    from tapeworks.operators.identity import resolve_securities

    rows = filed.join(resolve_securities(filed, known), "holding_id", "left")
    return rows.groupBy("fund_symbol", "as_of").agg(
        F.count("*").alias("filed"), F.countDistinct("security_id").alias("holdings"), F.countDistinct(F.when(~F.col("matched"), F.col("security_id"))).alias("securities_added"), F.count(F.when(F.col("security_id").isNull(), 1)).alias("skipped")
    )
