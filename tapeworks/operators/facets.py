"""The spine of security facets, style, peers, and aggregates over any facet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.common import optional_filters, ratio, round4, top1
from tapeworks.functions.rules import cap_band
from tapeworks.functions.scans import blocks_with_halo
from tapeworks.functions.scratch import stored
from tapeworks.operators.currencies import market_cap_usd, security_currency
from tapeworks.operators.funds import best_node, holdings_current

#: Columns of the spine that group countries, and the scheme and lens of each.
LENSES = {
    "msci_tier": ("msci", "tier"), "msci_region": ("msci", "region"), "ftse_tier": ("ftse", "tier"), "ftse_region": ("ftse", "region"),
    "income_group": ("world-bank", "tier"), "wb_region": ("world-bank", "region"), "un_region": ("un", "region"),
}
VALUE_FROM, GROWTH_TO, LEAST_COHORT = 0.29, 0.10, 30
#: Levels of cap that one task looks for neighbours in.
BLOCK_LEVELS = 10_000


def country_lens(members: DataFrame) -> DataFrame:
    """Countries with a column for each (scheme, lens). members: scheme, lens, iso2, group_id."""
    return members.groupBy(F.col("iso2").alias("country_iso2")).agg(*[F.max(F.when((F.col("scheme") == s) & (F.col("lens") == v), F.col("group_id"))).alias(name) for name, (s, v) in LENSES.items()])


def index_label(holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """(security_id, index_style): growth or value if only funds of that style hold it, blend if both do."""
    held = holdings_current(holdings).join(funds.where("style is not null").select("fund_symbol", "style"), "fund_symbol")
    n = held.groupBy("security_id").agg(F.count(F.when(F.col("style") == "growth", 1)).alias("g"), F.count(F.when(F.col("style") == "value", 1)).alias("v"))
    return n.select("security_id", F.when((F.col("g") > 0) & (F.col("v") > 0), "blend").when(F.col("g") > 0, "growth").otherwise("value").alias("index_style"))


def style(spine: DataFrame, fundamentals: DataFrame, labels: DataFrame) -> DataFrame:
    """Rank of book-to-price within tier and cap band; membership of an index overrides it.

    spine: security_id, security_type_code, msci_tier, market_cap_usd. Cohorts of fewer than 30 give no row. Ranks are
    running sums over a cohort's counts of equal values, not over its securities.
    """
    rows = spine.select("security_id", "security_type_code", "msci_tier", "market_cap_usd").join(fundamentals.select("security_id", "price_to_book"), "security_id")
    rows = rows.where("security_type_code = 'equity' and price_to_book > 0 and market_cap_usd > 0 and msci_tier is not null")
    rows = rows.withColumn("book_to_price", 1 / F.col("price_to_book")).withColumn("cohort", F.concat_ws("/", "msci_tier", cap_band(F.col("market_cap_usd"))))
    counts = rows.groupBy("cohort", "book_to_price").agg(F.count("*").alias("n"))
    cohort = Window.partitionBy("cohort")
    below = F.coalesce(F.sum("n").over(cohort.orderBy("book_to_price").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("cohort", "book_to_price", below.alias("below"), F.sum("n").over(cohort).alias("cohort_size")).where(F.col("cohort_size") >= LEAST_COHORT)
    rows = rows.join(counts, ["cohort", "book_to_price"])
    rows = rows.withColumn("value_score", F.col("below") / (F.col("cohort_size") - 1)).join(labels, "security_id", "left")
    scored = F.when(F.col("value_score") >= VALUE_FROM, "value").when(F.col("value_score") <= GROWTH_TO, "growth").otherwise("blend")
    return rows.select(
        "security_id", round4(F.col("value_score")).alias("value_score"), round4(F.col("book_to_price")).alias("book_to_price"), "cohort", "cohort_size", F.coalesce("index_style", scored).alias("style"),
        F.when(F.col("index_style").isNotNull(), "index").otherwise("composite").alias("style_source"),
        F.when(F.col("index_style").isNotNull(), "high").when(F.col("value_score") >= VALUE_FROM, "moderate").otherwise("low").alias("style_confidence"),
    )


def facet_base(
    securities: DataFrame, nodes: DataFrame, sources: DataFrame, symbols: DataFrame, lenses: DataFrame, rates: DataFrame, listings: DataFrame, countries: DataFrame, labels: DataFrame, terms: DataFrame,
) -> DataFrame:
    """facets() without the columns of style, which are ranked from it."""
    sector = best_node(nodes, sources, 1).withColumnRenamed("node_id", "sector_id")
    industry = best_node(nodes, sources, 2).withColumnRenamed("node_id", "industry_id")
    caps = market_cap_usd(securities, rates).select("security_id", "market_cap_usd")
    currency = security_currency(securities, listings).select("security_id", "currency_code", F.col("source").alias("currency_source"))
    rows = securities.drop("currency_code").withColumn("country_iso2", F.coalesce("operating_country_iso2", "country_iso2")).join(caps, "security_id").join(currency, "security_id")
    joined = ((sector, "security_id"), (industry, "security_id"), (symbols, "security_id"), (lenses, "country_iso2"), (countries, "country_iso2"), (labels, "industry_id"), (terms, "security_id"))
    for other, key in joined:
        rows = rows.join(other, key, "left")
    return rows.select(
        "security_id", "symbol", "name", "security_type_code", "sector_id", "industry_id", "industry", "country_iso2", "country_name", "app_region_id", "country_market", *LENSES, "currency_code", "currency_source",
        F.col("market_cap").alias("market_cap_native"), "market_cap_usd", cap_band(F.col("market_cap_usd")).alias("cap_band"), "maturity_date", "coupon_rate", "coupon_kind", "in_default", "is_tradeable",
    )


def facets(base: DataFrame, fundamentals: DataFrame, holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """The read model: one row for each security with all that it can be grouped and filtered by.

    base: facet_base(), of countries: country_iso2, country_name, app_region_id, country_market; labels: industry_id,
    industry; terms: security_id, maturity_date, coupon_rate, coupon_kind, in_default. The currency is that of the primary
    listing, else the security's, and currency_source says which.
    """
    styles = style(base, fundamentals, index_label(holdings, funds)).withColumnRenamed("cohort", "style_cohort")
    return base.join(styles.select("security_id", "style", "style_source", "style_confidence", "value_score", "style_cohort"), "security_id", "left")


#: Columns that securities can be grouped by; industry_id is an industry's code and industry its label.
FACETS = (
    "sector_id", "industry", "industry_id", "country_iso2", "msci_tier", "msci_region", "ftse_tier", "ftse_region", "income_group", "wb_region", "app_region_id",
    "cap_band", "style", "security_type_code", "un_region", "currency_code",
)


def aggregate_performance(spine: DataFrame, performance: DataFrame, period: str, group_by: str, lists: dict | None = None, ranges: dict | None = None) -> DataFrame:
    """Cap-weighted and equal-weighted returns of each bucket of a facet, and how much of the bucket they cover.

    A bucket without any return stays, with its size and null returns.
    """
    if group_by not in FACETS:
        raise ValueError(f"unknown facet {group_by}")
    rows = optional_filters(spine, lists or {}, ranges).where(F.col(group_by).isNotNull())
    perf = performance.where(F.col("period") == period).select("security_id", F.col("change_pct").cast("decimal(18,4)").alias("c"), F.col("total_return_pct").cast("decimal(18,4)").alias("t"), F.col("as_of").alias("at"))
    rows = rows.join(perf, "security_id", "left").withColumn("cap", F.when(F.col("market_cap_usd") > 0, F.col("market_cap_usd").cast("decimal(18,0)")))
    cap, c, t = F.col("cap"), F.col("c"), F.col("t")
    part = F.abs(cap * c)
    top = F.struct(part.alias("p"), F.negative("security_id").alias("i"))
    out = rows.groupBy(F.col(group_by).alias("bucket")).agg(
        F.sum(cap * c).alias("wc"), F.sum(F.when(c.isNotNull(), cap)).alias("w"), F.sum(cap * t).alias("wt"), F.sum(F.when(t.isNotNull(), cap)).alias("tw"),
        F.sum(c).alias("plain"), F.count(c).alias("constituents"), F.count(t).alias("total_return_constituents"), F.count("*").alias("bucket_securities"),
        F.sum(cap).alias("bucket_cap"), F.max_by("symbol", F.when(part.isNotNull(), top)).alias("top_contributor"), F.max(part).alias("most"), F.sum(part).alias("all"), F.max("at").alias("as_of"),
    )
    return out.select(
        "bucket", round4(ratio(F.col("wc"), F.col("w"))).alias("change_pct"), round4(ratio(F.col("plain"), F.col("constituents"))).alias("change_pct_equal"), round4(ratio(F.col("wt"), F.col("tw"))).alias("total_return_pct"),
        "constituents", "total_return_constituents", "bucket_securities", round4(ratio(F.col("w"), F.col("bucket_cap"))).alias("weight_covered"), "top_contributor", round4(ratio(F.col("most"), F.col("all"))).alias("top_contributor_share"), "as_of",
    )


def _nearest(level: Column, k: Column | int) -> Column:
    """The first k of an array of peers in the order of rounded distance and id."""
    return F.slice(F.array_sort(level), 1, k)


def _sized(members: Column, peer_cap: Column, cap: Column) -> Column:
    """Members of a level as peers of a level of ``cap``: rounded distance and id come first, to sort by."""
    d = F.abs(F.log10(peer_cap / cap))
    return F.transform(
        members,
        lambda m: F.struct(F.round(d, 9).alias("rounded"), m["security_id"].alias("peer_id"), m["name"].alias("peer_name"), m["symbol"].alias("peer_symbol"), peer_cap.alias("peer_market_cap_usd"), d.alias("d")),
    )


def peers(spine: DataFrame, k: int = 5) -> DataFrame:
    """Each security's k nearest in its sector by the size of the log ratio of caps; ties in distance, rounded to 9
    decimals, go to the lesser id.

    A level is a cap of a sector with its k + 1 least ids, the most that can be asked of it. The k + 1 levels below
    and above hold the k nearest of a level's members, other than itself, unless the last of them ties with the
    last that is taken: only such levels meet all levels of that distance.
    """
    rows = spine.where("sector_id is not null and market_cap_usd > 0").select("security_id", "symbol", "name", "sector_id", "market_cap_usd")
    rows = stored(rows, "peers")
    key = ["sector_id", "market_cap_usd"]
    least = rows.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy("security_id"))).where(F.col("r") <= k + 1)
    levels = stored(least.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("security_id", "name", "symbol"))).alias("members")), "peer_levels")
    # blocks of a sector's levels, each with the levels that neighbour it on either side: no sector is one task
    beside = blocks_with_halo(levels, ["sector_id"], ["market_cap_usd"], k + 1, max(BLOCK_LEVELS, k + 1))
    order = Window.partitionBy("sector_id", "_block").orderBy("market_cap_usd")
    level, cap = F.struct("members", "market_cap_usd"), F.col("market_cap_usd")
    around = [f(level, i).over(order) for f in (F.lag, F.lead) for i in range(1, k + 2)]
    near = beside.withColumn("around", F.array(level, *around)).where("_own")
    near = near.withColumn("near", _nearest(F.flatten(F.transform(F.array_compact("around"), lambda x: _sized(x["members"], x["market_cap_usd"], cap))), k + 1))
    last, full = F.element_at("near", -1)["rounded"], F.size("near") > k
    far = [F.round(F.abs(F.log10(F.col("around")[i]["market_cap_usd"] / cap)), 9) for i in (k + 1, 2 * k + 2)]
    open_ = F.coalesce(full & (far[0] <= last), F.lit(False)) | F.coalesce(full & (far[1] <= last), F.lit(False))
    near = stored(near.select(*key, "near", F.when(open_, last).alias("last")), "peer_near")
    tied = near.where("last is not null")
    if not tied.isEmpty():
        # all levels at distances up to the last, of which those nearer than it are few
        scale, edge = 10**8, 1e-8
        at = F.log10("market_cap_usd")
        sides = F.array(*[F.sequence(F.floor((at + s * F.col("last") - edge) * scale), F.floor((at + s * F.col("last") + edge) * scale)) for s in (-1, 1)])
        probes = tied.select("sector_id", F.col("market_cap_usd").alias("own"), "near", "last", F.explode(F.array_distinct(F.flatten(sides))).alias("bin"))
        others = levels.select("sector_id", F.floor(at * scale).alias("bin"), "market_cap_usd", "members")
        met = probes.join(others, ["sector_id", "bin"]).withColumn("peer", F.explode(_sized(F.col("members"), cap, F.col("own")))).where(F.col("peer.rounded") == F.col("last"))
        rank = F.row_number().over(Window.partitionBy("sector_id", "own").orderBy("peer.peer_id"))
        met = met.withColumn("r", rank).where(F.col("r") <= k + 1).groupBy("sector_id", F.col("own").alias("market_cap_usd")).agg(F.collect_list("peer").alias("met"))
        near = near.join(met, key, "left").withColumn("near", F.when(F.col("met").isNull(), F.col("near")).otherwise(_nearest(F.array_union(F.filter("near", lambda x: x["rounded"] < F.col("last")), F.col("met")), k + 1)))
    own = rows.join(near.select(*key, "near"), key)
    own = own.select("security_id", *key, F.inline(F.slice(F.filter("near", lambda x: x["peer_id"] != F.col("security_id")), 1, k)))
    return own.select("security_id", "peer_id", "peer_name", "peer_symbol", "peer_market_cap_usd", "market_cap_usd", "sector_id", round4(F.col("d")).alias("size_distance"))
