"""Which security, issuer, symbol and venue a record is about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions import rules
from tapeworks.functions.common import top1
from tapeworks.functions.scratch import stored


#: Identifiers of a holding, the most telling first.
KINDS = ("isin", "cusip", "figi")


def _valid_ids() -> Column:
    """The valid identifiers of a holding, cleaned: an array of (rank, kind, value)."""
    own = [F.when(rules.valid_identifier(F.lit(k), F.col(k)), F.struct(F.lit(n).alias("rank"), F.lit(k).alias("kind"), rules.identifier(F.col(k)).alias("value"))) for n, k in enumerate(KINDS)]
    return F.array_compact(F.array(*own))


def _sets(holdings: DataFrame) -> DataFrame:
    """(holding_id, set_id, ids) of the holdings that have a valid identifier, each once; set_id is a hash of ids.

    A holding has the identifiers of all its rows; a row without a holding_id is a holding of its own.
    Many holdings of a security file the same identifiers. What is found out about a set is found out once, and meets holdings
    by set_id only in the end, so a security with a third of all holdings is one row until then.
    """
    rows = holdings.select("holding_id", _valid_ids().alias("ids")).where(F.size("ids") > 0)
    own = F.when(F.col("holding_id").isNull(), F.to_json("ids"))
    rows = rows.groupBy("holding_id", own.alias("own")).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("ids"))
    return stored(rows.select("holding_id", F.md5(F.to_json("ids")).alias("set_id"), "ids"), "identifier_sets")


def _identifiers(held: DataFrame) -> DataFrame:
    """(set_id, rank, kind, value) of each set once."""
    return stored(held.dropDuplicates(["set_id"]).select("set_id", F.inline("ids")), "identifiers")


def resolve_securities(holdings: DataFrame, known: DataFrame) -> DataFrame:
    """(holding_id, security_id, matched): which security each holding is of.

    A holding with a known identifier is of that security: the first known of ISIN, CUSIP and FIGI decides, so a
    holding with identifiers of two known securities merges neither. The others are new, and those that share an
    identifier, directly or through others, are one security, whatever their order; its id is a hash of
    the component's best identifier, so a batch that is run again makes the same ids. Holdings without a valid identifier
    are left out; skipped_holdings() counts them. Rows that repeat a holding_id are one holding with the identifiers of them all.

    known: kind, value, security_id. new_identifiers() has what later batches must know.
    """
    held = _sets(holdings)
    rows = _identifiers(held)
    found = _known(rows, known)
    first = top1(found, ["set_id"], F.asc("rank"), F.asc("security_id")).select("set_id", F.col("security_id").cast("string").alias("security_id"), F.lit(True).alias("matched"))
    made = _new_securities(rows, found).select("set_id", "security_id", F.lit(False).alias("matched")).distinct()
    return held.select("holding_id", "set_id").join(first.unionByName(made), "set_id").select("holding_id", "security_id", "matched")


def _known(rows: DataFrame, known: DataFrame) -> DataFrame:
    return rows.join(known.select("kind", rules.identifier(F.col("value")).alias("value"), "security_id"), ["kind", "value"])


def _new_securities(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(set_id, kind, value, security_id): identifiers of the sets that have no known one, with the id of their component."""
    new = stored(rows.join(found.select("set_id").distinct(), "set_id", "left_anti"), "new_sets")
    groups = _components(new.select(F.col("set_id").alias("node"), "kind", "value"))
    both = new.join(groups.withColumnRenamed("node", "set_id"), "set_id")
    ids = both.groupBy("group_id").agg(F.min(F.struct("rank", "kind", "value")).alias("best"))
    ids = ids.select("group_id", F.sha2(F.concat_ws(":", "best.kind", "best.value"), 256).alias("security_id"))
    return both.join(ids, "group_id").select("set_id", "kind", "value", "security_id")


def new_identifiers(holdings: DataFrame, known: DataFrame) -> DataFrame:
    """(kind, value, security_id) of the securities that resolve_securities() makes: registered, they are found by later batches."""
    rows = _identifiers(_sets(holdings))
    return _new_securities(rows, _known(rows, known)).select("kind", "value", "security_id").distinct()


def skipped_holdings(holdings: DataFrame) -> DataFrame:
    """Holdings without a valid identifier in any of their rows: what resolution leaves out."""
    ids = F.size(_valid_ids())
    return holdings.where(ids == 0).join(holdings.where(ids > 0).select("holding_id"), "holding_id", "left_anti").select(*holdings.columns)


def resolve_issuers(holdings: DataFrame, known: DataFrame) -> DataFrame:
    """(lei, issuer_id, name): known issuers by LEI, and new ones named by their first holding."""
    rows = holdings.where(rules.valid_identifier(F.lit("lei"), F.col("lei")))
    first = top1(rows.select("lei", "name", "holding_id"), ["lei"], F.asc("holding_id"))
    return first.join(known.withColumnRenamed("name", "known_name"), "lei", "left").select(
        "lei", F.coalesce("issuer_id", F.sha2(F.concat(F.lit("lei:"), "lei"), 256)).alias("issuer_id"), F.coalesce("known_name", "name").alias("name")
    )


def security_symbol(securities: DataFrame, listings: DataFrame, provider: DataFrame, identifiers: DataFrame) -> DataFrame:
    """The primary listing's symbol, else the provider's, else the lowest ticker; securities without any are left out."""
    primary = listings.where("is_primary").groupBy("security_id").agg(F.min("symbol").alias("a"))
    own = provider.groupBy("security_id").agg(F.min("symbol").alias("b"))
    ticker = identifiers.where("kind = 'ticker'").groupBy("security_id").agg(F.min("value").alias("c"))
    rows = securities.select("security_id")
    for other in (primary, own, ticker):
        rows = rows.join(other, "security_id", "left")
    return rows.select("security_id", F.coalesce("a", "b", "c").alias("symbol")).where("symbol is not null")


def security_current(securities: DataFrame, nodes: DataFrame, sources: DataFrame, symbols: DataFrame, identifiers: DataFrame, issuers: DataFrame, countries: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each security: sector and industry by priority, operating country over filed, with names of what it refers to.

    issuers: issuer_id, issuer_name. countries: country_iso2, country_name. labels: industry_id, industry. A
    security with several ISINs has a row for each.
    """
    from tapeworks.operators.funds import best_node

    rows = securities.withColumn("filed_country_iso2", F.col("country_iso2")).withColumn("provider_country_iso2", F.col("operating_country_iso2")).withColumn("country_iso2", F.coalesce("operating_country_iso2", "country_iso2"))
    rows = rows.drop("isin")
    isin = identifiers.where("kind = 'isin'").select("security_id", F.col("value").alias("isin"))
    joined = (
        (symbols, "security_id"), (isin, "security_id"), (best_node(nodes, sources, 1).withColumnRenamed("node_id", "sector_id"), "security_id"), (best_node(nodes, sources, 2).withColumnRenamed("node_id", "industry_id"), "security_id"),
        (issuers, "issuer_id"), (countries.select("country_iso2", "country_name"), "country_iso2"), (labels, "industry_id"),
    )
    for other, key in joined:
        rows = rows.join(other, key, "left")
    return rows.select(
        "security_id", "name", "symbol", "isin", "issuer_name", "security_type_code", "country_iso2", "country_name", "filed_country_iso2", "provider_country_iso2",
        "sector_id", "industry_id", "industry", "market_cap", "currency_code", "is_tradeable",
    )


def symbol_security(securities: DataFrame, listings: DataFrame, provider: DataFrame, identifiers: DataFrame) -> DataFrame:
    """(symbol, security_id) of every security that has a symbol: the map that charts are looked up by, to be kept by versions.read_model()."""
    return security_symbol(securities, listings, provider, identifiers).where("symbol is not null").select("symbol", "security_id")


def listing_venue(symbols: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Each symbol's venue by the longest suffix, then preference; one listing for a (security, venue), one primary for a security."""
    rows = symbols.withColumn("suffix", rules.suffix(F.col("symbol"))).join(exchanges, "suffix")
    rows = top1(rows, ["security_id", "symbol"], F.desc(F.length("suffix")), F.asc("preference"), F.asc("exch_code"))
    rows = top1(rows, ["security_id", "exch_code"], F.asc("symbol"))
    first = F.row_number().over(Window.partitionBy("security_id").orderBy(F.desc("chosen"), "preference", "symbol"))
    return rows.withColumn("r", first).select("security_id", "exch_code", "symbol", (F.col("r") == 1).alias("is_primary"), "currency_code")


def pick_local_symbol(securities: DataFrame, matches: DataFrame, exchanges: DataFrame) -> DataFrame:
    """The match at the first venue, by preference, of the security's home country."""
    rows = securities.select("security_id", "country_iso2").join(matches, "security_id").join(exchanges.withColumnRenamed("currency_code", "_c"), ["exch_code", "country_iso2"])
    return top1(rows, ["security_id"], F.asc("preference"), F.asc("symbol")).select("security_id", "symbol", "exch_code")


def pick_home_listing(hits: DataFrame, exchanges: DataFrame) -> DataFrame:
    """The first hit whose suffix is of the home country; any known suffix where the country has no venue."""
    venues = exchanges.where("suffix <> ''").select("suffix", F.col("country_iso2").alias("venue_country"))
    homes = exchanges.select(F.col("country_iso2").alias("home")).distinct()
    rows = hits.withColumn("suffix", rules.suffix(F.col("symbol"))).join(venues, "suffix").join(homes, F.col("country_iso2") == F.col("home"), "left")
    rows = rows.where((F.col("venue_country") == F.col("country_iso2")) | F.col("home").isNull())
    return top1(rows, ["security_id"], F.asc("hit_rank"), F.asc("symbol")).select("security_id", "symbol")


def symbol_repair(failed: DataFrame, listings: DataFrame) -> DataFrame:
    """(security_id, symbol, candidate): respellings of a symbol that a listing has."""
    s = F.col("symbol")
    short, venue = F.regexp_extract(s, r"^(\d{1,3})\.HK$", 1), F.lit(".HK")
    nordic = r"^([A-Z]+)([AB])(\.(?:ST|CO|HE|OL))$"
    options = F.array(
        F.replace(s, F.lit("*"), F.lit("")), F.regexp_replace(s, "/([A-Z])", "-$1"), F.replace(s, F.lit("/"), F.lit("")),
        F.when(short != "", F.concat(F.lpad(short, 4, "0"), venue)), F.when(s.rlike(nordic), F.regexp_replace(s, nordic, "$1-$2$3")),
    )
    rows = failed.select("security_id", "symbol", F.explode(F.array_distinct(F.array_compact(options))).alias("candidate"))
    return rows.where("candidate <> symbol").join(listings.select(F.col("symbol").alias("candidate")).distinct(), "candidate", "left_semi").select("security_id", "symbol", "candidate")


def industry_nodes(labels: DataFrame, known: DataFrame) -> DataFrame:
    """New level-2 codes: the sector's, two dashes, and the label as lower-case words with dashes, 60 characters at most."""
    slug = F.regexp_replace(F.regexp_replace(F.lower("label"), "[^a-z0-9]+", "-"), "^-|-$", "")
    rows = labels.select("sector_id", F.substring(F.concat("sector_id", F.lit("--"), slug), 1, 60).alias("code"), "label")
    return top1(rows, ["code"], F.asc("label")).join(known.select("code"), "code", "left_anti").select("code", "sector_id", "label")


def alias_link(aliases: DataFrame, instruments: DataFrame) -> DataFrame:
    """(symbol, security_id): curated instruments linked by any alias, the least id of an alias's."""
    best = top1(aliases, ["alias"], F.asc("security_id"))
    return instruments.join(best, F.upper(F.col("symbol")) == F.upper(F.col("alias"))).groupBy("symbol").agg(F.min("security_id").alias("security_id"))


def cik_map(tickers: DataFrame, payload: DataFrame, known: DataFrame) -> DataFrame:
    """Ticker to CIK from JSON objects {key: {ticker, cik}}, where it differs from what is known."""
    rows = payload.select(F.explode(F.from_json("body", "map<string,struct<ticker:string,cik:bigint>>")).alias("k", "v")).select(F.upper("v.ticker").alias("ticker"), F.col("v.cik").alias("cik"))
    rows = top1(rows, ["ticker"], F.asc("cik"))
    out = tickers.select("security_id", F.upper("ticker").alias("ticker")).join(rows, "ticker").join(known.withColumnRenamed("cik", "old"), "security_id", "left")
    return out.where(~F.col("cik").eqNullSafe(F.col("old"))).select("security_id", "cik")


def instrument_current(instruments: DataFrame, links: DataFrame, current: DataFrame) -> DataFrame:
    """Curated rows keep what an editor wrote; the linked security wins for what it knows."""
    sec = current.select("security_id", *[F.col(c).alias(f"s_{c}") for c in ("sector_id", "industry_id", "country_iso2", "market_cap", "currency_code")])
    rows = instruments.join(links, "symbol", "left").join(sec, "security_id", "left")
    return rows.select("symbol", "title", "security_id", *[F.coalesce(f"s_{c}", c).alias(c) for c in ("sector_id", "industry_id", "country_iso2", "currency_code")], F.col("s_market_cap").alias("market_cap"))


def valid_identifiers(identifiers: DataFrame) -> DataFrame:
    """Identifiers that identify something, trimmed and in capitals."""
    return identifiers.where(rules.valid_identifier(F.col("kind"), F.col("value"))).withColumn("value", rules.identifier(F.col("value")))


def profile_resolve(profiles: DataFrame, countries: DataFrame, aliases: DataFrame, labels: DataFrame) -> DataFrame:
    """Caps above 0, ISO-3 currencies, countries by name or alias whatever their case, sectors by label."""
    names = countries.select(F.lower("name").alias("n"), "iso2").unionByName(aliases.select(F.lower("provider_name").alias("n"), "iso2"))
    names = top1(names, ["n"], F.asc("iso2"))
    rows = profiles.join(names, F.lower("country_name") == F.col("n"), "left").join(labels, "sector_label", "left")
    return rows.select("security_id", F.when(F.col("market_cap") > 0, F.col("market_cap")).alias("market_cap"), F.when(F.col("currency").rlike("^[A-Z]{3}$"), F.col("currency")).alias("currency_code"), F.col("iso2").alias("country_iso2"), "node_id")


def untracked_listing(listings: DataFrame, identifiers: DataFrame, provider: DataFrame) -> DataFrame:
    """Listings of which FIGI, provider symbol and ticker are all unknown, whatever their case.

    A ticker that has a provider symbol of its own is known by that one only.
    """
    ids = identifiers.select("kind", F.upper("value").alias("k"))
    rows = listings.withColumn("_figi", F.upper("figi")).withColumn("_sym", F.upper("provider_symbol")).withColumn("_tick", F.when(F.col("provider_symbol").isNull(), F.upper("ticker")))
    rows = rows.join(ids.where("kind = 'figi'").select(F.col("k").alias("_figi")), "_figi", "left_anti")
    rows = rows.join(provider.select(F.upper("symbol").alias("_sym")), "_sym", "left_anti")
    rows = rows.join(ids.where("kind = 'ticker'").select(F.col("k").alias("_tick")), "_tick", "left_anti")
    return rows.select(*listings.columns)


def pending_promotion(untracked: DataFrame, venues: DataFrame, held: DataFrame) -> DataFrame:
    """The queue: untracked listings at enabled venues whose name isn't held, home markets first: by tier, preference and name, then FIGI."""
    rows = untracked.join(venues.where("enabled"), "exch_code").withColumn("_n", F.upper("name")).join(held.select(F.upper("name").alias("_n")), "_n", "left_anti")
    return rows.select("figi", "ticker", "name", "exch_code", "country_iso2", "provider_symbol", "tier", "preference").orderBy("tier", "preference", "name", "figi")


def promotion_wave(queue: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(securities, identifiers, provider symbols) of the first ``limit`` listings of the queue, one for each name.

    Names are compared trimmed and in capitals, and nameless listings are left out. The id of a new security is a
    hash of its FIGI, so a wave that is run again makes the same rows.
    """
    order = ("tier", "preference", "name", "figi")
    rows = queue if limit is None else queue.orderBy(*order).limit(limit)
    rows = top1(rows.withColumn("_n", F.upper(F.trim("name"))).where("_n <> ''"), ["_n"], *[F.asc(c) for c in order])
    rows = rows.withColumn("security_id", F.sha2(F.concat(F.lit("figi:"), "figi"), 256))
    securities = rows.select("security_id", "name", F.lit("equity").alias("security_type_code"), "country_iso2", F.lit(True).alias("is_tradeable"))
    of = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value"))
    identifiers = rows.select("security_id", F.inline(F.array(of("figi", "figi"), of("ticker", "ticker"))), F.lit("openfigi").alias("source_code")).where("value is not null")
    return securities, identifiers, rows.where("provider_symbol is not null").select("security_id", F.lit("yfinance").alias("provider_code"), F.col("provider_symbol").alias("symbol"))


def rekey(rows: DataFrame, renames: DataFrame) -> DataFrame:
    """Rows under their new symbol, dropped where the new key exists already. rows: symbol, period, value."""
    moved = rows.join(renames, rows["symbol"] == renames["old"]).select(F.col("new").alias("symbol"), "period", "value")
    kept = rows.join(renames.select(F.col("old").alias("symbol")), "symbol", "left_anti").select("symbol", "period", "value")
    return kept.unionByName(moved.join(kept, ["symbol", "period"], "left_anti"))


def shared_identifier_groups(holdings: DataFrame) -> DataFrame:
    """(holding_id, group_id): holdings that share any valid identifier, directly or through others, and their least id."""
    held = _sets(holdings)
    nodes = stored(held.groupBy("set_id").agg(F.min("holding_id").alias("node"), F.first("ids").alias("ids")), "identifiers")
    groups = _components(nodes.select("node", F.inline("ids")).select("node", "kind", "value"))
    groups = nodes.select("set_id", "node").join(groups, "node")
    return held.select("holding_id", "set_id").join(groups, "set_id").select("holding_id", "group_id")


def _components(rows: DataFrame) -> DataFrame:
    """(node, group_id) of rows (node, kind, value) that are read from a store: the least node of those that share values, directly or through others.

    Each round a node takes the least label among those that share an identifier with it, and rounds end
    when no label changes, which halves the way each time; labels are written to the shared folder between rounds. An
    identifier's least label is an aggregate, so one that many nodes share costs each task one row.
    """
    labels = stored(rows.select("node", F.col("node").alias("group_id")).distinct(), "labels")
    while True:
        least = rows.join(labels, "node").groupBy("kind", "value").agg(F.min("group_id").alias("least"))
        new = rows.join(least, ["kind", "value"]).groupBy("node").agg(F.min("least").alias("group_id"))
        # a label's own node has a label too, which may be less: following it halves the way
        jump = new.select(F.col("node").alias("group_id"), F.col("group_id").alias("further"))
        new = stored(new.join(jump, "group_id", "left").select("node", F.coalesce("further", "group_id").alias("group_id")), "labels")
        changed = not new.join(labels, ["node", "group_id"], "left_anti").isEmpty()
        labels = new
        if not changed:
            return labels
