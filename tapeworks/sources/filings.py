"""Filed documents as tables: fund holdings in XML, company facts and fundamentals in JSON."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.functions.common import top1

_S = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: One <invstOrSec> of a fund's filing; attributes carry an underscore.
HOLDING_XML = _struct(
    name=_S, lei=_S, title=_S, cusip=_S,
    identifiers=_struct(isin=_struct(_value=_S), other=T.ArrayType(_struct(_otherDesc=_S, _value=_S))),
    balance=T.DoubleType(), units=_S, curCd=_S, valUSD=T.DoubleType(), pctVal=T.DoubleType(), assetCat=_S, issuerCat=_S, invCountry=_S,
    debtSec=_struct(maturityDt=T.DateType(), couponKind=_S, annualizedRt=T.DoubleType(), isDefault=_S),
)


def _known(x: Column) -> Column:
    x = F.trim(x)
    return F.when(~F.upper(x).isin("N/A", ""), x)


def nport_holdings(spark: SparkSession, path: str) -> DataFrame:
    """Holdings of a folder of fund filings, a row for each with a name, debt terms included."""
    return nport_rows(spark, path).where("name is not null")


def nameless_holdings(spark: SparkSession, path: str) -> DataFrame:
    """Holdings that nport_holdings() leaves out."""
    return nport_rows(spark, path).where("name is null")


def nport_rows(spark: SparkSession, path: str) -> DataFrame:
    """All holdings of a folder of fund filings."""
    rows = spark.read.format("xml").option("rowTag", "invstOrSec").schema(HOLDING_XML).load(path)
    debt = F.col("debtSec")
    return rows.select(
        _known(F.col("name")).alias("name"), _known(F.col("lei")).alias("lei"), _known(F.col("cusip")).alias("cusip"), _known(F.col("identifiers.isin._value")).alias("isin"),
        F.transform("identifiers.other", lambda o: F.struct(o["_otherDesc"].alias("kind"), o["_value"].alias("value"))).alias("other"),
        "balance", _known(F.col("units")).alias("units"), _known(F.col("curCd")).alias("currency_code"), F.col("valUSD").alias("value_usd"), F.col("pctVal").alias("weight"),
        _known(F.col("assetCat")).alias("asset_category"), _known(F.col("issuerCat")).alias("issuer_category"), _known(F.col("invCountry")).alias("country_iso2"),
        debt["maturityDt"].alias("maturity_date"), debt["couponKind"].alias("coupon_kind"), debt["annualizedRt"].alias("coupon_rate"),
        F.when(debt["isDefault"] == "Y", True).when(debt["isDefault"] == "N", False).alias("in_default"),
    )


_FACT = _struct(start=T.DateType(), end=T.DateType(), val=T.DoubleType(), fp=_S, form=_S, filed=T.DateType(), accn=_S)
_FACTS = _struct(cik=T.LongType(), facts=T.MapType(_S, T.MapType(_S, _struct(units=T.MapType(_S, T.ArrayType(_FACT))))))


def xbrl_facts(spark: SparkSession, path: str, wholetext: bool = True) -> DataFrame:
    """Company facts files, one JSON object each, or one on each line without ``wholetext``, as a row for each fact."""
    return facts_of(spark.read.text(path, wholetext=wholetext))


def facts_of(bodies: DataFrame) -> DataFrame:
    """A row for each fact of the JSON objects in column value."""
    rows = bodies.select(F.from_json("value", _FACTS).alias("j"))
    rows = rows.select("j.cik", F.explode("j.facts").alias("taxonomy", "concepts")).select("cik", "taxonomy", F.explode("concepts").alias("concept", "c"))
    rows = rows.select("cik", "taxonomy", "concept", F.explode("c.units").alias("unit", "facts"))
    return rows.select("cik", "taxonomy", "concept", "unit", F.inline("facts")).where("val is not null and end is not null")


def choose_units(facts: DataFrame) -> DataFrame:
    """Facts of one unit for each concept: shares, else the ISO-3 unit (or per share) with most points, the first by name of equals."""
    usable = facts.where((F.col("unit") == "shares") | F.col("unit").rlike("^[A-Z]{3}(/shares)?$"))
    n = usable.groupBy("cik", "taxonomy", "concept", "unit").agg(F.count("*").alias("points"))
    best = top1(n, ["cik", "taxonomy", "concept"], (F.col("unit") == "shares").desc(), F.desc("points"), F.asc("unit"))
    return usable.join(best.drop("points"), ["cik", "taxonomy", "concept", "unit"], "left_semi")


def fundamentals_load(raw: DataFrame, fields: list[str]) -> DataFrame:
    """raw: security_id, payload. Named numbers or null, and the payload as it came."""
    return raw.select("security_id", *[F.get_json_object("payload", f"$.{f}").try_cast("double").alias(f) for f in fields], "payload")


def statement_load(raw: DataFrame) -> DataFrame:
    """raw: security_id, statement, body (a JSON array of periods). One row for each period with a date, the last of repeats, its payload kept."""
    rows = raw.select("security_id", "statement", F.posexplode(F.from_json("body", "array<map<string,string>>")).alias("place", "m"))
    rows = rows.select("security_id", "statement", F.col("m")["period_ending"].try_cast("date").alias("period_ending"), F.coalesce(F.col("m")["period_type"], F.lit("annual")).alias("period_type"), F.to_json("m").alias("payload"), "place")
    key = ["security_id", "statement", "period_ending", "period_type"]
    return top1(rows.where("period_ending is not null"), key, F.desc("place"), F.desc("payload")).drop("place")


#: Numbers that a provider states of a share, and of what analysts expect of it.
SHARE_STATS = ["float_shares", "outstanding_shares", "short_interest", "short_percent_of_float", "days_to_cover", "insider_ownership", "institution_ownership", "institutions_count"]
ESTIMATES = ["target_high", "target_low", "target_consensus", "target_median", "recommendation_mean", "number_of_analysts"]


def _provider_rows(raw: DataFrame, symbols: DataFrame, numbers: list[str], texts: list[str]) -> DataFrame:
    """Objects of the JSON arrays in column body, of symbols that are known whatever their case. What isn't a JSON number is null."""
    fields = ", ".join([*[f"`{c}` double" for c in numbers], *[f"`{c}` string" for c in texts]])
    rows = raw.select(F.posexplode(F.from_json("body", f"array<struct<{fields}>>")).alias("place", "r")).select("place", "r.*")
    known = symbols.select(F.upper("symbol").alias("known"), "security_id")
    return rows.join(known, F.upper("symbol") == F.col("known"))


def share_stats_load(raw: DataFrame, symbols: DataFrame, asof: dt.date) -> DataFrame:
    """raw: body. A row for each security and date of the provider, or ``asof`` where it gives none; the last of repeats stays."""
    rows = _provider_rows(raw, symbols, SHARE_STATS, ["symbol", "date"])
    rows = rows.withColumn("as_of", F.coalesce(F.substring("date", 1, 10).try_cast("date"), F.lit(asof)))
    return top1(rows, ["security_id", "as_of"], F.desc("place"), *[F.desc(c) for c in SHARE_STATS]).select("security_id", "as_of", *SHARE_STATS)


def estimates_load(raw: DataFrame, symbols: DataFrame, asof: dt.date) -> DataFrame:
    """raw: body. What analysts expect as of ``asof``; the currency in capitals if it is three letters, else null."""
    rows = _provider_rows(raw, symbols, ESTIMATES, ["symbol", "currency", "recommendation"])
    code = F.when(F.col("currency").rlike("^[A-Za-z]{3}$"), F.upper("currency"))
    rows = rows.select("place", "security_id", F.lit(asof).alias("as_of"), *ESTIMATES, "recommendation", code.alias("currency_code"))
    return top1(rows, ["security_id"], F.desc("place"), *[F.desc(c) for c in ESTIMATES]).drop("place")


def eps_history_load(raw: DataFrame) -> DataFrame:
    """raw: security_id, body (a JSON object with quarterlyEarnings). Figures come as text, and "None" or any other word is null; 0 is a figure."""
    fields = ("fiscalDateEnding", "reportedDate", "reportedEPS", "estimatedEPS", "surprise", "surprisePercentage")
    body = F.from_json("body", f"quarterlyEarnings array<struct<{', '.join(f'{c} string' for c in fields)}>>")
    rows = raw.select("security_id", F.posexplode(body["quarterlyEarnings"]).alias("place", "q"))
    day = lambda c: F.substring(F.col(f"q.{c}"), 1, 10).try_cast("date")
    number = lambda c: F.when(F.col(f"q.{c}").rlike(r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"), F.col(f"q.{c}").try_cast("double"))
    rows = rows.select(
        "security_id", "place", day("fiscalDateEnding").alias("period_ending"), day("reportedDate").alias("reported_date"), number("reportedEPS").alias("eps_actual"),
        number("estimatedEPS").alias("eps_estimated"), number("surprise").alias("surprise"), number("surprisePercentage").alias("surprise_pct"),
    ).where("period_ending is not null")
    return top1(rows, ["security_id", "period_ending"], F.desc("place"), F.desc("eps_actual")).drop("place")
