"""Queries by name over the inputs of ``market``, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import __version__
from tapeworks.functions import common, rules, versions
from tapeworks.operators import currencies, events, facets, funds, identity, macro, metrics, pending, returns, stores, writes
from tapeworks.functions.scratch import new_path, shared_dir
from tapeworks.plans.market import ASOF, EVENT_ASOF, Market, with_inputs
from tapeworks.sources import filings
from tapeworks.streaming import streams

#: No bar of the inputs is later.
LAST_BAR = dt.date(2003, 12, 31)
QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}

_A, _E = f"date '{ASOF}'", f"date '{EVENT_ASOF}'"


def r4(x: str) -> str:
    return f"cast(round(cast({x} as decimal(28,10)), 4) as double)"


def d(x: str) -> str:
    return f"cast({x} as double)"


def query(name: str, sql: str | None = None, make: Callable[[Market], DataFrame] | None = None):
    def add(f: Callable[[Market], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Market(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[name] = with_inputs(sql)
        return f

    return add(make) if make else add


# Funds and classification

_CURRENT = """held as (select h.*, f.security_id as own_id, f.name as fund_name, f.kind, f.represents_code, f.style from holding h join fund f on h.fund_symbol = f.fund_symbol
  where h.as_of = (select max(as_of) from holding x where x.fund_symbol = h.fund_symbol)), outside as (select * from held where security_id <> own_id)"""
_BEST = """best as (select security_id, level, node_id, row_number() over (partition by security_id, level order by priority desc nulls last, as_of desc, node_id) as r from node left join source_rank on node.source_code = source_rank.source_code),
sector as (select security_id, node_id as sector_id from best where level = 1 and r = 1), industry as (select security_id, node_id as industry_id from best where level = 2 and r = 1)"""
_FX_NOW = "fx_now as (select currency_code, usd_per_unit, as_of from fx_double f where as_of = (select max(as_of) from fx_double x where x.currency_code = f.currency_code))"

query("holdings_current", f"with {_CURRENT} select fund_symbol, security_id, as_of, {d('weight')} as weight from held",
      lambda m: funds.holdings_current(m.holding).select("fund_symbol", "security_id", "as_of", F.col("weight").cast("double").alias("weight")))
query("fund_sector_weight", f"""with {_CURRENT}, {_BEST}, w as (select fund_symbol, coalesce(sector_id, 'unclassified') as sector_id, sum(weight) as weight, max(as_of) as as_of
  from outside join (select security_id from security where security_type_code = 'equity') e using (security_id) left join sector using (security_id) group by all)
  select fund_symbol, sector_id, {d('weight')} as weight, {r4(f"100 * {d('weight')} / nullif({d('sum(weight) over (partition by fund_symbol)')}, 0)")} as weight_pct, as_of from w""",
      lambda m: funds.fund_sector_weight(m.holding, m.fund, m.security, m.node, m.source_rank))
query("fund_country_weight", f"""with {_CURRENT}, w as (select fund_symbol, coalesce(operating_country_iso2, country_iso2, 'XX') as country_iso2, sum(weight) as weight, max(as_of) as as_of from outside join (select * from security) s using (security_id) group by all)
  select fund_symbol, country_iso2, {d('weight')} as weight, {r4(f"100 * {d('weight')} / nullif({d('sum(weight) over (partition by fund_symbol)')}, 0)")} as weight_pct, as_of from w""",
      lambda m: funds.fund_country_weight(m.holding, m.fund, m.security))
query("fund_holdings", f"""with {_CURRENT} select fund_symbol, o.security_id, s.name, symbol, country_iso2, security_type_code, currency_code, {d('weight')} as weight, {d('market_value')} as market_value, as_of
  from outside o join security s on o.security_id = s.security_id left join provider_symbol p on o.security_id = p.security_id""",
      lambda m: funds.fund_holdings(m.holding, m.fund, m.security.select("security_id", "name", "country_iso2", "security_type_code", "currency_code"), m.provider_symbol))
query("security_funds", f"with {_CURRENT} select security_id, fund_symbol, fund_name, kind as fund_kind, represents_code, {d('weight')} as weight, as_of from outside", lambda m: funds.security_funds(m.holding, m.fund))
query("merge_lots", f"select fund_symbol, security_id, as_of, {d('sum(weight)')} as weight, {d('sum(market_value)')} as market_value from lot group by 1, 2, 3",
      lambda m: funds.merge_lots(m.lot).withColumn("weight", F.col("weight").cast("double")).withColumn("market_value", F.col("market_value").cast("double")))
query("type_from_filing", """with g as (select security_id, max(asset_category) as c from holding group by 1 having count(distinct asset_category) = 1)
  select s.security_id, case when c in ('EC','EP') then 'equity' when c in ('DBT','LON') or c like 'ABS-%' then 'bond' end as security_type_code from security s join g on s.security_id = g.security_id where security_type_code = 'other'""",
      lambda m: funds.type_from_filing(m.holding, m.security))
query("derive_classifications", f"""with {_CURRENT}, j as (select o.*, s.security_type_code, s.country_iso2 as filed from outside o join security s on o.security_id = s.security_id where represents_code is not null),
  tags as (select security_id, represents_code as code, max(as_of) as as_of from j where kind = 'sector' and security_type_code = 'equity' group by 1, 2)
  select security_id, 'sector' as what, code, as_of from tags union all
  select security_id, 'country', arg_max(represents_code, weight), arg_max(as_of, weight) from (select * from j where kind = 'country' and filed is null and not exists (select 1 from j x where x.kind = 'country' and x.security_id = j.security_id and (x.weight > j.weight or (x.weight = j.weight and x.fund_symbol < j.fund_symbol)))) group by 1""",
      lambda m: funds.derive_classifications(m.holding, m.fund, m.security))
query("sector_constituents", f"""with {_CURRENT}, n as (select node.*, priority from node left join source_rank on node.source_code = source_rank.source_code),
  mem as (select distinct node_id as sector_id, security_id from n where level = 1),
  ind as (select security_id, parent_id, node_id, row_number() over (partition by security_id, parent_id order by priority desc nulls last, as_of desc, node_id) as r from n where level = 2),
  h as (select represents_code, security_id, weight, fund_symbol, market_value, as_of, row_number() over (partition by represents_code, security_id order by weight desc, fund_symbol) as r from held where kind = 'sector')
  select mem.sector_id, mem.security_id, s.name, symbol, country_iso2, ind.node_id as industry, {d('h.weight')} as weight, h.fund_symbol, market_cap, currency_code, {d('h.market_value')} as market_value, h.as_of
  from mem join security s on mem.security_id = s.security_id left join provider_symbol p on p.security_id = mem.security_id
  left join ind on ind.security_id = mem.security_id and ind.parent_id = mem.sector_id and ind.r = 1 left join h on h.represents_code = mem.sector_id and h.security_id = mem.security_id and h.r = 1""",
      lambda m: funds.sector_constituents(m.holding, m.fund, m.security, m.node, m.source_rank, m.provider_symbol))
query("country_sector_perf", f"""with {_CURRENT}, {_BEST}, c as (select s.security_id, sector_id, s.country_iso2, fund_symbol, weight from (select security_id, security_type_code, coalesce(operating_country_iso2, country_iso2) as country_iso2 from security) s
  join sector on sector.security_id = s.security_id join provider_symbol p on p.security_id = s.security_id join held h on h.security_id = s.security_id and h.kind = 'country' and h.represents_code = s.country_iso2 where security_type_code = 'equity' and weight > 0
  qualify row_number() over (partition by s.security_id order by weight desc, fund_symbol) = 1)
  select country_iso2, sector_id, period, {r4(f"{d('sum(weight * change_pct)')} / nullif({d('sum(weight)')}, 0)")} as change_pct, {r4(f"{d('sum(weight * total_return_pct)')} / nullif({d('sum(weight) filter (where total_return_pct is not null)')}, 0)")} as total_return_pct,
  count(*) as constituents, count(total_return_pct) as total_return_constituents, {d('sum(weight)')} as weight_covered, min(fund_symbol) as fund_symbol, max(p.as_of) as as_of
  from c join security_perf p on c.security_id = p.security_id group by 1, 2, 3""",
      lambda m: funds.country_sector_performance(m.holding, m.fund, m.security, m.node, m.source_rank, m.provider_symbol, m.security_perf))

# Scans and writes

query("price_bars", """select series_id, date, close, case when dividend > 0 then dividend end as dividend, case when split_ratio > 0 and split_ratio <> 1 then split_ratio end as split_ratio from raw_bar where close > 0""", lambda m: returns.price_bars(m.raw_bar))
query("corporate_actions", """select series_id, date as ex_date, 'split' as kind, split_ratio as value from event_bar where split_ratio is not null and split_ratio <> 1 union all select series_id, date, 'dividend', dividend from event_bar where dividend > 0""",
      lambda m: returns.corporate_actions(m.event_bar.withColumn("split_ratio", F.col("split_ratio").cast("double"))))
query("macro_points", """with v as (select indicator_code, date as as_of, coalesce(json_extract_string(body, '$.maturity'), '') as dimension, seq,
  coalesce(try_cast(json_extract_string(body, '$.value') as double), try_cast(json_extract_string(body, '$.rate') as double), try_cast(json_extract_string(body, '$.close') as double), try_cast(json_extract_string(body, '$.k') as double)) as value from macro_row),
  r as (select *, row_number() over (partition by indicator_code, as_of, dimension order by seq) as r from v where value is not null) select indicator_code, as_of, dimension, value from r where r = 1""", lambda m: macro.macro_points(m.macro_row))
query("insider_keyed", """select distinct sha256(concat_ws('|', cast(security_id as varchar), cast(transaction_date as varchar), owner_name, coalesce(direction, ''), security_type, cast(shares as varchar), coalesce(cast(price as varchar), ''))) as trade_key, security_id, transaction_date, owner_name, direction, shares, security_type, price from insider where transaction_date is not null""",
      lambda m: events.insider_keyed(m.insider))
query("news_split", """with g as (select * from article where title is not null), r as (select *, row_number() over (partition by url order by published_at, title) as r from g)
  select url, 'article' as kind, title, cast(null as bigint) as security_id from r where r = 1 union all select distinct url, 'link', null, security_id from g""",
      lambda m: (lambda a, k: a.select("url", F.lit("article").alias("kind"), "title", F.lit(None).cast("long").alias("security_id")).unionByName(k.select("url", F.lit("link").alias("kind"), F.lit(None).cast("string").alias("title"), "security_id")))(*events.news_split(m.article)))
query("prune_news", f"""with g as (select * from article where title is not null), r as (select *, row_number() over (partition by url order by published_at, title) as r from g), a as (select url from r where r = 1 and published_at >= {_E} - interval 90 day)
  select distinct url, security_id from g where url in (select url from a)""", lambda m: events.prune_news(*events.news_split(m.article), EVENT_ASOF)[1])
query("prune_earnings", f"select symbol, report_date, period_ending from earnings where report_date >= {_A} - interval 90 day", lambda m: events.prune_earnings(m.earnings, ASOF).select("symbol", "report_date", "period_ending"))
query("earnings_load", f"select e.symbol, report_date, p.security_id, period_ending, {d('eps_consensus')} as eps_consensus from earnings e left join provider_symbol p on e.symbol = p.symbol",
      lambda m: events.earnings_load(m.earnings.select("symbol", "report_date", "period_ending", "eps_consensus"), m.provider_symbol).withColumn("eps_consensus", F.col("eps_consensus").cast("double")))
query("officer_clean", f"""select security_id, name, title, case when pay > 0 then pay end as pay, case when born > 1900 then cast(born as bigint) end as born, case when born > 1900 then cast({EVENT_ASOF.year} - born as bigint) end as age, fiscal_year from officer""",
      lambda m: events.officer_clean(m.officer, EVENT_ASOF).withColumn("born", F.col("born").cast("long")).withColumn("age", F.col("age").cast("long")))
query("sector_unpivot", """with w as (select p_type as label, cast(count(*) as double) / 4096 as "1m", case when p_type <> 'PROMO' then cast(max(p_size) as double) / 512 end as "1y" from {part} group by 1)
  select concat('id-', label) as sector_id, period, floor(v * 1e6 + 0.5) / 1e4 as change_pct from (select label, '1m' as period, "1m" as v from w union all select label, '1y', "1y" from w) where v is not null and label <> 'SMALL'""",
      lambda m: macro.sector_unpivot(m.sql("select p_type as label, cast(count(*) as double) / 4096 as `1m`, case when p_type <> 'PROMO' then cast(max(p_size) as double) / 512 end as `1y` from {part} group by 1"),
                                     m.sql("select distinct p_type as label, concat('id-', p_type) as sector_id from {part} where p_type <> 'SMALL'"), ["1m", "1y"]))
query("unmapped_labels", """select p_type as label, cast(case when p_type <> 'PROMO' then 2 else 1 end as bigint) as dropped from {part} where p_type in ('SMALL', 'PROMO') group by 1""",
      lambda m: macro.unmapped_labels(m.sql("select p_type as label, cast(count(*) as double) / 4096 as `1m`, case when p_type <> 'PROMO' then cast(max(p_size) as double) / 512 end as `1y` from {part} group by 1"),
                                      m.sql("select distinct p_type as label from {part} where p_type not in ('SMALL', 'PROMO')"), ["1m", "1y"]))
query("profile_resolve", """select s.security_id, s.market_cap, case when length(currency_code) = 3 then currency_code end as currency_code, c.iso2 as country_iso2, l.node_id
  from (select security_id, market_cap, currency_code, (select name from country where iso2 = security.country_iso2) as cn, kind from security) s left join country c on c.name = s.cn left join (select distinct p_type as sl, concat('n-', p_type) as node_id from {part}) l on l.sl = s.kind""",
      lambda m: identity.profile_resolve(m.security.join(m.country.select(F.col("iso2").alias("country_iso2"), F.when(F.col("iso2").cast("int") % 2 == 0, F.lower("name")).otherwise(F.concat(F.lit("land OF "), "name")).alias("country_name")), "country_iso2", "left").select("security_id", "market_cap", F.col("currency_code").alias("currency"), "country_name", F.col("kind").alias("sector_label")),
                                         m.country, m.sql("select concat('Land of ', name) as provider_name, iso2 from country"), m.sql("select distinct p_type as sector_label, concat('n-', p_type) as node_id from {part}")))
_OLD = "select security_id, metric_code, as_of, source_code, value, fetched_at from metric"
_NEW = "select security_id, metric_code, as_of, case when security_id % 3 = 0 then 'derived' else 'sec-nport' end as source_code, value + 1 as value, fetched_at + interval 1 day as fetched_at from metric where security_id % 2 = 0"
_KEY = "security_id, metric_code, as_of"
query("upsert_latest", f"""with o as ({_OLD}), n as ({_NEW}) select {_KEY}, {d('value')} as value from n union all select {_KEY}, {d('value')} from o where not exists (select 1 from n where n.security_id = o.security_id and n.metric_code = o.metric_code and n.as_of = o.as_of)""",
      lambda m: writes.upsert_latest(m.sql(_OLD).withColumn("seq", F.lit(0)), m.sql(_NEW).withColumn("seq", F.lit(0)), ["security_id", "metric_code", "as_of"]).select("security_id", "metric_code", "as_of", F.col("value").cast("double").alias("value")))
query("upsert_priority", f"""with u as (select *, 0 as new from ({_OLD}) union all select *, 1 from ({_NEW})), r as (select u.*, row_number() over (partition by {_KEY} order by coalesce(priority, 100) desc, new desc, fetched_at desc) as r from u left join source_rank s on u.source_code = s.source_code)
  select {_KEY}, source_code, {d('value')} as value from r where r = 1""",
      lambda m: writes.upsert_priority(m.sql(_OLD), m.sql(_NEW), ["security_id", "metric_code", "as_of"], m.source_rank).select("security_id", "metric_code", "as_of", "source_code", F.col("value").cast("double").alias("value")))
_TERMS = "select p_partkey as security_id, date '2030-01-01' as maturity_date, cast(p_size as double) / 10 as coupon_rate, date '2001-01-01' as as_of from {part} where p_type = 'PROMO'"
_LATER = "select p_partkey as security_id, date '2031-01-01' as maturity_date, cast(p_size as double) / 20 as coupon_rate, case when p_partkey % 2 = 0 then date '2000-01-01' else date '2001-01-01' end as as_of from {part} where p_type = 'PROMO' and p_partkey % 3 = 0"
query("debt_terms_latest", f"""with u as (select *, 0 as new from ({_TERMS}) union all select *, 1 from ({_LATER})), r as (select *, row_number() over (partition by security_id order by as_of desc, new desc) as r from u) select security_id, maturity_date, coupon_rate, as_of from r where r = 1""",
      lambda m: writes.debt_terms_latest(m.sql(_TERMS), m.sql(_LATER)))
query("learn_codes", "select distinct s.currency_code from security s where currency_code is not null and currency_code not in (select currency_code from venue)", lambda m: common.learn_codes(m.venue.select("currency_code"), m.security, "currency_code"))
_GRAINED = "select series_id, date, close, case when day(date) % 7 = 0 then 'weekly' else 'daily' end as grain from bar"
query("prune_prices", f"select * from ({_GRAINED}) where grain <> 'daily' or date >= {_A} - interval 400 day", lambda m: returns.prune_prices(m.sql(_GRAINED), ASOF))
_STALE = "select concat('S', cast(p_partkey % 50 as string)) as scope_id, t.period, max(p_size) as value from {part} cross join (values ('1d'), ('1y'), ('5y')) as t(period) group by 1, 2"
_MADE = "select distinct concat('S', cast(p_partkey % 50 as string)) as scope_id, t.period from {part} cross join (values ('1d'), ('1y')) as t(period) where p_partkey % 50 < 30"
query("retract_periods", f"with made as ({_MADE}) select p.* from ({_STALE}) p where not (scope_id in (select scope_id from made) and not exists (select 1 from made where made.scope_id = p.scope_id and made.period = p.period))",
      lambda m: pending.retract_periods(m.sql(_STALE), m.sql(_MADE)))

# Scalar rules

query("filing_kind", """select f.security_id, symbol, accession, form, filed, case when form in ('10-K','10-K/A','20-F','20-F/A') then 'annual' when form in ('10-Q','10-Q/A','6-K','6-K/A') then 'interim' else 'event' end as kind from filing f left join provider_symbol p on f.security_id = p.security_id where accession is not null""",
      lambda m: events.filings(m.filing, m.provider_symbol))
query("leadership", f"""select o.security_id, o.name, title, case when pay > 0 then pay end as pay, case when born > 1900 then {EVENT_ASOF.year} - born end as age, fiscal_year, title ilike '%chief executive%' or title ilike '%CEO%' as is_ceo,
  case when filed_currency is not null then filed_currency when currency_code is null then null when currency_code <> 'USD' then currency_code when coalesce(operating_country_iso2, country_iso2) = 'US' then currency_code end as pay_currency
  from officer o join security s on o.security_id = s.security_id""", lambda m: events.leadership(events.officer_clean(m.officer, EVENT_ASOF), m.security))
query("reporting_currency", """select security_id, coalesce(case when security_id % 4 = 0 then filed_currency end, case when currency_code <> 'USD' then currency_code when currency_code = 'USD' and country_iso2 = 'US' then 'USD' end) as reporting_currency from security""",
      lambda m: m.security.select("security_id", rules.reporting_currency(F.when(F.col("security_id") % 4 == 0, F.col("filed_currency")), F.col("currency_code"), F.col("country_iso2")).alias("reporting_currency")))
_IDS = "select security_id, kind, case when security_id % 3 = 0 then concat(' ', lower(value)) when security_id % 3 = 1 then concat(value, '  ') else value end as value from identifier union all select c_custkey, case when c_custkey % 2 = 0 then 'lei' else 'other' end, case c_custkey % 5 when 0 then 'none' when 1 then ' ' else concat(lpad(cast(c_custkey as string), 18, '5'), case when c_custkey % 3 = 0 then 'aB' else '07' end) end from {customer}"
query("valid_identifiers", f"""with i as (select security_id, kind, upper(trim(value)) as value from ({_IDS})) select * from i where (case kind when 'isin' then regexp_matches(value, '^[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]$') when 'cusip' then regexp_matches(value, '^[A-Z0-9]{{9}}$') when 'figi' then regexp_matches(value, '^BBG[A-Z0-9]{{9}}$')
  when 'lei' then regexp_matches(value, '^[A-Z0-9]{{20}}$') else true end) and value not in ('', 'N/A', 'NONE', 'UNKNOWN') and replace(value, left(value, 1), '') <> ''""", lambda m: identity.valid_identifiers(m.sql(_IDS)))
query("asset_type", """select fund_symbol, security_id, as_of, case when asset_category in ('EC','EP') and security_id % 3 <> 0 then 'equity' when asset_category in ('DBT','LON') or asset_category like 'ABS-%' then 'bond' when security_id % 5 = 0 then 'equity' else 'other' end as security_type_code from holding""",
      lambda m: m.holding.select("fund_symbol", "security_id", "as_of", rules.asset_type(F.expr("case when asset_category = 'EC' and security_id % 3 = 0 then 'OTHER' else asset_category end"), F.expr("case when security_id % 5 = 0 then 'NS' else 'PA' end")).alias("security_type_code")))
query("cap_band", "select security_id, case when market_cap >= 10e9 then 'large' when market_cap >= 2e9 then 'mid' when market_cap > 0 then 'small' end as cap_band from security", lambda m: m.security.select("security_id", rules.cap_band(F.col("market_cap")).alias("cap_band")))
query("fx_plausible", "select * from fx_double where usd_per_unit > 1e-7 and usd_per_unit < 10", lambda m: m.fx_double.where(rules.plausible_rate(F.col("usd_per_unit"))))
query("period_types", "select security_id, period_ending, case when lower(period_type) in ('fy', 'annual') then 'annual' when lower(period_type) like 'q%' then 'quarter' else lower(period_type) end as period_type from statement",
      lambda m: m.statement.select("security_id", "period_ending", rules.period_type(F.col("period_type")).alias("period_type")))
query("filtered_securities", "select security_id from security where country_iso2 in ('03', 'US') and currency_code in ('EUR', 'JPY') and market_cap >= 1e9 and market_cap <= 1e12",
      lambda m: common.optional_filters(m.security, {"country_iso2": ["03", "US"], "currency_code": ["EUR", "JPY"], "brand": None}, {"market_cap": (1e9, 1e12)}).select("security_id"))
query("dual_filter", "select security_id, node_id from node where node_id in ('ECONOMY', 'yfinance') or source_code in ('ECONOMY', 'yfinance')", lambda m: common.dual_filter(m.node, "node_id", "source_code", ["ECONOMY", "yfinance"]).select("security_id", "node_id"))

# Returns

_PERIODS = [*returns.PERIOD_DAYS.items()]


def _returns_sql(bars: str, asof: str, year: int, total: bool) -> str:
    """Anchors by a join with each period instead of one aggregation."""
    level = "exp(sum(case when prev is null then 0.0 else ln((close + coalesce(dividend, 0.0)) / prev) end) over (partition by series_id order by date rows unbounded preceding))" if total else "close"
    anchors = " union all ".join([f"select '{p}' as period, cast({asof} - interval {n} day as date) as anchor" for p, n in _PERIODS] + [f"select 'ytd', date '{year - 1}-12-31'"])
    moved = "" if total else "and exists (select 1 from b y where y.series_id = p.series_id and y.date > p.date and y.close <> p.close)"
    return f"""with b0 as (select *, lag(close) over (partition by series_id order by date) as prev from {bars}), b1 as (select *, {level} as v from b0), b as (select * from b1 where date <= {asof}),
  k as (select series_id, max(date) filter (where close > 5 * prev or prev > 5 * close) as broke, count(*) as n, max(date) as last_date from b group by 1), l as (select k.*, b.v as last from k join b on b.series_id = k.series_id and b.date = k.last_date where n >= 2 and last_date >= {asof} - interval 10 day),
  an as ({anchors}), f as (select l.series_id, an.period, max(b.date) as date from l cross join an join b on b.series_id = l.series_id and b.date <= an.anchor group by 1, 2
  union all select l.series_id, '1d', max(b.date) from l join b on b.series_id = l.series_id and b.date < l.last_date group by 1),
  p as (select f.*, b.v, b.close, l.last, l.broke, l.last_date from f join b on b.series_id = f.series_id and b.date = f.date join l on l.series_id = f.series_id)
  select series_id, period, floor((last / v - 1) * 1e6 + 0.5) / 1e4 as {'total_return_pct' if total else 'change_pct'}, last_date as as_of from p where (broke is null or date >= broke) {moved}"""


query("price_returns", _returns_sql("bar", _A, ASOF.year, False), lambda m: returns.price_returns(m.bar, ASOF))
query("total_returns", _returns_sql("event_bar", _E, EVENT_ASOF.year, True), lambda m: returns.total_returns(m.event_bar, EVENT_ASOF))
query("comparable_from", "with b as (select *, lag(close) over (partition by series_id order by date) as prev from bar) select series_id, coalesce(max(date) filter (where close > 5 * prev or prev > 5 * close), min(date)) as comparable_from from b group by 1", lambda m: returns.comparable_from(m.bar))
query("downsample", f"""with b as (select series_id, date, close, date < {_A} - interval 90 day as old, floor(epoch(date) / 604800) as week, max(date) over (partition by series_id) as newest from bar),
  r as (select *, row_number() over (partition by series_id, old, week order by date) as r from b) select series_id, date, close from r where not old or r = 1 or date = newest""", lambda m: returns.downsample(m.bar, ASOF))
_S1 = "select symbol, grain, date, close from sec_bar"
_S2 = "select symbol, 'daily' as grain, cast(date + interval 1 day as date) as date, close + 1 as close from sec_bar"
query("price_series", f"with u as (select *, 1 as p from ({_S1}) union all select *, 2 from ({_S2})), r as (select *, row_number() over (partition by symbol, grain, date order by p, close) as r from u) select symbol, grain, date, close from r where r = 1", lambda m: returns.price_series(m.sql(_S1), m.sql(_S2)))
query("performance", f"with p as ({_returns_sql('bar', _A, ASOF.year, False).replace('with ', 'with ', 1)}) select 'instrument' as scope, f.fund_symbol as scope_id, period, change_pct, as_of, cast(as_of + interval 1 day as date) as stale_after, 'derived' as source from p join fund f on p.series_id = f.series_id where not retired",
      lambda m: returns.performance(m.bar.withColumn("dividend", F.lit(None).cast("double")), m.fund.select(F.lit("instrument").alias("scope"), F.col("fund_symbol").alias("scope_id"), "series_id", "retired"), ASOF).drop("total_return_pct"))
_LAST = "select concat('F', cast(series_id as string)) as symbol, case when series_id % 9 <> 0 then cast(max(date) - interval 1 day * cast(series_id * 37 % 600 as int) as date) end as last_date from bar group by series_id"
query("price_plan", f"""with s as ({_LAST}), f as (select *, last_date is null or last_date < {_A} - interval 400 day as full_ from s), r as (select *, cast(ceil(row_number() over (partition by full_ order by last_date nulls first, symbol) / 20.0) as bigint) as batch from f)
  select symbol, full_ as "full", batch, case when full_ then cast({_A} - interval 400 day as date) else min(last_date) over (partition by full_, batch) end as start from r""", lambda m: returns.price_plan(m.sql(_LAST), ASOF, 20, 400))

_KEPT_BAR = "select security_id, case when security_id % 4 = 0 then 'weekly' else 'daily' end as grain, date, max(close) as close from sec_bar group by 1, 2, 3"
_NEW_BAR = "select security_id, grain, date, close + 1 as close from ({0}) t where year(date) = 2001 and month(date) > 6 union all select security_id, grain, cast(date + interval 1 day * 3000 as date), close from ({0}) t where security_id % 5 = 0 and month(date) = 1"
_STORED_BAR = f"""o as ({_KEPT_BAR}), n as ({_NEW_BAR.format('select * from o')}), w as (select security_id, grain, date, max(close) as close from n group by 1, 2, 3), u as (select * from w union all select * from o where not exists (select 1 from w where w.security_id = o.security_id and w.grain = o.grain and w.date = o.date)),
  kept as (select * from u where grain <> 'daily' or date >= {_A} - interval 400 day)"""


def _bar_table(m: Market) -> str:
    """A laid out table of bars, with others written over it, pruned."""
    name = f"bars_{uuid.uuid4().hex}"
    stores.create_bars(m.sql(_KEPT_BAR), name, new_path(m._spark, "bars"), buckets=8)
    stores.upsert_bars(m.sql(_NEW_BAR.format(_KEPT_BAR)), name, buckets=8)
    stores.prune_bars(m._spark, name, ASOF, buckets=8)
    return name


query("bar_store", f"with {_STORED_BAR} select * from kept", lambda m: m._spark.table(_bar_table(m)).select("security_id", "grain", "date", "close"))
query("latest_bars", f"with {_STORED_BAR} select security_id, max(date) as date, arg_max(close, date) as close from kept where grain = 'daily' group by 1", lambda m: stores.latest_bars(m._spark, _bar_table(m)))

# Currencies

query("fx_current", f"with {_FX_NOW} select * from fx_now", lambda m: currencies.fx_current(m.fx_double))
_MINOR = "(values ('ILA', 'ILS', 100), ('ZAC', 'ZAR', 100), ('KWF', 'KWD', 1000)) as s(minor, major, per)"
query("fx_subunits", f"select currency_code, as_of, usd_per_unit, cast(null as varchar) as derived_from from fx_double union all select minor, as_of, usd_per_unit / per, currency_code from fx_double join {_MINOR} on major = currency_code", lambda m: currencies.fx_subunits(m.fx_double))
query("fx_history", f"""with g as (select * from fx_double where usd_per_unit > 1e-7 and usd_per_unit < 10), u as (select currency_code, as_of, usd_per_unit, cast(null as varchar) as derived_from from g union all select minor, as_of, usd_per_unit / per, currency_code from g join {_MINOR} on major = currency_code)
  select *, count(*) over (partition by currency_code) >= 8 as has_history from u""", lambda m: currencies.fx_history(m.fx_double))
query("market_cap_usd", f"with {_FX_NOW} select security_id, market_cap as market_cap_native, s.currency_code, {r4('cast(market_cap as double) * case when s.currency_code = ' + chr(39) + 'USD' + chr(39) + ' then 1.0 else usd_per_unit end')} as market_cap_usd, f.as_of as fx_as_of from security s left join fx_now f on s.currency_code = f.currency_code",
      lambda m: currencies.market_cap_usd(m.security, m.fx_double))
_VENUES = """vc as (select regexp_extract(symbol, '(\\.[A-Z]+)$', 1) as suffix, currency_code, count(*) as agreeing from security s join provider_symbol p on s.security_id = p.security_id where currency_code is not null and symbol like '%.%' group by 1, 2),
  vt as (select *, sum(agreeing) over (partition by suffix) as securities, row_number() over (partition by suffix order by agreeing desc, currency_code) as r from vc), vq as (select suffix, currency_code as quote_currency, agreeing, cast(securities as bigint) as securities from vt where r = 1 and securities >= 5 and agreeing > {share} * securities)"""
_priced = lambda m: m.security.join(m.provider_symbol, "security_id")
query("venue_currency", f"with {_VENUES.replace('{share}', '0.2')} select * from vq", lambda m: currencies.venue_currency(_priced(m), share=0.2))
query("currency_repair", f"with {_VENUES.replace('{share}', '0.2')} select s.security_id, currency_code as previous, quote_currency as repaired, suffix from security s join provider_symbol p on s.security_id = p.security_id join vq on vq.suffix = regexp_extract(symbol, '(\\.[A-Z]+)$', 1) where currency_code = 'USD' and market_cap > 2e12 and quote_currency <> 'USD'",
      lambda m: currencies.currency_repair(_priced(m), currencies.venue_currency(_priced(m), share=0.2)))
_LIST = """lv as (select p.security_id, exch_code, symbol, preference, v.currency_code, row_number() over (partition by p.security_id, symbol order by preference, exch_code) as r from provider_symbol p join venue v on regexp_extract(symbol, '(\\.[A-Z]+)$', 1) = suffix),
  ls as (select security_id, exch_code, symbol, row_number() over (partition by security_id order by preference, symbol) = 1 as is_primary, currency_code from lv where r = 1)"""
_listings = lambda m: identity.listing_venue(m.provider_symbol.withColumn("chosen", F.lit(False)), m.venue.drop("tier", "enabled", "country_iso2"))
query("listing_venue", f"with {_LIST} select * from ls", _listings)
query("security_currency", f"with {_LIST} select s.security_id, coalesce(ls.currency_code, s.currency_code) as currency_code, case when ls.currency_code is not null then 'listing' when s.currency_code is not null then 'security' end as source, exch_code as venue from security s left join ls on ls.security_id = s.security_id and is_primary",
      lambda m: currencies.security_currency(m.security, _listings(m)))

# Identity

query("security_symbol", f"with {_LIST} select s.security_id, coalesce(l.symbol, p.symbol, t.value) as symbol from security s left join ls l on l.security_id = s.security_id and is_primary left join provider_symbol p on p.security_id = s.security_id left join (select security_id, min(value) as value from identifier where kind = 'ticker' group by 1) t on t.security_id = s.security_id where coalesce(l.symbol, p.symbol, t.value) is not null",
      lambda m: identity.security_symbol(m.security, _listings(m), m.provider_symbol, m.identifier))
_ISSUER = "select concat('I', cast(s_suppkey as string)) as issuer_id, s_name as issuer_name from {supplier}"
_now = lambda m: identity.security_current(m.security, m.node, m.source_rank, m.provider_symbol, m.identifier, m.sql(_ISSUER), m.country_label, m.industry_label)
query("security_current", f"""with {_BEST} select s.security_id, s.name, symbol, i.value as isin, issuer_name, security_type_code, coalesce(operating_country_iso2, country_iso2) as country_iso2, c.name as country_name, country_iso2 as filed_country_iso2, operating_country_iso2 as provider_country_iso2,
  sector_id, industry.industry_id, (select any_value(n.industry) from industry_label n where n.industry_id = industry.industry_id) as industry, market_cap, currency_code, is_tradeable from security s left join provider_symbol p on p.security_id = s.security_id left join identifier i on i.security_id = s.security_id and i.kind = 'isin'
  left join ({_ISSUER}) u on u.issuer_id = s.issuer_id left join country c on c.iso2 = coalesce(operating_country_iso2, country_iso2) left join sector on sector.security_id = s.security_id left join industry on industry.security_id = s.security_id""", _now)
_RES = """select l_orderkey * 10000000 + l_partkey * 10 + l_linenumber as holding_id, case when l_partkey % 3 = 0 and l_linenumber % 3 <> 2 then concat(' us', lpad(cast(l_partkey as string), 9, '0'), cast(l_partkey % 10 as string)) when l_partkey % 3 = 1 then 'N/A' end as isin,
  case when l_partkey % 5 = 0 then '000000000' when l_linenumber % 4 = 3 then lpad(cast(l_partkey + 1 as string), 9, '7') else lpad(cast(l_partkey as string), 9, '7') end as cusip, case when l_partkey % 2 = 0 and l_linenumber % 2 = 0 then concat('BBG', lpad(cast(l_partkey as string), 9, '0')) end as figi from {lineitem}"""
# Securities are found by half of the identifiers that there are, so that others are new; those of a few parts are known by two of their kinds under two ids.
_KNOWN_IDS = "select kind, value, security_id from identifier where security_id % 4 <> 1 union all select 'figi', concat('BBG', lpad(cast(p_partkey as string), 9, '0')), p_partkey + 1000000 from {part} where p_partkey % 10 = 5"
_RESOLVED = f"""h as (select distinct * from ({_RES})), u as (select holding_id, 0 as k, 'isin' as kind, upper(trim(isin)) as value from h union all select holding_id, 1, 'cusip', upper(trim(cusip)) from h union all select holding_id, 2, 'figi', upper(trim(figi)) from h),
  v as materialized (select u.* from u where (kind = 'isin' and regexp_matches(value, '^[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]$')) or (kind = 'cusip' and regexp_matches(value, '^[A-Z0-9]{{9}}$') and replace(value, left(value, 1), '') <> '') or (kind = 'figi' and regexp_matches(value, '^BBG[A-Z0-9]{{9}}$'))),
  known as (select kind, upper(trim(value)) as value, security_id from ({_KNOWN_IDS})), hit as (select holding_id, arg_min(security_id, k * 100000000 + security_id) as sid from v join known using (kind, value) group by 1),
  fresh as materialized (select *, kind || ':' || value as node from v where holding_id not in (select holding_id from hit)), pairs as (select distinct a.node as p, b.node as q from fresh a join fresh b using (holding_id)),
  reach as (select p, p as q from pairs union select r.p, e.q from reach r join pairs e on e.p = r.q), ranked as (select r.p, q, case split_part(q, ':', 1) when 'isin' then '0' when 'cusip' then '1' else '2' end || q as o from reach r),
  made as (select p as node, sha256(arg_min(q, o)) as sid from ranked group by 1)"""
query("resolve_securities", f"""with recursive {_RESOLVED} select holding_id, cast(sid as varchar) as security_id, true as matched from hit union all select distinct holding_id, sid, false from fresh join made using (node)""",
      lambda m: identity.resolve_securities(m.sql(_RES).distinct(), m.sql(_KNOWN_IDS)))
query("new_identifiers", f"with recursive {_RESOLVED} select distinct kind, value, sid as security_id from fresh join made using (node)", lambda m: identity.new_identifiers(m.sql(_RES).distinct(), m.sql(_KNOWN_IDS)))
query("skipped_holdings", f"with recursive {_RESOLVED} select h.* from h where holding_id not in (select holding_id from v)", lambda m: identity.skipped_holdings(m.sql(_RES).distinct()))
_LEI = "select c_custkey as holding_id, c_name as name, case when c_custkey % 4 <> 0 then concat(lpad(cast(c_custkey % 300 as string), 18, '5'), '07') else 'N/A' end as lei from {customer}"
_ISS = "select concat(lpad(cast(s_suppkey as string), 18, '5'), '07') as lei, concat('I', cast(s_suppkey as string)) as issuer_id, s_name as name from {supplier}"
query("resolve_issuers", f"""with h as ({_LEI}), f as (select lei, name, row_number() over (partition by lei order by holding_id) as r from h where regexp_matches(lei, '^[A-Z0-9]{{18}}[0-9]{{2}}$')) select f.lei, coalesce(k.issuer_id, sha256('lei:' || f.lei)) as issuer_id, coalesce(k.name, f.name) as name from f left join ({_ISS}) k on k.lei = f.lei where r = 1""",
      lambda m: identity.resolve_issuers(m.sql(_LEI), m.sql(_ISS)))
_MATCH = "select p_partkey as security_id, concat('T', cast(p_partkey as string), t.s) as symbol, t.e as exch_code from {part} cross join (values ('.HK', 'HK'), ('.KS', 'KS'), ('.L', 'L'), ('.L', 'IL')) as t(s, e) where p_partkey % 4 <> 0"
query("pick_local_symbol", f"with m as ({_MATCH}), r as (select m.security_id, m.symbol, m.exch_code, row_number() over (partition by m.security_id order by preference, m.symbol) as r from m join security s on s.security_id = m.security_id join venue v on v.exch_code = m.exch_code and v.country_iso2 = s.country_iso2) select security_id, symbol, exch_code from r where r = 1",
      lambda m: identity.pick_local_symbol(m.security, m.sql(_MATCH), m.venue))
_HITS = "select p_partkey as security_id, lpad(cast(p_partkey % 8 as string), 2, '0') as country_iso2, concat('T', cast(p_partkey as string), t.s) as symbol, t.k as hit_rank from {part} cross join (values ('', 0), ('.KS', 1), ('.HK', 2), ('.L', 3)) as t(s, k)"
query("pick_home_listing", f"""with h as (select *, regexp_extract(symbol, '(\\.[A-Z]+)$', 1) as suffix from ({_HITS})), j as (select h.*, v.country_iso2 as vc, h.country_iso2 in (select country_iso2 from venue) as known from h join venue v on v.suffix = h.suffix and v.suffix <> ''),
  r as (select security_id, symbol, row_number() over (partition by security_id order by hit_rank, symbol) as r from j where vc = country_iso2 or not known) select security_id, symbol from r where r = 1""", lambda m: identity.pick_home_listing(m.sql(_HITS), m.venue))
_BROKEN = "select p_partkey as security_id, case p_partkey % 4 when 0 then concat('T', cast(p_partkey as string), '*') when 1 then concat('T', cast(p_partkey as string), '/A') when 2 then concat(cast(p_partkey % 900 + 1 as string), '.HK') else concat(case p_partkey % 3 when 0 then 'ABC' else 'XYZ' end, 'B.ST') end as symbol from {part}"
_THERE = "select concat('T', cast(p_partkey as string), case when p_partkey % 8 = 1 then '-A' when p_partkey % 8 = 5 then 'A' else '' end) as symbol from {part} union all select concat(lpad(cast(p_partkey as string), 4, '0'), '.HK') from {part} where p_partkey < 1000 union all select 'ABC-B.ST' from {region}"
query("symbol_repair", f"""with f as ({_BROKEN}), c as (select security_id, symbol, replace(symbol, '*', '') as candidate from f union select security_id, symbol, regexp_replace(symbol, '/([A-Z])', '-\\1', 'g') from f union select security_id, symbol, replace(symbol, '/', '') from f
  union select security_id, symbol, lpad(regexp_extract(symbol, '^(\\d{{1,3}})\\.HK$', 1), 4, '0') || '.HK' from f where regexp_matches(symbol, '^\\d{{1,3}}\\.HK$') union select security_id, symbol, regexp_replace(symbol, '^([A-Z]+)([AB])(\\.(ST|CO|HE|OL))$', '\\1-\\2\\3') from f)
  select security_id, symbol, candidate from c where candidate <> symbol and candidate in (select symbol from ({_THERE}))""", lambda m: identity.symbol_repair(m.sql(_BROKEN), m.sql(_THERE)))
_LABELS = "select distinct p_type as sector_id, concat(p_brand, ' & ', p_type, ' Co.') as label from {part}"
_KNOWN = "select distinct concat(p_type, '--', lower(replace(p_brand, '#', '-')), '-', lower(p_type), '-co') as code from {part} where p_size % 2 = 0 and p_partkey % 3 = 0"
query("industry_nodes", f"""with l as (select sector_id, left(sector_id || '--' || regexp_replace(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), 60) as code, label from ({_LABELS})), r as (select *, row_number() over (partition by code order by label) as r from l)
  select code, sector_id, label from r where r = 1 and code not in (select code from ({_KNOWN}))""", lambda m: identity.industry_nodes(m.sql(_LABELS), m.sql(_KNOWN)))
_ALIAS = "select security_id, symbol as alias from provider_symbol union all select security_id, value from identifier where kind = 'ticker'"
_INSTR = "select case when s_suppkey % 2 = 0 then lower(concat('t', cast(s_suppkey as string))) else concat('T', cast(s_suppkey as string), '.HK') end as symbol, s_name as title, 'curated' as sector_id, case when s_suppkey % 2 = 1 then 'own' end as industry_id, case when s_suppkey % 3 = 0 then 'ZZ' end as country_iso2, 'CHF' as currency_code from {supplier}"
_LINKS = f"a as (select alias, min(security_id) as security_id from ({_ALIAS}) group by 1), k as (select symbol, min(security_id) as security_id from ({_INSTR}) i join a on upper(symbol) = upper(alias) group by 1)"
query("alias_link", f"with {_LINKS} select * from k", lambda m: identity.alias_link(m.sql(_ALIAS), m.sql(_INSTR)))
query("instrument_current", f"""with {_LINKS}, {_BEST} select i.symbol, title, k.security_id, coalesce(sector.sector_id, i.sector_id) as sector_id, coalesce(industry.industry_id, i.industry_id) as industry_id, coalesce(s.operating_country_iso2, s.country_iso2, i.country_iso2) as country_iso2, coalesce(s.currency_code, i.currency_code) as currency_code, s.market_cap
  from ({_INSTR}) i left join k on k.symbol = i.symbol left join security s on s.security_id = k.security_id left join sector on sector.security_id = k.security_id left join industry on industry.security_id = k.security_id""",
      lambda m: identity.instrument_current(m.sql(_INSTR), identity.alias_link(m.sql(_ALIAS), m.sql(_INSTR)), _now(m)))
_CIK = "select concat('{\"0\":{\"ticker\":\"t', cast(p_partkey as string), '\",\"cik\":', cast(p_partkey * 10 + p_partkey % 3 as string), '}}') as body from {part} where p_partkey % 4 <> 1"
query("cik_map", f"with j as (select upper(json_extract_string(body, '$.0.ticker')) as ticker, cast(json_extract_string(body, '$.0.cik') as bigint) as cik from ({_CIK})) select s.security_id, j.cik from security s join j on j.ticker = upper(s.ticker) where s.cik is distinct from j.cik",
      lambda m: identity.cik_map(m.security.select("security_id", "ticker"), m.sql(_CIK), m.security.select("security_id", "cik")))
_EXCH = "select concat('BBG', lpad(cast(p_partkey as string), 9, '0')) as figi, concat('T', cast(p_partkey + 3 as string)) as ticker, case when p_partkey % 5 <> 0 then concat('T', cast(p_partkey + 1 as string), case (p_partkey + 1) % 4 when 1 then '.hk' when 2 then '.ks' when 3 then '.l' else '' end) end as provider_symbol, p_name as name, case p_partkey % 3 when 0 then 'HK' when 1 then 'KS' else 'IL' end as exch_code from {part}"
_UNT = f"""u as (select * from ({_EXCH}) e where not exists (select 1 from identifier i where i.kind = 'figi' and upper(i.value) = upper(e.figi)) and not exists (select 1 from provider_symbol p where upper(p.symbol) = upper(e.provider_symbol))
  and not (e.provider_symbol is null and exists (select 1 from identifier i where i.kind = 'ticker' and upper(i.value) = upper(e.ticker))))"""
_untracked = lambda m: identity.untracked_listing(m.sql(_EXCH), m.identifier, m.provider_symbol)
query("untracked_listing", f"with {_UNT} select * from u", _untracked)
_HELD = "select distinct p_name as name from {part} where p_partkey % 13 = 0"
_QUEUE = f"""{_UNT}, q as (select figi, ticker, name, u.exch_code, country_iso2, provider_symbol, tier, preference from u join venue v on v.exch_code = u.exch_code and enabled where upper(name) not in (select upper(name) from ({_HELD})))"""
_queue = lambda m: identity.pending_promotion(_untracked(m), m.venue.select("exch_code", "country_iso2", "tier", "preference", "enabled"), m.sql(_HELD))
query("pending_promotion", f"with {_QUEUE} select * from q", _queue)
_WAVE = f"{_QUEUE}, w as (select *, sha256('figi:' || figi) as security_id from q where trim(name) <> '' qualify row_number() over (partition by upper(trim(name)) order by tier, preference, name, figi) = 1)"
query("promotion_wave", f"with {_WAVE} select security_id, name, security_type_code, country_iso2, is_tradeable from (select *, 'equity' as security_type_code, true as is_tradeable from w)", lambda m: identity.promotion_wave(_queue(m))[0])
query("promotion_identifiers", f"with {_WAVE} select security_id, 'figi' as kind, figi as value, 'openfigi' as source_code from w union all select security_id, 'ticker', ticker, 'openfigi' from w where ticker is not null", lambda m: identity.promotion_wave(_queue(m))[1])
query("promotion_symbols", f"with {_WAVE} select security_id, 'yfinance' as provider_code, provider_symbol as symbol from w where provider_symbol is not null", lambda m: identity.promotion_wave(_queue(m))[2])
_ROWS = "select concat('F', cast(s_suppkey as string)) as symbol, t.period, cast(s_suppkey as bigint) as value from {supplier} cross join (values ('1y'), ('ytd')) as t(period) where not (s_suppkey % 4 = 1 and t.period = 'ytd')"
_REN = "select concat('F', cast(s_suppkey as string)) as old, concat('F', cast(s_suppkey + 1 as string)) as new from {supplier} where s_suppkey % 4 = 0"
query("rekey", f"with r as ({_ROWS}), n as ({_REN}), k as (select * from r where symbol not in (select old from n)), m as (select n.new as symbol, period, value from r join n on r.symbol = n.old) select * from k union all select * from m where not exists (select 1 from k where k.symbol = m.symbol and k.period = m.period)", lambda m: identity.rekey(m.sql(_ROWS), m.sql(_REN)))

# Statements and metrics

_TTM = """tt as (select security_id, metric_code, as_of, currency_code, sum(value) over w as total, count(*) over w as n, min(as_of) over w as first from metric where period_type = 'quarter' and metric_code in (select metric_code from metric_name where is_flow)
  window w as (partition by security_id, metric_code order by as_of rows between 3 preceding and current row)), t4 as (select * from tt where n = 4 and as_of - first <= 370)"""
query("ttm", f"with {_TTM} select security_id, metric_code, 'ttm' as period_type, as_of, {d('total')} as value, currency_code, 'derived' as source_code from t4", lambda m: metrics.ttm(m.metric, m.metric_name).withColumn("value", F.col("value").cast("double")))
query("metric_series", f"""with g as (select *, as_of - lag(as_of) over (partition by security_id, metric_code, period_type order by as_of, source_code) as gap from metric_mixed),
  c as (select *, sum(case when gap <= 7 then 0 else 1 end) over (partition by security_id, metric_code, period_type order by as_of, source_code rows unbounded preceding) as run from g),
  r as (select c.*, row_number() over (partition by security_id, metric_code, period_type, run order by priority desc nulls last, as_of desc, c.source_code) as r from c left join source_rank s on s.source_code = c.source_code)
  select symbol, r.security_id, r.metric_code, metric_name, category, unit, is_derived, period_type, as_of, {d('value')} as value, currency_code, r.source_code from r join metric_name n on n.metric_code = r.metric_code join provider_symbol p on p.security_id = r.security_id where r = 1""",
      lambda m: metrics.metric_series(m.metric_mixed, m.source_rank, m.metric_name, m.provider_symbol))
query("statement_metrics", f"""with e as (select s.security_id, 'revenue' as metric_code, period_type, period_ending, currency_code, source_code, cast(json_extract_string(payload, '$.total_revenue') as decimal(28,4)) as value from statement s
  union all select security_id, 'eps_diluted', period_type, period_ending, currency_code, source_code, cast(json_extract_string(payload, '$.eps') as decimal(28,4)) from statement)
  select security_id, metric_code, case when lower(period_type) in ('fy', 'annual') then 'annual' when lower(period_type) like 'q%' then 'quarter' else lower(period_type) end as period_type, period_ending as as_of, {d('value')} as value, currency_code, source_code from e""",
      lambda m: metrics.statement_metrics(m.statement, m.field).withColumn("value", F.col("value").cast("double")))
_CASH_KEY = "a.security_id = b.security_id and a.period_type = b.period_type and a.as_of = b.as_of"
_unreported = lambda code: f"not exists (select 1 from cash_metric b where {_CASH_KEY} and b.metric_code = '{code}' and b.source_code <> 'derived')"
query("free_cash_flow", f"select a.security_id, a.period_type, a.as_of, a.currency_code, {d('a.value - abs(b.value)')} as value from cash_metric a join cash_metric b on {_CASH_KEY} and b.metric_code = 'capital_expenditure' where a.metric_code = 'operating_cash_flow' and {_unreported('free_cash_flow').replace('cash_metric b', 'cash_metric c').replace('b.', 'c.')}", lambda m: metrics.free_cash_flow(m.cash_metric))
query("total_debt", f"select a.security_id, a.period_type, a.as_of, a.currency_code, {d('a.value + coalesce(b.value, 0)')} as value from cash_metric a left join cash_metric b on {_CASH_KEY} and b.metric_code = 'short_term_debt' where a.metric_code = 'long_term_debt' and {_unreported('total_debt').replace('cash_metric b', 'cash_metric c').replace('b.', 'c.')}", lambda m: metrics.total_debt(m.cash_metric))
_FACTS = """select o_custkey as security_id, 'us-gaap' as taxonomy, case o_orderkey % 3 when 0 then 'Revenues' when 1 then 'SalesRevenueNet' else 'Assets' end as concept, case when o_orderkey % 20 = 0 then 'EUR' else 'USD' end as unit,
  case when o_orderkey % 3 <> 2 then cast(date_trunc('quarter', o_orderdate) as date) end as start, case when o_orderkey % 4 = 0 then cast(date_trunc('quarter', o_orderdate) + interval 12 month - interval 1 day as date) else cast(date_trunc('quarter', o_orderdate) + interval 3 month - interval 1 day as date) end as "end",
  o_totalprice as val, case when o_orderkey % 4 = 0 then 'FY' else 'Q1' end as fp, cast(o_orderdate as date) as filed from {orders}"""
_CONC = """(values ('us-gaap', 'Revenues', 'revenue', 2, 'USD'), ('us-gaap', 'SalesRevenueNet', 'revenue', 1, 'USD'), ('us-gaap', 'Assets', 'total_assets', 1, 'USD')) as c(taxonomy, concept, metric_code, priority, want_unit)"""
query("xbrl_resolve", f"""with f as (select f.*, case when fp = 'FY' then 'annual' else 'quarter' end as period_type from ({_FACTS}) f), j as (select f.*, metric_code, priority from f join {_CONC} on c.taxonomy = f.taxonomy and c.concept = f.concept and f.unit = want_unit where start is null or (period_type = 'annual' and "end" - start between 300 and 400) or (period_type = 'quarter' and "end" - start between 80 and 100)),
  r as (select *, row_number() over (partition by security_id, metric_code, period_type, "end" order by priority desc, filed desc, val desc) as r from j) select security_id, metric_code, period_type, "end" as as_of, val as value, concept from r where r = 1""",
      lambda m: metrics.xbrl_resolve(m.sql(_FACTS.replace('"end"', "`end`")), m.sql(f"select * from {_CONC}")))
query("metric_asof", f"""select b.security_id, b.date, b.close, {d('(select value from metric x where x.security_id = b.security_id and metric_code = ' + chr(39) + 'revenue' + chr(39) + ' and x.as_of <= b.date order by as_of desc limit 1)')} as revenue from sec_bar b""",
      lambda m: metrics.metric_asof(m.sec_bar, m.metric, ["revenue"]).select("security_id", "date", "close", "revenue"))

_HOT_BAR = "select case when security_id % 3 = 0 then 3 else security_id end as security_id, date, close from sec_bar"
query("metric_asof_hot", f"""select b.security_id, b.date, b.close, m.value as revenue from ({_HOT_BAR}) b asof left join (select security_id, as_of, {d('value')} as value from metric where metric_code = 'revenue') m on m.security_id = b.security_id and b.date >= m.as_of""",
      lambda m: metrics.metric_asof(m.sql(_HOT_BAR), m.metric, ["revenue"], segments=True))


def _ratio_sql() -> str:
    flows, stocks = ("eps_diluted", "revenue", "net_income", "free_cash_flow"), ("total_equity", "total_assets", "shares")
    joins = "".join(f" asof left join (select security_id, as_of, currency_code, cast(total as double) as v from t4 where metric_code = '{c}') {c} on {c}.security_id = b.security_id and b.date >= {c}.as_of" for c in flows)
    joins += "".join(f" asof left join (select security_id, as_of, currency_code, cast(value as double) as v from metric where metric_code = '{c}') {c} on {c}.security_id = b.security_id and b.date >= {c}.as_of" for c in stocks)
    fx = "".join(f" asof left join fx_double {s} on {s}.currency_code = {s}_currency and j.date >= {s}.as_of" for s in ("report", "quote"))
    cols = ", ".join(f"{c}.v as {c}" for c in flows + stocks)
    rate = lambda s: f"case when {s}_currency = 'USD' then 1.0 else {s}.usd_per_unit end"
    pos = lambda a, b: r4(f"({a}) / case when {b} > 0 then {b} end")
    when = lambda test, x: r4(f"case when {test} then {x} end")
    return f"""with {_TTM}, b as (select b.*, currency_code as quote_currency, filed_currency from sec_bar b left join security s on s.security_id = b.security_id),
  j as (select b.symbol, b.security_id, b.date, grain, close, quote_currency, coalesce(greatest({', '.join(f'{c}.currency_code' for c in flows + stocks)}), filed_currency) as report_currency, {cols} from b {joins} where {' or '.join(f'{c}.v is not null' for c in flows + stocks)}),
  p as (select j.*, {rate('report')} as rr, {rate('quote')} as qr from j {fx}), k as (select *, case when report_currency = quote_currency then 1.0 when qr > 0 then rr / qr end as f from p)
  select symbol, security_id, date, grain, close, report_currency, quote_currency, f is not null as currency_comparable, f is not null and not coalesce(report_currency = quote_currency, false) as fx_converted,
  {when('eps_diluted * f > 0', 'close / (eps_diluted * f)')} as pe_ratio, {when('revenue > 0 and shares > 0', 'close * shares / (revenue * f)')} as ps_ratio, {when('total_equity > 0 and shares > 0', 'close * shares / (total_equity * f)')} as pb_ratio,
  {when('free_cash_flow > 0 and shares > 0', 'close * shares / (free_cash_flow * f)')} as price_to_fcf, {when('eps_diluted * f > 0', '100 * (eps_diluted * f / nullif(close, 0))')} as earnings_yield_pct,
  {when('free_cash_flow > 0 and shares > 0', '100 * (free_cash_flow * f / nullif(close * shares, 0))')} as fcf_yield_pct,
  {pos('100 * net_income', 'revenue')} as net_margin_pct, {pos('100 * net_income', 'total_equity')} as roe_pct, {pos('100 * net_income', 'total_assets')} as roa_pct from k"""


query("ratio_series", _ratio_sql(), lambda m: metrics.ratio_series(m.sec_bar, m.metric.drop("source_code").unionByName(metrics.ttm(m.metric, m.metric_name).select("security_id", "metric_code", "period_type", "as_of", "value", "currency_code"), allowMissingColumns=True),
                                                                   m.security, m.fx_double, m.security.select("security_id", F.col("filed_currency").alias("report_currency")), LAST_BAR))
_DONE_M = "select security_id, statement, period_ending, period_type, sha2({0}, 256) as payload_hash from statement where security_id % 3 <> 1"
query("pending_metrics", "select security_id, statement, period_ending, period_type from statement where security_id % 3 = 1 or security_id % 15 = 0",
      lambda m: metrics.pending_metrics(m.statement, m.sql(_DONE_M.format("case when security_id % 15 = 0 then concat(payload, ' ') else payload end"))))
_DONE_T = "select security_id, metric_code, max(fetched_at) - interval 1 day * cast(security_id % 3 as int) as fetched_at from metric where security_id % 4 <> 0 group by 1, 2, security_id % 3"
query("pending_ttm", f"""with q as (select security_id, metric_code, max(fetched_at) as q, count(*) as n from metric where period_type = 'quarter' and metric_code in (select metric_code from metric_name where is_flow) group by 1, 2) select q.security_id, q.metric_code from q left join ({_DONE_T}) d on d.security_id = q.security_id and d.metric_code = q.metric_code where n >= 4 and (d.fetched_at is null or q > d.fetched_at)""",
      lambda m: metrics.pending_ttm(m.metric, m.sql(_DONE_T), m.metric_name))
_RAW = "select p_partkey as security_id, case p_partkey % 3 when 0 then concat('{\"marketCap\":', cast(p_partkey * 1000 as string), ',\"currency\":\"GBP\"}') when 1 then '{\"marketCap\":-5,\"currency\":\"GBp\"}' else '{\"currency\":\"CHF\"}' end as raw from {part}"
_PART_SEC = "select security_id, case when security_id % 2 = 0 then cast(market_cap as double) end as market_cap, currency_code from security"
query("promote_from_raw", f"""select s.security_id, coalesce(s.market_cap, case when s.security_id % 3 = 0 then cast(s.security_id * 1000 as double) end) as market_cap, coalesce(s.currency_code, case s.security_id % 3 when 0 then 'GBP' end) as currency_code,
  case s.security_id % 3 when 0 then 'GBP' when 1 then 'GBP' else 'CHF' end as reporting_currency from ({_PART_SEC}) s""",
      lambda m: metrics.promote_from_raw(m.sql(_PART_SEC), m.sql(_RAW), m.fx_double))
query("statement_current", """select t.security_id, symbol, statement, period_ending, period_type, coalesce(operating_country_iso2, country_iso2) as country, s.currency_code as quote_currency,
  coalesce(t.currency_code, case when s.currency_code <> 'USD' then s.currency_code when s.currency_code = 'USD' and coalesce(operating_country_iso2, country_iso2) = 'US' then 'USD' end) as reporting_currency
  from statement t join security s on s.security_id = t.security_id left join provider_symbol p on p.security_id = t.security_id""", lambda m: metrics.statement_current(m.statement, m.security, m.provider_symbol))
query("fundamentals_current", "select v.security_id, symbol, price_to_book, currency_code from valuation v join security s on s.security_id = v.security_id left join provider_symbol p on p.security_id = v.security_id",
      lambda m: metrics.fundamentals_current(m.valuation, m.security, m.provider_symbol).select("security_id", "symbol", "price_to_book", "currency_code"))

# Facets, style, peers

_LENS = "select iso2 as country_iso2, " + ", ".join(f"max(group_id) filter (where scheme = '{s}' and lens = '{v}') as {c}" for c, (s, v) in facets.LENSES.items()) + " from lens group by 1"
_SPINE = f"""{_BEST}, {_LIST}, {_FX_NOW}, lens_wide as ({_LENS}),
  spine as (select s.security_id, p.symbol, s.name, security_type_code, sector_id, industry.industry_id, industry_label.industry, coalesce(operating_country_iso2, s.country_iso2) as country_iso2, country_name, app_region_id, country_market, msci_tier, msci_region, ftse_tier, ftse_region, income_group, wb_region, un_region, coalesce(ls.currency_code, s.currency_code) as currency_code, case when ls.currency_code is not null then 'listing' when s.currency_code is not null then 'security' end as currency_source, market_cap as market_cap_native,
  maturity_date, coupon_rate, coupon_kind, in_default, is_tradeable,
  {r4("cast(market_cap as double) * case when s.currency_code = 'USD' then 1.0 else usd_per_unit end")} as market_cap_usd from security s left join fx_now f on f.currency_code = s.currency_code left join provider_symbol p on p.security_id = s.security_id left join ls on ls.security_id = s.security_id and is_primary
  left join sector on sector.security_id = s.security_id left join industry on industry.security_id = s.security_id left join lens_wide l on l.country_iso2 = coalesce(operating_country_iso2, s.country_iso2)
  left join country_label on country_label.country_iso2 = coalesce(operating_country_iso2, s.country_iso2) left join industry_label on industry_label.industry_id = industry.industry_id left join bond_terms on bond_terms.security_id = s.security_id),
  banded as (select *, case when market_cap_usd >= 10e9 then 'large' when market_cap_usd >= 2e9 then 'mid' when market_cap_usd > 0 then 'small' end as cap_band from spine)"""
_STYLE = f"""{_CURRENT}, idx as (select security_id, case when bool_or(style = 'growth') and bool_or(style = 'value') then 'blend' when bool_or(style = 'growth') then 'growth' else 'value' end as index_style from held where style is not null group by 1), {_SPINE},
  sc as (select b.security_id, 1 / price_to_book as btp, concat_ws('/', msci_tier, cap_band) as cohort from banded b join valuation v on v.security_id = b.security_id where security_type_code = 'equity' and price_to_book > 0 and market_cap_usd > 0 and msci_tier is not null),
  sr as (select *, percent_rank() over (partition by cohort order by btp) as score, count(*) over (partition by cohort) as n from sc), st as (select sr.*, index_style, case when score >= 0.29 then 'value' when score <= 0.10 then 'growth' else 'blend' end as scored from sr left join idx on idx.security_id = sr.security_id where n >= 30),
  styled as (select security_id, {r4('score')} as value_score, {r4('btp')} as book_to_price, cohort, n as cohort_size, coalesce(index_style, scored) as style, case when index_style is not null then 'index' else 'composite' end as style_source, case when index_style is not null then 'high' when score >= 0.29 then 'moderate' else 'low' end as style_confidence from st)"""


def _base(m: Market) -> DataFrame:
    return facets.facet_base(m.security, m.node, m.source_rank, m.provider_symbol, facets.country_lens(m.lens), m.fx_double, _listings(m), m.country_label, m.industry_label, m.bond_terms)


def _model(m: Market, name: str, tables: str, build: Callable[[], DataFrame], again: bool = False) -> DataFrame:
    """A read model of the driver tables it is made from, by the version of their files."""
    root = f"{shared_dir(m._spark)}/{name}-{hashlib.sha256(m._dir.encode()).hexdigest()[:16]}"
    return versions.read_model(m._spark, root, [f"{m._dir}/{t}.parquet" for t in tables.split()], build, __version__, again).drop("refreshed_at")


def _spine(m: Market, again: bool = False) -> DataFrame:
    return _model(m, "spine", "part nation region orders supplier lineitem", lambda: facets.facets(_base(m), m.valuation, m.holding, m.fund), again)


query("country_lens", _LENS, lambda m: facets.country_lens(m.lens))
query("symbol_security", f"with {_LIST} select s.security_id, coalesce(l.symbol, p.symbol, t.value) as symbol from security s left join ls l on l.security_id = s.security_id and is_primary left join provider_symbol p on p.security_id = s.security_id left join (select security_id, min(value) as value from identifier where kind = 'ticker' group by 1) t on t.security_id = s.security_id where coalesce(l.symbol, p.symbol, t.value) is not null",
      lambda m: _model(m, "symbols", "part", lambda: identity.symbol_security(m.security, _listings(m), m.provider_symbol, m.identifier)))
query("style", f"with {_STYLE} select * from styled", lambda m: facets.style(_base(m), m.valuation, facets.index_label(m.holding, m.fund)))
query("facets", f"with {_STYLE} select banded.*, styled.style, style_source, style_confidence, value_score, cohort as style_cohort from banded left join styled on styled.security_id = banded.security_id", lambda m: _spine(m, again=True))
for _facet in facets.FACETS:
    query(f"aggregate_performance_{_facet}", f"""with {_STYLE}, fc as (select banded.*, styled.style, case when market_cap_usd > 0 then cast(market_cap_usd as decimal(28,0)) end as cap from banded left join styled on styled.security_id = banded.security_id where {_facet} is not null),
  jp as (select fc.*, change_pct as c, total_return_pct as t, p.as_of as dated from fc left join security_perf p on p.security_id = fc.security_id and p.period = '1y')
  select {_facet} as bucket, {r4(f"{d('sum(cap * c)')} / nullif({d('sum(cap) filter (where c is not null)')}, 0)")} as change_pct, {r4(f"{d('sum(c)')} / nullif(count(c), 0)")} as change_pct_equal, {r4(f"{d('sum(cap * t)')} / nullif({d('sum(cap) filter (where t is not null)')}, 0)")} as total_return_pct,
  count(c) as constituents, count(t) as total_return_constituents, count(*) as bucket_securities, {r4(f"{d('sum(cap) filter (where c is not null)')} / nullif({d('sum(cap)')}, 0)")} as weight_covered,
  first(symbol order by abs(cap * c) desc nulls last, security_id) filter (where cap * c is not null) as top_contributor, {r4(f"{d('max(abs(cap * c))')} / nullif({d('sum(abs(cap * c))')}, 0)")} as top_contributor_share, max(dated) as as_of from jp group by 1""",
          lambda m, f=_facet: facets.aggregate_performance(_spine(m), m.security_perf, "1y", f))
query("aggregate_performance_filtered", f"""with {_STYLE}, fc as (select banded.*, case when market_cap_usd > 0 then cast(market_cap_usd as decimal(28,0)) end as cap from banded where un_region in ('ASIA', 'EUROPE') and cap_band in ('large', 'mid') and market_cap_usd <= 1e12 and sector_id is not null),
  jp as (select fc.*, change_pct as c from fc left join security_perf p on p.security_id = fc.security_id and p.period = 'ytd')
  select sector_id as bucket, {r4(f"{d('sum(cap * c)')} / nullif({d('sum(cap) filter (where c is not null)')}, 0)")} as change_pct, count(c) as constituents, count(*) as bucket_securities from jp group by 1""",
      lambda m: facets.aggregate_performance(_spine(m), m.security_perf, "ytd", "sector_id", {"un_region": ["ASIA", "EUROPE"], "cap_band": ["large", "mid"]}, {"market_cap_usd": (None, 1e12)}).select("bucket", "change_pct", "constituents", "bucket_securities"))
query("peers", f"""with {_SPINE}, s as (select * from spine where sector_id is not null and market_cap_usd > 0), p as (select a.security_id, b.security_id as peer_id, b.name as peer_name, b.symbol as peer_symbol, b.market_cap_usd as peer_market_cap_usd, a.market_cap_usd, a.sector_id, abs(log10(b.market_cap_usd / a.market_cap_usd)) as x
  from s a join s b on a.sector_id = b.sector_id and a.security_id <> b.security_id), r as (select *, row_number() over (partition by security_id order by round(x, 9), peer_id) as r from p)
  select security_id, peer_id, peer_name, peer_symbol, peer_market_cap_usd, market_cap_usd, sector_id, {r4('x')} as size_distance from r where r <= 5""", lambda m: facets.peers(_spine(m)))

# Events

_REPORTED = dt.date(2001, 3, 1)
query("earnings_surprise", f"""with e as (select *, strptime(period_ending || '-01', '%Y-%m-%d') as month from earnings where eps_consensus is not null and security_id is not null and report_date <= date '{_REPORTED}')
  select e.security_id, symbol, report_date, period_ending, x.as_of as period_end_date, {d('eps_consensus')} as expected, {d('x.value')} as actual, {d('x.value - eps_consensus')} as surprise,
  cast(round(cast(100 * ({d('x.value - eps_consensus')} / nullif({d('abs(eps_consensus)')}, 0)) as decimal(28,10)), 2) as double) as surprise_pct, x.value >= eps_consensus as beat
  from e join metric x on x.security_id = e.security_id and x.metric_code = 'eps_diluted' and x.period_type = 'quarter' and x.as_of >= month - interval 7 day and x.as_of < month + interval 1 month + interval 7 day""",
      lambda m: events.earnings_surprise(m.earnings, m.metric, _REPORTED))
query("next_earnings", f"""with r as (select *, report_date >= date '2001-03-01' as upcoming, row_number() over (partition by security_id order by report_date >= date '2001-03-01' desc, abs(report_date - date '2001-03-01'), symbol, report_date) as r from earnings where security_id is not null)
  select security_id, symbol, report_date, {d('eps_consensus')} as eps_consensus, {d('eps_previous')} as eps_previous, num_estimates, reporting_time, period_ending, upcoming, as_of from r where r = 1""", lambda m: events.next_earnings(m.earnings, __import__("datetime").date(2001, 3, 1)))
query("insider_summary", f"""select security_id, count(*) filter (where direction = 'Acquisition') as buys, count(*) filter (where direction = 'Disposition') as sells, count(distinct owner_name) filter (where direction = 'Acquisition') as buyers, count(distinct owner_name) filter (where direction = 'Disposition') as sellers,
  {d("coalesce(sum(shares) filter (where direction = 'Acquisition'), 0) - coalesce(sum(shares) filter (where direction = 'Disposition'), 0)")} as net_shares, max(transaction_date) as latest, count(*) as trades from insider where transaction_date >= {_E} - interval 90 day group by 1""", lambda m: events.insider_summary(m.insider, EVENT_ASOF))
query("security_news", """with g as (select * from article where title is not null), r as (select *, row_number() over (partition by url order by published_at, title) as r from g), k as (select distinct url, security_id from g)
  select k.security_id, symbol, k.url, title, source, summary, published_at from k join r on r.url = k.url and r = 1 join provider_symbol p on p.security_id = k.security_id""", lambda m: events.security_news(*events.news_split(m.article), m.provider_symbol))

# Macro

query("macro_current", f"""with r as (select *, row_number() over (partition by indicator_code, dimension order by as_of desc) as r from observation) select code, name, category, country_iso2, unit, frequency, dimension, case when value_is_fraction then {r4('cast(value as decimal(28,10)) * 100')} else value end as value, as_of, fetched_at from r join indicator on code = indicator_code where r = 1 and enabled""",
      lambda m: macro.macro_current(m.observation, m.indicator))
query("macro_dedupe", """select a.code from indicator a where enabled and provider = 'fred' and category in ('inflation', 'labour', 'growth') and exists (select 1 from indicator b where b.enabled and b.provider <> 'fred' and b.country_iso2 is not distinct from a.country_iso2 and b.category = a.category)""", lambda m: macro.macro_dedupe(m.indicator))

# Pending work: twins ask each condition by "exists" of its own table, not by the joins and maps of pending.py.

_MAXW = "mw as (select security_id, cast(max(weight) as double) as best_weight from holding h where as_of = (select max(as_of) from holding x where x.fund_symbol = h.fund_symbol) group by 1)"
_SYMBOLS = f"""{_LIST}, sy as (select s.security_id, coalesce(l.symbol, p.symbol, t.value) as symbol from security s left join ls l on l.security_id = s.security_id and is_primary left join provider_symbol p on p.security_id = s.security_id
  left join (select security_id, min(value) as value from identifier where kind = 'ticker' group by 1) t on t.security_id = s.security_id)"""
_ENT = f"""{_SYMBOLS}, e as (select s.security_id, s.name, security_type_code, country_iso2, operating_country_iso2, cik, i.value as isin, t.value as ticker, p.symbol as own, sy.symbol, coalesce(p.symbol, t.value) as ask
  from security s left join identifier i on i.security_id = s.security_id and i.kind = 'isin' left join identifier t on t.security_id = s.security_id and t.kind = 'ticker' left join provider_symbol p on p.security_id = s.security_id left join sy on sy.security_id = s.security_id)"""
_EQ = "security_type_code = 'equity'"
_has = lambda table, test="true": f"exists (select 1 from {table} x where x.security_id = e.security_id and {test})"
_open = lambda what, days=30: f"not {_has('mark', f'''x.what = '{what}' and x.marked_at >= {_A} - interval {days} day''')}"
_unasked = lambda what, days: f"not {_has('asked', f'''x.what = '{what}' and x.asked_at >= {_A} - interval {days} day''')}"
_failed = lambda *what: _has("mark", f"x.what in ({', '.join(repr(w) for w in what)})")
_BY_PRICE = "symbol, coalesce(own, symbol) as fetch_symbol"
_DRILL = "select iso2 as country_iso2 from country where cast(iso2 as int) % 4 <> 3"
_STALE_AFTER = f"select p_partkey, cast({_A} + interval 1 day * cast(p_partkey % 5 - 2 as int) as date) as stale_after, concat('T', cast(p_partkey as string), case p_partkey % 4 when 1 then '.HK' when 2 then '.KS' when 3 then '.L' else '' end) as served from {{part}} where p_partkey % 3 <> 0"
_PT = "select security_id, case when period_type = 'FY' then 'annual' when security_id % 8 = 1 then 'annual' else 'quarter' end as period_type, currency_code from statement"
#: Columns besides id and weight, and the condition.
_BACKLOGS = {
    "ticker": ("isin, name", f"{_EQ} and isin is not null and not {_has('identifier', '''x.kind = 'ticker' ''')} and {_open('ticker')}"),
    "local_symbol": ("country_iso2, isin", f"{_EQ} and isin is not null and not {_has('provider_symbol')} and country_iso2 is not null and country_iso2 <> 'US' and {_open('local_symbol')}"),
    "home_symbol": ("isin, country_iso2, ask as current_symbol", f"{_EQ} and isin is not null and country_iso2 is not null and {_open('home_symbol')} and (ask is null or {_failed('industry', 'profile', 'performance')})"),
    "profile": ("ask as symbol, name, case when " + _has("node", "x.source_code = 'yfinance'") + " then 'country' else 'sector' end as want",
                f"{_EQ} and ask is not null and ((not {_has('node', '''x.source_code = 'yfinance' ''')} and {_open('profile')}) or (operating_country_iso2 is null and (country_iso2 is null or country_iso2 not in ({_DRILL})) and {_open('provider_country')}))"),
    "profile_detail": ("ask as symbol", f"{_EQ} and ask is not null and not {_has('done', '''x.what = 'profile_detail' ''')} and {_open('profile_detail')}"),
    "industry": ("ask as symbol, sector_id", f"not {_has('node', 'x.level = 2')} and ask is not null and {_open('industry')}"),
    "performance": ("coalesce(symbol, ask) as symbol, ask as fetch_symbol", f"ask is not null and {_open('performance')} and not exists (select 1 from ({_STALE_AFTER}) x where x.served = coalesce(e.symbol, e.ask) and stale_after > {_A})"),
    "prices": (f"{_BY_PRICE}, (select max(date) from held_bar x where x.security_id = e.security_id) as last_date", f"{_EQ} and symbol is not null and {_open('prices')} and not {_has('held_bar', f'x.date >= {_A} - interval 2 day')}"),
    "price_history": (_BY_PRICE, f"{_EQ} and symbol is not null and {_open('price_history')} and not {_has('held_bar', '''x.grain = 'weekly' ''')}"),
    "fundamentals": ("ask as symbol", f"{_EQ} and ask is not null and {_open('fundamentals')} and not {_has('done', '''x.what = 'fundamentals' ''')}"),
    "statements": (f"ask as symbol, ticker as us_ticker, case when {_has(f'({_PT})')} then 'no_currency' else 'missing' end as want",
                   f"{_EQ} and ask is not null and {_open('statements')} and (not {_has(f'({_PT})')} or (not {_has(f'({_PT})', 'x.currency_code is not null')} and ticker is not null and {_open('statement_currency')}))"),
    "quarters": ("ask as symbol", f"{_EQ} and cik is null and ask is not null and {_open('quarters')} and {_has(f'({_PT})', '''x.period_type = 'annual' ''')} and not {_has(f'({_PT})', '''x.period_type = 'quarter' ''')}"),
    "xbrl": ("cik", f"{_EQ} and cik is not null and {_unasked('xbrl', 30)} and {_open('xbrl')}"),
    "corporate_actions": ("ticker as symbol", f"{_EQ} and upper(ticker) = upper(symbol) and {_open('corporate_actions')} and not {_has('held_action', f'x.as_of > {_A} - interval 30 day')}"),
    "dividends": (_BY_PRICE, f"{_EQ} and symbol is not null and {_open('dividends')} and not {_has('held_action', f'''x.kind = 'dividend' and x.as_of > {_A} - interval 30 day''')}"),
    "share_stats": (_BY_PRICE, f"{_EQ} and symbol is not null and {_open('share_stats')} and not {_has('done', f'''x.what = 'share_stats' and x.done_at > {_A} - interval 7 day''')}"),
    "news": (_BY_PRICE, f"{_EQ} and symbol is not null and {_unasked('news', 7)}"),
    "insider": ("cik", f"{_EQ} and cik is not null and {_unasked('insider', 7)}"),
    "filings": ("cik", f"{_EQ} and cik is not null and {_unasked('filings', 7)}"),
    "management": ("ask as symbol", f"{_EQ} and ask is not null and {_unasked('management', 180)} and best_weight >= 0.5"),
    "eps_history": ("ticker as symbol", f"{_EQ} and ticker not like '%.%' and {_has('ls', '''x.exch_code = 'US' ''')} and {_unasked('eps_history', 90)} and best_weight >= 1.0"),
    "symbol_repair": (_BY_PRICE, f"{_EQ} and symbol is not null and {_failed('prices', 'price_history', 'performance')} and {_open('symbol_repair')}"),
}


_level = lambda m, n: m.node.where(F.col("level") == n)
_did = lambda m, what: m.done.where(F.col("what") == what)
#: How each fact that backlogs read is made.
_FACTS_OF: dict[str, Callable[[Market], DataFrame]] = {
    "tagged": lambda m: pending.there(m.node.where("source_code = 'yfinance'"), "tagged"),
    "drillable": lambda m: pending.there(m.sql(_DRILL), "drillable", "country_iso2"),
    "has_profile": lambda m: pending.there(_did(m, "profile_detail"), "has_profile"),
    "sector": lambda m: _level(m, 1).select("security_id", F.col("node_id").alias("sector_id")).distinct(),
    "has_industry": lambda m: pending.there(_level(m, 2), "has_industry"),
    "performance": lambda m: pending.there(m.sql(_STALE_AFTER).where(F.col("stale_after") > F.lit(ASOF)), "fresh", "served"),
    "bars": lambda m: pending.bar_facts(m.held_bar),
    "has_fundamentals": lambda m: pending.there(_did(m, "fundamentals"), "has_fundamentals"),
    "statements": lambda m: pending.statement_facts(m.sql(_PT)),
    "actions": lambda m: pending.action_facts(m.held_action),
    "stats": lambda m: _did(m, "share_stats").groupBy("security_id").agg(F.max("done_at").alias("stats_at")),
    "us_listed": lambda m: pending.there(_listings(m).where("exch_code = 'US'"), "us_listed"),
}


def _backlog(m: Market, name: str) -> DataFrame:
    symbols = identity.security_symbol(m.security, _listings(m), m.provider_symbol, m.identifier)
    facts = {f: _FACTS_OF[f](m) for f in pending.INSTANCES[name].facts}
    return pending.pending(name, pending.entities(m.security, m.identifier, m.provider_symbol, symbols), m.mark, m.asked, funds.max_weight(m.holding), ASOF, facts)


for _name, (_columns, _where) in _BACKLOGS.items():
    _from = "e join (select distinct security_id, node_id as sector_id from node where level = 1) n using (security_id)" if _name == "industry" else "e"
    query(f"pending_{_name}", f"with {_MAXW}, {_ENT} select e.security_id, {_columns}, coalesce(best_weight, 0.0) as best_weight from {_from} left join mw on mw.security_id = e.security_id where {_where}", lambda m, n=_name: _backlog(m, n))
# The same by the names that these had.
for _name in ("home_symbol", "corporate_actions", "eps_history", "quarters"):
    QUERIES[f"{_name}_backlog"], ORACLE_SQL[f"{_name}_backlog"] = QUERIES[f"pending_{_name}"], ORACLE_SQL[f"pending_{_name}"]
_SHORT = "select currency_code, as_of, usd_per_unit from fx_double where currency_code not in ('KWD', 'GBP') or as_of > date '2001-09-01'"
_FX_MARK = f"select currency_code, cast({_A} - interval 1 day * cast(preference * 15 as int) as date) as marked_at from venue"
query("pending_fx_history", f"select distinct currency_code from venue where currency_code <> 'USD' and currency_code not in (select currency_code from ({_SHORT}) where as_of < {_A} - interval 90 day) and currency_code not in (select currency_code from ({_FX_MARK}) where marked_at >= {_A} - interval 30 day)",
      lambda m: pending.pending_fx_history(m.venue.select("currency_code").distinct(), m.sql(_SHORT), m.sql(_FX_MARK), ASOF))
_CHG = "select p_partkey as security_id, date '2001-10-20' as changed_at from {part} where p_partkey % 10 = 0"
query("clear_marks", "select k.* from mark k where not (what in ('prices', 'fundamentals') and security_id % 10 = 0 and marked_at < date '2001-10-20')", lambda m: pending.clear_marks(m.mark, m.sql(_CHG), ["prices", "fundamentals"]))
query("clear_symbol_caches", f"select k.* from mark k where not (what in ({', '.join(repr(w) for w in pending.SYMBOL_KEYED)}) and security_id % 10 = 0 and marked_at < date '2001-10-20')", lambda m: pending.clear_marks(m.mark, m.sql(_CHG), list(pending.SYMBOL_KEYED)))
query("clear_contradicted", f"select k.* from mark k where not (what = 'performance' and exists (select 1 from held_bar b where b.security_id = k.security_id and b.date >= {_A} - interval 5 day))", lambda m: pending.clear_contradicted(m.mark, m.held_bar, ASOF))
_CNT = "select exch_code, cast(preference * 100 as bigint) as stored from venue"
query("listing_counts", f"with e as ({_EXCH}), n as (select exch_code, count(*) as n from e group by 1) select c.exch_code, stored, coalesce(n.n, 0) as actual from ({_CNT}) c left join n on n.exch_code = c.exch_code where stored is distinct from coalesce(n.n, 0)", lambda m: pending.listing_counts(m.sql(_CNT), m.sql(_EXCH)))

# Payload scans, ingest, set operations

_FUND_RAW = """select p_partkey as security_id, concat('{"peRatio":"', cast(p_size as string), '.5","beta":', case when p_partkey % 3 = 0 then '"n/a"' else cast(p_partkey % 4 as string) end, '}') as payload from {part}"""
query("fundamentals_load", """select p_partkey as security_id, p_size + 0.5 as "peRatio", case when p_partkey % 3 <> 0 then cast(p_partkey % 4 as double) end as beta from {part}""".replace("p_size + 0.5", "cast(p_size as double) + 0.5"),
      lambda m: filings.fundamentals_load(m.sql(_FUND_RAW), ["peRatio", "beta"]).drop("payload"))
_PERIODS = "select security_id, to_json(array_sort(collect_list(struct(place, as_of as period_ending, case when security_id % 2 = 0 then 'quarter' end as period_type, cast(cast(s + place as decimal(28,2)) as string) as value)))) as body from (select security_id, as_of, s, explode(array(0, 1)) as place from metric_base) group by 1"
query("statement_load", "select security_id, 'income' as statement, as_of as period_ending, case when security_id % 2 = 0 then 'quarter' else 'annual' end as period_type, cast(cast(s + 1 as decimal(28,2)) as double) as value from metric_base",
      lambda m: filings.statement_load(m.sql(_PERIODS).select("security_id", F.lit("income").alias("statement"), "body")).withColumn("value", F.get_json_object("payload", "$.value").cast("double")).drop("payload"))
_FEED = """select concat('[', array_join(collect_list(to_json(struct(concat('t', cast(p_partkey as string), case when p_partkey % 4 = 0 then '' else '.hk' end) as symbol, case when p_partkey % 3 <> 0 then concat('2001-10-', cast(10 + p_partkey % 15 as string), 'T00:00') end as date,
  cast(p_size as double) as float_shares, cast(p_retailprice as double) as short_interest, p_partkey as institutions_count, case when p_partkey % 5 = 0 then 'usd' when p_partkey % 5 = 1 then 'US$' else 'GBP' end as currency, case when p_partkey % 2 = 0 then 'buy' end as recommendation,
  cast(p_size as double) / 4 as target_high))), ','), case when part % 2 = 0 then ',{"symbol":"T4","date":"2001-10-14","float_shares":"12","target_high":1.5,"currency":7}]' else ']' end) as body from (select *, p_partkey % 7 as part from {part}) group by part"""
_FED = "select p_partkey, security_id, p_size, p_retailprice from {part} join provider_symbol on security_id = p_partkey where p_partkey % 4 in (0, 1) and p_partkey <> 4"
query("share_stats_load", f"""select security_id, case when p_partkey % 3 <> 0 then date '2001-10-10' + cast(p_partkey % 15 as integer) else {_A} end as as_of, cast(p_size as double) as float_shares, p_retailprice as short_interest, cast(p_partkey as double) as institutions_count from ({_FED})
  union all select 4, date '2001-10-14', null, null, null""", lambda m: filings.share_stats_load(m.sql(_FEED), m.provider_symbol, ASOF).select("security_id", "as_of", "float_shares", "short_interest", "institutions_count"))
query("estimates_load", f"""select security_id, {_A} as as_of, cast(p_size as double) / 4 as target_high, case when p_partkey % 2 = 0 then 'buy' end as recommendation, case when p_partkey % 5 = 0 then 'USD' when p_partkey % 5 <> 1 then 'GBP' end as currency_code from ({_FED})
  union all select 4, {_A}, 1.5, null, null""", lambda m: filings.estimates_load(m.sql(_FEED), m.provider_symbol, ASOF).select("security_id", "as_of", "target_high", "recommendation", "currency_code"))
_EPS = """select security_id, concat('{"quarterlyEarnings":[', array_join(collect_list(to_json(struct(cast(as_of as string) as fiscalDateEnding, case when security_id % 4 <> 0 then cast(report_date as string) end as reportedDate, case when security_id % 5 = 0 then 'None' else cast(value as string) end as reportedEPS,
  case when security_id % 7 = 0 then '-' else '0' end as estimatedEPS, '12.5' as surprisePercentage))), ','), ']}') as body from (select security_id, as_of, as_of + interval 30 day as report_date, value from metric where metric_code = 'eps_diluted') group by 1"""
query("eps_history_load", """select security_id, as_of as period_ending, case when security_id % 4 <> 0 then cast(as_of + interval 30 day as date) end as reported_date, case when security_id % 5 <> 0 then cast(value as double) end as eps_actual, case when security_id % 7 <> 0 then 0.0 end as eps_estimated,
  cast(null as double) as surprise, 12.5 as surprise_pct from metric where metric_code = 'eps_diluted'""", lambda m: filings.eps_history_load(m.sql(_EPS)))


def _company_facts(m: Market) -> DataFrame:
    """Facts written as JSON files of company facts, and read from them. A file has the facts of a company in one line."""
    rows = m.metric_base.groupBy("security_id").agg(F.collect_list(F.struct(F.col("as_of").alias("end"), F.col("s").cast("double").alias("val"), F.lit("Q1").alias("fp"))).alias("f"))
    unit = F.create_map(F.when(F.col("security_id") % 5 == 0, "EUR").otherwise("USD"), F.col("f"))
    facts = F.create_map(F.lit("us-gaap"), F.create_map(F.lit("Revenues"), F.struct(unit.alias("units"))))
    path = new_path(m._spark, "facts")
    rows.select(F.to_json(F.struct(F.col("security_id").alias("cik"), facts.alias("facts")))).write.text(path)
    return filings.xbrl_facts(m._spark, path, wholetext=False)


query("xbrl_facts", "select security_id as cik, 'us-gaap' as taxonomy, 'Revenues' as concept, case when security_id % 5 = 0 then 'EUR' else 'USD' end as unit, as_of as \"end\", cast(s as double) as val, 'Q1' as fp from metric_base",
      lambda m: _company_facts(m).select("cik", "taxonomy", "concept", "unit", "end", "val", "fp"))
_UNIT_FACTS = "select o_custkey as cik, 'us-gaap' as taxonomy, case o_orderkey % 2 when 0 then 'Revenues' else 'Shares' end as concept, case when o_orderkey % 2 = 1 and o_orderkey % 3 = 0 then 'shares' when o_orderkey % 5 = 0 then 'EUR' when o_orderkey % 7 = 0 then 'pure' else 'USD' end as unit, o_orderkey as fact from {orders}"
query("choose_units", f"""with f as ({_UNIT_FACTS}), u as (select * from f where unit = 'shares' or regexp_matches(unit, '^[A-Z]{{3}}(/shares)?$')), n as (select cik, concept, unit, row_number() over (partition by cik, concept order by unit = 'shares' desc, count(*) desc, unit) as r from u group by 1, 2, 3)
  select u.* from u join n on n.cik = u.cik and n.concept = u.concept and n.unit = u.unit and r = 1""", lambda m: filings.choose_units(m.sql(_UNIT_FACTS)))
_FILED = "select l_orderkey * 10000000 + l_partkey * 10 + l_linenumber as holding_id, concat('F', cast(l_suppkey as string)) as fund_symbol, cast(date_trunc('quarter', l_shipdate) as date) as as_of, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as weight, cast(max(cast(l_extendedprice as decimal(18,2))) as decimal(28,2)) as market_value, case when l_partkey % 3 = 0 then concat('US', lpad(cast(l_partkey as string), 9, '0'), cast(l_partkey % 10 as string)) end as isin, case when l_partkey % 3 = 1 then lpad(cast(l_partkey as string), 9, '7') end as cusip, cast(null as string) as figi from {lineitem} where l_shipdate >= timestamp '2001-01-01 00:00:00' group by 1, 2, 3, l_partkey"
_INGESTED = f"""h as ({_FILED}), u as (select holding_id, 'isin' as kind, isin as value from h where isin is not null union all select holding_id, 'cusip', cusip from h where cusip <> '777777777'),
  i as (select holding_id, coalesce(cast(min(security_id) as varchar), sha256(any_value(u.kind) || ':' || any_value(u.value))) as sid, min(security_id) is not null as matched from u left join identifier x on x.kind = u.kind and x.value = u.value group by 1)"""
query("fund_ingest", f"""with {_INGESTED}, n as (select fund_symbol, sid as security_id, as_of, sum(weight) as weight, sum(market_value) as market_value from h join i on i.holding_id = h.holding_id group by 1, 2, 3)
  select fund_symbol, security_id, as_of, {d('weight')} as weight, {d('market_value')} as market_value from n
  union all select fund_symbol, cast(security_id as varchar), as_of, {d('sum(weight)')}, {d('sum(market_value)')} from holding o where not exists (select 1 from n where n.fund_symbol = o.fund_symbol and n.security_id = cast(o.security_id as varchar) and n.as_of = o.as_of) group by 1, 2, 3""",
      lambda m: funds.fund_ingest(m.sql(_FILED), m.identifier, funds.merge_lots(m.holding).withColumn("security_id", F.col("security_id").cast("string"))).withColumn("weight", F.col("weight").cast("double")).withColumn("market_value", F.col("market_value").cast("double")))
query("ingest_report", f"with {_INGESTED} select fund_symbol, as_of, count(*) as filed, count(distinct sid) as holdings, count(distinct sid) filter (where not matched) as securities_added, count(*) filter (where sid is null) as skipped from h left join i on i.holding_id = h.holding_id group by 1, 2",
      lambda m: funds.ingest_report(m.sql(_FILED), m.identifier))
_SHARED = "select c_custkey as holding_id, case when c_custkey % 3 = 0 then concat('US', lpad(cast(c_custkey % 200 as string), 9, '0'), '7') end as isin, lpad(cast(c_custkey % 310 as string), 9, '7') as cusip, cast(null as string) as figi from {customer}"
query("shared_identifier_groups", f"""with recursive h as ({_SHARED}), n as (select holding_id, coalesce(isin, '') as a, cusip as b from h), e as (select distinct x.holding_id as p, y.holding_id as q from n x join n y on (x.a <> '' and x.a = y.a) or (x.b <> '777777777' and x.b = y.b)),
  c as (select holding_id as p, holding_id as g from n where a <> '' or b <> '777777777' union select e.q, c.g from c join e on e.p = c.p) select p as holding_id, min(g) as group_id from c group by 1""", lambda m: identity.shared_identifier_groups(m.sql(_SHARED)))
query("dedupe_last", "select user_id, event_type, max(event_id) as event_id from {events} group by 1, 2", lambda m: common.top1(m.sql("select user_id, event_type, event_id from {events}"), ["user_id", "event_type"], F.desc("event_id")))
query("dedupe_first", "select user_id, event_type, min(event_id) as event_id from {events} group by 1, 2", lambda m: common.top1(m.sql("select user_id, event_type, event_id from {events}"), ["user_id", "event_type"], F.asc("event_id")))
query("month_series", "select currency_code, cast(unnest(generate_series(min(as_of), max(as_of), interval 1 month)) as date) as month from fx_double group by 1",
      lambda m: m.fx_double.groupBy("currency_code").agg(F.explode(F.sequence(F.min("as_of"), F.max("as_of"), F.expr("interval 1 month"))).alias("month")))
query("largest_caps", "select security_id, market_cap from security order by market_cap desc nulls last, security_id limit 100", lambda m: m.security.select("security_id", "market_cap").orderBy(F.desc_nulls_last("market_cap"), "security_id").limit(100))


def _streamed(m: Market) -> DataFrame:
    """The events of one file through the stream of bars, and the table that it leaves."""
    spark, schema = m._spark, "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    bars = spark.readStream.schema(schema).parquet(f"{m._dir}/events.parquet*").select(F.col("user_id").alias("series_id"), "ts", F.col("value").alias("close"))
    path = new_path(spark, "prices")
    streams.stream_prices(bars, f"{path}/table", f"{path}/state").awaitTermination()
    return streams.read_prices(spark, f"{path}/table")


query("stream_prices", """with d as (select user_id, ts, max(value) as value from {events} group by 1, 2), r as (select *, row_number() over (partition by user_id, cast(ts as date) order by ts desc) as r from d) select user_id as series_id, cast(ts as date) as date, ts, value as close from r where r = 1""",
      lambda m: _streamed(m).select("series_id", "date", "ts", "close"))


# Filings in XML, and the other streams

_NPORT = """select case when p_partkey % 31 <> 0 then p_name end as name, case when p_partkey % 3 = 0 then 'N/A' else concat('LEI', cast(p_partkey as string)) end as lei, case when p_partkey % 4 = 0 then lpad(cast(p_partkey as string), 9, '7') end as cusip,
  case when p_partkey % 8 <> 0 then concat('US', lpad(cast(p_partkey as string), 9, '0'), cast(p_partkey % 10 as string)) end as isin, case when p_partkey % 6 = 0 then concat('BBG', cast(p_partkey as string)) end as figi,
  cast(p_size as double) as balance, case when p_partkey % 2 = 0 then 'NS' else 'PA' end as units, case when p_partkey % 5 = 0 then 'n/a' else 'EUR' end as currency_code, cast(p_retailprice as double) as value_usd, cast(p_size as double) / 16 as weight,
  case when p_type = 'PROMO' then 'DBT' else 'EC' end as asset_category, 'CORP' as issuer_category, case when p_partkey % 10 <> 9 then 'US' end as country_iso2, maturity_date, coupon_kind, coupon_rate, in_default
  from {part} left join bond_terms on security_id = p_partkey"""


def _filed(m: Market, read: Callable = filings.nport_holdings) -> DataFrame:
    """The holdings written as a folder of fund filings, and read from it."""
    rows, path = m.sql(_NPORT), new_path(m._spark, "nport")
    value = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("_value")))
    other = F.when(F.col("figi").isNotNull(), F.array(F.struct(F.lit("FIGI").alias("_otherDesc"), F.col("figi").alias("_value"))))
    debt = F.struct(F.col("maturity_date").alias("maturityDt"), F.col("coupon_kind").alias("couponKind"), F.col("coupon_rate").alias("annualizedRt"), F.when(F.col("in_default"), "Y").otherwise("N").alias("isDefault"))
    xml = rows.select(
        "name", "lei", F.col("name").alias("title"), "cusip", F.struct(value("isin").alias("isin"), other.alias("other")).alias("identifiers"), "balance", "units", F.col("currency_code").alias("curCd"), F.col("value_usd").alias("valUSD"),
        F.col("weight").alias("pctVal"), F.col("asset_category").alias("assetCat"), F.col("issuer_category").alias("issuerCat"), F.col("country_iso2").alias("invCountry"), F.when(F.col("maturity_date").isNotNull(), debt).alias("debtSec"),
    )
    xml.write.format("xml").option("rootTag", "invstOrSecs").option("rowTag", "invstOrSec").save(path)
    return read(m._spark, path)


query("nport_holdings", f"""select name, nullif(lei, 'N/A') as lei, cusip, isin, figi, balance, units, nullif(currency_code, 'n/a') as currency_code, value_usd, weight, asset_category, issuer_category, country_iso2 from ({_NPORT}) where name is not null""",
      lambda m: _filed(m).withColumn("figi", F.get("other", F.lit(0))["value"]).drop("other", "maturity_date", "coupon_kind", "coupon_rate", "in_default"))
query("nameless_holdings", f"select isin, cusip, balance, weight from ({_NPORT}) where name is null", lambda m: _filed(m, filings.nameless_holdings).select("isin", "cusip", "balance", "weight"))
query("debt_terms_scan", f"select isin, cusip, maturity_date, coupon_kind, coupon_rate, in_default from ({_NPORT}) where name is not null and maturity_date is not null",
      lambda m: _filed(m).where("maturity_date is not null").select("isin", "cusip", "maturity_date", "coupon_kind", "coupon_rate", "in_default"))


def _stream_of(m: Market, parts: list[DataFrame]) -> tuple[DataFrame, str]:
    """A stream that brings each table as a batch of its own, and a new folder. Files are read in the order of their times."""
    path = new_path(m._spark, "stream")
    for k, rows in enumerate(parts):
        # a file of a batch comes after all of the batch before
        rows.coalesce(1).write.parquet(f"{path}/in/part={k}")
    stream = m._spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{path}/in")
    return stream, path


_TITLED = "select url, published_at, title, security_id from article"
_TWICE = f"select url, cast(published_at + interval 1 day * cast(security_id % 3 - 1 as int) as timestamp) as published_at, concat(title, ' v2') as title, security_id + 1 as security_id from ({_TITLED}) t where security_id % 2 = 0"
_NEWS_SQL = f"""with g as (select * from ({_TITLED}) t where title is not null union all select * from ({_TWICE}) t where title is not null), a as (select url, published_at, title from g qualify row_number() over (partition by url order by published_at, title) = 1),
  k as (select * from a where published_at >= {_E} - interval 90 day)"""


def _news_streamed(m: Market) -> tuple[DataFrame, DataFrame]:
    stream, path = _stream_of(m, [m.sql(_TITLED), m.sql(_TWICE)])
    streams.stream_news(stream, f"{path}/out", f"{path}/state").awaitTermination()
    return streams.read_news(m._spark, f"{path}/out", EVENT_ASOF)


query("stream_news", f"{_NEWS_SQL} select url, published_at, title from k", lambda m: _news_streamed(m)[0])
query("stream_news_links", f"{_NEWS_SQL} select distinct url, security_id from g where url in (select url from k)", lambda m: _news_streamed(m)[1])
# Three batches: statements, then changed payloads and another source's, then some as they were at first, later, and some once more.
_BATCHES = [
    "select *, timestamp '2002-01-01 00:00:00' as fetched_at from statement",
    """select security_id, statement, period_ending, period_type, currency_code, source_code, replace(payload, '"total_revenue":', '"total_revenue":9') as payload, timestamp '2002-02-01 00:00:00' as fetched_at from statement where security_id % 2 = 0
  union all select security_id, statement, period_ending, period_type, 'EUR', 'sec-xbrl', replace(payload, '.5}', '.25}'), timestamp '2001-06-01 00:00:00' from statement where security_id % 5 = 0""",
    "select *, timestamp '2002-03-01 00:00:00' as fetched_at from statement where security_id % 4 = 0 union all select *, timestamp '2002-01-01 00:00:00' from statement where security_id % 7 = 0",
]
_FIELDS = "select * from field union all select metric_code, 'sec-xbrl', statement, field from field where metric_code <> 'revenue'"


def _derive_streamed(m: Market) -> DataFrame:
    stream, path = _stream_of(m, [m.sql(b) for b in _BATCHES])
    streams.stream_derive(stream, m.sql(_FIELDS), f"{path}/out", f"{path}/state").awaitTermination()
    return streams.read_derived(m._spark, f"{path}/out", m.source_rank)


query("stream_derive", f"""with s as ({' union all '.join(_BATCHES)}), v as (select s.*, f.metric_code, json_extract(payload, '$.' || f.field) as j from s join ({_FIELDS}) f on f.source_code = s.source_code and f.statement = s.statement),
  n as (select security_id, metric_code, case when lower(period_type) in ('fy', 'annual') then 'annual' when lower(period_type) like 'q%' then 'quarter' else lower(period_type) end as period_type, period_ending as as_of, currency_code, v.source_code, cast(j as decimal(28,4)) as value, fetched_at, priority
  from v left join source_rank r on r.source_code = v.source_code where json_type(j) in ('BIGINT', 'UBIGINT', 'DOUBLE'))
  select security_id, metric_code, period_type, as_of, source_code, {d('value')} as value, currency_code from n qualify row_number() over (partition by security_id, metric_code, period_type, as_of order by coalesce(priority, 100) desc, fetched_at desc) = 1""",
      lambda m: _derive_streamed(m).drop("fetched_at").withColumn("value", F.col("value").cast("double")))


def _periods_streamed(m: Market) -> DataFrame:
    """Metrics by half-decades in the order of their dates, each a batch of a run that goes on from the one before; a row far in the future closes all periods."""
    rows = m.metric_mixed.select("security_id", "metric_code", "period_type", "as_of", "source_code", "value", "currency_code")
    last = m._spark.createDataFrame([(-1, "end", "quarter", dt.date(2100, 1, 1), "none", None, None)], rows.schema)
    cuts = [dt.date(1900, 1, 1), dt.date(1995, 1, 1), dt.date(1998, 6, 15), dt.date(2100, 1, 1)]
    parts = [rows.where((F.col("as_of") >= F.lit(a)) & (F.col("as_of") < F.lit(b))) for a, b in zip(cuts, cuts[1:])]
    path = new_path(m._spark, "stream")
    for part in [*parts, last]:
        part.write.mode("append").parquet(f"{path}/in")
        stream = m._spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        streams.stream_periods(stream, m.source_rank, f"{path}/out", f"{path}/state").awaitTermination()
    return streams.read_periods(m._spark, f"{path}/out")


query("stream_periods", f"""with g as (select *, as_of - lag(as_of) over (partition by security_id, metric_code, period_type order by as_of, source_code) as gap from metric_mixed),
  c as (select *, sum(case when gap <= 7 then 0 else 1 end) over (partition by security_id, metric_code, period_type order by as_of, source_code rows unbounded preceding) as run from g)
  select security_id, metric_code, period_type, as_of, {d('value')} as value, currency_code, c.source_code from c left join source_rank s on s.source_code = c.source_code
  qualify row_number() over (partition by security_id, metric_code, period_type, run order by priority desc nulls last, as_of desc, c.source_code) = 1""",
      lambda m: _periods_streamed(m).withColumn("value", F.col("value").cast("double")))
