"""Market-shaped inputs derived from the driver tables, in SQL that Spark and DuckDB both run.

``{name}`` stands for a driver table, a bare name for another input. Each reads its whole tables; where a rule
leaves rows out by their key, it makes the gaps (no symbol, no quarter, no rate) that operators must handle.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

ASOF, EVENT_ASOF = dt.date(2001, 11, 4), dt.date(2024, 1, 30)

INPUTS: dict[str, str] = {
    "source_rank": """select * from (values ('sec-nport', 300), ('sec-xbrl', 275), ('sec', 250), ('authored', 200), ('openfigi', 150), ('yfinance', 100), ('derived', 50)) as t(source_code, priority)""",
    "venue": """select * from (values ('US', '', 'US', 1, 'USD', 1, true), ('HK', '.HK', '01', 2, 'HKD', 2, true), ('KS', '.KS', '02', 3, 'KRW', 2, true), ('L', '.L', '03', 4, 'GBP', 1, true), ('IL', '.L', '04', 5, 'USD', 3, false)) as t(exch_code, suffix, country_iso2, preference, currency_code, tier, enabled)""",
    "security": """select p_partkey as security_id, p_name as name,
  case when p_type = 'PROMO' then 'bond' when p_partkey % 11 = 0 then 'other' else 'equity' end as security_type_code,
  cast(floor(p_retailprice * (1 + p_size)) as bigint) * (case p_partkey % 4 when 0 then 100000 when 1 then 1000000 when 2 then 10000000 else 100000000 end) as market_cap,
  case p_partkey % 5 when 0 then 'USD' when 1 then 'EUR' when 2 then 'JPY' when 3 then 'GBP' end as currency_code,
  case when p_partkey % 10 = 9 then null when p_partkey % 6 = 0 then 'US' else lpad(cast(p_partkey % 25 as string), 2, '0') end as country_iso2,
  case when p_partkey % 3 = 0 then lpad(cast((p_partkey + 7) % 25 as string), 2, '0') end as operating_country_iso2,
  concat('T', cast(p_partkey as string)) as ticker, p_brand as brand, p_type as kind, case when p_partkey % 4 = 0 then p_partkey * 10 end as cik,
  case when p_partkey % 2 = 0 then 'USD' end as filed_currency, p_partkey % 9 = 0 as price_failed, p_partkey % 14 <> 13 as is_tradeable, concat('I', cast(p_partkey % 30 as string)) as issuer_id,
  case when p_partkey % 8 <> 0 then concat('US', lpad(cast(p_partkey as string), 9, '0'), cast(p_partkey % 10 as string)) end as isin from {part}""",
    "provider_symbol": """select p_partkey as security_id, concat('T', cast(p_partkey as string), case p_partkey % 4 when 1 then '.HK' when 2 then '.KS' when 3 then '.L' else '' end) as symbol from {part} where p_partkey % 7 <> 0""",
    "identifier": """select p_partkey as security_id, 'ticker' as kind, concat('t', cast(p_partkey as string)) as value from {part} where p_partkey % 2 = 0
  union all select p_partkey, 'figi', concat('BBG', lpad(cast(p_partkey as string), 9, '0')) from {part} where p_partkey % 3 = 0
  union all select p_partkey, 'isin', concat('US', lpad(cast(p_partkey as string), 9, '0'), cast(p_partkey % 10 as string)) from {part} where p_partkey % 8 <> 0
  union all select p_partkey, 'cusip', case when p_partkey % 5 = 0 then '000000000' when p_partkey % 7 = 0 then 'N/A' else lpad(cast(p_partkey as string), 9, '7') end from {part} where p_partkey % 4 = 0""",
    "node": """select p_partkey as security_id, 1 as level, p_type as node_id, cast(null as string) as parent_id, 'sec-nport' as source_code, date '2001-01-01' as as_of from {part} where p_partkey % 3 <> 0
  union all select p_partkey, 1, concat('ALT ', p_type), cast(null as string), 'yfinance', date '2001-06-01' from {part} where p_partkey % 2 = 0
  union all select p_partkey, 2, p_brand, p_type, 'yfinance', date '2001-06-01' from {part} where p_partkey % 5 <> 0
  union all select p_partkey, 2, concat(p_brand, ' b'), concat('ALT ', p_type), 'openfigi', date '2001-03-01' from {part} where p_partkey % 4 = 0""",
    "fund": """select concat('F', cast(s_suppkey as string)) as fund_symbol, s_name as name, cast(s_suppkey as bigint) as security_id, s_suppkey as series_id,
  case s_suppkey % 3 when 0 then 'sector' when 1 then 'country' else 'broad' end as kind,
  case s_suppkey % 3 when 0 then case s_suppkey % 2 when 0 then 'ECONOMY' else 'STANDARD' end when 1 then lpad(cast(s_nationkey as string), 2, '0') end as represents_code,
  case s_suppkey % 5 when 0 then 'growth' when 1 then 'value' end as style, s_suppkey % 17 = 0 as retired from {supplier}""",
    "holding": """select concat('F', cast(l_suppkey as string)) as fund_symbol, l_partkey as security_id, cast(date_trunc('quarter', l_shipdate) as date) as as_of,
  cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as weight, cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(28,2)) as market_value,
  case when l_partkey % 11 = 0 and l_partkey % 2 = 0 then case when l_suppkey % 2 = 0 then 'DBT' else 'EC' end when l_partkey % 11 = 0 then 'ABS-MBS' else 'EC' end as asset_category
  from {lineitem} group by 1, 2, 3, 6""",
    "lot": """select concat('F', cast(l_suppkey as string)) as fund_symbol, l_partkey as security_id, cast(date_trunc('quarter', l_shipdate) as date) as as_of,
  case when l_linenumber > 1 then cast(l_quantity as decimal(18,2)) end as weight, case when l_returnflag <> 'R' then cast(l_extendedprice as decimal(18,2)) end as market_value from {lineitem}""",
    "country": """select lpad(cast(n_nationkey as string), 2, '0') as iso2, n_name as name, n_regionkey as regionkey from {nation}""",
    "lens": """select 'msci' as scheme, 'tier' as lens, iso2, case regionkey % 3 when 0 then 'developed' when 1 then 'emerging' else 'frontier' end as group_id from country
  union all select 'un', 'region', lpad(cast(n_nationkey as string), 2, '0'), r_name from {nation} join {region} on n_regionkey = r_regionkey
  union all select s.scheme, s.lens, iso2, concat(s.scheme, ' ', s.lens, ' ', cast((regionkey + cast(iso2 as int) * s.k) % s.n as string)) from country
  cross join (values ('msci', 'region', 1, 5), ('ftse', 'tier', 2, 3), ('ftse', 'region', 3, 4), ('world-bank', 'tier', 1, 4), ('world-bank', 'region', 2, 7)) as s(scheme, lens, k, n) where (cast(iso2 as int) + s.k) % 8 <> 5""",
    "country_label": """select iso2 as country_iso2, name as country_name, concat('region-', cast(regionkey as string)) as app_region_id, case cast(iso2 as int) % 3 when 0 then 'developed' when 1 then 'emerging' end as country_market from country""",
    "industry_label": """select distinct node_id as industry_id, concat('Industry ', node_id) as industry from node where level = 2""",
    "bond_terms": """select p_partkey as security_id, cast(date '2005-01-15' + interval 1 month * cast(p_partkey % 200 as int) as date) as maturity_date, cast(p_size as double) / 8 as coupon_rate,
  case when p_partkey % 3 = 0 then 'Floating' else 'Fixed' end as coupon_kind, p_partkey % 17 = 0 as in_default from {part} where p_type = 'PROMO'""",
    "day_bar": """select l_suppkey as series_id, cast(l_shipdate as date) as date,
  (100 + cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / cast(sum(cast(l_quantity as decimal(18,2))) as double) / 1000) as raw from {lineitem} group by 1, 2""",
    "bar": """select series_id, date, case when series_id % 13 = 0 and date >= date '2001-06-01' then raw * 10 else raw end as close from day_bar""",
    "event_bar": """select user_id as series_id, cast(ts as date) as date, max(value) + 100 as close, max(case when event_type = 'purchase' then value end) as dividend,
  max(case when event_type = 'signup' then 1.0 + user_id % 3 end) as split_ratio from {events} group by 1, 2""",
    "raw_bar": """select event_id as series_id, cast(ts as date) as date, case when event_id % 10 = 0 then 0.0 when event_id % 10 = 1 then -3.0 else value end as close,
  case when event_id % 3 = 0 then value when event_id % 3 = 1 then -1.0 end as dividend, cast(event_id % 4 as double) as split_ratio from {events}""",
    "sec_bar": """select l_partkey as security_id, cast(l_shipdate as date) as date, 'daily' as grain, concat('T', cast(l_partkey as string)) as symbol,
  100 + cast(max(cast(l_extendedprice as decimal(18,2))) as double) / 1000 as close from {lineitem} group by 1, 2, 3, 4""",
    "quarter_sum": """select c_nationkey + 1 as security_id, date_trunc('quarter', o_orderdate) as q, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as s
  from {orders} join {customer} on o_custkey = c_custkey group by 1, 2""",
    "sparse_sum": """select 1000 + o_custkey as security_id, date_trunc('quarter', o_orderdate) as q, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as s from {orders} group by 1, 2""",
    "metric_base": """select security_id, cast(q + interval 3 month - interval 1 day as date) as as_of, s from (select * from quarter_sum union all select * from sparse_sum) u""",
    "metric": """select security_id, m.code as metric_code, 'quarter' as period_type, as_of, cast(s * m.factor as decimal(28,4)) as value,
  case security_id % 4 when 0 then 'USD' when 1 then 'EUR' when 2 then 'JPY' end as currency_code, case when security_id % 2 = 0 then 'sec-xbrl' else 'yfinance' end as source_code, cast(as_of as timestamp) as fetched_at
  from metric_base cross join (values ('revenue', cast(1 as decimal(6,4))), ('net_income', cast(0.1 as decimal(6,4))), ('free_cash_flow', cast(0.08 as decimal(6,4))), ('gross_profit', cast(0.4 as decimal(6,4))), ('total_equity', cast(2 as decimal(6,4))), ('total_assets', cast(5 as decimal(6,4)))) as m(code, factor)
  union all select security_id, 'eps_diluted', 'quarter', as_of, cast(cast(floor(s / 100000) as bigint) % 500 as decimal(28,4)) / 100 - 1, case security_id % 4 when 0 then 'USD' when 1 then 'EUR' when 2 then 'JPY' end, 'sec-xbrl', cast(as_of as timestamp) from metric_base
  union all select security_id, 'shares', 'quarter', as_of, cast(1000 + security_id as decimal(28,4)), null, 'sec-xbrl', cast(as_of as timestamp) from metric_base""",
    "metric_mixed": """select security_id, metric_code, period_type, as_of, value, currency_code, source_code from metric
  union all select security_id, metric_code, period_type, cast(as_of - interval 3 day as date), value + 1, currency_code, 'sec-nport' from metric where security_id % 3 = 0
  union all select security_id, metric_code, period_type, cast(as_of + interval 20 day as date), value + 2, currency_code, 'openfigi' from metric where security_id % 5 = 0""",
    "metric_name": """select * from (values ('revenue', 'Revenue', 'income', 'currency', false, true), ('net_income', 'Net income', 'income', 'currency', false, true), ('free_cash_flow', 'Free cash flow', 'cash', 'currency', true, true), ('gross_profit', 'Gross profit', 'income', 'currency', false, true),
  ('total_equity', 'Equity', 'balance', 'currency', false, false), ('total_assets', 'Assets', 'balance', 'currency', false, false), ('eps_diluted', 'Diluted EPS', 'income', 'per share', false, true), ('shares', 'Shares', 'balance', 'count', false, false)) as t(metric_code, metric_name, category, unit, is_derived, is_flow)""",
    "cash_metric": """select security_id, 'quarter' as period_type, as_of, case when security_id % 4 <> 1 or m.every = 1 and m.factor > 0 then 'USD' end as currency_code, case when security_id % 10 = 0 then 'derived' else 'sec-xbrl' end as source_code, m.code as metric_code, cast(s * m.factor as decimal(28,4)) as value from metric_base
  cross join (values ('operating_cash_flow', cast(0.3 as decimal(6,4)), 1), ('capital_expenditure', cast(-0.1 as decimal(6,4)), 2), ('free_cash_flow', cast(0.25 as decimal(6,4)), 5), ('long_term_debt', cast(1 as decimal(6,4)), 1), ('short_term_debt', cast(0.2 as decimal(6,4)), 3), ('total_debt', cast(1.1 as decimal(6,4)), 4)) as m(code, factor, every) where security_id % m.every = 0""",
    "fx": """select c.code as currency_code, cast(d.m as date) as as_of, c.base * (1 + cast(d.n % 7 as double) / 100) as usd_per_unit
  from (select date_trunc('month', o_orderdate) as m, count(*) as n from {orders} group by 1) d cross join (values ('EUR', 1.1), ('JPY', 0.0067), ('GBP', 1.3), ('ILS', 0.27), ('KWD', 3.2), ('XXX', 11.5)) as c(code, base)""",
    "fx_double": """select currency_code, as_of, cast(usd_per_unit as double) as usd_per_unit from fx""",
    "valuation": """select p_partkey as security_id, cast(p_partkey % 97 - 3 as double) / 10 as price_to_book from {part}""",
    "security_perf": """select p_partkey as security_id, t.period, cast(p_partkey % 41 - 20 as decimal(18,4)) as change_pct, case when p_partkey % 3 <> 0 then cast(p_partkey % 37 - 15 as decimal(18,4)) end as total_return_pct, date '2001-11-04' as as_of
  from {part} cross join (values ('1y'), ('ytd')) as t(period) where p_partkey % 6 <> 5""",
    "earnings": """select concat('T', cast(security_id as string)) as symbol, cast(as_of + interval 30 day as date) as report_date, case when security_id % 10 <> 3 then security_id end as security_id,
  substring(cast(as_of as string), 1, 7) as period_ending, case when security_id % 7 <> 2 then value + cast(security_id % 5 - 2 as decimal(28,4)) / 10 end as eps_consensus, value - cast(security_id % 3 as decimal(28,4)) as eps_previous, security_id % 9 as num_estimates, case security_id % 3 when 0 then 'bmo' when 1 then 'amc' end as reporting_time, cast(as_of - interval 1 day * cast(security_id % 20 as int) as date) as as_of from metric where metric_code = 'eps_diluted'""",
    "insider": """select user_id % 100 as security_id, case when event_id % 50 <> 0 then cast(ts as date) end as transaction_date, concat('owner ', cast(user_id % 40 as string)) as owner_name,
  case event_type when 'purchase' then 'Acquisition' when 'signup' then 'Acquisition' when 'view' then null else 'Disposition' end as direction, cast(event_id % 7 as bigint) * 100 as shares,
  case when event_id % 3 = 0 then 'Option' else 'Common Stock' end as security_type, case when event_id % 5 <> 0 then 10 + event_id % 2 end as price from {events}""",
    "filing": """select o_custkey % 2000 as security_id, case when o_orderkey % 9 <> 0 then concat('acc-', cast(o_orderkey as string)) end as accession,
  case o_orderkey % 7 when 0 then '10-K' when 1 then '20-F/A' when 2 then '10-Q' when 3 then '6-K' when 4 then '8-K' else 'DEF 14A' end as form, cast(o_orderdate as date) as filed from {orders}""",
    "officer": """select c_custkey % 2000 + 1 as security_id, c_name as name, case c_custkey % 5 when 0 then 'Chief Executive Officer' when 1 then 'CEO & Director' when 2 then 'Oceanographer' when 3 then 'Group Ceo' end as title, 2021 + c_custkey % 3 as fiscal_year,
  cast(floor(c_acctbal) as bigint) as pay, case when c_custkey % 6 = 0 then 1800 else 1940 + c_custkey % 60 end as born from {customer}""",
    "article": """select url, timestamp '2024-01-30 00:00:00' - interval 1 day * cast(page_id % 200 as int) as published_at, case when page_id % 20 <> 0 then concat('page ', cast(page_id % 90 as string)) end as title, 'feed' as source, concat('about ', cast(page_id % 90 as string)) as summary, page_id % 400 + 1 as security_id from {pages}
  union all select url, timestamp '2024-01-20 00:00:00', 'again', 'feed', null, page_id % 300 + 1 from {pages} where page_id % 3 = 0""",
    "indicator": """select concat('ind-', cast(n_nationkey as string), '-', p.provider) as code, concat(n_name, ' ', p.provider) as name, case n_nationkey % 4 when 0 then 'inflation' when 1 then 'labour' when 2 then 'growth' else 'rates' end as category,
  case when n_nationkey % 9 <> 4 then lpad(cast(n_nationkey as string), 2, '0') end as country_iso2, p.provider as provider, case n_nationkey % 3 when 0 then 'percent' when 1 then 'index' end as unit, case when n_nationkey % 2 = 0 then 'monthly' else 'quarterly' end as frequency, n_nationkey % 2 = 0 as value_is_fraction, (n_nationkey + p.k) % 5 <> 0 as enabled
  from {nation} cross join (values ('fred', 0), ('oecd', 2)) as p(provider, k)""",
    "observation": """select concat('ind-', cast(c_nationkey as string), '-', case when c_custkey % 2 = 0 then 'fred' else 'oecd' end) as indicator_code, cast(date_trunc('quarter', o_orderdate) as date) as as_of,
  case c_custkey % 3 when 0 then '3m' when 1 then '10y' else '' end as dimension, cast(count(*) as double) / 128 as value, max(o_orderdate) as fetched_at from {orders} join {customer} on o_custkey = c_custkey group by 1, 2, 3""",
    "macro_row": """select concat('ind-', cast(user_id % 25 as string)) as indicator_code, cast(ts as date) as date, event_id as seq,
  case event_id % 4 when 0 then concat('{"maturity":"10y","rate":', cast(event_id % 50 as string), '}') when 1 then concat('{"value":', cast(event_id % 70 as string), '}') when 2 then concat('{"close":"', cast(event_id % 30 as string), '"}') else props end as body from {events}""",
    "statement": """select security_id, 'income' as statement, as_of as period_ending, case security_id % 4 when 0 then 'FY' when 1 then 'Q1' else 'quarter' end as period_type, case when security_id % 3 = 0 then 'USD' end as currency_code, 'yfinance' as source_code,
  concat('{"total_revenue":', cast(cast(floor(s) as bigint) as string), ',"netIncome":"', cast(security_id as string), '","eps":', cast(security_id % 10 as string), '.5}') as payload from metric_base""",
    "field": """select * from (values ('revenue', 'yfinance', 'income', 'total_revenue'), ('net_income', 'yfinance', 'income', 'netIncome'), ('eps_diluted', 'yfinance', 'income', 'eps')) as t(metric_code, source_code, statement, field)""",
    "mark": """select p_partkey as security_id, t.what, cast(date '2001-11-04' - interval 1 day * cast((p_partkey * 7 + t.n * 13) % 61 as int) as date) as marked_at from {part}
  cross join (values ('prices', 0), ('profile', 1), ('statements', 2), ('xbrl', 3), ('ticker', 4), ('industry', 5), ('fundamentals', 6), ('share_stats', 7), ('local_symbol', 8), ('home_symbol', 9), ('provider_country', 10), ('profile_detail', 11), ('performance', 12),
  ('price_history', 13), ('statement_currency', 14), ('quarters', 15), ('corporate_actions', 16), ('dividends', 17), ('symbol_repair', 18), ('estimates', 19)) as t(what, n) where (p_partkey + t.n) % 5 = 0""",
    "asked": """select p_partkey as security_id, t.what, cast(date '2001-11-04' - interval 1 day * cast((p_partkey * t.n) % (t.days * 2) as int) as date) as asked_at from {part}
  cross join (values ('xbrl', 3, 30), ('news', 5, 7), ('insider', 7, 7), ('filings', 11, 7), ('management', 13, 180), ('eps_history', 17, 90)) as t(what, n, days) where (p_partkey + t.n) % 3 <> 0""",
    "held_bar": """select security_id, case when security_id % 3 = 0 and day(date) % 7 = 0 then 'weekly' else 'daily' end as grain, date from sec_bar where date <= date '2001-11-04' - interval 1 day * cast(security_id % 40 as int)""",
    "held_action": """select security_id, case when what = 'dividends' then 'dividend' else 'split' end as kind, done_at as as_of from done where what in ('dividends', 'corporate_actions')""",
    "done": """select p_partkey as security_id, t.what, cast(date '2001-11-04' - interval 1 day * cast((p_partkey + length(t.what) * 5) % 53 as int) as date) as done_at from {part} cross join (values ('prices'), ('performance'), ('xbrl'), ('share_stats'), ('dividends'), ('corporate_actions'), ('news'), ('insider'), ('filings'), ('management'), ('eps_history'), ('fundamentals'), ('industry'), ('price_history'), ('profile_detail')) as t(what) where p_partkey % 8 in (0, 2, 6)""",
}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def needed(text: str) -> list[str]:
    """Inputs that a query names, directly or through others, each after what it needs."""
    out: list[str] = []

    def visit(sql: str) -> None:
        for name in INPUTS:
            if name not in out and re.search(rf"\b(?:from|join)\s+{name}\b", sql):
                visit(INPUTS[name])
                out.append(name)

    visit(text)
    return out


def _fill(sql: str, where) -> str:
    return re.sub(r"\{(\w+)\}", lambda m: where(m[1]) if m[1] in TABLES else m[0], sql)


def with_inputs(text: str, where=lambda t: t) -> str:
    """A query with the inputs that it names as common table expressions."""
    parts = [f"{n} as ({_fill(INPUTS[n], where)})" for n in needed(text)]
    text = _fill(text.strip(), where)
    if not parts:
        return text
    if text.startswith("with recursive "):
        return f"with recursive {', '.join(parts)}, {text[15:]}"
    return f"with {', '.join(parts)}, {text[5:]}" if text.startswith("with ") else f"with {', '.join(parts)} {text}"


class Market:
    """The inputs over the tables of a folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def sql(self, text: str) -> DataFrame:
        return self._spark.sql(with_inputs(text, lambda t: f"parquet.`{self._dir}/{t}.parquet`"))

    def __getattr__(self, name: str) -> DataFrame:
        if name not in INPUTS:
            raise AttributeError(name)
        return self.sql(f"select * from {name}")
