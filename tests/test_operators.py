"""Small literal cases, each chosen so that a tempting wrong formula gives another answer."""

import datetime as dt
import hashlib
import math
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tapeworks.functions import common, rules, scans
from tapeworks.operators import currencies, events, facets, funds, identity, macro, metrics, pending, returns, stores, writes

DAY = dt.date(2026, 8, 9)


def day(text):
    return dt.date.fromisoformat(text)


def table(spark, schema, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_aggregate_performance_recomputes_over_what_is_covered(spark):
    spine = table(spark, "security_id long, symbol string, sector_id string, market_cap_usd double", (1, "AAA", "f", 30e9), (2, "BBB", "f", 10e9), (3, "CCC", "f", 20e9), (4, "DDD", "f", 40e9))
    perf = table(spark, "security_id long, period string, change_pct double, total_return_pct double, as_of date", (1, "1y", 10.0, 12.0, DAY), (2, "1y", 20.0, None, DAY), (3, "1y", -5.0, -5.0, DAY))
    got = facets.aggregate_performance(spine, perf, "1y", "sector_id").first()
    assert (got.change_pct, got.change_pct_equal, got.constituents, got.bucket_securities, got.weight_covered) == (6.6667, 8.3333, 3, 4, 0.6)
    assert got.total_return_pct == 5.2 and got.top_contributor == "AAA" and got.top_contributor_share == 0.5
    with pytest.raises(ValueError):
        facets.aggregate_performance(spine, perf, "1y", "name")


METRIC = "security_id string, metric_code string, period_type string, as_of date, value decimal(28,4), currency_code string, source_code string"


def test_ttm_needs_four_real_quarters(spark):
    ends = ["2025-03-31", "2025-06-30", "2025-09-30", "2025-12-31"]
    rows = [("A", "revenue", "quarter", day(e), D(10 * (k + 1)), "USD", "sec") for k, e in enumerate(ends)]
    rows += [("A", "total_assets", "quarter", day(e), D(500 + k), "USD", "sec") for k, e in enumerate(ends)]
    rows += [("B", "revenue", "quarter", day(e), D(1), "USD", "sec") for e in ("2024-03-31", "2024-06-30", "2025-09-30", "2025-12-31")]
    rows += [("A", "gross_profit", "quarter", day(e), D(k), "USD", "sec") for k, e in enumerate(ends)]
    flows = table(spark, "metric_code string, is_flow boolean", ("revenue", True), ("gross_profit", True), ("total_assets", False))
    got = metrics.ttm(table(spark, METRIC, *rows), flows).collect()
    assert sorted((r.security_id, r.metric_code, r.as_of, r.value) for r in got) == [("A", "gross_profit", day("2025-12-31"), D(6)), ("A", "revenue", day("2025-12-31"), D(100))]


def test_one_fiscal_period_is_one_point(spark):
    dates = [("2025-09-27", "sec-xbrl"), ("2025-09-30", "yfinance"), ("2024-09-26", "yfinance"), ("2024-09-29", "sec-xbrl"), ("2023-08-20", "sec-xbrl"), ("2023-09-29", "sec-xbrl")]
    rows = table(spark, METRIC, *[("A", "revenue", "annual", day(x), D(1), "USD", s) for x, s in dates])
    sources = table(spark, "source_code string, priority int", ("sec-xbrl", 275), ("yfinance", 100))
    got = {r.as_of for r in metrics.fiscal_periods(rows, sources).collect()}
    assert got == {day("2025-09-27"), day("2024-09-29"), day("2023-08-20"), day("2023-09-29")}


def test_ratios_use_the_value_known_at_the_bar(spark):
    m = [("A", "eps_diluted", "ttm", "2025-01-01", 4), ("A", "eps_diluted", "ttm", "2025-07-01", 2), ("A", "eps_diluted", "quarter", "2025-02-01", 9), ("A", "net_income", "ttm", "2025-01-01", 100), ("A", "free_cash_flow", "ttm", "2025-01-01", -9), ("A", "shares", "quarter", "2025-01-01", 3), ("L", "eps_diluted", "ttm", "2025-01-01", -5), ("E", "eps_diluted", "ttm", "2025-01-01", 10), ("A", "total_equity", "quarter", "2025-01-01", 500), ("N", "eps_diluted", "ttm", "2025-01-01", 1)]
    m = table(spark, "security_id string, metric_code string, period_type string, as_of date, value decimal(28,4), currency_code string", *[(a, b, c, day(e), D(v), "EUR" if a == "E" else None) for a, b, c, e, v in m])
    bars = table(spark, "security_id string, symbol string, grain string, date date, close double", *[(s, s, "daily", day(x), 40.0 if x < "2025-08" else 40.0) for s in "ANLEX" for x in ("2025-03-01", "2025-06-30", "2025-08-01")])
    sec = table(spark, "security_id string, currency_code string", ("A", "USD"), ("N", None), ("L", "USD"), ("E", "USD"))
    fx = table(spark, "currency_code string, as_of date, usd_per_unit double", ("EUR", day("2025-01-01"), 1.1))
    rep = table(spark, "security_id string, report_currency string", ("A", "USD"), ("N", None), ("L", "USD"), ("E", "USD"))
    got = by(metrics.ratio_series(bars, m, sec, fx, rep), "security_id", "date")
    assert [got["A", day(x)].pe_ratio for x in ("2025-03-01", "2025-06-30", "2025-08-01")] == [10, 10, 20]
    assert got["A", day("2025-03-01")].roe_pct == 20 and got["A", day("2025-03-01")].earnings_yield_pct == 10 and got["A", day("2025-03-01")].fcf_yield_pct is None
    # a loss has no yield, a metric's own currency is what it was reported in, and a bar before any metric has no row
    assert got["L", day("2025-03-01")].earnings_yield_pct is None and got["L", day("2025-03-01")].pe_ratio is None
    e = got["E", day("2025-03-01")]
    assert (e.report_currency, e.fx_converted, e.pe_ratio) == ("EUR", True, 3.6364) and not [k for k in got if k[0] == "X"]
    assert not got["N", day("2025-03-01")].currency_comparable and got["N", day("2025-03-01")].pe_ratio is None


def test_returns_leave_out_what_they_cannot_know(spark):
    schema = "series_id string, date date, close double, dividend double"
    plain = [("2025-06-01", 80.0), ("2025-12-30", 100.0), ("2026-06-01", 110.0), ("2026-08-01", 120.0), ("2026-08-08", 132.0)]
    broken = [("2025-06-01", 80.0), ("2025-12-30", 100.0), ("2026-07-10", 10000.0), ("2026-08-07", 10500.0), ("2026-08-08", 11000.0)]
    flat = [(str(dt.date(2026, 6, 10) + dt.timedelta(k)), 100.0) for k in range(60)]
    rows = [("p", day(a), b, None) for a, b in plain] + [("b", day(a), b, None) for a, b in broken] + [("f", day(a), b, 2.0 if a == "2026-08-05" else None) for a, b in flat]
    bars = table(spark, schema, *rows)
    price = {k: r.change_pct for k, r in by(returns.price_returns(bars, DAY), "series_id", "period").items()}
    assert (price["p", "1d"], price["p", "ytd"], price["p", "1y"]) == (10.0, 32.0, 65.0) and ("p", "5y") not in price
    assert price["b", "1d"] == 4.7619 and ("b", "1y") not in price and ("b", "ytd") not in price
    assert not [k for k in price if k[0] == "f"]
    total = {k: r.total_return_pct for k, r in by(returns.total_returns(bars, DAY), "series_id", "period").items()}
    assert total["f", "1w"] == 2.0 and total["p", "1y"] == 65.0
    old = returns.price_returns(bars, dt.date(2026, 9, 1))
    assert old.isEmpty()
    assert by(returns.comparable_from(bars), "series_id")["b"].comparable_from == day("2026-07-10")


def test_bars_are_checked(spark):
    rows = table(spark, "series_id long, date date, close double, dividend double, split_ratio double", (1, DAY, 0.0, None, None), (2, DAY, -3.0, None, None), (3, DAY, float("nan"), None, None), (4, DAY, float("inf"), None, None), (5, DAY, 5.0, -1.0, 1.0), (6, DAY, 5.0, 2.0, 4.0))
    good = by(returns.price_bars(rows), "series_id")
    assert set(good) == {5, 6} and good[5].dividend is None and good[5].split_ratio is None
    acts = {(r.series_id, r.kind, r.value) for r in returns.corporate_actions(returns.price_bars(rows)).collect()}
    assert acts == {(6, "dividend", 2.0), (6, "split", 4.0)}


def test_price_plan_numbers_series_in_many_tasks(spark):
    rows = [(f"S{i * 37 % 400:03}", None if i % 9 == 0 else DAY - dt.timedelta(i * i % 130)) for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = returns.price_plan(table(spark, "symbol string, last_date date", *rows), DAY, 20, 100)
        got = out.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    begin, want = DAY - dt.timedelta(100), {}
    for full in (True, False):
        group = sorted((d or dt.date.min, s) for s, d in rows if (d is None or d < begin) == full)
        for k, (_, s) in enumerate(group):
            want[s] = (full, k // 20 + 1, begin if full else group[k // 20 * 20][0])
    assert {r.symbol: (r.full, r.batch, r.start) for r in got} == want and len(got) == 400
    assert len({r.task for r in got}) > 2


def test_surprise_matches_the_right_quarter(spark):
    cal = table(spark, "symbol string, report_date date, security_id string, period_ending string, eps_consensus decimal(28,4)", ("A", DAY, "a", "2026-06", D("2.00")), ("B", DAY, "b", "2026-06", D("-0.10")), ("C", DAY, "c", "2026-06", D("1")), ("Z", DAY, "z", "2026-06", D("0")))
    m = table(spark, METRIC, *[(i, "eps_diluted", "quarter", day(x), D(v), "USD", "sec") for i, x, v in (("a", "2026-07-04", "2.50"), ("a", "2026-03-31", "9"), ("b", "2026-06-30", "-0.05"), ("z", "2026-06-30", "1"))])
    cal = cal.unionByName(table(spark, "symbol string, report_date date, security_id string, period_ending string, eps_consensus decimal(28,4)", ("M", DAY, "m", "2026-06", D("1")), ("F", DAY + dt.timedelta(1), "a", "2026-06", D("1"))))
    m = m.unionByName(table(spark, METRIC, ("m", "eps_diluted", "quarter", day("2026-06-30"), D(1), "USD", "sec")))
    got = by(events.earnings_surprise(cal, m, DAY), "security_id")
    # the consensus met is a beat; a report still to come is none
    assert (got["m"].surprise, got["m"].beat) == (0.0, True) and got["a"].symbol == "A"
    assert (got["a"].surprise, got["a"].surprise_pct, got["a"].beat) == (0.5, 25.0, True)
    assert (got["b"].surprise_pct, got["b"].beat) == (50.0, True)
    assert "c" not in got and got["z"].surprise_pct is None


def test_a_quarter_may_end_a_week_around_its_month(spark):
    cal = table(spark, "symbol string, report_date date, security_id string, period_ending string, eps_consensus decimal(28,4)", *[("A", DAY, i, p, D("1")) for i, p in (("a", "2026-06"), ("a", "2026-05"), ("a", None), (None, "2026-06"), ("b", "2026-12"))])
    ends = ["2026-05-24", "2026-05-25", "2026-06-07", "2026-06-08", "2026-06-30", "2026-07-07", "2026-07-08"]
    m = table(spark, METRIC, *[(i, "eps_diluted", "quarter", day(x), D(1), "USD", "sec") for i, x in [("a", x) for x in ends] + [("b", "2026-11-24"), ("b", "2027-01-07"), ("b", "2027-01-08"), (None, "2026-06-30")]])
    got = {(r.security_id, r.period_ending, str(r.period_end_date)) for r in events.earnings_surprise(cal, m, DAY).collect()}
    assert got == {("a", "2026-06", x) for x in ends[1:6]} | {("a", "2026-05", x) for x in ends[:3]} | {("b", "2026-12", "2026-11-24"), ("b", "2026-12", "2027-01-07")}


def test_the_first_of_a_key_is_found_before_the_shuffle(spark):
    # so a key with a third of all rows sends one row from each task
    rows = table(spark, "k long, v long", *[(1, k) for k in range(50)])
    plan = common.top1(rows, ["k"], F.desc("v"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial") and "WindowGroupLimit" in text
    assert [tuple(r) for r in plan.collect()] == [(1, 49)]


def test_next_earnings_prefers_upcoming(spark):
    d1 = dt.timedelta(1)
    cal = table(spark, "symbol string, report_date date, security_id string, period_ending string, eps_consensus double, eps_previous double, num_estimates int, reporting_time string, as_of date", *[(*r, 0.5, 3, "amc", DAY) for r in (("A", DAY - 2 * d1, "a", "x", 1.0), ("A", DAY + 30 * d1, "a", "x", 2.0), ("B", DAY - 9 * d1, "b", "x", 3.0), ("B", DAY - 5 * d1, "b", "x", 4.0), ("N", DAY, None, "x", 5.0))])
    got = by(events.next_earnings(cal, DAY), "security_id")
    assert (got["a"].eps_previous, got["a"].num_estimates, got["a"].reporting_time) == (0.5, 3, "amc") and got["a"].eps_consensus == 2.0 and got["a"].upcoming and got["b"].eps_consensus == 4.0 and not got["b"].upcoming and None not in got


def test_insiders_are_counted_as_people(spark):
    rows = [("s", DAY, n, "Acquisition", 1000) for n in ("Ada", "Ada", "Grace", "Alan", "Edsger")] + [("s", DAY, "Tony", "Disposition", 50000), ("s", DAY - dt.timedelta(200), "Old", "Acquisition", 1)]
    neither = events.insider_summary(table(spark, "security_id string, transaction_date date, owner_name string, direction string, shares long", ("n", DAY, "x", None, 5)), DAY).first()
    assert (neither.trades, neither.net_shares) == (1, 0.0)
    got = events.insider_summary(table(spark, "security_id string, transaction_date date, owner_name string, direction string, shares long", *rows), DAY).first()
    assert (got.buys, got.sells, got.buyers, got.sellers, got.net_shares) == (5, 1, 4, 1, -45000.0)
    assert events.insider_keyed(table(spark, "security_id string, transaction_date date, owner_name string, direction string, shares long", *rows, ("s", None, "x", "Acquisition", 1))).count() == 6


def test_trades_at_two_prices_are_two(spark):
    schema = "security_id string, transaction_date date, owner_name string, direction string, shares long, security_type string, price double, note string"
    rows = [("s", DAY, "Ada", "Acquisition", 100, "Common", 10.0, "b"), ("s", DAY, "Ada", "Acquisition", 100, "Common", 11.0, None), ("s", DAY, "Ada", "Acquisition", 100, "Option", 10.0, None), ("s", DAY, "Ada", "Acquisition", 100, "Common", 10.0, "a"), ("s", DAY, "Ada", None, None, None, None, None)]
    got = events.insider_keyed(table(spark, schema, *rows)).collect()
    assert sorted((r.price or 0, r.security_type or "", r.note or "") for r in got) == [(0, "", ""), (10.0, "Common", "a"), (10.0, "Option", ""), (11.0, "Common", "")]


def test_ranks_in_ranges_are_ranks(spark):
    import random

    from tapeworks.functions.common import ranked

    rng = random.Random(4)
    rows = [(k, rng.choice(["a", "b", None]), rng.choice([None, *range(40)]) if k % 3 else 7) for k in range(400)]
    got = {r.i: (r.rank, r.group_size) for r in ranked(table(spark, "i int, g string, v int", *rows), "g", "v").collect()}
    low = lambda v: (v is not None, v or 0)
    assert got == {i: (1 + sum(low(w) < low(v) for _, h, w in rows if h == g), sum(h == g for _, h, _ in rows)) for i, g, v in rows}
    assert ranked(table(spark, "i int, g string, v int", *rows).where("false"), "g", "v").count() == 0


def test_old_reports_leave_the_calendar(spark):
    rows = [("A", DAY - dt.timedelta(90)), ("B", DAY - dt.timedelta(91)), ("C", DAY + dt.timedelta(5)), ("D", None)]
    assert sorted(r.symbol for r in events.prune_earnings(table(spark, "symbol string, report_date date", *rows), DAY).collect()) == ["A", "C"]


def test_reporting_currency_is_promoted_apart_from_the_quote(spark):
    sec = table(spark, "security_id int, market_cap double, currency_code string, reporting_currency string", (1, None, None, None), (2, 5.0, "GBP", "GBP"), (3, None, None, "EUR"), (4, None, None, None))
    raw = table(spark, "security_id int, raw string", (1, '{"marketCap": 7, "currency": "USD"}'), (2, '{"currency": "usd"}'), (3, '{"currency": 840}'), (4, '{"currency": "QQQ"}'))
    got = {r.security_id: (r.market_cap, r.currency_code, r.reporting_currency) for r in metrics.promote_from_raw(sec, raw, table(spark, "currency_code string", ("USD",), ("GBP",))).collect()}
    assert got == {1: (7.0, "USD", "USD"), 2: (5.0, "GBP", "USD"), 3: (None, None, "EUR"), 4: (None, None, "QQQ")}


def test_a_read_model_follows_its_inputs(spark, tmp_path):
    from tapeworks.functions import versions

    root, source, built = str(tmp_path / "model"), str(tmp_path / "in"), []
    write = lambda n: spark.range(n).write.mode("overwrite").parquet(source)
    read = lambda **k: versions.read_model(spark, root, [source], lambda: built.append(1) or spark.read.parquet(source), **k)
    write(5)
    first = read()
    assert first.count() == 5 and "refreshed_at" in first.columns and read().count() == 5 and len(built) == 1
    write(7)
    assert read().count() == 7 and len(built) == 2
    # whoever began with the old version ends with it
    assert first.count() == 5
    assert read(also="other code").count() == 7 and len(built) == 3
    assert versions.prune(root, keep=1) == 2 and read(also="other code").count() == 7 and len(built) == 3


def test_shared_folder_must_be_named_on_a_cluster(spark):
    from tapeworks.functions.scratch import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError):
        shared_dir(Session())
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        shared_dir(Session())
    assert shared_dir(spark).startswith("file:")


def test_peers_are_comparable_in_one_currency(spark):
    sec = table(spark, "security_id long, market_cap double, currency_code string, sector_id string, name string, symbol string", (1, 10e9, "USD", "s", "a", "A"), (2, 12.5e9, "USD", "s", "b", "B"), (3, 1.5e12, "JPY", "s", "c", "C"), (4, 900e9, "USD", "s", "d", "D"), (5, 1.0, "GBP", "s", "e", "E"))
    fx = table(spark, "currency_code string, as_of date, usd_per_unit double", ("JPY", DAY, 0.0067), ("JPY", DAY - dt.timedelta(9), 1.0))
    spine = currencies.market_cap_usd(sec, fx).select("security_id", "market_cap_usd").join(sec, "security_id")
    got = facets.peers(spine, 3).where("security_id = 1").collect()
    assert [r.peer_id for r in sorted(got, key=lambda r: r.size_distance)] == [3, 2, 4]
    assert abs([r for r in got if r.peer_id == 4][0].size_distance - 1.9542) < 1e-3


def test_peers_of_equal_caps_are_the_least_ids(spark):
    caps = [1e9] * 12 + [2e9, 3e9] + [5e9 + i / 8 for i in (7, 3, 11, 0, 5, 9, 1, 10, 2, 8, 4, 6, 12, 13)] + [7e9] * 13
    caps += [5e9 * 1.5 + 9 * i for i in (3, 1, 2, 0)]
    rows = [(i + 1, c, s, f"n{i}", f"S{i}") for s, shift in (("s", 0), ("t", 100)) for i, c in ((j + shift, c) for j, c in enumerate(caps))]
    spine = table(spark, "security_id long, market_cap_usd double, sector_id string, name string, symbol string", *rows)
    for k in (5, 2):
        got = {}
        for r in facets.peers(spine, k).collect():
            got.setdefault(r.security_id, set()).add(r.peer_id)
        for i, c, s, *_ in rows:
            others = sorted((round(abs(math.log10(d / c)), 9), j) for j, d, t, *_ in rows if t == s and j != i)
            assert got[i] == {j for _, j in others[:k]}, (k, i)
    few = table(spark, "security_id long, market_cap_usd double, sector_id string, name string, symbol string", (1, 5.0, "s", None, None), (2, 5.0, "s", "b", "B"), (3, 9.0, "t", "c", "C"))
    assert sorted((r.security_id, r.peer_id, r.size_distance) for r in facets.peers(few).collect()) == [(1, 2, 0.0), (2, 1, 0.0)]


def test_style_ranks_within_a_cohort(spark):
    rows = [(i, "developed", 1 / i) for i in range(1, 41)] + [(100 + i, "emerging", 1 / (100 + i)) for i in range(1, 41)] + [(900 + i, "frontier", 1.0) for i in range(5)]
    spine = table(spark, "security_id long, security_type_code string, msci_tier string, market_cap_usd double", *[(i, "equity", t, 25e9) for i, t, _ in rows])
    val = table(spark, "security_id long, price_to_book double", *[(i, p) for i, _, p in rows])
    labels = table(spark, "security_id long, index_style string", (40, "growth"))
    got = by(facets.style(spine, val, labels), "security_id")
    assert got[1].value_score == got[101].value_score == 0 and got[40].value_score == got[140].value_score == 1
    assert (got[40].style_source, got[40].style_confidence, got[140].style_source, got[140].style_confidence, got[1].style_confidence, got[1].cohort) == ("index", "high", "composite", "moderate", "low", "developed/large")
    assert got[40].style == "growth" and got[40].style_source == "index" and got[140].style == "value" and 900 not in got


def test_macro(spark):
    obs = table(spark, "indicator_code string, as_of date, dimension string, value double, fetched_at date", *[(*r, DAY) for r in (("us-cpi", DAY, "", 0.0239), ("us-cpi", DAY - dt.timedelta(31), "", 0.5), ("us-gdp", DAY, "", 21500.0), ("curve", DAY, "10y", 4.0), ("curve", DAY, "3m", 5.0), ("off", DAY, "", 1.0))])
    ind = table(spark, "code string, name string, category string, country_iso2 string, unit string, frequency string, value_is_fraction boolean, enabled boolean", *[(c, c, "x", "US", "u", "f", c == "us-cpi", c != "off") for c in ("us-cpi", "us-gdp", "curve", "off")])
    got = {(r.code, r.dimension): r.value for r in macro.macro_current(obs, ind).collect()}
    assert got == {("us-cpi", ""): 2.39, ("us-gdp", ""): 21500.0, ("curve", "10y"): 4.0, ("curve", "3m"): 5.0}
    pts = table(spark, "indicator_code string, date date, seq long, body string", ("a", DAY, 1, '{"maturity":"10y","rate":4.5}'), ("a", DAY, 2, '{"maturity":"10y","rate":9}'), ("b", DAY, 1, '{"name":"x","odd":"7.5"}'), ("c", DAY, 1, '{"value":"None","close":3}'), ("d", DAY, 1, "{}"))
    got = {(r.indicator_code, r.dimension): r.value for r in macro.macro_points(pts).collect()}
    assert got == {("a", "10y"): 4.5, ("b", ""): 7.5, ("c", ""): 3.0}


def test_untracked_means_untracked(spark):
    listings = table(spark, "figi string, ticker string, name string, exch_code string, provider_symbol string", ("F1", "X", "n", "KS", None), ("F2", "Y", "n", "KS", "held.ks"), ("F3", "zz", "n", "US", None), ("F4", "005930", "n", "KS", "005930.KS"))
    ids = table(spark, "kind string, value string, security_id long", ("figi", "f1", 1), ("ticker", "ZZ", 2), ("ticker", "005930", 3))
    prov = table(spark, "security_id long, symbol string", (9, "HELD.KS"))
    assert [r.figi for r in identity.untracked_listing(listings, ids, prov).collect()] == ["F4"]


def test_a_venue_majority_repairs_only_the_impossible(spark):
    rows = [(i, f"S{i}.XX", "CNY", 1e9) for i in range(5)] + [(6, "S6.XX", "HKD", 1e9), (7, "S7.XX", "USD", 4.4e14), (8, "S8.XX", "USD", 1e9)]
    sec = table(spark, "security_id long, symbol string, currency_code string, market_cap double", *rows)
    venues = currencies.venue_currency(sec)
    assert [(r.suffix, r.quote_currency, r.agreeing, r.securities) for r in venues.collect()] == [(".XX", "CNY", 5, 8)]
    assert [(r.security_id, r.previous, r.repaired) for r in currencies.currency_repair(sec, venues).collect()] == [(7, "USD", "CNY")]


def test_news_is_shared_and_bounded(spark):
    rows = table(spark, "url string, published_at timestamp, title string, source string, security_id long", ("u", dt.datetime(2026, 8, 1), "t", "s", 1), ("u", dt.datetime(2026, 8, 1), "t", "s", 2), ("old", dt.datetime(2026, 1, 1), "t", "s", 1), (None, dt.datetime(2026, 8, 1), "t", "s", 1), ("x", None, "t", "s", 1))
    articles, links = events.news_split(rows)
    assert articles.count() == 2 and links.count() == 3
    articles, links = events.prune_news(articles, links, DAY)
    assert [r.url for r in articles.collect()] == ["u"] and links.count() == 2


def test_older_filings_change_nothing(spark):
    schema = "security_id long, maturity_date date, coupon_rate double, as_of date"
    old = table(spark, schema, (1, DAY, 5.0, DAY), (2, DAY, 5.0, DAY))
    new = table(spark, schema, (1, DAY, 4.0, DAY - dt.timedelta(1)), (2, DAY, 0.0, DAY))
    got = by(writes.debt_terms_latest(old, new), "security_id")
    assert got[1].coupon_rate == 5.0 and got[2].coupon_rate == 0.0
    again = writes.debt_terms_latest(writes.debt_terms_latest(old, new), new)
    assert sorted(again.collect()) == sorted(got.values())


def test_priority_beats_recency(spark):
    schema = "k long, source_code string, value double, fetched_at timestamp"
    old = table(spark, schema, (1, "sec-xbrl", 1.0, dt.datetime(2026, 1, 1)), (2, "yfinance", 1.0, dt.datetime(2026, 1, 1)))
    new = table(spark, schema, (1, "yfinance", 2.0, dt.datetime(2026, 2, 1)), (2, "nobody", 2.0, dt.datetime(2026, 2, 1)))
    sources = table(spark, "source_code string, priority int", ("sec-xbrl", 275), ("yfinance", 100))
    got = by(writes.upsert_priority(old, new, ["k"], sources), "k")
    assert got[1].value == 1.0 and got[2].value == 2.0
    seq = "k long, seq long, v string"
    kept = writes.upsert_latest(table(spark, seq, (1, 0, "old")), table(spark, seq, (1, 0, "new"), (1, 1, "newer"), (2, 0, "x")), ["k"])
    assert {r.k: r.v for r in kept.collect()} == {1: "newer", 2: "x"}
    assert {r.k: r.v for r in writes.upsert_latest(table(spark, seq, (1, 0, "old")), table(spark, seq, (1, 0, "new")), ["k"], keep_existing=True).collect()} == {1: "old"}


def test_asof_carries_forward_from_each_step(spark):
    points = table(spark, "k string, at int", ("a", 0), ("a", 5), ("a", 9), ("b", 5), (None, 5))
    steps = table(spark, "k string, since int, v string", ("a", 5, "x"), ("a", 8, "y"))
    got = {(r.k, r["at"]): r.v for r in common.asof(points, steps, ["k"], "at", "since", ["v"]).collect()}
    assert got == {("a", 0): None, ("a", 5): "x", ("a", 9): "y", ("b", 5): None, (None, 5): None}


def test_scalar_rules(spark):
    rows = table(spark, "kind string, value string", ("isin", "US0378331005"), ("isin", "US037833100"), ("cusip", "000000000"), ("cusip", "037833100"), ("lei", "N/A"), ("figi", "BBG000B9XRY4"), ("isin", None), ("isin", " us0378331005 "), ("lei", "HWUPKR0MPOU8FGXBT3AB"), ("other", "x"), ("other", " "))
    assert [r.ok for r in rows.select(rules.valid_identifier(F.col("kind"), F.col("value")).alias("ok")).collect()] == [True, False, False, True, False, True, False, True, True, False, False]
    rows = table(spark, "s string", ("005930.KS",), ("AAPL",), ("BRK-B",), ("SOME.KQ",))
    assert [r[0] for r in rows.select(rules.suffix(F.col("s"))).collect()] == [".KS", "", "", ".KQ"]
    rows = table(spark, "f string, q string, c string", ("EUR", "USD", "US"), (None, "GBP", "US"), (None, "USD", "US"), (None, "USD", "DE"), (None, "USD", None))
    assert [r[0] for r in rows.select(rules.reporting_currency(F.col("f"), F.col("q"), F.col("c"))).collect()] == ["EUR", "GBP", "USD", None, None]
    rows = table(spark, "t string", ("Chief Executive Officer",), ("Group Ceo",), ("Oceanographer",), (None,))
    assert [r[0] for r in rows.select(rules.is_ceo(F.col("t"))).collect()] == [True, True, False, None]


HELD = "holding_id long, isin string, cusip string, figi string"
ISIN_A, ISIN_B, ISIN_C = "US0378331005", "US5949181045", "DE0007164600"


def test_holdings_become_securities(spark):
    held = table(
        spark, HELD,
        (1, ISIN_A, None, None), (2, f" {ISIN_A.lower()} ", "037833100", None), (3, None, "037833100", None),  # known by ISIN, and by a CUSIP that isn't
        (4, ISIN_A, "594918104", None),  # bridges two known securities and merges neither
        (5, ISIN_C, None, "BBG000000001"), (6, None, "716460000", "BBG000000001"), (7, None, "716460000", None),  # a chain of new ones
        (8, "N/A", "000000000", None), (9, None, None, None), (10, None, "999", ""), *[(k, ISIN_C, None, "BBG000000001") for k in range(20, 60)], (5, ISIN_C, None, "BBG000000001"),
    )
    known = table(spark, "kind string, value string, security_id long", ("isin", ISIN_A, 7), ("cusip", "594918104", 8), ("isin", ISIN_B, 8))
    rows = identity.resolve_securities(held, known).collect()
    got = {r.holding_id: (r.security_id, r.matched) for r in rows}
    assert len(rows) == len(got) and set(got) == {1, 2, 3, 4, 5, 6, 7, *range(20, 60)}
    assert [got[k] for k in (1, 2, 4)] == [("7", True)] * 3
    assert len({got[k] for k in (5, 6, 7, *range(20, 60))}) == 1 and not got[5][1] and not got[3][1] and got[3] != got[5]
    assert got[5][0] == hashlib.sha256(f"isin:{ISIN_C}".encode()).hexdigest()
    assert sorted(r.holding_id for r in identity.skipped_holdings(held).collect()) == [8, 9, 10]
    # what a batch registers is found by the next, with the ids that it made
    new = identity.new_identifiers(held, known)
    assert {(r.kind, r.value) for r in new.collect()} == {("isin", ISIN_C), ("figi", "BBG000000001"), ("cusip", "716460000"), ("cusip", "037833100")}
    again = identity.resolve_securities(held, new.unionByName(known.withColumn("security_id", F.col("security_id").cast("string"))))
    assert {r.holding_id: r.security_id for r in again.collect()} == {k: v[0] for k, v in got.items()}
    groups = {r.holding_id: r.group_id for r in identity.shared_identifier_groups(held).collect()}
    assert [groups[k] for k in (1, 2, 3, 4, 5, 6, 7, 59)] == [1, 1, 1, 1, 5, 5, 5, 5] and set(groups) == set(got)
    empty = table(spark, HELD)
    assert identity.resolve_securities(empty, known).isEmpty() and identity.shared_identifier_groups(empty).isEmpty()


def test_rows_of_a_holding_are_one_holding(spark):
    held = table(
        spark, HELD,
        (1, ISIN_A, None, None), (1, None, "037833100", None), (2, None, "037833100", None),  # known by one of its rows, so its other one makes nothing known
        (3, ISIN_C, None, None), (3, None, "716460000", None), (4, None, "716460000", None), (3, ISIN_C, None, None),  # two rows that bridge
        (5, None, None, None), (5, ISIN_B, None, None), (6, None, None, None), (None, None, "111111118", None), (None, None, "222222228", None),
    )
    known = table(spark, "kind string, value string, security_id long", ("isin", ISIN_A, 7))
    hash_of = lambda x: hashlib.sha256(x.encode()).hexdigest()
    c, bare = hash_of(f"isin:{ISIN_C}"), ("111111118", "222222228")
    got = sorted(((r.holding_id or 0, r.security_id, r.matched) for r in identity.resolve_securities(held, known).collect()))
    assert got == sorted([(1, "7", True), (2, hash_of("cusip:037833100"), False), (3, c, False), (4, c, False), (5, hash_of(f"isin:{ISIN_B}"), False), *[(0, hash_of(f"cusip:{b}"), False) for b in bare]])
    new = {(r.value, r.security_id) for r in identity.new_identifiers(held, known).collect()}
    assert new == {("037833100", hash_of("cusip:037833100")), (ISIN_C, c), ("716460000", c), (ISIN_B, hash_of(f"isin:{ISIN_B}")), *[(b, hash_of(f"cusip:{b}")) for b in bare]}
    assert [r.holding_id for r in identity.skipped_holdings(held).collect()] == [6]
    one = held.where("holding_id is not null and holding_id < 5")
    assert sorted((r.holding_id, r.group_id) for r in identity.shared_identifier_groups(one).collect()) == [(1, 1), (2, 1), (3, 3), (4, 3)]


def test_a_long_chain_of_identifiers_is_one_security(spark):
    held = table(spark, HELD, *[(100 - k, None, f"7{k:08d}", f"BBG{k + 1:09d}") if k % 2 else (100 - k, None, f"7{k + 1:08d}", f"BBG{k:09d}") for k in range(40)])
    assert {r.group_id for r in identity.shared_identifier_groups(held).collect()} == {61}
    assert len({r.security_id for r in identity.resolve_securities(held, table(spark, "kind string, value string, security_id long")).collect()}) == 1


def test_symbol_repair(spark):
    failed = table(spark, "security_id long, symbol string", (1, "ABC*"), (2, "BRK/A"), (3, "5.HK"), (4, "VOLVB.ST"), (5, "NONE*"))
    there = table(spark, "symbol string", ("ABC",), ("BRK-A",), ("BRKA",), ("0005.HK",), ("VOLV-B.ST",))
    got = {(r.security_id, r.candidate) for r in identity.symbol_repair(failed, there).collect()}
    assert got == {(1, "ABC"), (2, "BRK-A"), (2, "BRKA"), (3, "0005.HK"), (4, "VOLV-B.ST")}


ENTITY = "security_id long, name string, security_type_code string, country_iso2 string, operating_country_iso2 string, cik long"


def standing(spark, rows, isin=(), ticker=(), own=(), symbol=()):
    """entities() of (id, type, country, operating country, cik) and of {id: value} by kind."""
    ids = [(i, "isin", v) for i, v in dict(isin).items()] + [(i, "ticker", v) for i, v in dict(ticker).items()]
    pairs = lambda d: table(spark, "security_id long, symbol string", *dict(d).items())
    sec = table(spark, ENTITY, *[(i, f"n{i}", t, c, o, k) for i, t, c, o, k in rows])
    return pending.entities(sec, table(spark, "security_id long, kind string, value string", *ids), pairs(own), pairs(symbol))


def marked(spark, *rows, at="marked_at"):
    return table(spark, f"security_id long, what string, {at} date", *rows)


def test_doing_the_work_empties_the_backlog(spark):
    ents = standing(spark, [(i, "bond" if i == 4 else "equity", "US", None, None) for i in range(1, 6)], symbol={1: "A", 2: "B", 3: "C", 4: "D"}, own={2: "B.X"})
    bars = lambda *rows: {"bars": pending.bar_facts(table(spark, "security_id long, grain string, date date", *rows))}
    marks, weights = marked(spark, (3, "prices", DAY)), table(spark, "security_id long, best_weight double", (2, 5.0))
    old = [(1, "daily", DAY), (2, "daily", DAY - dt.timedelta(9))]
    rows = pending.pending("prices", ents, marks, marked(spark, at="asked_at"), weights, DAY, bars(*old))
    # no bond, none without a symbol
    assert [(r.security_id, r.symbol, r.fetch_symbol, r.last_date, r.best_weight) for r in rows.collect()] == [(2, "B", "B.X", DAY - dt.timedelta(9), 5.0)]
    assert pending.pending("prices", ents, marks, marked(spark, at="asked_at"), weights, DAY, bars(*old, (2, "daily", DAY))).isEmpty()
    weekly = pending.pending("price_history", ents, marked(spark), marked(spark, at="asked_at"), weights, DAY, bars(*old, (1, "weekly", DAY)))
    assert [r.security_id for r in weekly.collect()] == [2, 3]


def test_a_mark_blocks_its_own_branch_only(spark):
    rows = [(1, "equity", None, None, None), (2, "equity", "US", None, None), (3, "equity", "US", None, None), (4, "equity", "ZZ", None, None), (5, "equity", None, None, None), (6, "bond", None, None, None), (7, "equity", None, "US", None)]
    ents = standing(spark, rows, ticker={i: f"T{i}" for i in (1, 2, 3, 4, 6, 7)})
    facts = {"tagged": table(spark, "security_id long, tagged boolean", *[(i, True) for i in (2, 3, 4, 7)]), "drillable": table(spark, "country_iso2 string, drillable boolean", ("US", True))}
    weights, none = table(spark, "security_id long, best_weight double", (4, 1.0)), marked(spark, at="asked_at")
    ask = lambda *m: [(r.security_id, r.want, r.best_weight) for r in pending.pending("profile", ents, marked(spark, *m), none, weights, DAY, facts).collect()]
    assert ask() == [(4, "country", 1.0), (1, "sector", 0.0)]
    # the sector's mark leaves the country's branch open
    assert ask((1, "profile", DAY), (4, "profile", DAY)) == [(4, "country", 1.0), (1, "sector", 0.0)]
    assert ask((1, "profile", DAY), (1, "provider_country", DAY)) == [(4, "country", 1.0)]
    assert ask((4, "provider_country", DAY - dt.timedelta(31))) == [(4, "country", 1.0), (1, "sector", 0.0)] and ask((4, "provider_country", DAY - dt.timedelta(30))) == [(1, "sector", 0.0)]
    statements = {"statements": pending.statement_facts(table(spark, "security_id long, period_type string, currency_code string", (1, "annual", None), (2, "annual", None), (2, "annual", "USD")))}
    want = lambda *m: {r.security_id: r.want for r in pending.pending("statements", ents, marked(spark, *m), none, weights, DAY, statements).collect()}
    assert want() == {1: "no_currency", 3: "missing", 4: "missing", 7: "missing"}
    assert want((1, "statement_currency", DAY), (3, "statement_currency", DAY)) == {3: "missing", 4: "missing", 7: "missing"}
    assert [r.currency_code for r in pending.pending_fx_history(table(spark, "currency_code string", ("EUR",), ("USD",), ("GBP",), ("JPY",)), table(spark, "currency_code string, as_of date", ("EUR", DAY - dt.timedelta(91)), ("GBP", DAY)), table(spark, "currency_code string, marked_at date", ("JPY", DAY)), DAY).collect()] == ["GBP"]


def test_marks_that_data_contradict_go(spark):
    marks = marked(spark, (1, "performance", DAY), (1, "prices", DAY), (2, "performance", DAY))
    bars = table(spark, "security_id long, date date", (1, DAY - dt.timedelta(5)), (2, DAY - dt.timedelta(6)))
    assert sorted((r.security_id, r.what) for r in pending.clear_contradicted(marks, bars, DAY).collect()) == [(1, "prices"), (2, "performance")]


def test_backlogs_have_the_conditions_of_the_survey(spark):
    rows = [
        (1, "equity", "DE", None, None), (2, "equity", "DE", None, None), (3, "equity", "DE", None, None), (4, "equity", "DE", None, None), (5, "equity", None, None, None), (6, "bond", "DE", None, None),
        (7, "equity", "DE", None, None), (8, "equity", "NL", None, None), (9, "equity", "US", None, 90), (10, "equity", "US", None, 100), (11, "equity", "US", None, None), (12, "equity", "FR", None, None),
    ]
    own = {1: "WRONG.DE", 3: "FINE.DE", 8: "asml", 9: "NINE.L", 10: "TEN", 12: "TW.PA"}
    ents = standing(spark, rows, isin={i: f"I{i}" for i in range(1, 13) if i != 4}, ticker={7: "T7", 8: "ASML", 9: "NINE", 10: "TEN", 12: "TW.PA"}, own=own, symbol=own)
    long_ago, lately = DAY - dt.timedelta(400), DAY - dt.timedelta(3)
    marks = marked(spark, (1, "profile", long_ago), (1, "industry", lately), (3, "prices", lately), (11, "home_symbol", lately), (9, "performance", long_ago), (3, "quarters", lately), (7, "quarters", long_ago))
    asked = marked(spark, (10, "eps_history", long_ago), (2, "home_symbol", lately), (9, "insider", lately), (10, "insider", DAY - dt.timedelta(8)), at="asked_at")
    weights = table(spark, "security_id long, best_weight double", *[(i, 2.0) for i in (1, 8, 9, 10, 12)])
    ask = lambda name, **facts: by(pending.pending(name, ents, marks, asked, weights, DAY, facts), "security_id")
    home = ask("home_symbol")
    assert {k: (r.current_symbol, r.best_weight) for k, r in home.items()} == {1: ("WRONG.DE", 2.0), 2: (None, 0.0), 9: ("NINE.L", 2.0)}
    assert list(home) == [2, 1, 9]
    actions = pending.action_facts(table(spark, "security_id long, kind string, as_of date", (10, "split", lately)))
    assert {k: r.symbol for k, r in ask("corporate_actions", actions=actions).items()} == {8: "ASML", 12: "TW.PA"}
    # a split is no dividend
    assert set(ask("dividends", actions=actions)) == {1, 3, 8, 9, 10, 12}
    listed = pending.there(table(spark, "security_id long", (9,), (10,), (10,), (12,), (7,)), "us_listed")
    assert sorted(r.symbol for r in ask("eps_history", us_listed=listed).values()) == ["NINE", "TEN"]
    statements = pending.statement_facts(table(spark, "security_id long, period_type string, currency_code string", *[(i, "annual", None) for i in (1, 1, 2, 3, 6, 7, 8, 9)], (8, "quarter", None), (12, "quarter", None)))
    assert {k: r.symbol for k, r in ask("quarters", statements=statements).items()} == {1: "WRONG.DE", 7: "T7"}
    assert set(ask("ticker")) == {1, 2, 3, 5, 11} and set(ask("local_symbol")) == {2, 7} and set(ask("symbol_repair")) == {3, 9}
    assert set(ask("insider")) == {10} and set(ask("management")) == {1, 8, 9, 10, 12}


def test_fund_weights(spark):
    holdings = table(spark, "fund_symbol string, security_id long, as_of date, weight decimal(28,2), market_value decimal(28,2)", ("F", 1, DAY, D(30), D(1)), ("F", 2, DAY, D(10), D(1)), ("F", 3, DAY, D(60), D(1)), ("F", 9, DAY, D(99), D(1)), ("F", 1, DAY - dt.timedelta(90), D(5), D(1)))
    f = table(spark, "fund_symbol string, security_id long, name string, kind string, represents_code string", ("F", 9, "fund", "broad", None))
    sec = table(spark, "security_id long, security_type_code string, country_iso2 string, operating_country_iso2 string", (1, "equity", "US", None), (2, "equity", "US", "DE"), (3, "bond", None, None), (9, "equity", "US", None))
    nodes = table(spark, "security_id long, level int, node_id string, parent_id string, source_code string, as_of date", (1, 1, "low", None, "yfinance", DAY), (1, 1, "tech", None, "sec", DAY), (1, 2, "chips", "tech", "sec", DAY))
    sources = table(spark, "source_code string, priority int", ("sec", 250), ("yfinance", 100))
    got = {r.sector_id: (r.weight, r.weight_pct) for r in funds.fund_sector_weight(holdings, f, sec, nodes, sources).collect()}
    assert got == {"tech": (30.0, 75.0), "unclassified": (10.0, 25.0)}
    got = {r.country_iso2: r.weight_pct for r in funds.fund_country_weight(holdings, f, sec).collect()}
    assert got == {"US": 30.0, "DE": 10.0, "XX": 60.0}


def test_a_scan_in_ranges_equals_one_in_order(spark):
    rows = [(k if k % 3 else 0, (k * 37) % 500, None if k % 4 == 0 else k, float(k % 7)) for k in range(500)] + [(None, 3, 5, 1.0), (None, 1, None, None), (9999, 1, None, None)]
    table_ = table(spark, "k long, at long, a long, b double", *rows)
    out = scans.scanned(table_, ["k"], ["at"], last=["a"], total=["b"], previous=["a", "at"])
    got = {(r.k, r["at"]): (r.last_a, r.total_b, r.previous_a, r.previous_at) for r in out.collect()}
    want = {}
    for key in {r[0] for r in rows}:
        last = total = None
        before = (None, None)
        for _, at, a, b in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            last, total = a if a is not None else last, total if b is None else b + (total or 0)
            want[key, at] = (last, total, *before)
            before = (a, at)
    assert got == want
    # the key with a third of the rows is in several ranges
    hot = table_.repartitionByRange(8, "k", "at").withColumn("range", F.spark_partition_id()).where("k = 0").select("range").distinct().count()
    assert hot > 1
    points, steps = table(spark, "k long, at long", *[(k % 5 and 1, k) for k in range(200)]), table(spark, "k long, since long, v long", *[(k % 2, k * 7, k) for k in range(20)])
    plain, ranged = (sorted(common.asof(points, steps, ["k"], "at", "since", ["v"], s).collect()) for s in (False, True))
    assert plain == ranged
    bars = [(1 if k % 3 else k % 4 + 2, DAY - dt.timedelta(k // 2 if k % 3 else k), 100.0 + (k * 7) % 13, 1.0 if k % 5 == 0 else None) for k in range(300)]
    bars = table(spark, "series_id long, date date, close double, dividend double", *{(r[0], r[1]): r for r in bars}.values())
    for measure in (returns.total_returns, returns.price_returns):
        plain, ranged = (sorted(measure(bars, DAY, s).collect()) for s in (False, True))
        assert plain == ranged and len(plain) > 10
    jumps = bars.withColumn("close", F.when(F.col("date") >= DAY - dt.timedelta(20), F.col("close") * 10).otherwise(F.col("close")))
    plain, ranged = (sorted(returns.comparable_from(jumps, s).collect()) for s in (False, True))
    assert plain == ranged and DAY - dt.timedelta(20) in {r.comparable_from for r in plain}


def test_neighbours_meet_across_blocks(spark, monkeypatch):
    rows = [(i, 1e9 * 1.001 ** ((i * 61) % 400), "one", f"n{i}", f"S{i}") for i in range(400)]
    spine = table(spark, "security_id long, market_cap_usd double, sector_id string, name string, symbol string", *rows)
    whole = sorted(facets.peers(spine).collect())
    monkeypatch.setattr(facets, "BLOCK_LEVELS", 16)
    assert sorted(facets.peers(spine).collect()) == whole and len(whole) == 2000
    beside = scans.blocks_with_halo(spine, ["sector_id"], ["market_cap_usd"], 6, 16)
    assert beside.groupBy("_block").count().agg(F.max("count"), F.count("*")).first()[:] == (28, 25) and beside.where("_own").count() == 400


def test_bars_are_laid_out_for_their_readers(spark, tmp_path):
    bar = "security_id long, grain string, date date, close double"
    days = [DAY - dt.timedelta(40 * k) for k in range(30)]
    stores.create_bars(table(spark, bar, *[(i, g, d, float(i)) for i in range(5) for g in ("daily", "weekly") for d in days]), "laid_out", str(tmp_path / "bars"), 4)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "bars").rglob("*.parquet")}
    before = files()
    stores.upsert_bars(table(spark, bar, (1, "daily", days[0], 9.0), (1, "daily", days[0], 8.0), (7, "daily", DAY - dt.timedelta(1), 7.0)), "laid_out", 4)
    # only what the new bars are in has been written
    assert {p.split("/grain=")[1].rsplit("/", 1)[0] for p in set(before) ^ set(files())} == {f"daily/year={DAY.year}"}
    rows = {(r.security_id, r.grain, r.date): r.close for r in spark.table("laid_out").collect()}
    assert len(rows) == 301 and rows[1, "daily", days[0]] == 9.0 and rows[7, "daily", DAY - dt.timedelta(1)] == 7.0
    stores.prune_bars(spark, "laid_out", DAY, 400, buckets=4)
    left = spark.table("laid_out").groupBy("grain").agg(F.count("*"), F.min("date")).collect()
    assert sorted(tuple(r) for r in left) == [("daily", 56, days[10]), ("weekly", 150, days[29])]
    assert {r.security_id: (r.date, r.close) for r in stores.latest_bars(spark, "laid_out").collect()}[1] == (days[0], 9.0)
    plan = stores.latest_bars(spark, "laid_out")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "grain" in plan.split("PartitionFilters")[1][:80]
    spark.sql("drop table laid_out")
