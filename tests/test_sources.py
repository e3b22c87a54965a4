import datetime as dt
import json

from pyspark.sql import functions as F

from tapeworks.operators import metrics, writes
from tapeworks.sources import filings
from tapeworks.streaming import streams

FILING = """<edgarSubmission><formData><invstOrSecs>
<invstOrSec><name>Acme</name><lei>N/A</lei><cusip>037833100</cusip><identifiers><isin value="US0378331005"/><other otherDesc="FIGI" value="BBG000B9XRY4"/></identifiers>
<balance>10.5</balance><units>NS</units><curCd>USD</curCd><valUSD>100</valUSD><pctVal>1.5</pctVal><assetCat>EC</assetCat><issuerCat>CORP</issuerCat><invCountry>US</invCountry></invstOrSec>
<invstOrSec><name>Bond</name><identifiers><isin value="N/A"/></identifiers><balance>1</balance><assetCat>DBT</assetCat>
<debtSec><maturityDt>2030-01-15</maturityDt><couponKind>Fixed</couponKind><annualizedRt>0.0</annualizedRt><isDefault>N</isDefault></debtSec></invstOrSec>
<invstOrSec><name>N/A</name><balance>1</balance></invstOrSec></invstOrSecs></formData></edgarSubmission>"""


def test_holdings_of_a_filing(spark, tmp_path):
    (tmp_path / "a.xml").write_text(FILING)
    got = {r.name: r for r in filings.nport_holdings(spark, str(tmp_path)).collect()}
    assert set(got) == {"Acme", "Bond"}
    a, b = got["Acme"], got["Bond"]
    assert a.lei is None and a.isin == "US0378331005" and a.other[0].value == "BBG000B9XRY4" and a.balance == 10.5 and a.in_default is None
    assert b.isin is None and b.coupon_rate == 0.0 and b.maturity_date == dt.date(2030, 1, 15) and b.in_default is False


def test_company_facts(spark, tmp_path):
    fact = lambda start, end, val, fp, filed: {"start": start, "end": end, "val": val, "fp": fp, "filed": filed}
    body = {"cik": 7, "facts": {"us-gaap": {
        "Revenues": {"units": {"USD": [fact("2010-01-01", "2010-12-31", 1, "FY", "2011-02-01"), fact("2010-01-01", "2010-12-31", 2, "FY", "2011-05-01"), fact("2010-01-01", "2010-06-30", 9, "FY", "2011-05-01")]}},
        "NewRevenue": {"units": {"USD": [fact("2020-01-01", "2020-12-31", 3, "FY", "2021-02-01")], "EUR": [fact("2020-01-01", "2020-12-31", 4, "FY", "2021-02-01"), fact("2019-01-01", "2019-12-31", 4, "FY", "2021-02-01")]}},
        "Shares": {"units": {"shares": [{"end": "2020-12-31", "val": 50, "fp": "FY", "filed": "2021-02-01"}], "USD": []}}}}}
    (tmp_path / "f.json").write_text(json.dumps(body))
    facts = filings.xbrl_facts(spark, str(tmp_path))
    assert facts.count() == 7
    units = {(r.concept, r.unit) for r in filings.choose_units(facts).select("concept", "unit").distinct().collect()}
    assert units == {("Revenues", "USD"), ("NewRevenue", "EUR"), ("Shares", "shares")}
    concepts = spark.createDataFrame([("us-gaap", "NewRevenue", "revenue", 2, "USD"), ("us-gaap", "Revenues", "revenue", 1, "USD"), ("us-gaap", "Shares", "shares", 1, "shares")], "taxonomy string, concept string, metric_code string, priority int, want_unit string")
    got = {(r.metric_code, str(r.as_of)): r.value for r in metrics.xbrl_resolve(facts.withColumnRenamed("cik", "security_id"), concepts).collect()}
    assert got == {("revenue", "2010-12-31"): 2.0, ("revenue", "2020-12-31"): 3.0, ("shares", "2020-12-31"): 50.0}


def test_payload_scans(spark):
    raw = spark.createDataFrame([(1, '{"peRatio":"12.5","beta":"x"}')], "security_id long, payload string")
    r = filings.fundamentals_load(raw, ["peRatio", "beta", "none"]).first()
    assert (r.peRatio, r.beta, r.none) == (12.5, None, None)
    raw = spark.createDataFrame([(1, "income", '[{"period_ending":"2025-12-31","v":1},{"period_ending":"bad"},{"period_ending":"2025-12-31","v":2}]')], "security_id long, statement string, body string")
    assert [(r.period_ending, r.period_type) for r in filings.statement_load(raw).collect()] == [(dt.date(2025, 12, 31), "annual")]


def test_partitions_and_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
    writes.replace_partitions(df, path, "day")
    writes.replace_partitions(spark.createDataFrame([(9, "b")], "v int, day string"), path, "day")
    assert {(r.v, r.day) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b")}
    assert "refreshed_at" in writes.snapshot(df, str(tmp_path / "s")).columns


def test_streams(spark, tmp_path):
    rows = [(1, dt.datetime(2026, 8, 1, 10), 5.0), (1, dt.datetime(2026, 8, 1, 12), 6.0), (1, dt.datetime(2026, 8, 1, 12), 6.0), (2, dt.datetime(2026, 8, 2, 9), 7.0)]
    schema = "series_id long, ts timestamp, close double"
    src, out = tmp_path / "src", str(tmp_path / "out")
    spark.createDataFrame(rows, schema).write.parquet(str(src))
    for _ in range(2):
        streams.stream_prices(spark.readStream.schema(schema).parquet(str(src)), out, str(tmp_path / "cp")).awaitTermination()
    assert {(r.series_id, r.close) for r in streams.read_prices(spark, out).collect()} == {(1, 6.0), (2, 7.0)}
    spark.createDataFrame([(1, dt.datetime(2026, 8, 1, 13), 8.0)], schema).write.mode("append").parquet(str(src))
    streams.stream_prices(spark.readStream.schema(schema).parquet(str(src)), out, str(tmp_path / "cp")).awaitTermination()
    assert {(r.series_id, r.close) for r in streams.read_prices(spark, out).collect()} == {(1, 8.0), (2, 7.0)}


def feed(spark, path, schema, *batches):
    """A stream of one file for each batch, read in that order."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/part={k}")
    return lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(path))


def test_merged_batches_change_nothing(spark, tmp_path, monkeypatch):
    schema, out = "series_id long, ts timestamp, close double", str(tmp_path / "out")
    monkeypatch.setattr(streams, "COMPACT_EVERY", 2)
    batches = [[(1, dt.datetime(2026, 8, 1, h), float(h)), (2, dt.datetime(2026, 8, h), 1.0)] for h in (5, 9, 3, 7, 8)]
    streams.stream_prices(feed(spark, tmp_path / "in", schema, *batches)(), out, str(tmp_path / "cp")).awaitTermination()
    got = {(r.series_id, r.date, r.close) for r in streams.read_prices(spark, out).collect()}
    assert got == {(1, dt.date(2026, 8, 1), 9.0), *[(2, dt.date(2026, 8, h), 1.0) for h in (5, 9, 3, 7, 8)]}
    assert (tmp_path / "out" / "base" / "CURRENT").exists()


def test_news_keeps_the_earliest_of_any_batch(spark, tmp_path, monkeypatch):
    schema, day = "url string, published_at timestamp, title string, security_id long", lambda m, d: dt.datetime(2026, m, d)
    batches = [[("u", day(8, 2), "b", 1), ("w", day(8, 2), "c", 1), (None, day(8, 2), "c", 1), ("x", None, "c", 1)], [("u", day(8, 1), "a", 2), ("old", day(4, 1), "o", 1)], [("u", day(8, 3), "0", 1), ("w", day(8, 2), "a", None)]]
    read = feed(spark, tmp_path / "in", schema, *batches)
    for every in (2, 16):
        monkeypatch.setattr(streams, "COMPACT_EVERY", every)
        out = str(tmp_path / f"n{every}")
        for _ in range(2):
            streams.stream_news(read(), out, str(tmp_path / f"cp{every}")).awaitTermination()
        articles, links = streams.read_news(spark, out, dt.date(2026, 8, 9))
        assert {(r.url, r.published_at, r.title) for r in articles.collect()} == {("u", day(8, 1), "a"), ("w", day(8, 2), "a")}
        assert {(r.url, r.security_id) for r in links.collect()} == {("u", 1), ("u", 2), ("w", 1)}


def test_derivation_has_one_row_for_a_key_however_it_comes(spark, tmp_path):
    schema = "security_id long, statement string, period_ending date, period_type string, source_code string, currency_code string, payload string, fetched_at timestamp"
    day = dt.date(2026, 6, 30)
    row = lambda source, body, d: (1, "income", day, "Q2", source, "USD", body, dt.datetime(2026, 8, d))
    batches = [[row("yfinance", '{"rev":1,"net":5}', 1)], [row("yfinance", '{"rev":2}', 2), row("sec", '{"rev":7}', 1)], [row("yfinance", '{"rev":3}', 3), row("yfinance", '{"rev":2}', 2)]]
    fields = spark.createDataFrame([(m, s, "income", f) for s in ("yfinance", "sec") for m, f in (("revenue", "rev"), ("net_income", "net"))], "metric_code string, source_code string, statement string, field string")
    first = spark.createDataFrame([("yfinance", 300), ("sec", 100)], "source_code string, priority int")
    other = spark.createDataFrame([("yfinance", 100), ("sec", 300)], "source_code string, priority int")
    for name, parts in (("three", batches), ("one", [sum(batches, [])]), ("turned", batches[::-1])):
        read, out = feed(spark, tmp_path / name, schema, *parts), str(tmp_path / f"{name}-out")
        for _ in range(2):
            streams.stream_derive(read(), fields, out, str(tmp_path / f"{name}-cp")).awaitTermination()
            for sources, revenue in ((first, 3), (other, 7)):
                got = {(r.metric_code, r.period_type, float(r.value)) for r in streams.read_derived(spark, out, sources).collect()}
                assert got == {("revenue", "quarter", revenue), ("net_income", "quarter", 5)}, name


def test_periods_of_a_stream_meet_late_rows(spark, tmp_path):
    schema = "security_id long, metric_code string, period_type string, as_of date, source_code string, value double, currency_code string"
    row = lambda d, source, v, i=1: (i, "revenue", "annual", dt.date.fromisoformat(d), source, v, "USD")
    batches = [[row("2024-09-27", "yfinance", 1.0), row("2024-10-11", "yfinance", 2.0)], [row("2024-10-04", "sec", 3.0)], [row("2024-12-31", "yfinance", 4.0)], [row("2024-09-28", "sec", 9.0), row("2024-12-24", "sec", 5.0)], [row("2100-01-01", "sec", 0.0, 2)]]
    sources = spark.createDataFrame([("sec", 250), ("yfinance", 100)], "source_code string, priority int")
    out = str(tmp_path / "out")
    streams.stream_periods(feed(spark, tmp_path / "in", schema, *batches)(), sources, out, str(tmp_path / "cp")).awaitTermination()
    # the second row joins two runs 14 days apart; the one that comes 60 days late is lost, the one 7 days late isn't
    assert sorted((r.as_of, r.value) for r in spark.read.parquet(out).collect()) == [(dt.date(2024, 10, 4), 3.0), (dt.date(2024, 12, 24), 5.0)]


def test_a_row_that_is_not_lost_joins_its_period(spark, tmp_path):
    schema = "security_id long, metric_code string, period_type string, as_of date, source_code string, value double, currency_code string"
    row = lambda d, source, v, i=1: (i, "revenue", "annual", dt.date.fromisoformat(d), source, v, "USD")
    # of the rows after 2024-10-09 one is 36 days late and joins a period, one is later and lost; the last lies within a period whose rows came out of order
    batches = [[], [row("2024-09-01", "yfinance", 1.0), row("2024-01-05", "sec", 8.0)], [row("2024-10-09", "yfinance", 2.0)], [row("2024-09-03", "sec", 3.0), row("2024-08-27", "sec", 9.0)], [row("2024-10-15", "yfinance", 4.0), row("2024-10-03", "yfinance", 5.0)], [row("2024-10-10", "sec", 6.0), row("2024-10-10", "sec", 7.0, 2)]]
    sources = spark.createDataFrame([("sec", 250), ("yfinance", 100)], "source_code string, priority int")
    out, state = str(tmp_path / "out"), str(tmp_path / "cp")
    read = feed(spark, tmp_path / "in", schema, *batches)
    streams.stream_periods(read(), sources, out, state).awaitTermination()
    assert [(str(r.as_of), r.value) for r in spark.read.parquet(out).collect()] == [("2024-01-05", 8.0)]
    # one row is kept of each open period
    kept = spark.read.parquet(f"{state}/open/batch=5").collect()
    assert sorted((r["security_id"], str(r["first"]), str(r["last"]), r["value"]) for r in kept) == [(1, "2024-09-01", "2024-09-03", 3.0), (1, "2024-10-03", "2024-10-15", 6.0), (2, "2024-10-10", "2024-10-10", 7.0)]
    spark.createDataFrame([row("2100-01-01", "sec", 0.0, 3)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    streams.stream_periods(read(), sources, out, state).awaitTermination()
    assert sorted((r.security_id, str(r.as_of), r.value) for r in spark.read.parquet(out).collect()) == [(1, "2024-01-05", 8.0), (1, "2024-09-03", 3.0), (1, "2024-10-10", 6.0), (2, "2024-10-10", 7.0)]


def test_bars_of_one_time_do_not_depend_on_their_order(spark, tmp_path):
    schema, noon = "series_id long, ts timestamp, close double", dt.datetime(2026, 8, 1, 12)
    for name, closes in (("up", (5.0, 6.0, 7.0, 7.0)), ("down", (7.0, 6.0, 5.0, 7.0))):
        src, out = str(tmp_path / name), str(tmp_path / f"{name}-out")
        spark.createDataFrame([(1, noon, c) for c in closes], schema).coalesce(1).write.parquet(src)
        streams.stream_prices(spark.readStream.schema(schema).parquet(src), out, str(tmp_path / f"{name}-cp")).awaitTermination()
        assert [r.close for r in streams.read_prices(spark, out).collect()] == [7.0]


def test_share_stats_and_estimates(spark):
    import datetime as dt

    day = dt.date(2026, 8, 9)
    symbols = spark.createDataFrame([("AAA", 1), ("BBB.L", 2)], "symbol string, security_id int")
    body = '[{"symbol":"aaa","date":"2026-08-01T00:00","float_shares":5,"short_interest":"9"},{"symbol":"AAA","date":"2026-08-01","float_shares":6.5},{"symbol":"bbb.l","float_shares":1},{"symbol":"ZZZ","float_shares":1}]'
    got = sorted((r.security_id, r.as_of, r.float_shares, r.short_interest) for r in filings.share_stats_load(spark.createDataFrame([(body,), (None,), ("{",)], "body string"), symbols, day).collect())
    assert got == [(1, dt.date(2026, 8, 1), 6.5, None), (2, day, 1.0, None)]
    body = '[{"symbol":"AAA","target_high":"12","target_low":3,"currency":"usd","recommendation":"buy"},{"symbol":"BBB.L","target_high":0,"currency":"US$"}]'
    got = sorted((r.security_id, r.as_of, r.target_high, r.target_low, r.currency_code, r.recommendation) for r in filings.estimates_load(spark.createDataFrame([(body,)], "body string"), symbols, day).collect())
    assert got == [(1, day, None, 3.0, "USD", "buy"), (2, day, 0.0, None, None, None)]


def test_eps_history(spark):
    import datetime as dt

    body = '{"symbol":"A","quarterlyEarnings":[{"fiscalDateEnding":"2026-06-30","reportedDate":"2026-07-29","reportedEPS":"4.74","estimatedEPS":"4.21","surprise":"0.53","surprisePercentage":"12.5891"},{"fiscalDateEnding":"2026-03-31","reportedEPS":"None","estimatedEPS":"0"},{"reportedEPS":"1"},{"fiscalDateEnding":"2026-06-30","reportedEPS":"4.75"}]}'
    got = sorted(tuple(r) for r in filings.eps_history_load(spark.createDataFrame([(1, body), (2, "{}"), (3, None)], "security_id int, body string")).collect())
    assert got == [(1, dt.date(2026, 3, 31), None, None, 0.0, None, None), (1, dt.date(2026, 6, 30), None, 4.75, None, None, None)]


def test_the_last_statement_of_a_period_stays(spark):
    body = '[{"period_ending":"2026-06-30","v":"1"},{"period_ending":"2026-06-30","v":"2"},{"period_ending":"none","v":"3"}]'
    rows = filings.statement_load(spark.createDataFrame([(1, "income", body)], "security_id int, statement string, body string")).collect()
    assert [(str(r.period_ending), r.period_type, '"v":"2"' in r.payload) for r in rows] == [("2026-06-30", "annual", True)]
