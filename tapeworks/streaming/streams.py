"""Incremental forms of the batch operators on Structured Streaming."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tapeworks.functions.common import top1
from tapeworks.operators.metrics import statement_metrics
from tapeworks.streaming.log import Log

#: Batches that a table keeps apart until they are merged.
COMPACT_EVERY = 16


def _bars(spark: SparkSession, path: str) -> Log:
    return Log(spark, path, "series_id long, ts timestamp, close double, date date", ["series_id", "date"], F.desc("ts"), F.desc("close"))


def stream_prices(bars: DataFrame, path: str, checkpoint: str, delay: str = "10 days") -> StreamingQuery:
    """Bars (series_id, ts, close) once each, stored by batch; read_prices() gives the last of each day.

    A batch writes a folder of its own number, and finished ones are merged now and then. Of bars of one time the greatest
    close stays, whichever comes first. Bars that come more than ``delay`` after the latest are lost.
    """
    table = _bars(bars.sparkSession, path)

    def write(batch: DataFrame, epoch: int) -> None:
        table.write(top1(batch.withColumn("date", F.to_date("ts")), ["series_id", "date"], F.desc("ts"), F.desc("close")), epoch)
        table.compact(epoch - 1, COMPACT_EVERY)

    unique = bars.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["series_id", "ts", "close"])
    return unique.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """The upserted table: of each (series_id, date) the latest bar of any batch."""
    return _bars(spark, path).rows()


def _news(spark: SparkSession, path: str) -> tuple[Log, Log]:
    articles = Log(spark, f"{path}/articles", "url string, published_at timestamp, title string", ["url"], F.asc("published_at"), F.asc("title"))
    return articles, Log(spark, f"{path}/links", "url string, security_id long, published_at timestamp", ["url", "security_id"], F.desc("published_at"))


def stream_news(articles: DataFrame, path: str, checkpoint: str, retention_days: int = 90) -> StreamingQuery:
    """Articles (url, published_at, title, security_id) and which securities they are about, each once; read_news() has what is retained.

    Of an url's rows the earliest stays, then the first title, in whatever batch it comes. When batches are merged, rows that are
    older than ``retention_days`` before the newest go, so the table grows with the window and not with the stream.
    """
    texts, links = _news(articles.sparkSession, path)

    def write(batch: DataFrame, epoch: int) -> None:
        good = batch.where("url is not null and published_at is not null and title is not null")
        texts.write(top1(good, ["url"], F.asc("published_at"), F.asc("title")), epoch)
        links.write(top1(good.where("security_id is not null"), ["url", "security_id"], F.desc("published_at")), epoch)
        newest = texts.rows().agg(F.max("published_at").alias("t")).first()["t"] if (epoch + 1) % COMPACT_EVERY == 0 else None
        if newest is not None:
            recent = F.col("published_at") >= F.lit(newest) - F.expr(f"interval {retention_days} days")
            texts.compact(epoch - 1, COMPACT_EVERY - 1, recent)
            links.compact(epoch - 1, COMPACT_EVERY - 1, recent)

    return articles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_news(spark: SparkSession, path: str, asof: dt.date, retention_days: int = 90) -> tuple[DataFrame, DataFrame]:
    """(articles, links) of the ``retention_days`` up to ``asof``; a link goes with its article."""
    texts, links = _news(spark, path)
    kept = texts.rows().where(F.col("published_at") >= F.date_sub(F.lit(asof), retention_days))
    return kept, links.rows().join(kept.select("url"), "url", "left_semi").select("url", "security_id")


#: What a statement is known by, and what a metric is.
STATEMENT_KEY = ["security_id", "statement", "period_ending", "period_type", "source_code"]
METRIC_KEY = ["security_id", "metric_code", "period_type", "as_of"]


def _derived(spark: SparkSession, path: str) -> tuple[Log, Log]:
    seen = "security_id long, statement string, period_ending date, period_type string, source_code string, payload_hash string, fetched_at timestamp"
    value = "security_id long, metric_code string, period_type string, as_of date, source_code string, value decimal(28,4), currency_code string, fetched_at timestamp"
    return (
        Log(spark, f"{path}/processed", seen, STATEMENT_KEY, F.desc("fetched_at"), F.asc("payload_hash")),
        Log(spark, f"{path}/metrics", value, [*METRIC_KEY, "source_code"], F.desc("fetched_at"), F.desc("value"), F.asc("currency_code")),
    )


def stream_derive(statements: DataFrame, fields: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Metrics of statements as they come: a statement whose payload was derived last time isn't derived again, and a changed one is.

    statements: STATEMENT_KEY, currency_code, payload, fetched_at. The table of processed keys has each statement's latest
    payload hash and is joined anti by the next batches; the metrics of a batch are written before its keys, so one that
    fails between is done again as a whole. read_derived() merges: the latest value of each source, then the best source's.
    """
    processed, values = _derived(statements.sparkSession, path)

    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("payload_hash", F.sha2("payload", 256)).persist()
        last = processed.rows(before=epoch).withColumnRenamed("fetched_at", "_last")
        new = rows.join(last.where("_last is not null").drop("_last"), [*STATEMENT_KEY, "payload_hash"], "left_anti")
        # statement_metrics works on one payload for each key and source; a batch may bring several
        found = statement_metrics(new.withColumn("statement_at", F.col("fetched_at")), fields, keep=["statement_at"])
        values.write(top1(found.withColumnRenamed("statement_at", "fetched_at"), [*METRIC_KEY, "source_code"], F.desc("fetched_at"), F.desc("value"), F.asc("currency_code")), epoch)
        processed.write(top1(rows, STATEMENT_KEY, F.desc("fetched_at"), F.asc("payload_hash")), epoch)
        rows.unpersist()
        for table in (values, processed):
            table.compact(epoch - 1, COMPACT_EVERY)

    return statements.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_derived(spark: SparkSession, path: str, sources: DataFrame) -> DataFrame:
    """One row for each metric key: of the best source by priority (unknown ones 100), then the latest."""
    rows = _derived(spark, path)[1].rows().join(sources, "source_code", "left")
    return top1(rows, METRIC_KEY, F.desc(F.coalesce("priority", F.lit(100))), F.desc("fetched_at"), F.asc("source_code")).drop("priority")


PERIOD_KEY = ["security_id", "metric_code", "period_type"]


def _joined(spans: DataFrame, sources: DataFrame, gap_days: int) -> DataFrame:
    """Spans (PERIOD_KEY, first, last, as_of, value, currency_code, source_code) that lie within ``gap_days`` of each other as one, with the best row of any."""
    by_date = Window.partitionBy(*PERIOD_KEY).orderBy("first")
    # a span may end before an earlier one does
    reach = F.max("last").over(by_date.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(F.datediff("first", "reach") <= gap_days, 0).otherwise(1)
    rows = spans.withColumn("reach", reach).withColumn("run", F.sum(starts).over(by_date.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*PERIOD_KEY, "run")
    rows = rows.join(sources, "source_code", "left").withColumn("first", F.min("first").over(run)).withColumn("last", F.max("last").over(run))
    return top1(rows, [*PERIOD_KEY, "run"], F.desc_nulls_last("priority"), F.desc("as_of"), F.asc("source_code")).select(*spans.columns)


def stream_periods(metrics: DataFrame, sources: DataFrame, path: str, checkpoint: str, gap_days: int = 7, delay: str = "30 days") -> StreamingQuery:
    """fiscal_periods() of a stream: rows of a series that follow each other within ``gap_days`` are one period, of which the best source's stays, then the latest.

    A period is written once no row can join it any more: when a row has come that is later by two gaps and ``delay``. Rows that come
    later than ``delay`` and a gap after a row of an earlier batch are lost. A batch is clustered together with the periods that the batch before left open,
    of which a row each is kept beside the checkpoint; read_periods() has what is written. metrics: METRIC_KEY, source_code, value, currency_code; as_of is the event time.
    """
    spark, columns = metrics.sparkSession, [*METRIC_KEY, "value", "currency_code", "source_code"]
    schema = T.StructType([*metrics.select(*columns).schema, T.StructField("first", T.DateType()), T.StructField("last", T.DateType())])

    def write(batch: DataFrame, epoch: int) -> None:
        left = f"{checkpoint}/open/batch={epoch - 1}"
        before = spark.read.schema(schema).parquet(left) if epoch else spark.createDataFrame([], schema)
        # the newest row's period is always open
        past = before.agg(F.max("last").alias("t")).first()["t"]
        newest = max((t for t in (past, batch.agg(F.max("as_of").alias("t")).first()["t"]) if t is not None), default=None)
        mark = lambda t, gaps: F.lit(t).cast("timestamp") - F.expr(f"interval {delay}") - F.expr(f"interval {gaps * gap_days} days")
        rows = batch.where("as_of is not null").select(*columns, F.col("as_of").alias("first"), F.col("as_of").alias("last"))
        if past is not None:
            rows = rows.where(F.col("as_of") >= mark(past, 1))
        spans, is_open, seen = before.unionByName(rows), F.col("last") >= mark(newest, 2), Observation()
        closed, left_open = spans.where("false"), spans.where("false")
        if newest is not None:
            closed = _joined(spans, sources, gap_days).observe(seen, F.min(F.when(is_open, F.col("first"))).alias("first")).where(~is_open)
        closed.select(*columns).write.mode("overwrite").parquet(f"{path}/batch={epoch}")
        if newest is not None:
            # no open period begins earlier than that, and closed ones whose end is there are closed there too
            left_open = _joined(spans.where(F.col("first") >= F.lit(seen.get["first"])), sources, gap_days).where(is_open)
        left_open.write.mode("overwrite").parquet(f"{checkpoint}/open/batch={epoch}")

    return metrics.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_periods(spark: SparkSession, path: str) -> DataFrame:
    """The periods that stream_periods() has written."""
    return spark.read.parquet(path).drop("batch")
