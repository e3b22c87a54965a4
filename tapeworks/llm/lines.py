"""Line deduplication by site-relative frequency, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.scratch import stored

#: A line goes if more than RATIO of its site's pages have it. On one page alone a line repeats nothing, whatever its share of a small site.
RATIO, MIN_PAGES = 0.05, 2
#: Boilerplate tables of more bytes than this are joined by shuffle.
BROADCAST_BYTES = 64 << 20


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(docs: DataFrame, host: str, text: str, ratio: float, min_pages: int, copies: bool = True) -> DataFrame:
    """(host, drops): of each site the hashes of its boilerplate lines, sites that have none left out.

    A page counts once for a line, and white space around a line doesn't count. A site's list is short: its
    lines that over ``ratio`` of pages have are fewer than its mean lines a page divided by ``ratio``. Without
    ``copies``, pages of a site with the same set of lines are one page; a task sends each set once.
    """
    pages = docs.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    solid = F.filter(_lines(F.col("t")), lambda s: F.trim(s) != "")
    pages = pages.select("host", F.array_distinct(F.transform(solid, _key)).alias("lines"))
    if not copies:
        pages = pages.select("host", F.array_sort("lines").alias("lines")).distinct()
    seen = pages.select("host", F.explode("lines").alias("line"))
    counts = seen.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    common = counts.join(totals, "host").where(F.col("n") > ratio * F.col("pages"))
    return common.groupBy("host").agg(F.collect_set("line").alias("drops"))


def drop_boilerplate(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host_col: str = "source", text_col: str = "text", copies: bool = True) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text_col``, and the columns n_lines and n_dropped, which replace such columns of ``docs``.

    Lines are what stands between line feeds; those that stay keep their order and white space. Blank lines
    always stay. A row with a null site or text stays as it is (0 lines for a null text); an empty text is one
    blank line, an empty table stays empty. Null and repeated ids make no difference, as every row counts as
    a page, repeated ones too, unless ``copies`` is false: then the copies of a document don't make its lines
    boilerplate. A line of a third of all rows costs one row for each task that meets it. No name of another
    column can clash: rows are carried whole.
    """
    drops = stored(boilerplate(docs, host_col, text_col, ratio, min_pages, copies), "boilerplate")
    size = drops.agg(F.sum(16 + F.octet_length("host") + 8 * F.size("drops"))).first()[0] or 0
    columns = [f"`{c.replace('`', '``')}`" for c in docs.columns]
    rows = docs.select(F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(columns)]).alias("row"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(drops) if size <= BROADCAST_BYTES else drops, "host", "left")
    stay = F.filter("lines", lambda s: (F.trim(s) == "") | ~F.array_contains("drops", _key(s)))
    rows = rows.select("row", "text", "drops", _lines(F.col("text")).alias("lines"))
    rows = rows.select("row", "text", F.coalesce(F.size("lines"), F.lit(0)).alias("n"), F.when(F.col("drops").isNotNull(), stay).alias("stay"))
    text = F.when(F.col("stay").isNull(), F.col("text")).otherwise(F.array_join("stay", "\n"))
    out = [(text if c == text_col else F.col(f"row.c{k}")).alias(c) for k, c in enumerate(docs.columns) if c not in ("n_lines", "n_dropped")]
    dropped = F.col("n") - F.coalesce(F.size("stay"), F.col("n"))
    return rows.select(*out, F.col("n").cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"))
