"""Benchmark decontamination by size-partitioned MinHash containment, in built-in functions only.

A document holds an item if it has at least 80 % of the item's distinct five-word shingles, or the words of a shorter item in a row. An item's
sketch is the shingles of least hash, as many as its size class needs: of an item of n shingles a document
that holds it lacks n - ceil(0.8 n) at most, so of any n - ceil(0.8 n) + 1 it has one or more. Items are
partitioned by size, in classes of powers of two, and all of a class have the sketch size of its largest
item, or all their shingles if they have fewer. A document's sketch is its shingles of hash up to the greatest
in any item's sketch, as it may hold any of them. The search misses nothing; candidates are verified exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.scratch import stored

#: Sketches or candidates of more bytes than this are joined by shuffle.
BROADCAST_BYTES = 64 << 20
SPACES = " \t\n\x0b\x0c\r"


def _words(text: Column) -> Column:
    upper = "".join(chr(c) for c in range(65, 91))
    plain = F.translate(text, SPACES + upper, " " * len(SPACES) + upper.lower())
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _hashes(words: Column, n: int) -> Column:
    """Hashes of n words in a row, repeats too; empty with fewer."""
    many = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    return F.when(F.size(words) >= n, many).otherwise(F.array().cast("array<bigint>"))


def _sized(words: Column, n: int) -> Column:
    """Hashes of n words in a row, or of all words if there are fewer; null without words."""
    short = [F.when(F.size(words) == k, F.array(F.xxhash64(*[F.get(words, j) for j in range(k)]))) for k in range(1, n)]
    return F.when(F.size(words) >= n, _hashes(words, n)).otherwise(F.coalesce(F.lit(None).cast("array<bigint>"), *short))


def contained_items(
    docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, n_shared, n_item of every pair of which the document holds percent of the item's shingles or more.

    An item of fewer than n words is one shingle of its own length, found wherever these words stand in a row. Null or empty
    texts hold nothing and are in nothing, rows with a null id neither; without items or documents there are no pairs. Rows
    that repeat an id count together: a pair is returned once, with its best n_shared. Texts of any length are
    searched whole. Other columns are not read, whatever their names.
    """
    words = lambda rows, key, text, name: rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(name), _words(F.col(text).cast("string")).alias("words"))
    item_sets = words(items, item_col, item_text_col, "item_id").select("item_id", F.least(F.size("words"), F.lit(n)).alias("length"), F.array_distinct(_sized(F.col("words"), n)).alias("hashes"))
    item_sets = stored(item_sets.where("hashes is not null").distinct(), "items").withColumn("n_item", F.size("hashes")).withColumn("item", F.xxhash64("hashes"))
    size_class = F.floor(F.log2("n_item"))
    need = F.ceil(F.col("n_item") * percent / 100).cast("int")
    sized = item_sets.withColumn("class", size_class).withColumn("k", F.col("n_item") - need + 1)
    # a class has the sketch of its largest item: one aggregate for each class, of which there are as many as doublings
    widest = sized.groupBy("class").agg(F.max("k").alias("widest"))
    sized = sized.join(F.broadcast(widest), "class")
    sketches = stored(sized.select("item_id", F.explode(F.slice(F.sort_array("hashes"), F.lit(1), F.col("widest"))).alias("h")).distinct(), "sketches")
    made = sketches.agg(F.count("*").alias("n"), F.max("h").alias("most")).first()
    few = made["n"] * 32 <= BROADCAST_BYTES
    lengths = sorted(r["length"] for r in item_sets.select("length").distinct().collect())
    shingles = lambda words: F.concat(*[_hashes(words, k) for k in lengths]) if lengths else F.array().cast("array<bigint>")
    # don't filter rows on hashes: the filter moves below ``words`` and splits the text anew for each word
    sets = words(docs, id_col, text_col, "doc_id").select("doc_id", shingles(F.col("words")).alias("hashes"))
    probes = sets.select("doc_id", F.explode_outer(F.filter("hashes", lambda h: h <= F.lit(made["most"]))).alias("h"))
    hits = probes.join(F.broadcast(sketches) if few else sketches, "h").select("doc_id", "item_id").distinct()
    hits = stored(hits, "candidates")

    wanted = hits.select(F.col("doc_id").alias(id_col)).distinct()
    small = wanted.count() * 32 <= BROADCAST_BYTES
    again = docs.join(F.broadcast(wanted) if small else wanted, id_col, "left_semi")
    # a candidate's items meet its hashes one by one, so no document's hashes are repeated for each item. Rows of an id are told apart by their text
    own = words(again.withColumn("_text", F.col(text_col).cast("string")), id_col, "_text", "doc_id").select("doc_id", "words", F.xxhash64("words").alias("row"))
    own = own.select("doc_id", "row", F.explode_outer(F.array_distinct(shingles(F.col("words")))).alias("h")).distinct()
    asked = hits.join(item_sets, "item_id").select("doc_id", "item_id", "item", "n_item", F.explode("hashes").alias("h"))
    shared = own.join(asked, ["doc_id", "h"]).groupBy("doc_id", "row", "item_id", "item", "n_item").agg(F.count("*").alias("n_shared"))
    kept = shared.where(100 * F.col("n_shared") >= percent * F.col("n_item"))
    return kept.groupBy("doc_id", "item_id").agg(F.max("n_shared").cast("long").alias("n_shared"), F.max_by("n_item", "n_shared").cast("long").alias("n_item"))
