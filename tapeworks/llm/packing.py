"""Packing into optimal length buckets.

The global histogram of lengths goes through dynamic programming that chooses the bucket boundaries of
least padding; in a bucket every document is padded to its boundary, and batches of a token budget form.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.scratch import stored

SPACES = " \t\n\x0b\x0c\r"
#: Boundaries are chosen among so many lengths: all lengths up to EXACT, then PER_OCTAVE for each doubling.
EXACT, PER_OCTAVE = 512, 128


def _bin_top(length):
    """The greatest length of the bin that ``length`` lies in: exact up to EXACT, then within 1/PER_OCTAVE."""
    width = F.greatest(F.lit(1), F.floor(F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double")))) / PER_OCTAVE)).cast("long")
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / width).cast("long") * width)


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Bucket tops of least total of counts times tops, out of sorted distinct ``lengths``; of equals, the lowest tops.

    best[k][j] is the least cost of the first j lengths in k buckets; the last of these takes lengths i to j.
    """
    n, before = len(lengths), np.r_[0, np.cumsum(counts)].astype(np.int64)
    if not n:
        return []
    best, cuts = before[1:] * lengths, []
    for _ in range(min(buckets, n) - 1):
        row, cut = best.copy(), np.full(n, -1)
        for j in range(1, n):
            costs = best[:j] + (before[j + 1] - before[1 : j + 1]) * lengths[j]
            i = int(costs.argmin())
            if costs[i] < row[j]:
                row[j], cut[j] = costs[i], i
        best = row
        cuts.append(cut)
    tops, j = [int(lengths[-1])], n - 1
    for cut in reversed(cuts):
        if cut[j] >= 0:
            j = int(cut[j])
            tops.append(int(lengths[j]))
    return tops[::-1]


def word_count(text):
    """Words of a whole text; 0 for a null one."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), SPACES, " " * len(SPACES))
    spaced = F.concat(F.lit(" "), plain)
    return (F.length(spaced) - F.length(F.regexp_replace(spaced, " (?=[^ ])", ""))).cast("long")


def pack(docs: DataFrame, buckets: int = 16, budget: int = 65_536, id_col: str = "doc_id", length=None) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_len, batch, place, padding: a row for each row of ``docs``.

    ``length`` is a column of token counts, such as token_counts.counts(), and words of column text by default;
    a null length counts as 0, and so do a null or empty text. Null and repeated ids are rows as any other. A
    batch holds floor(budget / bucket_len) documents, one at least, so a document longer than the budget is a
    batch of its own, whole. Within a bucket rows go in the order of a hash of their id and length, and
    batches are numbered from 0. A row's rank is its rank among its block plus the sizes of earlier blocks,
    so no bucket, however full, is sorted in one task. The driver sees one count for each length bin. Other columns are
    not read, whatever their names, and an empty table gives no rows.
    """
    length = word_count(F.col("text")) if length is None else F.coalesce(length.cast("long"), F.lit(0))
    rows = docs.select(F.col(id_col).alias("doc_id"), length.alias("n_tokens"))
    rows = stored(rows.withColumn("mixed", F.xxhash64("doc_id", "n_tokens")), "lengths")
    bins = rows.groupBy(_bin_top(F.col("n_tokens")).alias("top")).agg(F.count("*").alias("n"), F.max("n_tokens").alias("longest")).orderBy("top").collect()
    lengths = np.array([b["longest"] for b in bins], np.int64)
    tops = boundaries(lengths, np.array([b["n"] for b in bins], np.int64), buckets)
    total = sum(b["n"] for b in bins)
    blocks = max(1, total // 100_000)
    tops_col = F.array(*[F.lit(t).cast("long") for t in tops]) if tops else F.array().cast("array<long>")
    bucket = F.size(F.filter(tops_col, lambda t: t < F.col("n_tokens")))
    rows = rows.withColumn("bucket", bucket).withColumn("bucket_len", F.get(tops_col, F.col("bucket")))
    # the block is a range of the hash, so that blocks in order are all rows in order
    rows = rows.withColumn("block", F.floor((F.shiftrightunsigned("mixed", 32)) * blocks / F.lit(1 << 32)).cast("int"))
    from pyspark.sql import Window

    sizes = rows.groupBy("bucket", "block").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket", "block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("bucket", "block").orderBy("mixed", "doc_id", "n_tokens"))
    rows = rows.withColumn("rank", rank).join(sizes, ["bucket", "block"])
    rank = F.col("rank") - 1 + F.col("ahead")
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1)))).cast("long")
    return rows.select(
        "doc_id", "n_tokens", "bucket", "bucket_len",
        F.floor(rank / room).cast("long").alias("batch"), (rank % room).cast("long").alias("place"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
    )
