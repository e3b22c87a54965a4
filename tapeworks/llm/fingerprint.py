"""Fingerprints of texts that stay near when a text is edited a little.

Byte triplets are hashed into buckets and counted; a digest has two bits for each bucket, which quarter of
the text's counts its own is in, and the length in eighths of a doubling.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import BATCH_ROWS, give_back, mix, small_batches

#: Buckets of a digest, a multiple of 4, and bytes of text that are counted at once.
BUCKETS, RUN_BYTES = 1024, 4 << 20
#: Mean difference of two independent quarters, and what a doubling of the length adds to the difference, at most how much.
UNRELATED, PER_DOUBLING, MOST_BY_LENGTH = 1.25, 0.1, 0.5

_WEIGHTS = np.array([64, 16, 4, 1], np.uint8)
_RESULT = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: Two bytes that no text has ahead of it, so that each byte ends a triplet and short texts have some too.
_AHEAD = b"\xff\xff"


def quarters(texts: Sequence[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """For each text the quarter (0 to 3) of each bucket's count among the text's, and the length code."""
    data = np.frombuffer(b"".join(_AHEAD + t for t in texts), np.uint8).astype(np.uint64)
    sizes = np.array([len(t) for t in texts], np.int64)
    triplet = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
    bucket = (mix(triplet + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
    starts = np.cumsum(sizes + 2) - sizes - 2
    row = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
    counts = np.bincount(row * buckets + bucket[at], minlength=len(texts) * buckets).reshape(len(texts), buckets)
    cuts = [buckets * k // 4 - 1 for k in (1, 2, 3)]
    ordered = np.partition(counts, cuts, axis=1)[:, cuts]
    return (counts[:, :, None] > ordered[:, None, :]).sum(axis=2, dtype=np.uint8), np.minimum(255, np.rint(8 * np.log2(sizes + 1))).astype(np.uint8)


def encoded(quarter: np.ndarray, length: np.ndarray) -> list[str]:
    """Digests in hex: the length, then four buckets to a byte."""
    packed = (quarter.reshape(len(quarter), -1, 4) * _WEIGHTS).sum(axis=2, dtype=np.uint8)
    return [bytes([n]).hex() + row.tobytes().hex() for n, row in zip(length.tolist(), packed)]


def decoded(digests: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    data = np.array([list(bytes.fromhex(d)) for d in digests], np.uint8)
    return ((data[:, 1:, None] // _WEIGHTS) % 4).reshape(len(data), -1), data[:, 0]


def likeness_of(a: np.ndarray, a_len: np.ndarray, b: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """1 less the difference of two digests, from 0 to 1, row by row.

    The buckets' difference is over what unrelated digests differ by, or over all that the two have where that is
    less, as in short texts; lengths add up to MOST_BY_LENGTH. An empty text is like empty ones only.
    """
    a, b = a.astype(np.int32), b.astype(np.int32)
    most = np.minimum(UNRELATED * a.shape[1], (a + b).sum(axis=1))
    differ = np.abs(a - b).sum(axis=1) / np.maximum(most, 1)
    longer = np.minimum(MOST_BY_LENGTH, np.abs(a_len.astype(np.int32) - b_len.astype(np.int32)) / 8 * PER_DOUBLING)
    return np.where((a_len == 0) != (b_len == 0), 0.0, 1 - np.minimum(1.0, differ + longer))


def likeness(a: Column, b: Column) -> Column:
    """The likeness of two digest columns, 0 to 1; null where one is null."""

    @F.pandas_udf("double")
    def compare(x: pd.Series, y: pd.Series) -> pd.Series:
        out, known = pd.Series(np.nan, x.index), x.notna() & y.notna()
        if known.any():
            out[known] = likeness_of(*decoded(x[known].tolist()), *decoded(y[known].tolist()))
        return out.astype(object).where(known, None)

    return compare(a, b)


def fingerprint(text: Column, buckets: int = BUCKETS) -> Column:
    """The digest of each whole text; null counts as empty, and equal texts have equal digests."""

    @F.pandas_udf("string")
    def digest(texts: pd.Series) -> pd.Series:
        data, out = [(t or "").encode() for t in texts], []
        for some in _runs(data):
            out += encoded(*quarters(some, buckets))
        return pd.Series(out, texts.index, dtype=object)

    return digest(text)


def _runs(data: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in order, in lists of about RUN_BYTES and of BATCH_ROWS at most."""
    some, size = [], 0
    for t in data:
        some.append(t)
        size += len(t)
        if size >= RUN_BYTES or len(some) >= BATCH_ROWS:
            yield some
            some, size = [], 0
    if some:
        yield some


def _below(bounds: list[int], x: Column) -> Column:
    """How many of the ascending bounds are less than x, found in two steps of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    count = lambda values: F.size(F.filter(values, lambda b: b < x))
    coarse = count(F.array(*[F.lit(b) for b in bounds[step - 1 :: step]])) * step
    return coarse + count(F.slice(F.array(*[F.lit(b) for b in bounds]), coarse + 1, step))


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, halo) in partitions that follow each other by id, nulls first, and each sorted; a partition ends with the
    first rows of the next one, and the last with those of the first, marked halo.

    Partitions are cut at quantiles of the ids, which are read without the texts; the driver gets one id for each
    partition. Each text moves once.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"))
    cuts = ids.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 20 * n).alias("q")).first()["q"] if n > 1 else None
    bounds = sorted(set(cuts or []))
    part = _below(bounds, F.col("doc_id"))
    heads = ids.groupBy(part.alias("part")).agg(F.when(F.count("*") > F.count("doc_id"), F.lit(None)).otherwise(F.min("doc_id")).alias("first")).orderBy("part").collect()
    before = [heads[i - 1]["part"] for i in range(len(heads))]
    halo = spark.createDataFrame([(h["first"], p) for h, p in zip(heads, before)], "first long, part int")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # a row for each partition
    rows = rows.join(F.broadcast(halo), F.col("doc_id").eqNullSafe(F.col("first")), "left")
    own = F.struct(part.alias("part"), F.lit(False).alias("halo"))
    rows = rows.select("doc_id", "text", F.inline(F.array_compact(F.array(own, F.when(F.col("part").isNotNull(), F.struct("part", F.lit(True).alias("halo")))))))
    return rows.repartitionById(len(bounds) + 1, F.col("part").cast("int")).sortWithinPartitions("halo", "doc_id", "text").drop("part")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by as many of the first ones of ``following``, or all of them."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how near it is to that and to the next document.

    Columns: the id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The
    next document is that of the next id, after the last the first; rows of one id follow each other by text, and a
    null id or text comes first. A null text is empty: its edited text is empty too. A text of any length is
    counted whole. An only row is next to itself. An empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(rows: list[tuple], out: list) -> None:
        """Results of all rows but the last, each with the row behind it as next one."""
        texts = [r[1] for r in rows]
        changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
        own, own_len = quarters([t.encode() for t in texts], buckets)
        other, other_len = quarters([t.encode() for t in changed], buckets)
        near = likeness_of(own[:-1], own_len[:-1], other, other_len)
        following = likeness_of(own[:-1], own_len[:-1], own[1:], own_len[1:])
        digests = encoded(own[:-1], own_len[:-1]), encoded(other, other_len)
        for i, (doc_id, text, halo) in enumerate(rows[:-1]):
            if not halo:
                out.append((doc_id, len(text), hashlib.sha256(changed[i].encode()).hexdigest(), digests[0][i], digests[1][i], float(near[i]), float(following[i])))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        names = [c.split()[0] for c in _RESULT.split(", ")]
        for batch in batches:
            out, size = [], 0
            for doc_id, text, halo in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), batch["halo"].to_pylist()):
                held.append((None if doc_id is None else str(doc_id), text or "", halo))
                size += len(held[-1][1])
                if size >= RUN_BYTES and len(held) > 1:
                    run(held, out)
                    held, size = held[-1:], 0
            if len(held) > 1:
                run(held, out)
                held = held[-1:]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names)
        give_back()

    out = in_order(docs, id_col, text_col).mapInArrow(walk, _RESULT)
    return out.select(F.col("doc_id").cast(docs.schema[id_col].dataType).alias(id_col), *out.columns[1:])


_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
