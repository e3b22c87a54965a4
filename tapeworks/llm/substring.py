"""Substring deduplication by fixed-block anchors.

A window is 13 words. Wherever it lies in a document, it covers one of that document's blocks of 7 words
that begin at words 0, 7, 14 ... So these blocks are the index, and every rolling run of 7 words probes
it. Hits are extended: all windows around a hit are compared whole, by a hash of 96 bits and more, between
all chunks that hold them. Equal windows that overlap or adjoin make up the maximal repeat, of which every
word goes. A chunk says of each of its windows the least id that has it, so chunks need no order, and what
belongs to one id may lie in several.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.scratch import stored

from . import exchange as X
from .words import gram_hashes, trimmed, word_hashes

_WINDOW_ASKED = "chunk long, bucket int, vals binary, more binary, ids binary"
_ANCHORS, _WINDOWS = 0, 1


def _probe(table: pa.Table, block: int):
    """Words, and of each distinct run of `block` words its hash, occurrences, and whether documents share it or a block has it."""
    docs, hashes = word_hashes(table["text"])
    at, h = gram_hashes(docs, hashes, block)
    order = np.argsort(h, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(h[order]) != 0]) if len(h) else np.zeros(0, np.int64)
    return docs, hashes, at, h, order, starts


def _ranks(ids: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """Of each row the rank of its id; rows without an id rank apart and last."""
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    rank[missing] = len(ids) + np.arange(missing.sum())
    return rank


def _by_id(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    table = table.sort_by([("doc_id", "ascending")])
    missing = np.asarray(table["doc_id"].is_null())
    return table, _ranks(np.asarray(table["doc_id"].fill_null(0)), missing), missing


def _ask_anchors(block: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        table, rank, missing = _by_id(table)
        docs, _, at, h, order, starts = _probe(table, block)
        if not len(h):
            return X.asked(0, h, h, h, buckets)
        first_word = np.searchsorted(docs, np.arange(table.num_rows))
        aligned = ((at - first_word[docs[at]]) % block == 0) & ~missing[docs[at]]
        own = rank[docs[at]][order]
        several = np.maximum.reduceat(own, starts) != np.minimum.reduceat(own, starts)
        return X.asked(table["chunk"][0].as_py(), h[order][starts], 1 + several, np.logical_or.reduceat(aligned[order], starts), buckets)

    return trimmed(run)


def _candidates(table: pa.Table, rank: np.ndarray, missing: np.ndarray, answers: pa.Table, block: int, window: int, buckets: int):
    """The windows that hold a run of words which some block elsewhere has too, sorted by hash."""
    docs, hashes, at, h, order, starts = _probe(table, block)
    near = np.zeros(len(hashes) + window + 1, np.int32)
    if len(h):
        bit = X.replies(answers, _ANCHORS, *X.bucket_bounds(h[order][starts], buckets)[:2])
        hit = np.empty(len(h), np.uint8)
        hit[order] = np.repeat(bit, np.diff(np.r_[starts, len(h)]))
        near[at[hit > 0] + 1] = 1
    near = np.cumsum(near)
    w_at, w_h = gram_hashes(docs, hashes, window, seed=1)
    keep = (near[w_at + window - block + 1] > near[w_at]) & ~missing[docs[w_at]]
    w_at, w_h = w_at[keep], w_h[keep]
    w_more = gram_hashes(docs, hashes, window, seed=2)[1][keep].astype(np.uint32)
    order = np.lexsort((rank[docs[w_at]], w_more, w_h))
    w_at, w_h, w_more = w_at[order], w_h[order], w_more[order]
    fresh = np.flatnonzero(np.r_[True, (np.diff(w_h) != 0) | (np.diff(w_more) != 0)]) if len(w_h) else np.zeros(0, np.int64)
    return docs, w_at, w_h, w_more, fresh


def _ask_windows(block: int, window: int, buckets: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        table, rank, missing = _by_id(table)
        docs, at, h, more, fresh = _candidates(table, rank, missing, answers, block, window, buckets)
        ids = np.asarray(table["doc_id"].fill_null(0))[docs[at[fresh]]]
        h, more = h[fresh], more[fresh]
        full, bounds, _ = X.bucket_bounds(h, buckets)
        return pa.table({
            "chunk": pa.array(np.full(len(full), table["chunk"][0].as_py() if table.num_rows else 0, np.int64)),
            "bucket": pa.array(full, pa.int32()),
            "vals": X.cells(h.astype("<u8"), bounds),
            "more": X.cells(more.astype("<u4"), bounds),
            "ids": X.planes(ids.astype("<i8").view("<u8"), bounds),
        })

    return trimmed(run)


def _least_ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows of some rows: hash, the rest of it, id, the least id of equal windows, and the rows' bounds."""
    (h, bounds), more = X.contents(table["vals"], "<u8"), X.contents(table["more"], "<u4")[0]
    ids = X.from_planes(table["ids"], "<u8")[0].view("<i8")
    least = np.empty(len(h), np.int64)
    for own in X.parts(h):
        order = own[np.lexsort((ids[own], more[own], h[own]))]
        if len(order):
            some, rest = h[order], more[order]
            starts = np.flatnonzero(np.r_[True, (some[1:] != some[:-1]) | (rest[1:] != rest[:-1])])
            least[order] = np.repeat(ids[order][starts], np.diff(np.r_[starts, len(order)]))
    return h, more, ids, least, bounds


def _earlier(table: pa.Table) -> pa.Table:
    """Of each window of a bucket: whether a smaller id than the least one of its chunk has it."""
    _, _, ids, least, bounds = _least_ids(table)
    bit = (least < ids).astype(np.uint8)
    return pa.table({"chunk": table["chunk"], "tag": pa.array(np.full(table.num_rows, _WINDOWS, np.int32)), "bucket": table["bucket"], "reply": X.cells(bit, bounds)})


def _narrowed(table: pa.Table) -> pa.Table:
    """The windows of a bucket from a group of chunks, each once with its least id, as if the group were a chunk."""
    h, more, ids, _, _ = _least_ids(table)
    order = np.lexsort((ids, more, h))
    h, more, ids = h[order], more[order], ids[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (more[1:] != more[:-1])]) if len(h) else np.zeros(0, np.int64)
    one = np.array([0, len(first)])
    cells = {"vals": X.cells(h[first], one), "more": X.cells(more[first], one), "ids": X.planes(ids[first].view("<u8"), one)}
    return pa.table({"chunk": table["salt"].slice(0, 1), "bucket": table["bucket"].slice(0, 1)} | cells)


def _least_of_all(table: pa.Table) -> pa.Table:
    """For each group of chunks and window of a bucket: the least id of all groups."""
    _, _, _, least, bounds = _least_ids(table)
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "ids": X.planes(least.view("<u8"), bounds)})


def _spread(table: pa.Table, told: pa.Table) -> pa.Table:
    """Of each window of a group of chunks: whether the least id of all is smaller than its chunk's."""
    h, more, ids, _, bounds = _least_ids(table)
    order = np.lexsort((more, h))
    fresh = np.r_[True, (np.diff(h[order]) != 0) | (np.diff(more[order]) != 0)] if len(h) else np.zeros(0, bool)
    bit = np.zeros(len(h), np.uint8)
    bit[order] = X.from_planes(told["ids"], "<u8")[0].view("<i8")[np.cumsum(fresh) - 1] < ids[order]
    return pa.table({"chunk": table["chunk"], "tag": pa.array(np.full(table.num_rows, _WINDOWS, np.int32)), "bucket": table["bucket"], "reply": X.cells(bit, bounds)})


def _compared(windows: DataFrame, chunks: int) -> DataFrame:
    """The answers to the windows that chunks asked for; of very many chunks they are merged by groups first, as hashes are (exchange.told)."""
    n = X.salts(chunks)
    if n == 1:
        return windows.groupBy("bucket").applyInArrow(trimmed(_earlier), X.ANSWER)
    rows = stored(windows, "windows").withColumn("salt", F.pmod("chunk", F.lit(n)))
    groups = stored(rows.groupBy("bucket", "salt").applyInArrow(trimmed(_narrowed), _WINDOW_ASKED), "narrowed")
    least = groups.groupBy("bucket").applyInArrow(trimmed(_least_of_all), "chunk long, bucket int, ids binary")
    return rows.groupBy("bucket", "salt").cogroup(least.groupBy("bucket", "chunk")).applyInArrow(trimmed(_spread), X.ANSWER)


def _remove(block: int, window: int, buckets: int, with_text: bool):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        table, rank, missing = _by_id(table)
        docs, at, h, _, fresh = _candidates(table, rank, missing, answers, block, window, buckets)
        gone = np.zeros(len(docs) + 1, np.int32)
        if len(at):
            sizes = np.diff(np.r_[fresh, len(at)])
            own = rank[docs[at]]
            bit = X.replies(answers, _WINDOWS, *X.bucket_bounds(h[fresh], buckets)[:2])
            drop = at[(np.repeat(bit, sizes) > 0) | (own > np.repeat(own[fresh], sizes))]
            np.add.at(gone, drop, 1)
            np.add.at(gone, drop + window, -1)
        gone = np.cumsum(gone[:-1]) > 0
        bounds = np.searchsorted(docs, np.arange(table.num_rows + 1))
        n_words, texts, digests, n_gone = np.diff(bounds), [], [], []
        for k, text in enumerate(table["text"]):
            words, mask = (text.as_py() or "").encode().split(), gone[bounds[k] : bounds[k + 1]]
            n_gone.append(int(mask.sum()))
            kept = b" ".join(compress(words, ~mask) if n_gone[-1] else words)
            digests.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                texts.append(kept)
        columns = {
            "doc_id": table["doc_id"],
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_gone, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        return pa.table(columns | ({"kept_text": pa.array(texts, pa.binary()).cast(pa.string())} if with_text else {}))

    return trimmed(run)


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Every word of a window that also starts in a document of a smaller id is removed.

    Returns doc_id, n_words, n_removed, kept_sha256 and, with_text, kept_text (kept words joined by one space),
    a row for each row of ``docs``; other columns are not read. A null or empty text has no words, an empty
    table gives no rows. Rows that repeat an id count as one document and don't shorten each other; a row with
    a null id keeps its words and shortens nothing. A very long text is a chunk by itself, or part of one.
    ``window`` must be odd and 3 or more: blocks have (window + 1) / 2 words.
    """
    if window < 3 or window % 2 == 0:
        raise ValueError("window must be odd, and 3 or more")
    block = (window + 1) // 2
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    chunks, buckets = X.plan(size)
    # by text too, so that neither null nor repeated ids gather in one chunk
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))).groupBy("chunk")
    anchors = dealt.applyInArrow(_ask_anchors(block, buckets), X.ASKED)
    shared = X.told(anchors, chunks, _ANCHORS, True)
    windows = dealt.cogroup(shared.groupBy("chunk")).applyInArrow(_ask_windows(block, window, buckets), _WINDOW_ASKED)
    earlier = _compared(windows, chunks)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return dealt.cogroup(shared.unionByName(earlier).groupBy("chunk")).applyInArrow(_remove(block, window, buckets, with_text), schema)
