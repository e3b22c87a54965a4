"""Which hashes of a chunk of documents also occur elsewhere, without a row for each word.

Documents are dealt to chunks of a bounded number of bytes. A chunk sends the sorted set of its hashes
to range buckets, one packed row for each bucket: a hash costs about two bytes, however often the chunk
holds it, so that no passage, however common, is hot. A bucket answers each chunk in the order in which
it asked, and the chunk, which recomputes its sorted hashes from the same documents, puts the answers in
place. Chunks and buckets are many as the bytes are many; each is one bounded group of a task: of very many
chunks, a bucket's rows are merged by groups of chunks first, then the groups' sums, and the answers go back the same way. A chunk has
no row for a bucket in which it has no hash, so rows are at most one for each distinct hash of a chunk:
on a large corpus rows become short, and never more than a plain shuffle of hashes would have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.scratch import stored

from .words import trimmed

#: Bytes of text in a chunk, and bytes of text for which there is one bucket.
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 12 << 20
#: Parts of its range that a bucket goes through one by one.
PARTS = 8

#: Chunks whose rows of a bucket are one group of a task.
GROUP_CHUNKS = 1 << 16

ASKED = "chunk long, bucket int, vals binary, marks binary"
ANSWER = "chunk long, tag int, bucket int, reply binary"


def plan(n_bytes: int) -> tuple[int, int]:
    """How many chunks and buckets texts of so many bytes get."""
    return max(1, -(-n_bytes // CHUNK_BYTES)), max(1, -(-n_bytes // BUCKET_BYTES))


def bucket_bounds(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted hashes: the buckets that have some, where these begin and the last one ends, and the 32 bits that tell hashes apart within a bucket."""
    n, low = np.uint64(buckets), np.uint64(0xFFFFFFFF)
    wide = (h >> np.uint64(32)) * n + ((h & low) * n >> np.uint64(32))
    bucket = (wide >> np.uint64(32)).astype(np.int32)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(h) else np.zeros(0, np.int64)
    return bucket[starts], np.r_[starts, len(h)], (wide & low).astype(np.uint32)


def cells(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary cell for each row, of the bytes of the values from one bound to the next."""
    data = np.ascontiguousarray(values)
    offsets = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def contents(column: pa.ChunkedArray | pa.Array, item: str) -> tuple[np.ndarray, np.ndarray]:
    """What cells() was given: the values of all rows, and the bounds of each row's."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    size = np.dtype(item).itemsize
    if not len(column):
        return np.zeros(0, item), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(data.tobytes(), item) if len(data) else np.zeros(0, item), (offsets - offsets[0]) // size


def _places(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each value the place of its lowest byte, and how far apart its bytes are, if each row is laid out by byte plane."""
    sizes = np.diff(bounds)
    return np.arange(bounds[-1]) + (width - 1) * np.repeat(bounds[:-1], sizes), np.repeat(sizes, sizes)


def planes(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Cells of unsigned integers by byte plane: the high planes are nearly all zero and compress away."""
    width = values.itemsize
    place, apart = _places(bounds, width)
    out = np.empty(len(values) * width, np.uint8)
    for k in range(width):
        out[place + k * apart] = (values >> values.dtype.type(8 * k)).astype(np.uint8)
    return cells(out, bounds * width)


def from_planes(column: pa.ChunkedArray | pa.Array, item: str) -> tuple[np.ndarray, np.ndarray]:
    """What planes() was given."""
    data, ends = contents(column, "u1")
    width = np.dtype(item).itemsize
    bounds = ends // width
    place, apart = _places(bounds, width)
    out = np.zeros(bounds[-1], item)
    for k in range(width):
        out |= data[place + k * apart].astype(item) << np.dtype(item).type(8 * k)
    return out, bounds


def packed(sorted_vals: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Cells of 32-bit values that are sorted in each row, as the steps between them."""
    steps = np.diff(sorted_vals, prepend=np.uint32(0))
    starts = bounds[:-1]
    steps[starts] = sorted_vals[starts]
    return planes(steps, bounds)


def unpacked(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What packed() was given."""
    steps, bounds = from_planes(column, "<u4")
    sums = np.cumsum(steps, dtype=np.uint32)
    before = np.r_[np.uint32(0), sums][bounds[:-1]]
    return sums - np.repeat(before, np.diff(bounds)), bounds


def asked(chunk: int, h: np.ndarray, weights: np.ndarray, flags: np.ndarray, buckets: int) -> pa.Table:
    """The rows that a chunk sends. h: sorted set of hashes; weights: documents with it, up to 127 count; flags: 0 or 1."""
    full, bounds, vals = bucket_bounds(h, buckets)
    marks = np.minimum(weights, 127).astype(np.uint8) | (flags.astype(np.uint8) << np.uint8(7))
    return pa.table({
        "chunk": pa.array(np.full(len(full), chunk, np.int64)),
        "bucket": pa.array(full, pa.int32()),
        "vals": packed(vals, bounds),
        "marks": cells(marks, bounds),
    })


def parts(values: np.ndarray) -> Iterator[np.ndarray]:
    """Places of unsigned integers in PARTS ranges of values, so that a bucket is sorted a part at a time."""
    if len(values):
        low, high = int(values.min()), int(values.max())
        part = ((values - values.dtype.type(low)) // values.dtype.type((high - low) // PARTS + 1)).astype(np.uint8)
        for k in range(PARTS):
            yield np.flatnonzero(part == k)


def answered(tag: int, as_bits: bool):
    """For a bucket's rows: of each hash the sum of weights, up to 255, or 0 if no chunk flagged it; as_bits: whether that is 2 or more."""

    def run(table: pa.Table) -> pa.Table:
        (vals, bounds), marks = unpacked(table["vals"]), contents(table["marks"], "u1")[0]
        reply = np.zeros(len(vals), np.uint8)
        for own in parts(vals):
            order = own[np.argsort(vals[own], kind="stable")]
            if not len(order):
                continue
            same = vals[order]
            starts = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
            total = np.minimum(np.add.reduceat(marks[order] & np.uint8(127), starts, dtype=np.int64), 255).astype(np.uint8)
            total *= np.maximum.reduceat(marks[order] >> np.uint8(7), starts)
            reply[order] = np.repeat(total, np.diff(np.r_[starts, len(order)]))
        return pa.table({
            "chunk": table["chunk"],
            "tag": pa.array(np.full(table.num_rows, tag, np.int32)),
            "bucket": table["bucket"],
            "reply": cells((reply >= 2).astype(np.uint8) if as_bits else reply, bounds),
        })

    return trimmed(run)


def replies(table: pa.Table, tag: int, full: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The answers to a chunk's sorted hashes, in their order. full, bounds: as bucket_bounds has them."""
    out = np.zeros(int(bounds[-1]), np.uint8)
    table = table.filter(pc.equal(table["tag"], tag))
    if table.num_rows:
        data, ends = contents(table["reply"], "u1")
        sizes = np.diff(ends)
        starts = bounds[np.searchsorted(full, np.asarray(table["bucket"]))]
        out[np.arange(len(data)) + np.repeat(starts - ends[:-1], sizes)] = data
    return out


def _summed(table: pa.Table) -> pa.Table:
    """The rows of a bucket from a group of chunks as one row, as if the group were a chunk."""
    (vals, bounds), marks = unpacked(table["vals"]), contents(table["marks"], "u1")[0]
    order = np.argsort(vals, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(vals[order]) != 0]) if len(vals) else np.zeros(0, np.int64)
    total = np.minimum(np.add.reduceat(marks[order] & np.uint8(127), starts, dtype=np.int64), 127).astype(np.uint8)
    flag = np.maximum.reduceat(marks[order] >> np.uint8(7), starts)
    one = np.array([0, len(starts)])
    return pa.table({"chunk": table["salt"].slice(0, 1), "bucket": table["bucket"].slice(0, 1), "vals": packed(vals[order][starts], one), "marks": cells(total | (flag << np.uint8(7)), one)})


def _spread(table: pa.Table, told: pa.Table) -> pa.Table:
    """The answers to a group of chunks, for each of its chunks."""
    vals, bounds = unpacked(table["vals"])
    reply = contents(told["reply"], "u1")[0]
    return pa.table({"chunk": table["chunk"], "tag": pa.array(np.full(table.num_rows, told["tag"][0].as_py(), np.int32)), "bucket": table["bucket"], "reply": cells(reply[np.searchsorted(np.unique(vals), vals)], bounds)})


def salts(chunks: int) -> int:
    """Groups of chunks whose rows of a bucket are merged apart."""
    return max(1, -(-chunks // GROUP_CHUNKS))


def told(asked_rows: DataFrame, chunks: int, tag: int, as_bits: bool) -> DataFrame:
    """The answers (ANSWER) to what chunks asked (ASKED): see answered().

    A hash that every chunk has sends a row of each to one bucket. Of more than GROUP_CHUNKS chunks these are merged by group
    first (a group's sum counts up to 127), so no task holds a bucket's rows of all chunks.
    """
    n = salts(chunks)
    if n == 1:
        return asked_rows.groupBy("bucket").applyInArrow(answered(tag, as_bits), ANSWER)
    rows = stored(asked_rows, "asked").withColumn("salt", F.pmod("chunk", F.lit(n)))
    sums = stored(rows.groupBy("bucket", "salt").applyInArrow(trimmed(_summed), ASKED), "sums")
    totals = sums.groupBy("bucket").applyInArrow(answered(tag, as_bits), ANSWER)
    return rows.groupBy("bucket", "salt").cogroup(totals.groupBy("bucket", "chunk")).applyInArrow(trimmed(_spread), ANSWER)
