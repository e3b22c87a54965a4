"""Words of whole texts as numpy arrays, straight from Arrow's string buffers.

A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage
return. All of these are single bytes in UTF-8, so a text can be cut on its bytes.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"

#: Rows that Spark hands to a Python worker at once: whole texts may be long, and 10,000 of them need not fit.
BATCH_ROWS = 500

_SLICE = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_IS_SPACE = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(SPACES, np.uint8))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_powers: list[np.ndarray] = []


def unused(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores behind it as it takes to be none of ``columns``."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def small_batches(spark) -> None:
    """Lowers the session's limit of rows in an Arrow batch to BATCH_ROWS, unless it is lower."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns what a group or task has freed to the system: Spark keeps Python workers, which would hold it through later stages."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def trimmed(f):
    """``f`` of one or two tables, after which freed memory goes back."""

    def one(table):
        return two(table)

    def two(table, *other):
        try:
            return f(table, *other)
        finally:
            give_back()

    def both(table, other):
        return two(table, other)

    return one if f.__code__.co_argcount == 1 else both


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads each bit over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, _SLICE)
        _powers[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, step, np.uint64)]) for step in (_STEP, _BACK)]
    return _powers


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another, and where each begins; a null text has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def word_hashes(column: pa.Array | pa.ChunkedArray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each word of each text in order: the row of its text, and a 64-bit hash. fold: A-Z count as a-z."""
    data, at = text_bytes(column)
    table, docs, hashes = _FOLDED if fold else _BYTE, [], []
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + _SLICE, "right")) - 1)
        part = data[at[first] : at[last]]
        if len(part):
            bounds = at[first : last + 1] - at[first]
            solid = ~_IS_SPACE[part]
            begins, ends = solid.copy(), solid.copy()
            begins[1:] &= ~solid[:-1]
            ends[:-1] &= ~solid[1:]
            edges = bounds[1:-1]
            inner = edges[(edges > 0) & (edges < len(part))]
            begins[inner] = solid[inner]
            ends[inner - 1] = solid[inner - 1]
            b, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
            forth, back = _power_tables(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(table[part] * forth[: len(part)], out=sums[1:])
            hashes.append(mix((sums[e] - sums[b]) * back[b] + (e - b).astype(np.uint64)))
            docs.append((np.searchsorted(bounds, b, "right") - 1 + first).astype(np.int32))
        first = last
    return (np.concatenate(docs), np.concatenate(hashes)) if docs else (np.zeros(0, np.int32), np.zeros(0, np.uint64))


def gram_hashes(docs: np.ndarray, hashes: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which n words of one text begin, and a 64-bit hash of each such sequence."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    step, total = np.uint64((0xD6E8FEB86659FD93 + 2 * seed) & (1 << 64) - 1), np.zeros(size, np.uint64)
    words = mix(hashes + np.uint64(seed)) if seed else hashes
    for k in range(n):
        total = total * step + words[k : k + size]
    at = np.flatnonzero(docs[:size] == docs[n - 1 :])
    return at, mix(total[at])
