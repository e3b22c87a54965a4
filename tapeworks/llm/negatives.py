"""Hard negatives by integer scores, found through stored angles.

Every vector has its norm and its angles to a few reference directions stored. For a query q, a row x and a direction r the
triangle of their angles gives cos(q_r + x_r) <= cos(q, x) <= cos(q_r - x_r), so norms times these bound the score of
q and x. A block of rows is in the order of nearest direction and angle, so its ranges of angles are narrow and bound
all of its rows at once; only rows whose bounds meet a query's window are scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.common import top1
from tapeworks.functions.scratch import stored

from .order import numbered
from .words import give_back, trimmed

#: Reference directions, and vectors that they are drawn from at most.
DIRECTIONS, SAMPLE = 8, 1024
#: Rows of a block, queries of a group, and tasks that share a group's rows. All blocks move once for each group, so a group has as
#: many queries as a task holds with their best rows (about 20 MB at 64 dimensions), not as few as would spread them.
BLOCK_ROWS, GROUP_QUERIES, SLICES = 2048, 4096, 8
#: Angles are stored as 32-bit floats: two of them and their cosines are off by less than this.
SLACK = 1e-6
#: Vectors of this length or more take no part: a score of two might not fit 64 bits.
MOST_NORM = 2.0**31
#: Products of norms below this are summed exactly by doubles.
EXACT = 2.0**52

_ROW = "vec_id long, label long, vec binary, norm double, angles binary, cell int, own double"
_PACK = "block long, ids binary, labels binary, vecs binary, norms binary, angles binary"


def _directions(rows: DataFrame) -> np.ndarray:
    """Unit vectors in the middle of clusters of a sample of SAMPLE rows, the least by a hash of the id."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toPandas()["vector"]
    if not len(sample):
        return np.zeros((DIRECTIONS, 0))
    x = np.array([np.asarray(v, np.float64) for v in sample]).reshape(len(sample), -1)
    norm = np.linalg.norm(np.where(np.isfinite(x), x, 0), axis=1)
    x = x[(norm > 0) & (norm < 1e150)] / norm[(norm > 0) & (norm < 1e150), None]
    if not len(x):
        return np.zeros((DIRECTIONS, x.shape[1]))
    near, picked = x @ x[0], [0]
    while len(picked) < DIRECTIONS:
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[picked[-1]])
    middle = x[picked]
    for _ in range(10):
        cell = np.argmax(x @ middle.T, axis=1)
        sums = np.array([x[cell == k].sum(axis=0) for k in range(DIRECTIONS)])
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        middle = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), middle)
    return middle


def vectors(rows: DataFrame, id_col: str, label: Column, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, label, vector as doubles) of the rows that take part, one for each id, and the vectors' length."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    out = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    out = out.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))
    found = out.agg(F.count("*").alias("n"), F.countDistinct("vec_id").alias("ids")).first()
    if found["n"] > found["ids"]:
        out = stored(top1(out, ["vec_id"], F.asc("vector"), F.asc("label")), "vectors")
    sizes = out.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    dim = sizes[0]["size"] if sizes else 0
    return out.where(F.size("vector") == dim), dim


def indexed(rows: DataFrame, scale: int) -> DataFrame:
    """``rows`` (vec_id, label, vector) as integers floor(scale * x), with norm, angles, nearest direction (cell) and the angle to it (own)."""
    directions = _directions(rows)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = np.floor(scale * batch["vector"].flatten().to_numpy(zero_copy_only=False).reshape(n, -1))
            with np.errstate(over="ignore"):
                norm = np.sqrt(np.square(x).sum(axis=1))
            good = norm < MOST_NORM
            x, norm = x[good], norm[good]
            cosine = np.clip((x @ directions.T) / np.where(norm > 0, norm, 1)[:, None], -1, 1)
            angles = np.arccos(cosine).astype("<f4")
            cell = np.argmin(angles, axis=1) if len(angles) else np.zeros(0, np.int64)
            whole = x.astype("<i4")
            yield pa.RecordBatch.from_arrays([
                batch["vec_id"].filter(pa.array(good)), batch["label"].filter(pa.array(good)),
                pa.array([_small(v) for v in whole], pa.binary()), pa.array(norm), pa.array([a.tobytes() for a in angles], pa.binary()),
                pa.array(cell, pa.int32()), pa.array(angles[np.arange(len(cell)), cell].astype(np.float64)),
            ], [c.split()[0] for c in _ROW.split(", ")])

    return stored(rows.mapInArrow(index, _ROW), "angles")


def _small(v: np.ndarray) -> bytes:
    """Integers of two bytes each if all fit, else of four."""
    return (v.astype("<i2") if v.size and -32768 <= v.min() and v.max() <= 32767 else v).tobytes()


def _packed(rows: DataFrame, size: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows in blocks of ``size`` in the order of cell and angle, each block one row of binaries; ``extra`` are arrays of longs of equal length."""
    order = ["cell", "own", "vec_id"]
    placed = numbered(rows.select("vec_id", "label", "vec", "norm", "angles", "cell", "own", *extra), [], order).withColumn("block", F.expr(f"_pos div {size}"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        vecs = table["vec"].to_pylist()
        wide = max(map(len, vecs))
        if min(map(len, vecs)) < wide:
            vecs = [v if len(v) == wide else np.frombuffer(v, "<i2").astype("<i4").tobytes() for v in vecs]
        get = lambda c: table[c].to_numpy()
        data = {
            "block": [table["block"][0].as_py()], "ids": [get("vec_id").astype("<i8").tobytes()], "labels": [get("label").astype("<i8").tobytes()], "vecs": [b"".join(vecs)],
            "norms": [get("norm").astype("<f8").tobytes()], "angles": [b"".join(table["angles"].to_pylist())],
        } | {c: [table[c].combine_chunks().flatten().to_numpy().astype("<i8").tobytes()] for c in extra}
        return pa.table(data, pa.schema([(k, pa.int64() if k == "block" else pa.binary()) for k in data]))

    schema = _PACK + "".join(f", {c} binary" for c in extra)
    return stored(placed.groupBy("block").applyInArrow(trimmed(pack), schema), "blocks")


class Block:
    """A block of rows, or a group of queries, as arrays."""

    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        n, size = len(self.ids), len(row["vecs"])
        self.norms = np.frombuffer(row["norms"], "<f8")
        self.angles = np.frombuffer(row["angles"], "<f4").reshape(n, -1).astype(np.float64)
        width = row["dim"]
        self.whole = np.frombuffer(row["vecs"], "<i2" if size == 2 * n * width else "<i4").reshape(n, width)
        self.cos, self.sin = np.cos(self.angles), np.sin(self.angles)
        self.least, self.most = self.angles.min(axis=0), self.angles.max(axis=0)
        self.exact = self.whole.astype(np.float64)

    def bounds_of(self, other: Block) -> tuple[np.ndarray, np.ndarray]:
        """For each own vector the least and the greatest score that any row of ``other`` can have."""
        gap = np.maximum(0, np.maximum(other.least - self.angles, self.angles - other.most))
        upper = np.cos(gap).min(axis=1) + SLACK
        first, last = self.angles + other.least, self.angles + other.most
        lower = np.where((first <= math.pi) & (last >= math.pi), -1.0, np.minimum(np.cos(first), np.cos(last))).max(axis=1) - SLACK
        ends = np.array([other.norms.min(), other.norms.max()])
        return (lower[:, None] * ends).min(axis=1) * self.norms, (upper[:, None] * ends).max(axis=1) * self.norms

    def bounds(self, at: int, other: Block) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the score of one own vector with each row of ``other``, rounded so that none is cut off."""
        across, along = other.cos * self.cos[at], other.sin * self.sin[at]
        size = self.norms[at] * other.norms
        return ((across - along).max(axis=1) - SLACK) * size, ((across + along).min(axis=1) + SLACK) * size

    def scores(self, at: int, other: Block, rows: np.ndarray) -> np.ndarray:
        """Integer inner products of one own vector with some rows of ``other``."""
        if self.norms[at] * other.norms.max() < EXACT:
            return (other.exact[rows] @ self.exact[at]).astype(np.int64)
        return other.whole[rows].astype(np.int64) @ self.whole[at].astype(np.int64)


class Best:
    """The k best (score, id) seen so far: the highest scores, of equal ones the least ids."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def needed(self) -> float:
        """The least score that may still come in."""
        return float(self.scores[-1]) if len(self.scores) == self.k else -math.inf

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.r_[self.ids, ids], np.r_[self.scores, scores]
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


def _walk(dim: int, start, use, done, columns: dict):
    """A function over sorted rows (grp, slice, a group of queries, then blocks): start(group), use(state, block), done(state)."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None

        def out():
            rows = done(state) if state is not None else []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), columns.values())], list(columns)) if rows else None

        for batch in batches:
            for row in batch.to_pylist():
                row["dim"] = dim
                if (row["grp"], row["slice"]) != key:
                    if (part := out()) is not None:
                        yield part
                    key, state = (row["grp"], row["slice"]), start(row)
                else:
                    use(state, Block(row))
        if (part := out()) is not None:
            yield part
        give_back()

    return walk


def _met(blocks: DataFrame, groups: DataFrame, walk, schema: str) -> DataFrame:
    """``walk`` over each group of queries and all blocks, in SLICES tasks for each group: queries come first in each."""
    n_blocks, n_groups = blocks.count(), groups.count()
    slices = max(1, min(SLICES, n_blocks))
    both = groups.select(F.col("block").alias("grp"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(-1).cast("long").alias("at"), *[c for c in groups.columns if c != "block"])
    rows = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, n_groups - 1)).cast("long"))).alias("grp"), F.expr(f"cast(block % {slices} as int)").alias("slice"), F.col("block").alias("at"), *[c for c in blocks.columns if c != "block"])
    both = both.unionByName(rows.where(F.lit(n_groups > 0)), allowMissingColumns=True)
    parts = min(n_groups * slices, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))) or 1
    return both.repartition(parts, "grp", "slice").sortWithinPartitions("grp", "slice", "at").mapInArrow(walk, schema)


def _merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of what the slices found: keys, other_id, score, place from 1."""
    rows = found.select(*keys, F.inline(F.arrays_zip(F.col("ids").alias("other_id"), F.col("scores").alias("score"))))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id"))
    return rows.withColumn("place", place).where(F.col("place") <= k)


def nearest_of_label(blocks: DataFrame, groups: DataFrame, dim: int, k: int) -> DataFrame:
    """(anchor_id, positive_id, place, positive_score): each query's k best other rows of its label."""

    def start(row: dict) -> tuple[Block, list[Best]]:
        group = Block(row)
        return group, [Best(k) for _ in group.ids]

    def use(state, block: Block) -> None:
        group, best = state
        _, upper = group.bounds_of(block)
        held = set(np.unique(block.labels).tolist())
        for at in range(len(best)):
            if upper[at] < best[at].needed or int(group.labels[at]) not in held:
                continue
            _, high = group.bounds(at, block)
            rows = np.flatnonzero((high >= best[at].needed) & (block.labels == group.labels[at]) & (block.ids != group.ids[at]))
            if len(rows):
                best[at].add(block.ids[rows], group.scores(at, block, rows))

    def done(state) -> list[tuple]:
        return [(i, b.ids.tolist(), b.scores.tolist()) for i, b in zip(state[0].ids.tolist(), state[1]) if len(b.ids)]

    columns = {"anchor_id": pa.int64(), "ids": pa.list_(pa.int64()), "scores": pa.list_(pa.int64())}
    found = _met(blocks, groups, _walk(dim, start, use, done, columns), "anchor_id long, ids array<long>, scores array<long>")
    return stored(_merged(found, ["anchor_id"], k).select("anchor_id", F.col("other_id").alias("positive_id"), "place", F.col("score").alias("positive_score")), "positives")


def in_windows(blocks: DataFrame, groups: DataFrame, dim: int, windows: int, k: int) -> DataFrame:
    """(anchor_id, window, place, negative_id, negative_score): each query's k best rows of other labels in each of its windows (lows to highs)."""

    def start(row: dict):
        group = Block(row)
        lows, highs = (np.frombuffer(row[c], "<i8").reshape(-1, windows) for c in ("lows", "highs"))
        return group, lows, highs, [[Best(k) for _ in range(windows)] for _ in group.ids]

    def use(state, block: Block) -> None:
        group, lows, highs, best = state
        lower, upper = group.bounds_of(block)
        held = set(np.unique(block.labels).tolist())
        for at, own in enumerate(best):
            least = [max(float(low), b.needed) if low <= high else math.inf for low, high, b in zip(lows[at], highs[at], own)]
            need, most = min(least), float(highs[at].max())
            if upper[at] < need or lower[at] > most or held == {int(group.labels[at])}:
                continue
            low, high = group.bounds(at, block)
            rows = np.flatnonzero((high >= need) & (low <= most) & (block.labels != group.labels[at]))
            if not len(rows):
                continue
            scores = group.scores(at, block, rows)
            for w, b in enumerate(own):
                fits = (scores >= least[w]) & (scores <= highs[at, w])
                if fits.any():
                    b.add(block.ids[rows[fits]], scores[fits])

    def done(state) -> list[tuple]:
        return [(i, w, b.ids.tolist(), b.scores.tolist()) for i, own in zip(state[0].ids.tolist(), state[3]) for w, b in enumerate(own) if len(b.ids)]

    columns = {"anchor_id": pa.int64(), "window": pa.int32(), "ids": pa.list_(pa.int64()), "scores": pa.list_(pa.int64())}
    found = _met(blocks, groups, _walk(dim, start, use, done, columns), "anchor_id long, window int, ids array<long>, scores array<long>")
    return _merged(found, ["anchor_id", "window"], k).select("anchor_id", "window", "place", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, percent: tuple[int, int] = (30, 90), scale: int = 256,
    id_col: str = "vec_id", label: Column | None = None, vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows of which ``anchors`` (on vec_id, label) is true.

    A component counts as floor(scale * x), a score is the integer inner product, higher ones come first and equal ones
    by id. An anchor's positives are its first rows of the same label other than itself; for each of them its negatives are the first
    rows of other labels whose score is between the percentages of the positive's. A positive score below 0 has none.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part, nor do vectors whose
    length isn't the commonest one (of equal counts the longest), nor vectors that are 2**31 or longer once scaled. Of
    rows with one id that of the least vector, then label, counts. Other columns are not read; an empty table gives no rows.
    """
    table, dim = vectors(rows, id_col, F.col("label") if label is None else label, vector_col)
    table = indexed(table, scale)
    blocks, chosen = _packed(table, BLOCK_ROWS), table.where(anchors)
    near = nearest_of_label(blocks, _packed(chosen, GROUP_QUERIES), dim, positives)
    # q and r of score = 100 q + r, so that no product grows past 64 bits
    q, r = F.expr("positive_score div 100"), F.expr("positive_score % 100")
    low, high = percent[0] * q + F.ceil(percent[0] * r / 100), percent[1] * q + F.floor(percent[1] * r / 100)
    of = lambda x, place, none: F.coalesce(F.max(F.when((F.col("place") == place) & (F.col("positive_score") >= 0), x)), F.lit(none)).cast("long")
    places = range(1, positives + 1)
    windows = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array(*[of(low, p, 1) for p in places]).alias("lows"), F.array(*[of(high, p, 0) for p in places]).alias("highs"))
    found = in_windows(blocks, _packed(chosen.join(windows, "vec_id"), GROUP_QUERIES, ("lows", "highs")), dim, positives, negatives)
    found = found.select("anchor_id", (F.col("window") + 1).alias("place"), F.col("place").alias("rank"), "negative_id", "negative_score")
    return near.join(found, ["anchor_id", "place"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
