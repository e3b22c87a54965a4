"""Exact Jaccard self-join of word n-gram sets, and its classes.

1. Texts that are equal are one class with its least id as representative.
2. Chunks of representatives ask how many documents hold each shingle (``exchange``). A document of
   which less than 80 % of shingles occur in any other can have no link.
3. Of the others, the rarest 20 % of shingles are keys: two sets that link share one of them. Documents
   that share keys, however indirectly, are a group; links lie inside groups only.
4. A group is compared in tiles, in order of size, so that a document meets those of its size band only.
   A 512-bit or wider signature holds the parity of the shingles on each bit; the bits in which two differ
   are at most the shingles in which they differ, which bounds the overlap from above. What passes is
   settled by the intersection of sorted arrays. Documents known to be of one component aren't compared
   again, so a tile returns a spanning forest and not all its pairs.
5. A group too large for a task is first compared with a few leaders of its own. Documents that are not of
   the component of most others are then compared with those that share a key with them: each set of
   documents that has a key in common is a tile, once, however many keys it shares. Keys of too many
   documents for a tile make blocks, of which those of neighbouring size bands are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .components import components
from tapeworks.functions.scratch import stored
from .words import gram_hashes, mix, trimmed, word_hashes

#: Documents, and bytes of sorted shingle arrays, that one tile may hold; bytes for which there is a task's group of tiles.
TILE_DOCS, TILE_BYTES, SLOT_BYTES = 1000, 16 << 20, 8 << 20
_LEADERS = 8

_SET = "key binary, rep long, n_shingles long, alive boolean, arr binary, keys array<long>"
_LINK = "a long, b long"


def shingle_sets(text: pa.ChunkedArray, n: int) -> list[np.ndarray]:
    """Of each text the sorted set of hashes of n words in a row, or of its whole sequence if it has fewer words."""
    docs, hashes = word_hashes(text, fold=True)
    at, h = gram_hashes(docs, hashes, n)
    words = np.searchsorted(docs, np.arange(len(text) + 1))
    grams = np.searchsorted(docs[at], np.arange(len(text) + 1))
    out = []
    for k in range(len(text)):
        size = words[k + 1] - words[k]
        if 0 < size < n:
            own = slice(words[k], words[k + 1])
            out.append(mix(gram_hashes(docs[own], hashes[own], size)[1] + np.uint64(size)))
        else:
            out.append(np.unique(h[grams[k] : grams[k + 1]]))
    return out


def _sets(docs: pa.Table, known: pa.Table, n: int):
    """The chunk's representatives, their sets, and the sorted hashes of all with the number of sets that hold each."""
    reps = set(zip(known["rep"].to_pylist(), known["key"].to_pylist(), strict=True)) - {(None, None)}
    seen, rows = set(), []
    for k, x in enumerate(zip(docs["doc_id"].to_pylist(), docs["key"].to_pylist(), strict=True)):
        if x in reps and x not in seen:
            seen.add(x)
            rows.append(k)
    docs = docs.take(pa.array(rows, pa.int64()))
    sets = shingle_sets(docs["text"].combine_chunks() if docs.num_rows else pa.array([], pa.string()), n)
    every, count = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_counts=True)
    return docs, sets, every, count


def _ask(n: int, buckets: int):
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        chunk = docs["chunk"][0].as_py() if docs.num_rows else 0
        _, _, every, count = _sets(docs, known, n)
        return X.asked(chunk, every, np.minimum(count, 255), np.ones(len(every), bool), buckets)

    return trimmed(run)


def _keyed(n: int, buckets: int, percent: int):
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        docs, sets, every, _ = _sets(docs, known, n)
        df = X.replies(known, 1, *X.bucket_bounds(every, buckets)[:2])
        alive, arrays, keys = [], [], []
        for s in sets:
            held, least = df[np.searchsorted(every, s)], -(-percent * len(s) // 100)
            alive.append(bool(len(s)) and int((held >= 2).sum()) >= least)
            if alive[-1]:
                first = np.lexsort((s, held))[: len(s) - least + 1]
                keys.append(s[first[held[first] >= 2]].view(np.int64))
                arrays.append(s.astype("<u8").tobytes())
            else:
                keys.append(None)
                arrays.append(None)
        return pa.table({
            "key": docs["key"],
            "rep": docs["doc_id"],
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "alive": pa.array(alive, pa.bool_()),
            "arr": pa.array(arrays, pa.binary()),
            "keys": pa.array(keys, pa.list_(pa.int64())),
        })

    return trimmed(run)


def signatures(sets: list[np.ndarray], width: int) -> np.ndarray:
    """For each set a bitmap of `width` bits: the parity of the hashes that fall on each bit."""
    return np.stack([np.packbits(np.bincount((s % np.uint64(width)).astype(np.int64), minlength=width) & 1).view(np.uint64) for s in sets])


def _forest(ids, sizes, sets, labels, sides, percent: int) -> list[tuple[int, int]]:
    """Links of one tile that join all its linked documents. Rows of side 1 are compared with all, others with those of side 1 only."""
    order = np.lexsort((ids, sizes))
    ids, sizes, labels, sides, sets = ids[order], sizes[order], np.unique(labels[order], return_inverse=True)[1], sides[order], [sets[i] for i in order]
    width = int(min(16384, max(512, 1 << int(2 * sizes[-1] - 1).bit_length())))
    bitmaps, links = signatures(sets, width), []
    for i in range(len(ids) - 1):
        end = int(np.searchsorted(sizes, sizes[i] * 100 // percent, "right"))
        later = np.arange(i + 1, end)
        later = later[(labels[i + 1 : end] != labels[i]) & ((sides[i] == 1) | (sides[i + 1 : end] == 1))]
        if not len(later):
            continue
        both = sizes[later] + sizes[i]
        most = (both - np.bitwise_count(bitmaps[later] ^ bitmaps[i]).sum(1)) // 2
        passed = later[most * (100 + percent) >= percent * both]
        for j in passed:
            if labels[i] == labels[j]:
                continue
            small, large = (sets[i], sets[j])
            at = np.searchsorted(large, small)
            shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            if shared * (100 + percent) >= percent * int(sizes[i] + sizes[j]):
                links.append((int(ids[i]), int(ids[j])))
                labels[labels == labels[j]] = labels[i]
    return links


def _compare(percent: int):
    def run(table: pa.Table) -> pa.Table:
        tiles = np.asarray(table["tile"])
        ids, sizes, labels = (np.asarray(table[c]) for c in ("rep", "n_shingles", "label"))
        sides, raw, links = np.asarray(table["side"]), table["arr"].combine_chunks(), []
        order = np.argsort(tiles, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(tiles[order])) + 1):
            if len(rows) > 1:
                sets = [np.frombuffer(raw[int(i)].as_buffer(), "<u8") for i in rows]
                links += _forest(ids[rows], sizes[rows], sets, labels[rows], sides[rows], percent)
        return pa.table({c: pa.array([x[k] for x in links], pa.int64()) for k, c in enumerate("ab")})

    return trimmed(run)


def _links(tiles: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links of tiles (tile, side, rep), of which small ones are dealt to tasks together. rows: rep, n_shingles, arr, label."""
    tiles = stored(tiles, "tiles")
    size = tiles.join(rows.select("rep", "n_shingles"), "rep").agg(F.sum(8 * F.col("n_shingles")).alias("b")).first()["b"] or 0
    slots = max(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SLOT_BYTES))
    full = tiles.join(rows.select("rep", "n_shingles", "arr", "label"), "rep").withColumn("slot", F.pmod(F.xxhash64("tile"), F.lit(slots)))
    return full.groupBy("slot").applyInArrow(_compare(percent), _LINK)


def _blocks(rows: DataFrame, percent: int) -> DataFrame:
    """(tile, side, rep) that bring each of the rest of a group together with all that are of a near size. rows: comp, rep, n_shingles, rest."""
    sizes = rows.groupBy("comp").agg(F.count("*").alias("docs"), F.sum(8 * F.col("n_shingles")).alias("bytes"))
    parts = F.greatest(F.ceil(2 * F.col("docs") / TILE_DOCS), F.ceil(2 * F.col("bytes") / TILE_BYTES))
    block = F.pmod(F.xxhash64("rep", F.lit(7)), F.greatest(F.lit(1), parts))
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100 / percent))).cast("long")
    rows = stored(rows.join(sizes, "comp").select("comp", "rep", "rest", band.alias("band"), block.alias("block")), "blocks")
    heads = rows.where("rest").select("comp", F.col("band").alias("own"), F.col("block").alias("head")).distinct()
    near = heads.withColumn("band", F.explode(F.array(*[F.col("own") + k for k in (-1, 0, 1)])))
    pairs = near.join(rows.select("comp", "band", "block").distinct(), ["comp", "band"])
    tile = F.xxhash64("comp", "own", "head", "band", "block").alias("tile")
    others = pairs.join(rows, ["comp", "band", "block"]).select(tile, F.lit(0).alias("side"), "rep")
    ahead = rows.where("rest").select("comp", F.col("band").alias("own"), F.col("block").alias("head"), "rep")
    both = pairs.join(ahead, ["comp", "own", "head"]).select(tile, F.lit(1).alias("side"), "rep").unionByName(others)
    return both.groupBy("tile", "rep").agg(F.max("side").alias("side"))


def _shared(rows: DataFrame, percent: int) -> DataFrame:
    """(tile, side, rep) that bring each of the rest of a group together with all that share a key with it. rows: comp, rep, n_shingles, keys, rest, label."""
    keys = stored(rows.select("comp", "rep", "n_shingles", "rest", "label", F.explode("keys").alias("h")), "keys")
    lists = keys.groupBy("h").agg(F.count("*").alias("docs"), F.sum(8 * F.col("n_shingles")).alias("bytes"), F.max("rest").alias("any"), (F.min("label") < F.max("label")).alias("mixed"))
    lists = stored(lists.where("any and mixed"), "lists")
    fits = (F.col("docs") <= TILE_DOCS) & (F.col("bytes") <= TILE_BYTES)
    few = keys.join(lists.where(fits).select("h"), "h").groupBy("h").agg(F.array_sort(F.collect_set("rep")).alias("reps")).select("reps").distinct()
    few = few.select(F.xxhash64("reps").alias("tile"), F.explode("reps").alias("rep")).join(rows.select("rep", "rest"), "rep")
    few = few.select("tile", F.col("rest").cast("int").alias("side"), "rep")
    many = keys.join(lists.where(~fits).select("h"), "h").select("comp", "rep", "n_shingles", "rest").distinct()
    return few.unionByName(_blocks(many, percent))


def _large_groups(rows: DataFrame, percent: int) -> DataFrame:
    """Links inside groups too large for one tile. rows: comp, docs, bytes, rep, n_shingles, arr, keys, label."""
    rows = stored(rows, "large")
    parts = F.greatest(F.ceil(2 * F.col("docs") / TILE_DOCS), F.ceil(2 * F.col("bytes") / TILE_BYTES))
    block = F.pmod(F.xxhash64("rep", F.lit(7)), parts)
    leaders = rows.groupBy("comp", F.pmod(F.xxhash64("rep"), F.lit(_LEADERS)).alias("_")).agg(F.max_by("rep", F.struct(-F.size("keys"), -F.col("rep"))).alias("rep")).select("comp", "rep")
    tile = F.xxhash64("comp", "block").alias("tile")
    blocks = rows.select("comp", block.alias("block")).distinct()
    star = leaders.join(blocks, "comp").select(tile, F.lit(1).alias("side"), "rep")
    rest = rows.select("comp", "rep", block.alias("block")).join(leaders, ["comp", "rep"], "left_anti").select(tile, F.lit(0).alias("side"), "rep")
    first = stored(_links(star.unionByName(rest), rows, percent), "links")
    label = components(first).select(F.col("node").alias("rep"), F.col("component").alias("found"))
    rows = stored(rows.join(label, "rep", "left").withColumn("label", F.coalesce("found", "rep")).drop("found"), "labelled")
    main = rows.groupBy("comp", "label").count().groupBy("comp").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    rest = rows.select("comp", "rep", "n_shingles", "keys", "label").join(main, "comp").withColumn("rest", F.col("label") != F.col("main"))
    return first.unionByName(_links(_shared(rest, percent), rows, percent))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of documents whose sets of n-word shingles link at a Jaccard similarity of percent / 100 or more.

    Returns doc_id, n_shingles, component_id, a row for each row of ``docs``: component_id is the least id
    reachable by links, its own included. Words are runs of characters other than ASCII white space, A-Z
    lower-cased. With fewer than n words the sequence of all is the one shingle; without words or text the
    set is empty and links with nothing. Texts of any length count whole, an empty table gives no rows, and other columns
    are not read, whatever their names. Rows that repeat an id are one document of that component; a row
    with a null id takes no part: its component_id is null, and n_shingles too unless another row has its text.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("key", F.unhex(F.md5("text")))
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    chunks, buckets = X.plan(size)
    # by text too, so that neither null nor repeated ids gather in one chunk
    chunk = F.pmod(F.xxhash64("doc_id", "key"), F.lit(chunks))
    ids = stored(docs.select("doc_id", "key"), "ids")
    reps = stored(ids.groupBy("key").agg(F.min("doc_id").alias("rep")).where("rep is not null"), "reps")
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("tag", "int"), ("bucket", "int"), ("reply", "binary"))]
    known = reps.select(F.pmod(F.xxhash64("rep", "key"), F.lit(chunks)).alias("chunk"), *blank, "rep", "key")
    dealt = docs.withColumn("chunk", chunk).groupBy("chunk")
    asked = dealt.cogroup(known.groupBy("chunk")).applyInArrow(_ask(n, buckets), X.ASKED)
    told = X.told(asked, chunks, 1, False)
    told = told.select("chunk", "tag", "bucket", "reply", F.lit(None).cast("long").alias("rep"), F.lit(None).cast("binary").alias("key"))
    sets = stored(dealt.cogroup(known.unionByName(told).groupBy("chunk")).applyInArrow(_keyed(n, buckets, percent), _SET), "sets")

    alive = sets.where("alive")
    keys = alive.select("rep", F.explode("keys").alias("h"))
    leaders = keys.groupBy("h").agg(F.min("rep").alias("lead"), F.count("*").alias("c")).where("c > 1")
    near = keys.join(leaders, "h").select(F.col("rep").alias("a"), F.col("lead").alias("b")).distinct()
    groups = components(near).select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    rows = stored(alive.join(groups, "rep").withColumn("label", F.col("rep")).drop("alive", "key"), "grouped")
    sizes = rows.groupBy("comp").agg(F.count("*").alias("docs"), F.sum(8 * F.col("n_shingles")).alias("bytes"))
    sizes = stored(sizes.where("docs > 1"), "sizes")
    small, large = f"docs <= {TILE_DOCS} and bytes <= {TILE_BYTES}", f"docs > {TILE_DOCS} or bytes > {TILE_BYTES}"
    tiles = rows.join(sizes.where(small), "comp").select(F.col("comp").alias("tile"), F.lit(1).alias("side"), "rep")
    links = _links(tiles, rows, percent)
    if not sizes.where(large).isEmpty():
        links = links.unionByName(_large_groups(rows.join(sizes.where(large), "comp"), percent))
    found = components(links).select(F.col("node").alias("rep"), F.col("component").alias("found"))
    classes = sets.select("key", "rep", "n_shingles").join(found, "rep", "left")
    # stored, so that what joins is two plain shuffles, of which a class with a third of all rows can be split
    classes = stored(classes.groupBy("key").agg(F.first("n_shingles").alias("n_shingles"), F.min(F.coalesce("found", "rep")).alias("found")), "classes")
    return ids.join(classes, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("found")).otherwise(F.col("doc_id"))).alias("component_id"),
    )
