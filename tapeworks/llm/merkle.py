"""A Merkle tree over a table: a leaf for each row, a tree for each source, and one over these.

A tree is worked on in superblocks of 16 * 16 nodes. Upwards each superblock is reduced to its node, until a
source has one; downwards the nodes of a superblock meet the outer siblings of its own node, which they all share,
and get their proofs. So a source with a third of all rows is as many groups as it has superblocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.scratch import stored

from .order import numbered

#: Nodes that make one of the next level, and levels of a superblock.
RUN, LEVELS = 16, 2
BLOCK = RUN**LEVELS
#: The fields of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "grp long, block long, size long, hash string"
_PATHS = "grp long, pos long, path array<string>, subroot string, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values: Sequence[Column]) -> Column:
    """The hash of a row: each value as its UTF-8 byte count, a colon and itself, or a dash if it is null."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def levels_in_block(size: int) -> int:
    """Levels that a superblock of a tree of ``size`` nodes goes up: all of its own, or up to the tree's one node."""
    if size > BLOCK:
        return LEVELS
    n = 0
    while size > 1:
        size, n = -(-size // RUN), n + 1
    return n


def runs(nodes: list[str]) -> list[list[str]]:
    return [nodes[i : i + RUN] for i in range(0, len(nodes), RUN)]


def climb(nodes: list[str], size: int) -> list[list[list[str]]]:
    """The runs of each level of a superblock whose nodes are ``nodes``; the last level's hashes are the superblock's node."""
    out = []
    for _ in range(levels_in_block(size)):
        out.append(runs(nodes))
        nodes = [digest("".join(r)) for r in out[-1]]
    return out


def sides(levels: list[list[list[str]]], at: int) -> list[str]:
    """The siblings of the node at a place of its superblock: of each level those left of it and those right of it, in one text each."""
    out = []
    for level in levels:
        run = level[at // RUN]
        out += ["".join(run[: at % RUN]), "".join(run[at % RUN + 1 :])]
        at //= RUN
    return out


def fold(node: str, path: Sequence[str]) -> str:
    """The root that a node and its siblings (left, right, left, right, ...) make."""
    for left, right in zip(path[::2], path[1::2]):
        node = digest(left + node + right)
    return node


def _reduce(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("pos")
    size, nodes = int(rows["size"].iloc[0]), rows["hash"].tolist()
    for level in climb(nodes, size):
        nodes = [digest("".join(r)) for r in level]
    return pd.DataFrame({"grp": [rows["grp"].iloc[0]], "block": [rows["block"].iloc[0]], "size": [size], "hash": nodes})


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", (BLOCK - 1).bit_length()))


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (grp, pos, size, hash), then the nodes of their superblocks, and so on until each grp has one: the last table's."""
    most = nodes.agg(F.max("size").alias("m")).first()["m"] or 0
    out = [nodes]
    while True:
        up = _blocks(out[-1].select("grp", "pos", "size", "hash")).groupBy("grp", "block").applyInPandas(_reduce, _NODES)
        up = up.select("grp", F.col("block").alias("pos"), F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias("size"), "hash")
        out.append(stored(up, "merkle"))
        if most <= BLOCK:
            return out
        most = -(-most // BLOCK)


def _paths(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Of each node of a superblock its siblings up to the root: those inside, then those of the superblock's node."""
    nodes = nodes.sort_values("pos")
    above, levels = outer.iloc[0], climb(nodes["hash"].tolist(), int(nodes["size"].iloc[0]))
    paths = [[*sides(levels, at), *above["path"]] for at in range(len(nodes))]
    return pd.DataFrame({"grp": nodes["grp"], "pos": nodes["pos"], "path": paths, "subroot": above["subroot"], "root": above["root"]})


def _down(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """Paths of ``nodes`` from the paths of their superblocks."""
    pairs = _blocks(nodes).groupBy("grp", "block").cogroup(outer.groupBy("grp", "pos"))
    return stored(pairs.applyInPandas(_paths, _PATHS), "paths")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, by: str = "source", id_col: str = "doc_id", altered: dict[str, Column] | None = None, where: Column | None = None, with_path: bool = False) -> DataFrame:
    """Each row's id, leaf, its source's subroot, the root, a digest of its proof, and whether the proof holds.

    Leaves of a source ascend by id, equal ids by leaf, nulls first; sources ascend bytewise, null first. Every 16
    nodes make one, the last of a level fewer. proof_sha256 is the hash of the siblings from leaf to root;
    folded_root is what they make of the leaf, or, ``where`` that is true, of the leaf with the columns of ``altered``
    in place of its own, and verified says whether it is the root. with_path adds path: of each level the
    siblings to the left and to the right, as texts.

    Null values are a dash in a leaf; an empty text is "0:". Equal rows are leaves beside each other. Texts of any
    length are hashed where they are read and go no further. An empty table gives no rows. Other columns are not read.
    """
    names = list(dict.fromkeys([id_col, by, *fields]))
    own = {f: F.col(f"`{f}`") for f in names}
    changed = own | (altered or {})
    other = F.when(F.coalesce(where, F.lit(False)), leaf([changed[f] for f in fields])) if where is not None else F.lit(None).cast("string")
    rows = docs.select(own[id_col].alias("doc_id"), own[by].alias("source"), leaf([own[f] for f in fields]).alias("leaf"), other.alias("other"))
    # stored, as ranges are drawn by a sample, for which each text would be hashed once more
    rows = numbered(stored(rows, "leaves"), ["source"], ["doc_id", "leaf"])
    rows = rows.select("doc_id", "leaf", "other", F.col("_group").alias("grp"), F.col("_pos").alias("pos"), F.col("_size").alias("size"), "_groups", F.col("leaf").alias("hash"))
    trees = tiers(rows)
    groups = rows.where("pos = 0").select("grp", F.col("_groups").alias("size"))
    tops = trees[-1].select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("pos"), "hash").join(groups.withColumnRenamed("grp", "pos"), "pos")
    top = tiers(stored(tops.select("grp", "pos", "size", "hash"), "subroots"))
    path = top[-1].select("grp", "pos", F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    for nodes in reversed(top[:-1]):
        path = _down(nodes, path)
    path = path.drop("subroot").join(top[0].select("pos", F.col("hash").alias("subroot")), "pos")
    path = path.select(F.col("pos").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", "subroot", "root")
    for nodes in reversed(trees[1:-1]):
        path = _down(nodes, path)

    def finish(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        """The local reduction of a superblock, its nodes' proofs joined with the outer siblings, and folded."""
        nodes = nodes.sort_values("pos")
        above, levels = outer.iloc[0], climb(nodes["hash"].tolist(), int(nodes["size"].iloc[0]))
        rest = list(above["path"])
        paths = [[*sides(levels, at), *rest] for at in range(len(nodes))]
        others = [o if isinstance(o, str) else h for o, h in zip(nodes["other"], nodes["hash"])]
        out = {
            "doc_id": nodes["doc_id"], "leaf": nodes["hash"], "subroot": above["subroot"], "root": above["root"],
            "proof_sha256": [digest("".join(p)) for p in paths], "folded_root": [fold(h, p) for h, p in zip(others, paths)],
        }
        return pd.DataFrame(out | ({"path": paths} if with_path else {}))

    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string" + ", path array<string>" * with_path
    # as texts, since pandas has no integers beside nulls
    last = _blocks(rows.select("grp", "pos", "size", F.col("doc_id").cast("string"), "hash", "other")).groupBy("grp", "block").cogroup(path.groupBy("grp", "pos"))
    out = last.applyInPandas(finish, schema).withColumn("verified", F.col("folded_root") == F.col("root"))
    return out.select(F.col("doc_id").cast(docs.schema[id_col].dataType).alias(id_col), *out.columns[1:])
