"""Hard negatives, the Merkle manifest and fingerprints against brute force, and at their edges."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeworks.llm import fingerprint, merkle, negatives, order

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, pos string, grp string, block string, path string, halo string, part int"


def docs(spark, rows):
    """rows: (doc_id, text, source). The other columns clash with names that operators use inside."""
    return spark.createDataFrame([(i, t, None if t is None else "l", s, None if t is None else len(t), "x", "p", "g", "b", "q", "h", 3) for i, t, s in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# places


@pytest.mark.parametrize("group", [[], ["g"]])
def test_numbered(spark, group):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "b", None, ""]), rng.choice([None, *range(30)]), k) for k in range(300)]
    got = order.numbered(spark.createDataFrame(rows, "g string, x long, k long"), group, ["x", "k"]).collect()
    key = lambda v: (v is not None, v)
    for g in {r[0] for r in rows} if group else [None]:
        own = sorted((r for r in rows if not group or r[0] == g), key=lambda r: (key(r[1]), r[2]))
        mine = {r.k: r for r in got if not group or r.g == g}
        assert [mine[k]._pos for _, _, k in own] == list(range(len(own))) and {r._size for r in mine.values()} == {len(own)}
        if group:
            assert {(r._group, r._groups) for r in mine.values()} == {(sorted({r[0] for r in rows}, key=key).index(g), 4)}
    assert order.numbered(spark.createDataFrame([], "g string, x long, k long"), group, ["x"]).count() == 0


# 12 Merkle manifest


def slow_manifest(rows):
    """rows: (doc_id, text, source). A list of results by row, in the order of sources and ids."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, t, s: sha("".join(map(enc, (i, s, None if t is None else "l", None if t is None else len(t), t))))
    low = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)

    def tree(nodes):
        """The root, and of each node the siblings of each level: (left, right)."""
        paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
        while len(level) > 1:
            for k, p in enumerate(paths):
                run = level[at[k] // 16 * 16 :][:16]
                p.append((run[: at[k] % 16], run[at[k] % 16 + 1 :]))
                at[k] //= 16
            level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
        return level[0], paths

    key = lambda v: (v is not None, v if v is None or isinstance(v, int) else v.encode())
    sources = sorted({s for _, _, s in rows}, key=key)
    members = {s: sorted((r for r in rows if r[2] == s), key=lambda r: (key(r[0]), leaf(r[0], r[1], s))) for s in sources}
    # n_chars of a lowered text stays that of the text
    trees = {s: tree([leaf(*r) for r in members[s]]) for s in sources}
    root, outer = tree([trees[s][0] for s in sources])
    out = []
    for s, above in zip(sources, outer):
        for (i, t, _), own in zip(members[s], trees[s][1]):
            path, plain = own + above, leaf(i, t, s)
            node = leaf(i, low(t), s) if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else plain
            for left, right in path:
                node = sha("".join(left) + node + "".join(right))
            out.append((i, plain, trees[s][0], root, sha("".join("".join(a + b) for a, b in path)), node, node == root))
    return out


def manifest(table):
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = merkle.manifest(table, altered={"text": low}, where=F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_manifest(spark):
    rng = random.Random(8)
    rows = [(k, rng.choice(["Some Text", "plain", "É and A", "", None, "x" * 50_000 + "Y"]) and f"T{k % 7}", "hot") for k in range(700)]
    rows += [(1000 + k, f"Doc {k}", f"s{k % 23}") for k in range(60)] + [(2000, None, None), (2001, "A" * 30_000, None), (None, "B", None), (None, "B", "hot"), (5, "again", "hot"), (5, "again", "hot"), (2002, "", ""), ((1 << 62) + 1, "long id", "hot")]
    rng.shuffle(rows)
    got = manifest(docs(spark, rows))
    assert got == sorted(slow_manifest(rows), key=repr)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 16, 17, 257])
def test_manifest_of_few_rows(spark, n):
    rows = [(k, f"Text {k}", "s") for k in range(n)]
    assert manifest(docs(spark, rows)) == (sorted(slow_manifest(rows), key=repr) if n else [])


def test_paths_of_a_manifest_prove_a_leaf(spark):
    rows = docs(spark, [(k, f"t{k}", f"s{k % 3}") for k in range(60)])
    out = merkle.manifest(rows, with_path=True).collect()
    assert all(r.verified and merkle.fold(r.leaf, r.path) == r.root and merkle.digest("".join(r.path)) == r.proof_sha256 for r in out)


# 13 fingerprints


def slow_digest(text):
    counts = [0] * fingerprint.BUCKETS
    data = b"\xff\xff" + text.encode()
    for k in range(len(data) - 2):
        x = int.from_bytes(data[k : k + 3], "big") + 1
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % (1 << 64)
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % (1 << 64)
        counts[(x ^ (x >> 31)) % fingerprint.BUCKETS] += 1
    cuts = [sorted(counts)[len(counts) * q // 4 - 1] for q in (1, 2, 3)]
    codes = [sum(c > cut for cut in cuts) for c in counts]
    size = min(255, round(8 * math.log2(len(text.encode()) + 1)))
    return codes, size, bytes([size]).hex() + "".join(f"{codes[k] * 64 + codes[k + 1] * 16 + codes[k + 2] * 4 + codes[k + 3]:02x}" for k in range(0, len(codes), 4))


def slow_likeness(a, b):
    (x, n, _), (y, m, _) = a, b
    if (n == 0) != (m == 0):
        return 0.0
    most = max(1, min(1.25 * len(x), sum(x) + sum(y)))
    return 1 - min(1.0, sum(abs(p - q) for p, q in zip(x, y)) / most + min(0.5, abs(n - m) / 8 * 0.1))


def slow_fingerprints(rows):
    key = lambda r: (r[0] is not None, r[0], r[1] is not None, (r[1] or "").encode())
    rows, out = sorted(rows, key=key), []
    for k, (i, t, _) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 4
        changed = t[: len(t) - n] + following[:n]
        a, b, c = slow_digest(t), slow_digest(changed), slow_digest(following)
        out.append((i, len(t), sha(changed), a[2], b[2], round(slow_likeness(a, b), 9), round(slow_likeness(a, c), 9)))
    return out


def found(table):
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in fingerprint.edit_likeness(table).collect()), key=repr)


def test_fingerprints(spark, monkeypatch):
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choice(["the", "été", "日本", "🙂", "word", "Über", "of"]) + str(rng.randrange(50)) for _ in range(n))
    rows = [(k * 3, rng.choice([None, "", "a", "ab", say(5), say(60), say(60)]), "s") for k in range(120)]
    rows += [(None, "no id", "s"), (None, None, "s"), (9, "twice", "s"), (9, "twice", "s"), (10_000, say(20_000), "s"), ((1 << 62) + 1, "far", "s")]
    rng.shuffle(rows)
    want = sorted(slow_fingerprints(rows), key=repr)
    assert found(docs(spark, rows)) == want
    monkeypatch.setattr(fingerprint, "RUN_BYTES", 50)
    assert found(docs(spark, rows)) == want
    one = docs(spark, rows).select(fingerprint.fingerprint(F.col("text")).alias("f"), "text").collect()
    assert all(r.f == slow_digest(r.text or "")[2] for r in one)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_fingerprints_of_few_rows(spark, n):
    rows = [(k, "some text " * (k + 1), "s") for k in range(n)]
    assert found(docs(spark, rows)) == (sorted(slow_fingerprints(rows), key=repr) if n else [])
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert found(docs(spark, rows)) == (sorted(slow_fingerprints(rows), key=repr) if n else [])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_likeness_tells_edits_from_others(spark):
    rng = random.Random(2)
    say = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    texts = [say(200) for _ in range(40)]
    a = [slow_digest(t)[2] for t in texts]
    b = [slow_digest(t + " " + say(10))[2] for t in texts]
    table = spark.createDataFrame([(*p, None) for p in zip(a, b)] + [(None, a[0], None), (a[0], a[0], None)], "a string, b string, n string")
    got = [r[0] for r in table.select(fingerprint.likeness(F.col("a"), F.col("b"))).collect()]
    assert min(got[:40]) > 0.7 and got[40] is None and got[41] == 1.0
    others = spark.createDataFrame(list(zip(a, a[1:])), "a string, b string").select(fingerprint.likeness(F.col("a"), F.col("b"))).collect()
    assert max(r[0] for r in others) < min(got[:40])


# 11 hard negatives


def slow_negatives(rows, anchor, positives=5, negatives=10):
    """rows: (vec_id, label, vector)."""
    good = {i: (y, [math.floor(256 * x) for x in v]) for i, y, v in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, (y, v) in good.items():
        if not anchor(i):
            continue
        score = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, (_, w) in good.items() if j != i)
        for p, j in [s for s in score if good[s[1]][0] == y][:positives]:
            fits = [(n, k) for n, k in score if good[k][0] != y and 30 * -p <= 100 * -n <= 90 * -p]
            out += [(i, j, r + 1, k, -p, -n) for r, (n, k) in enumerate(fits[:negatives])]
    return sorted(out)


def mined(table, **how):
    return sorted(tuple(r) for r in negatives.hard_negatives(table, F.col("vec_id") % 10 == 0, **how).collect())


def vectors(seed, n, dim, spread=1.0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(4, dim))
    rows = []
    for k in range(n):
        v = middle[k % 4] + spread * rng.normal(size=dim)
        rows.append((k, int(rng.integers(0, 3)), [float(np.float32(x)) for x in v / np.linalg.norm(v) * rng.uniform(0.2, 3)]))
    return rows


VECTOR = "vec_id long, label int, embedding array<float>, norm string, cell string, block string, grp string, slice string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "g", "s") for r in rows], VECTOR)


@pytest.mark.parametrize(("dim", "spread"), [(8, 1.0), (3, 0.05), (64, 0.5)])
def test_hard_negatives(spark, monkeypatch, dim, spread):
    rows = vectors(dim, 230, dim, spread)
    rows += [(500 + k, 1, rows[7][2]) for k in range(40)] + [(600 + k, k % 3, [0.0] * dim) for k in range(4)] + [(610, 0, [-x for x in rows[3][2]])]
    odd = [(700, None, rows[0][2]), (701, 1, None), (702, 1, [None] * dim), (710, 1, [float("nan")] * dim), (720, 1, [float("inf")] * dim), (730, 1, []), (740, 1, rows[0][2] + [1.0]), (None, 1, rows[0][2]), (750, 1, [1e30] * dim), (7, 1, rows[7][2])]
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 32)
    monkeypatch.setattr(negatives, "GROUP_QUERIES", 5)
    got = mined(table_of(spark, rows + odd))
    best = {i: (v, y) for i, y, v in sorted(rows + [odd[-1]], key=lambda r: (r[2], r[1]), reverse=True)}
    assert got == slow_negatives([(i, y, v) for i, (v, y) in best.items()], lambda i: i % 10 == 0) and len(got) > 100


def test_hard_negatives_of_large_integers_and_few_rows(spark):
    rows = [(k, k % 2, [1000.0 * k + 1, -2e5 * (k % 3) + 7, 3e5]) for k in range(30)]
    big = [(i, y, [x * 10 for x in v]) for i, y, v in rows]
    for some in (rows, big, rows[:1], rows[:2]):
        f32 = [(i, y, [float(np.float32(x)) for x in v]) for i, y, v in some]
        assert mined(table_of(spark, f32)) == slow_negatives(f32, lambda i: i % 10 == 0)
    assert mined(table_of(spark, [])) == []
    # no anchors, one label, windows that nothing fits
    assert mined(table_of(spark, rows[1:9])) == []
    assert mined(table_of(spark, [(i, 1, v) for i, _, v in rows])) == []


def test_bounds_hold(spark):
    rows = vectors(5, 300, 16, 0.3)
    spark_rows, dim = negatives.vectors(table_of(spark, rows), "vec_id", F.col("label"), "embedding")
    packed = negatives._packed(negatives.indexed(spark_rows, 256), 64).collect()
    blocks = [negatives.Block({**r.asDict(), "dim": dim}) for r in packed]
    assert sum(len(b.ids) for b in blocks) == 300
    for a in blocks[:2]:
        for b in blocks:
            low, high = a.bounds_of(b)
            for at in range(0, len(a.ids), 9):
                real = b.exact @ a.exact[at]
                lower, upper = a.bounds(at, b)
                assert (lower <= real).all() and (real <= upper).all() and low[at] <= lower.max() + 1e9 and low[at] <= real.min() and real.max() <= high[at]
