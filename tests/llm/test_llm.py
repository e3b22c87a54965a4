"""Each operator against a brute-force version or an exact round trip, and at its edges."""

import collections
import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeworks.llm import chat, components, decontaminate, exchange, jaccard, langid, lines, packing, quality, substring, token_counts, token_files, words
from tapeworks.llm.registry import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, key string, chunk string, rep string, words string"
SPACES = st.sampled_from([" ", "\n", "\t", "\x0b", "\x0c", "\r", " ", "\x85", "  "])


def split(text):
    return (text or "").encode().split()


def docs(spark, rows, source="s"):
    """rows: (doc_id, text). The other columns clash with names that operators use inside."""
    return spark.createDataFrame([(i, t, None, source, None, "x", "y", "z", "r", "w") for i, t in rows], SCHEMA)


def corpus(seed=1, n=60):
    """Texts with shared passages, copies, near copies, nulls, blanks and one long text."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["Über", "été,", "日本", "A", "a", "B.", "🙂"]
    say = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, base = say(60), say(120)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one two three"), (4, "ONE Two  three"), (5, " ".join(passage)), (6, " ".join(say(20_000)))]
    for k in range(7, n):
        kind = k % 6
        if kind == 0:
            text = say(40) + passage[: rng.randrange(10, 60)] + say(30)
        elif kind == 1:
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = "new%d" % k
        elif kind == 2:
            text = base + say(rng.randrange(0, 40))
        elif kind == 3:
            text = say(rng.randrange(1, 8))
        elif kind == 4:
            text = say(15) * 3
        else:
            text = say(rng.randrange(50, 90))
        rows.append((k, rng.choice([" ", "\n", "  "]).join(text)))
    rows.append((n, rows[5][1]))
    rng.shuffle(rows)
    return rows


@given(st.lists(st.none() | st.lists(st.text(max_size=4) | SPACES, max_size=12).map("".join), max_size=6))
@settings(max_examples=150, deadline=None)
def test_word_hashes_find_the_words(texts):
    at, h = words.word_hashes(pa.array(texts, pa.string()))
    want = [(k, w) for k, t in enumerate(texts) for w in split(t)]
    assert at.tolist() == [k for k, _ in want]
    assert len(set(zip(h.tolist(), [w for _, w in want], strict=True))) == len(set(h.tolist())) == len({w for _, w in want})


def test_word_hashes_across_slices():
    text = ["ab " * 700_000, None, "x" * 1_200_000 + " ab", "ab"]
    at, h = words.word_hashes(pa.array(text).slice(0))
    assert np.bincount(at, minlength=4).tolist() == [700_000, 0, 2, 1]
    assert h[0] == h[699_999] == h[-1] == h[-2]
    assert words.word_hashes(pa.array(["AB Ç"]), fold=True)[1].tolist() == words.word_hashes(pa.array(["ab Ç"]))[1].tolist()


def test_exchange_packs_exactly():
    h = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64) * 2)
    for buckets in (1, 7, 1 << 20):
        full, bounds, vals = exchange.bucket_bounds(h, buckets)
        assert bounds[0] == 0 and bounds[-1] == len(h) and full.tolist() == sorted(set(full.tolist()))
        assert [int(x) * buckets >> 64 for x in h] == np.repeat(full, np.diff(bounds)).tolist()
        assert [(int(x) * buckets >> 32) & 0xFFFFFFFF for x in h] == vals.tolist()
        cells = pa.chunked_array([exchange.packed(vals, bounds).slice(k, 3) for k in range(0, len(full), 3)])
        got, ends = exchange.unpacked(cells)
        assert (got == vals).all() and (ends == bounds).all()
        wide = exchange.from_planes(exchange.planes(h, bounds), "<u8")
        assert (wide[0] == h).all() and (wide[1] == bounds).all()
    assert sorted(np.concatenate(list(exchange.parts(h))).tolist()) == list(range(len(h)))
    empty = np.zeros(0, np.uint64)
    assert exchange.asked(1, empty, empty, empty, 5).num_rows == 0 and list(exchange.parts(empty)) == []


def test_buckets_answer_every_chunk():
    rng = np.random.default_rng(2)
    chunks = [np.unique(words.mix(rng.integers(0, 300, 200).astype(np.uint64))) for _ in range(5)]
    weights, flags = [rng.integers(1, 4, len(h)) for h in chunks], [rng.integers(0, 2, len(h)).astype(bool) for h in chunks]
    asked = pa.concat_tables([exchange.asked(k, h, w, f, 6) for k, (h, w, f) in enumerate(zip(chunks, weights, flags, strict=True))])
    total, flagged = collections.Counter(), set()
    for h, w, f in zip(chunks, weights, flags, strict=True):
        total.update(dict(zip(h.tolist(), w.tolist(), strict=True)))
        flagged |= set(h[f].tolist())
    for as_bits in (False, True):
        told = pa.concat_tables([exchange.answered(4, as_bits)(asked.filter(pa.compute.equal(asked["bucket"], b))) for b in range(6)])
        other = told.set_column(1, "tag", pa.array([9] * told.num_rows, pa.int32()))
        for k, h in enumerate(chunks):
            own = pa.concat_tables([other, told]).filter(pa.compute.equal(pa.concat_tables([other, told])["chunk"], k))
            want = [total[x] * (x in flagged) for x in h.tolist()]
            assert exchange.replies(own, 4, *exchange.bucket_bounds(h, 6)[:2]).tolist() == [int(x >= 2) if as_bits else x for x in want]


def test_a_passage_in_every_chunk_meets_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(exchange, "GROUP_CHUNKS", 50)
    h = np.sort(words.mix(np.arange(40, dtype=np.uint64)))
    asked = pa.concat_tables([exchange.asked(k, np.unique(np.r_[h, words.mix(np.array([1000 + k], np.uint64))]), np.ones(41, np.uint8), np.ones(41, bool), 3) for k in range(1000)])
    rows = spark.createDataFrame(asked.to_pandas(), exchange.ASKED)
    assert rows.groupBy("bucket").count().agg(F.min("count")).first()[0] == 1000
    assert rows.groupBy("bucket", F.pmod("chunk", F.lit(exchange.salts(1000)))).count().agg(F.max("count")).first()[0] <= 50
    got = exchange.told(rows, 1000, 4, False).toPandas()
    for k in (0, 499, 999):
        own = np.unique(np.r_[h, words.mix(np.array([1000 + k], np.uint64))])
        some = pa.Table.from_pandas(got[got["chunk"] == k], preserve_index=False)
        some = some.set_column(1, "tag", some["tag"].cast(pa.int32())).set_column(3, "reply", some["reply"].cast(pa.binary()))
        assert exchange.replies(some, 4, *exchange.bucket_bounds(own, 3)[:2]).tolist() == [255 if x in h else 1 for x in own]


# 1 token counts


def test_scores_of_a_file(tmp_path):
    path = tmp_path / "scores.tsv"
    path.write_text("▁a\t-1.0\nb\t-1.5\n▁ab\t-4.0\n")
    pieces = token_counts.Pieces(tokenizer_file("piece_bpe_32k.model"), str(path))
    # two likely pieces beat an unlikely one, and a character without a piece is a byte
    assert pieces.longest == 3 and token_counts.trie_counts(["▁ab", "▁a", "▁abz"], pieces) == [2, 1, 3]


@pytest.fixture(scope="module")
def pieces():
    return token_counts.Pieces(tokenizer_file("piece_bpe_32k.model"))


def slow_best(word, pieces):
    """The greatest score over all segmentations, by recursion over the last piece, and its tokens."""
    memo = {0: (0, 0)}
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        options = [(memo[end - 1][0] + n * pieces.byte_score, memo[end - 1][1] + n)]
        options += [(memo[s][0] + pieces.score[word[s:end]], memo[s][1] + 1) for s in range(end) if word[s:end] in pieces.score]
        memo[end] = max(options, key=lambda x: x[0])
    return memo[len(word)][1]


@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), min_size=1, max_size=20) | st.sampled_from(["▁the", "▁understanding", "▁überall", "▁日本語🙂", "aaaa", "▁\x00"]), min_size=1, max_size=20, unique=True))
@settings(max_examples=60, deadline=None)
def test_trie_counts_equal_brute_force(pieces, some):
    want = [slow_best(w, pieces) for w in some]
    assert token_counts.trie_counts(some, pieces) == want == [token_counts.best_count(w, pieces) for w in some]


def test_token_counts(spark, pieces, monkeypatch):
    rows = corpus() + [(900, "x" * 5000 + " end"), (901, "a\x00 b")]
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in token_counts.token_counts(docs(spark, rows), tokenizer_file("piece_bpe_32k.model")).collect()}
    assert got == {i: (len(split(t)), sum(token_counts.best_count("▁" + w.decode(), pieces) for w in split(t))) for i, t in rows}
    assert token_counts.token_counts(docs(spark, []), tokenizer_file("piece_bpe_32k.model")).count() == 0


def test_long_pretokens_share_tries(pieces, monkeypatch):
    rng = random.Random(2)
    some = sorted({"".join(rng.choice("ab日本語é") for _ in range(rng.choice([3, 70, 300]))) for _ in range(60)})
    monkeypatch.setattr(token_counts, "TRIE_CELLS", 500)
    monkeypatch.setattr(token_counts, "TRIE_CHARS", 200)
    groups = list(token_counts.tries(some))
    assert sorted(i for g in groups for i in g) == [i for i, w in enumerate(some) if len(w) <= 200] and len(groups) > 3
    for g in groups:
        assert token_counts.trie_counts([some[i] for i in g], pieces) == [token_counts.best_count(some[i], pieces) for i in g]


# 2 quality


def test_quality(spark):
    text = {1: "the cat sat on the mat and the cat sat on the mat and #1 | x\nline\nline\n \n", 2: None, 3: "", 4: "a b c d e " * 30, 5: "plain words of the text in a row that is fine to keep and has no repeat at all"}
    got = {r.doc_id: r for r in quality.quality(docs(spark, text.items())).collect()}

    def repeated(w):
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        n = collections.Counter(grams)
        return len({p + k for p, g in enumerate(grams) if n[g] > 1 for k in range(5)})

    for i, t in list(text.items()) + []:
        w, r = split(t), got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(len(x.decode()) for x in w), repeated(w))
    assert (got[1].n_symbols, got[1].n_dup_lines) == (2, 1)
    assert got[2].base_failed and not got[2].kept and got[4].base_failed and got[5].kept
    assert quality.quality(docs(spark, [(5, text[5])]), rules=[("n_words", 99, None)]).first().kept is False
    assert quality.quality(docs(spark, [(5, text[5])]), stop_words=["und"]).first().kept is False
    rows = corpus()
    got = {r.doc_id: r.n_repeat_words for r in quality.quality(docs(spark, rows)).collect()}
    assert got == {i: repeated(split(t)) for i, t in rows}
    assert quality.quality(docs(spark, [])).count() == 0


# 3 language identification


def slow_kneser_ney(texts):
    """Probabilities of a character after a context, from dictionaries."""
    counts = [collections.Counter() for _ in range(langid.ORDER)]
    for w in texts:
        s = "\x02" + w + "\x03"
        for i in range(1, len(s)):
            for n in range(1, min(langid.ORDER, i + 1) + 1):
                counts[n - 1][s[i - n + 1 : i + 1]] += 1
    for n in range(langid.ORDER - 1):
        left = collections.Counter(g[1:] for g in counts[n + 1])
        counts[n] = {g: c if g[0] == "\x02" and n else left.get(g, 0) for g, c in counts[n].items()}
    tables = []
    for table in counts:
        ones, twos = (sum(c == k for c in table.values()) for k in (1, 2))
        total, kinds = collections.Counter(), collections.Counter()
        for g, c in table.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += c > 0
        tables.append((table, min(0.95, max(0.05, ones / max(1, ones + 2 * twos))), total, kinds))
    symbols = len({c for w in texts for c in w}) + 2

    def p(context, c):
        if context is None:
            return 1 / symbols
        table, d, total, kinds = tables[len(context)]
        lower = p(context[1:] if context else None, c)
        if not total[context]:
            return lower
        return max(table.get(context + c, 0) - d, 0) / total[context] + d * kinds[context] / total[context] * lower

    def word(w):
        s = "\x02" + w + "\x03"
        return sum(np.log(p(s[max(0, i - langid.ORDER + 1) : i], s[i])) for i in range(1, len(s)))

    return word


def test_model_equals_dictionaries():
    import pandas as pd

    a, b = ["the", "then", "this", "that", "the", "other", "he"], ["der", "die", "das", "den", "dem", "der", "über"]
    rows = pd.concat([pd.DataFrame({"lang": lang, "word": list(c), "n": list(c.values())}) for lang, c in (("a", collections.Counter(a)), ("b", collections.Counter(b)))])
    model = langid.fit(rows, ["a", "b"])
    model.base[:] = 0
    symbols = [len({c for w in x for c in w}) + 2 for x in (a, b)]
    model.base[:] = [1 / s for s in symbols]
    probe = ["the", "den", "zzz", "x", "thatother", "überder"]
    got = model.words(probe)
    want = np.array([[slow_kneser_ney(a)(w), slow_kneser_ney(b)(w)] for w in probe])
    assert np.allclose(got, want, rtol=1e-4)


def test_language_of_held_out_texts(spark):
    rng = random.Random(3)
    speak = {"en": ["the", "and", "thing", "with", "house", "ing", "ought"], "de": ["der", "und", "schloss", "über", "nicht", "ung", "zeit"]}
    rows = [(i, "".join(rng.choice(speak[lang]) + rng.choice(["", " "]) for _ in range(40)), lang) for i in range(200) for lang in [("en", "de")[i % 2]]]
    table = spark.createDataFrame([(i, t, lang) for i, t, lang in rows] + [(900, None, "en"), (901, "123 !!", "de"), (902, "the house", None)], "doc_id long, text string, lang string")
    model = langid.train(table.where("doc_id < 100 or doc_id >= 900"))
    got = {r.doc_id: r.language for r in langid.predict(table, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert all(0.5 <= got[i].score <= 1 for i, _, _ in rows) and not any(got[i].rejected for i in range(100))
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[900].score == 0 and got[900].rejected
    odd = spark.createDataFrame([(1, "qxqzj kkwxv vvjq " * 9)], "doc_id long, text string")
    assert langid.predict(odd, model).first().language.rejected
    empty = langid.train(table.where("false"))
    assert {r.language.lang_pred for r in langid.predict(table, empty).collect()} == {"und"}


def test_models_are_learned_from_bounded_bytes_and_shipped_by_file(spark, monkeypatch):
    texts = {"x": "abc cab bca ", "y": "xyz zyx yzx "}
    rows = [(k, texts[lang] * 5, lang) for k in range(40) for lang in texts] + [(99, texts["x"] * 10_000, "x"), (100, "mno " * 10_000, "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 1000)
    whole = {r.doc_id: r.language.lang_pred for r in langid.predict(table, langid.train(table)).collect() if r.doc_id > 40}
    assert whole[99] == "x" and langid.train(table).languages == ["x", "y"]
    models = langid.train(table)
    said = [r.language for r in langid.predict(table, models).orderBy("doc_id", "lang").collect()]
    monkeypatch.setattr(langid, "MODEL_BYTES", 0)
    assert [r.language for r in langid.predict(table, models).orderBy("doc_id", "lang").collect()] == said
    assert langid.predict(table.where("false"), models).count() == 0


def test_languages_in_several_tables_and_repeated_rows(spark, monkeypatch):
    """More languages than a table holds score as one table does; rows of one id are drawn as rows, and an id doesn't matter."""
    rng = random.Random(6)
    speak = {f"l{k}": [f"{a}{b}{a}" for a in "aeiou" for b in "bcdfg"[k : k + 2] or "xyz"[k % 3]] for k in range(5)}
    rows = [(None if i % 9 == 0 else i % 40, " ".join(rng.choice(speak[f"l{i % 5}"]) for _ in range(30)), f"l{i % 5}", "x", "y") for i in range(150)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, language string, place string")
    one = langid.train(table)
    monkeypatch.setattr(langid, "LANGUAGES_AT_ONCE", 2)
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 1000)
    several = langid.train(table)
    assert len(one.tables) == 1 and len(several.tables) == 3 and one.languages == several.languages == sorted(speak)
    words = ["aba", "ede", "zzz", "ufu"]
    assert np.allclose(one.words(words)[:, :2], several.words(words)[:, :2], rtol=0.2)
    out = langid.predict(table, several)
    assert out.columns == table.columns and out.where("not language.rejected").count() > 100
    assert all(r.language.lang_pred == r.lang for r in out.collect())


# 4 decontamination


def test_contained_items(spark, monkeypatch):
    rng = random.Random(5)
    say = lambda k: [f"v{rng.randrange(500)}" for _ in range(k)]
    items = [(k, say(rng.choice([5, 9, 14, 40, 60]))) for k in range(12)] + [(12, ["short", "one"]), (13, []), (14, say(30) * 2)]
    rows = []
    for k in range(60):
        own = say(rng.choice([30, 200, 3000]))
        i = rng.choice(items)[1]
        part = i[: max(1, int(len(i) * rng.choice([0.5, 0.8, 0.9, 1.0])))] if k % 3 else [w.upper() for w in i]
        at = rng.randrange(len(own))
        rows.append((k, " ".join(own[:at] + part + own[at:])))
    rows += [(100, "Short\tONE"), (101, "short one more"), (102, None), (103, ""), (None, " ".join(items[3][1])), (7, " ".join(items[2][1]))]

    def grams(w, n):
        return {tuple(w[p : p + n]) for p in range(len(w) - n + 1)} if n else set()

    want = {}
    for i, t in rows:
        own = [w.decode().lower() for w in split(t)]
        for j, w in items:
            n = min(5, len(w))
            have, need = grams(own, n), grams(w, n)
            if i is not None and need and len(have & need) * 100 >= 80 * len(need):
                want[i, j] = max(want.get((i, j), (0, 0)), (len(have & need), len(need)))
    table = spark.createDataFrame([(j, " ".join(w), "x") for j, w in items] + [(20, None, "x"), (None, "a b c d e f", "x")], "item_id long, text string, doc_id string")
    for limit in (1 << 26, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
        got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in decontaminate.contained_items(docs(spark, rows), table).collect()}
        assert got == want
    # an item shorter than a shingle is found inside a text too
    assert (100, 12) in want and (101, 12) in want
    twice = spark.createDataFrame([(1, " ".join(items[3][1]), "x"), (1, "v1 v2 v3", "x")], "item_id long, text string, doc_id string")
    odd = docs(spark, [(1, "a v1 V2 v3 b"), (1, "v1 v2 v3"), (2, " ".join(items[3][1]) * 2000)]).withColumn("words", F.lit("w")).withColumn("item_id", F.lit(9)).withColumn("h", F.lit("h")).withColumn("row", F.lit("r"))
    assert {(r.doc_id, r.item_id, r.n_shared) for r in decontaminate.contained_items(odd, twice).collect()} >= {(1, 1, 1)}
    assert decontaminate.contained_items(docs(spark, []), table).count() == 0
    assert decontaminate.contained_items(docs(spark, rows), table.where("false")).count() == 0


# 5 preference formatting


def test_preference_segments(spark):
    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "a"), (0, 2, "user", "more"), (1, 0, "user", "hi"), (1, 1, "assistant", "b"), (2, 0, "user", "same"), (2, 1, "assistant", "x"), (3, 0, "user", "same"), (3, 1, "assistant", "x"), (3, 2, "user", "on"), (4, 0, "user", None), (8, 0, "system", "s"), (8, 0, "user", "u"), (9, 0, "user", "u"), (9, 0, "system", "s"), (9, 1, None, "t"), (None, 0, "user", "x"), (5, None, "user", "x")]
    table = spark.createDataFrame([(*t, "c") for t in turns], "conv_id long, turn long, role string, text string, part string")
    got = sorted(tuple(r) for r in chat.preference_segments(table, chat.adjacent_pairs(table)).collect())
    seg = lambda r, t: f"<|im_start|>{r}\n{t}<|im_end|>\n"
    want = [(0, "prompt", 0, "user", "hi", False), (0, "chosen", 1, "assistant", "a", True), (0, "chosen", 2, "user", "more", False), (0, "rejected", 1, "assistant", "b", True), (1, "prompt", 0, "user", "same", False), (1, "prompt", 1, "assistant", "x", False), (1, "rejected", 2, "user", "on", False), (2, "chosen", 0, "user", "", False), (4, "prompt", 0, "system", "s", False), (4, "prompt", 0, "user", "u", False), (4, "rejected", 1, "", "t", False)]
    assert got == sorted((p, part, k, r, seg(r, t), m) for p, part, k, r, t, m in want)
    assert chat.preference_segments(table.where("false"), chat.adjacent_pairs(table.where("false"))).count() == 0
    whole = {r.pair_id: r for r in chat.preference_rows(table, chat.adjacent_pairs(table)).collect()}
    assert set(whole) == {0, 1, 2, 4}
    for k, r in whole.items():
        for part in ("prompt", "chosen", "rejected"):
            assert getattr(r, part) == "".join(seg(role, t) for p, x, _, role, t, _ in want if p == k and x == part)
        for part in ("chosen", "rejected"):
            spans = [tuple(map(int, s.split("-"))) for s in getattr(r, f"{part}_mask").split()]
            assert [getattr(r, part)[a:b] for a, b in spans] == [f"{t}<|im_end|>" for p, x, _, _, t, m in want if p == k and x == part and m]
    assert chat.preference_rows(table.where("false"), chat.adjacent_pairs(table)).count() == 0


def test_answer_swaps(spark):
    turns = [(4, 0, "user", "hi"), (4, 1, "assistant", "a"), (4, 2, "user", "on"), (5, 0, "system", None), (5, 1, "user", "hi"), (5, 2, "assistant", "b"), (6, 0, "user", "x"), (6, 1, "assistant", "y"), (7, 0, "user", "no answer"), (None, 0, "assistant", "x"), (4, None, "assistant", "x")]
    table = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, last int")
    got = chat.answer_swaps(table).collect()
    want = [(8, 0, "user", "hi"), (8, 1, "assistant", "a"), (9, 0, "user", "hi"), (9, 1, "assistant", "b"), (10, 0, "system", None), (10, 1, "user", "hi"), (10, 2, "assistant", "b"), (11, 0, "system", None), (11, 1, "user", "hi"), (11, 2, "assistant", "a"), (12, 0, "user", "x"), (12, 1, "assistant", "y"), (13, 0, "user", "x")]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# 6 token files


@given(st.integers(1, 32).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, (1 << b) - 1), max_size=300))))
@settings(max_examples=150, deadline=None)
def test_packing_is_exact(case):
    bits, ids = case
    data = token_files.pack(np.array(ids, np.uint32), bits)
    assert token_files.unpack(data, len(ids), bits).tolist() == ids and len(data) == -(-len(ids) // 64) * 8 * bits


@given(st.lists(st.text(max_size=12) | SPACES | st.sampled_from(["Don't", "<|endoftext|>", "ΣΑΣ.", "İstanbul,", "ß..", "éx", "a.,b", "I'LL"]), max_size=12).map("".join))
@settings(max_examples=150, deadline=None)
def test_chunks_encode_as_whole_texts_do(text):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    text = text.encode("utf-8", "ignore").decode()
    assert token_files.Encoder(path).encode(text).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_token_files(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    rows = corpus() + [(500, "again"), (500, "again"), (None, "none")]
    manifest = token_files.write_token_files(docs(spark, rows), f"file://{tmp_path}/ids", tokenizer_file("word_bpe_49k.json"))
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(manifest).collect()), key=lambda r: r[1])
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    from pyarrow import fs

    path = manifest.orderBy(F.desc("n_ids")).first()["path"]
    reader = token_files.Reader(fs.FileSystem.from_uri(path)[0].open_input_file(fs.FileSystem.from_uri(path)[1]))
    everything = reader.read(0, len(reader.doc_ids))
    k = len(reader.doc_ids) // 2
    assert (reader.read(k, k + 1) == everything[reader.starts[k] : reader.starts[k + 1]]).all()
    empty = token_files.write_token_files(docs(spark, []), f"file://{tmp_path}/none", tokenizer_file("word_bpe_49k.json"))
    assert token_files.read_token_files(empty).count() == 0


def test_other_tokenizers_get_whole_texts(spark, tmp_path, monkeypatch):
    """A vocabulary whose tokens hold white space isn't cut; long texts of one that may be cut give the same ids in runs."""
    from tokenizers import Tokenizer

    for name, cuts in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        path = tokenizer_file(name)
        tokenizer = Tokenizer.from_file(path)
        assert token_files.Encoder(path).by_chunk is cuts
        monkeypatch.setattr(token_files, "RUN_CHARS", 500)
        rows = corpus(11, 30)[:30] + [(800, "a  b\n c"), (801, " x" * 2000), (802, None)]
        written = list(token_files.runs(iter(rows), cuts))
        assert any(goes_on for _, _, goes_on in written) is cuts and sorted({i for own, _, _ in written for i in own}) == sorted(i for i, _ in rows)
        manifest = token_files.write_token_files(docs(spark, rows), f"file://{tmp_path}/{name}", path)
        got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(manifest).collect()}
        want = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
        assert got == {i: (len(w), zlib.crc32(w.tobytes())) for i, w in want.items()}


def test_an_encoder_that_forgets_still_encodes(monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    monkeypatch.setattr(token_files, "KEPT_CHUNKS", 20)
    encoder, tokenizer = token_files.Encoder(path), Tokenizer.from_file(path)
    for i, t in corpus(12, 40):
        assert encoder.encode(t or "").tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, i


def test_reader_crosses_blocks(tmp_path):
    from pyarrow import fs

    local, path = fs.LocalFileSystem(), str(tmp_path / "f.ids")
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 49408, n).astype(np.uint32) for n in (10, 200_000, 0, 5, 70_000)]
    with local.open_output_stream(path) as sink:
        writer = token_files.Writer(sink, 16)
        for k, p in enumerate(parts):
            writer.add(k, p)
        writer.close()
    reader = token_files.Reader(local.open_input_file(path))
    for a in range(5):
        for b in range(a, 6):
            assert (reader.read(a, b) == np.concatenate([np.zeros(0, np.uint32), *parts[a:b]])).all()


# 7 substring deduplication


def slow_repeats(rows, window):
    first = {}
    for i, t in rows:
        w = split(t)
        for p in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        out.append((-1 if i is None else i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("window", [13, 5])
def test_remove_repeats(spark, monkeypatch, window):
    rows = corpus(2) + [(5, "other text of a repeated id " * 4), (30, "q " * 30), (31, "q " * 14), (None, "q " * 20)]
    for size, group in ((1 << 23, 1 << 16), (3000, 1 << 16), (3000, 7)):
        monkeypatch.setattr(exchange, "CHUNK_BYTES", size)
        monkeypatch.setattr(exchange, "BUCKET_BYTES", 3 * size)
        monkeypatch.setattr(exchange, "GROUP_CHUNKS", group)
        got = substring.remove_repeats(docs(spark, rows), window).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == slow_repeats(rows, window)
    assert substring.remove_repeats(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        substring.remove_repeats(docs(spark, rows), 12)


# 8 line deduplication


def test_drop_boilerplate(spark, monkeypatch):
    rng = random.Random(4)
    rows = []
    for k in range(120):
        body = [f"line {rng.randrange(5000)}" for _ in range(rng.randrange(0, 6))]
        body += ["footer "] * (k % 3 == 0) + ["seldom"] * (k % 40 == 0) + [""] * (k % 2) + ["footer"] * (k % 9 == 0)
        rng.shuffle(body)
        rows.append((k, "\n".join(body), ["a", "b", None][k % 3] if k % 4 else "a"))
    rows += [(200, None, "a"), (201, "", "a"), (201, "footer", "a")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, drops string")
    pages = collections.Counter(s for _, _, s in rows)
    seen = collections.Counter((s, x) for _, t, s in rows for x in {x.strip(" ") for x in (t or "").split("\n")} - {""})
    bad = {k for k, n in seen.items() if k[0] is not None and n >= 2 and n > 0.1 * pages[k[0]]}
    want = []
    for i, t, s in rows:
        stay = None if t is None else [x for x in t.split("\n") if (s, x.strip(" ")) not in bad]
        n = 0 if t is None else len(t.split("\n"))
        want.append((i, None if t is None else "\n".join(stay), n, 0 if t is None else n - len(stay)))
    for limit in (1 << 26, -1):
        monkeypatch.setattr(lines, "BROADCAST_BYTES", limit)
        out = lines.drop_boilerplate(table, ratio=0.1)
        assert out.columns == [*table.columns, "n_lines", "n_dropped"]
        assert sorted((r.doc_id, str(r.text), r.n_lines, r.n_dropped) for r in out.collect()) == sorted((i, str(t), a, b) for i, t, a, b in want)
    assert sum(w[3] for w in want) > 10
    assert lines.drop_boilerplate(table.where("false")).count() == 0
    # the ratio alone decides in a small site too; one page repeats nothing
    few = spark.createDataFrame([(1, "all\none", "s"), (2, "all\ntwo", "s"), (3, "all", "s"), (4, "all\nalone", "t")], "doc_id long, text string, source string")
    assert {r.doc_id: r.text for r in lines.drop_boilerplate(few).collect()} == {1: "one", 2: "two", 3: "", 4: "all\nalone"}


def test_no_column_name_clashes_with_line_dedup(spark):
    names = "_text _lines _stay _host _drops drops host lines row stay n line pages c0 c1 n_lines n_dropped".split()
    rows = [(k, f"own {k}\nfooter", "s", *["kept"] * len(names), "dot") for k in range(20)]
    table = spark.createDataFrame(rows, ["doc_id", "text", "source", *names, "a.b`c"])
    for limit in (1 << 26, -1):
        out = lines.drop_boilerplate(table)
        assert out.columns == [*[c for c in table.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped"]
        assert {tuple(r) for r in out.collect()} == {(k, f"own {k}", "s", *["kept"] * (len(names) - 2), "dot", 2, 1) for k in range(20)}


def test_copies_of_a_document_do_not_drop_its_lines(spark):
    import corpus_pipeline

    words = lambda k, j: " ".join(f"w{k}x{j}x{i}" for i in range(9))
    rows = [(k, f"{words(k, 0)}\nfooter\n{words(k, 1)}", "a") for k in range(30)]
    rows += [(100 + k, f"{words(99, 0)}\nfooter\n{words(99, 1)}" + " \n" * (k % 2), "a") for k in range(20)]
    rows += [(200 + k, f"{words(98, 0)}\n{words(98, 1)}", "b") for k in range(6)] + [(300, None, "a"), (301, "footer", "a")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text").cast("long"))
    after = corpus_pipeline.line_dedup(spark, table, "")
    got = {r.doc_id: r.text for r in after.collect()}
    assert got == {i: t if t is None else "\n".join(x for x in t.split("\n") if x != "footer") for i, t, _ in rows}
    kept = corpus_pipeline.near_duplicates(spark, after, "")
    assert sorted(r.doc_id for r in kept.collect()) == [*range(30), 100, 200, 300, 301]


# 9 Jaccard join


def slow_components(rows):
    sets, parent = {}, {}
    for i, t in rows:
        w = [x.lower() for x in split(t)]
        sets.setdefault(i, []).append({tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, ss in sets.items() for s in ss if s and i is not None]
    for k, (i, a) in enumerate(flat):
        for j, b in flat[:k]:
            if len(a & b) * 100 >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: ([len(s) for s in ss], find(i)) for i, ss in sets.items()}


def test_near_duplicates(spark, monkeypatch):
    rows = corpus(7, 90)
    want = slow_components(rows)
    assert len({c for _, c in want.values()}) < len(want) - 20
    for docs_in_tile, size, group in ((2000, 1 << 23, 1 << 16), (4, 4000, 1 << 16), (4, 4000, 6)):
        monkeypatch.setattr(jaccard, "TILE_DOCS", docs_in_tile)
        monkeypatch.setattr(exchange, "GROUP_CHUNKS", group)
        monkeypatch.setattr(exchange, "CHUNK_BYTES", size)
        monkeypatch.setattr(exchange, "BUCKET_BYTES", 2 * size)
        got = {r.doc_id: ([r.n_shingles], r.component_id) for r in jaccard.near_duplicates(docs(spark, rows)).collect()}
        assert got == want
    odd = jaccard.near_duplicates(docs(spark, [(None, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, None), (4, "A B C D E F"), (4, "A B C D E F"), (None, "only here")])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles or 0, r.component_id or 0) for r in odd) == [(0, 0, 0), (0, 2, 0), (1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 2, 1), (4, 2, 1)]
    assert jaccard.near_duplicates(docs(spark, [])).count() == 0


def test_a_large_group_in_many_tiles(spark, monkeypatch):
    """A star of copies that link with their base and seldom with each other, over several size bands."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(400)]
    rows = []
    for k in range(150):
        text = base[: 400 - (k % 5) * 15]
        for p in rng.sample(range(len(text)), 7):
            text = text[:p] + [f"n{k}x{p}"] + text[p + 1 :]
        rows.append((k + 1, " ".join(text)))
    rows.append((500, " ".join(base)))
    want = slow_components(rows)
    monkeypatch.setattr(jaccard, "TILE_DOCS", 20)
    got = {r.doc_id: ([r.n_shingles], r.component_id) for r in jaccard.near_duplicates(docs(spark, rows)).collect()}
    assert got == want


def test_a_large_group_in_which_nothing_links(spark, monkeypatch):
    """A chain of 3,000 texts of which each shares a third with the next: one group by keys, and no links but of a few copies."""
    say = lambda k: [f"p{k}x{i}" for i in range(24)]
    rows = [(k + 1, " ".join(say(k) + say(k + 1) + say(k + 2))) for k in range(3000)]
    rows += [(10_000 + k, rows[k][1] + f" more{k}") for k in range(0, 3000, 500)]
    monkeypatch.setattr(jaccard, "TILE_DOCS", 100)
    tiles = []
    monkeypatch.setattr(jaccard, "_blocks", lambda rows, percent, f=jaccard._blocks: tiles.append(rows.count()) or f(rows, percent))
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs(spark, rows)).collect()}
    assert got == {i: i if i < 10_000 else i - 9_999 for i, _ in rows}
    assert tiles == [0]


def test_keys_of_too_many_documents_make_blocks(spark, monkeypatch):
    """Two families of copies and texts between them, with keys that more documents share than a tile holds."""
    rng = random.Random(10)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for k in range(90):
        text = list(base[: 40 + (k % 3) * 10])
        for p in rng.sample(range(20), k % 5):
            text[p] = f"n{k % 7}x{p}"
        rows.append((k + 1, " ".join(text)))
    want = slow_components(rows)
    assert len({c for _, c in want.values()}) > 5
    for docs_in_tile in (6, 20):
        monkeypatch.setattr(jaccard, "TILE_DOCS", docs_in_tile)
        got = {r.doc_id: ([r.n_shingles], r.component_id) for r in jaccard.near_duplicates(docs(spark, rows)).collect()}
        assert got == want


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(30):
        a, b = (np.unique(rng.integers(0, 4000, n).astype(np.uint64)) for n in rng.integers(1, 2000, 2))
        x, y = jaccard.signatures([words.mix(a), words.mix(b)], 512)
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)] + [(7, 7), (2000, 2000), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


# 10 packing


def slow_tops(sizes, buckets):
    import itertools

    lengths = sorted(set(sizes))
    cost = lambda tops: sum(min(t for t in tops if t >= s) - s for s in sizes)
    return min(cost((*c, lengths[-1])) for k in range(min(buckets, len(lengths))) for c in itertools.combinations(lengths[:-1], k))


@given(st.lists(st.integers(0, 40), min_size=1, max_size=30), st.integers(1, 4))
@settings(max_examples=80, deadline=None)
def test_boundaries_are_optimal(sizes, buckets):
    lengths, counts = np.unique(np.array(sizes), return_counts=True)
    tops = packing.boundaries(lengths, counts, buckets)
    assert len(tops) <= buckets and sum(min(t for t in tops if t >= s) - s for s in sizes) == slow_tops(sizes, buckets)


def test_pack(spark, monkeypatch):
    rows = corpus(8, 80) + [(5, "again"), (None, "a b")]
    out = packing.pack(docs(spark, rows), buckets=4, budget=300).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in out) == sorted(((i or -1), len(split(t))) for i, t in rows)
    batches = collections.defaultdict(list)
    for r in out:
        assert 0 <= r.padding == r.bucket_len - r.n_tokens
        batches[r.bucket, r.batch].append(r)
    for (bucket, batch), members in batches.items():
        room = max(1, 300 // max(1, members[0].bucket_len))
        assert sorted(r.place for r in members) == list(range(len(members))) and len(members) <= room
        assert batch == 0 or len(batches[bucket, batch - 1]) == room
    assert sum(r.padding for r in out) == slow_tops([len(split(t)) for _, t in rows], 4)
    assert packing.pack(docs(spark, [])).count() == 0
    by_length = packing.pack(docs(spark, rows), length=F.length("text")).collect()
    assert sorted(r.n_tokens for r in by_length) == sorted(len(t or "") for _, t in rows)


def test_word_count(spark):
    rows = corpus(8, 80) + [(900, "  x\x85y ")]
    got = {r.doc_id: r.n for r in docs(spark, rows).select("doc_id", packing.word_count(F.col("text")).alias("n")).collect()}
    assert got == {i: len(split(t)) for i, t in rows}


# the pipeline and the registry


def test_pipeline_stages_at_their_edges(spark, tmp_path):
    """Null, empty and repeated rows, columns of any name, and an empty table, through every stage."""
    import corpus_pipeline

    extra = "language language_ _language n_lines n_dropped component_id item_id hashes n_tokens text_ row host lines drops stay key chunk rep own label".split()
    rng = random.Random(12)
    say = lambda k: " ".join(rng.choice(["the", "house", "and", "with", "this", "thing"]) + rng.choice(["", "s", "ing"]) for _ in range(k))
    rows = [(k, say(40), "en", f"s{k % 3}", None) for k in range(60)]
    rows += [(100, rows[3][1], "en", "s0", 1), (3, rows[3][1], "en", "s1", 1), (None, rows[3][1], "en", None, 1), (None, None, None, None, None), (101, None, "en", "s0", 0), (102, "", "en", "s0", 0), (103, "1 2 3", None, "s0", 5)]
    rows += [(104, say(30) + " alpha beta gamma delta epsilon zeta " + say(30), "en", "s1", 9), (105, say(4000), "en", "s2", None)]
    table = spark.createDataFrame([(*r, *["kept"] * len(extra)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra))
    sf = str(tmp_path)
    spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (2, None), (None, "the house")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    current, gone = table, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, current, sf)
        assert after.columns == table.columns and after.select(*extra).distinct().count() == 1
        before, left = (sorted((r.doc_id is None, r.doc_id or 0) for r in d.collect()) for d in (current, after))
        gone[name] = {i for i in before if i not in left}
        assert stage(spark, table.where("false"), sf).count() == 0
        current = after
    assert gone == {"language_id": {(False, 101), (False, 102), (False, 103)}, "line_dedup": set(), "near_duplicates": {(False, 100)}, "decontamination": {(False, 104)}}
    out = corpus_pipeline.length_buckets(spark, current, sf)
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r.doc_id) for r in current.collect())
    assert corpus_pipeline.length_buckets(spark, table.where("false"), sf).count() == 0


def slow_line_dedup(rows):
    """rows: (id, text, source). Texts without the lines that over 5 % of a source's distinct pages have, five or more of them."""
    solid = lambda t: {x.strip(" ") for x in (t or "").split("\n")} - {""}
    pages = {(s, frozenset(solid(t))) for _, t, s in rows if s is not None}
    total = collections.Counter(s for s, _ in pages)
    seen = collections.Counter((s, x) for s, p in pages for x in p)
    bad = {k for k, n in seen.items() if n >= 5 and n > 0.05 * total[k[0]]}
    return {i: t if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" ")) not in bad) for i, t, s in rows}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    read = spark.read.parquet(f"{sf}/documents.parquet")
    out, current = corpus_pipeline.run(spark, sf), read
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, current, sf)
        assert after.columns == read.columns
        kept = {r.doc_id: r.text for r in after.select("doc_id", "text").collect()}
        before = {r.doc_id: r.text for r in current.select("doc_id", "text").collect()}
        assert set(kept) <= set(before)
        if name == "language_id":
            said = langid.predict(current, langid.train(current)).collect()
            assert set(kept) == {r.doc_id for r in said if not r.language.rejected}
            letterless = {i for i, t in before.items() if not any(c.isalpha() for c in t or "")}
            assert not set(kept) & letterless and len(kept) >= 0.95 * (len(before) - len(letterless))
            assert {r.doc_id: r.lang for r in after.collect()} == {r.doc_id: r.language.lang_pred for r in said if not r.language.rejected}
        if name == "line_dedup":
            assert kept == slow_line_dedup([(r.doc_id, r.text, r.source) for r in current.collect()])
        if name == "near_duplicates":
            slow = slow_components(list(before.items()))
            assert set(kept) == {c for _, c in slow.values()}
        if name == "decontamination":
            items = [split(r.text.lower()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            grams = [{tuple(w[p : p + 5]) for p in range(len(w) - 4)} for w in items]
            holds = {i for i, t in before.items() for s in [{tuple(w[p : p + 5]) for w in [split(t.lower())] for p in range(len(w) - 4)}] if any(g and 100 * len(g & s) >= 80 * len(g) for g in grams)}
            assert set(kept) == set(before) - holds
        current = after
    out = out.collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in current.select("doc_id").collect())
    counted = {r.doc_id: r.n_tokens for r in token_counts.token_counts(current, tokenizer_file("piece_bpe_32k.model")).collect()}
    assert {r.doc_id: r.n_tokens for r in out} == counted
    tops = packing.boundaries(*np.unique(np.array(list(counted.values())), return_counts=True), 16)
    if max(counted.values()) <= packing.EXACT:
        assert sum(r.padding for r in out) == sum(min(t for t in tops if t >= n) - n for n in counted.values())
    assert all(r.padding == r.bucket_len - r.n_tokens >= 0 for r in out)
