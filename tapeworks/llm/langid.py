"""Language identification by interpolated Kneser-Ney character models.

A model sees words one by one: lower-cased letters between a begin and an end mark. So a word's
log-probability depends on the word alone, and a task scores each distinct word that it meets once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.scratch import new_path, stored

from .words import give_back, mix, small_batches

ORDER = 4
#: Documents of each language that are learned from, of which one in CALIBRATE_EVERY is for calibration; languages that share a table of n-grams.
SAMPLE_DOCS, CALIBRATE_EVERY, LANGUAGES_AT_ONCE = 500, 5, 8
#: Bytes of the documents of a language that are learned from, at most. Models of more bytes than the second are shipped by file.
SAMPLE_BYTES, MODEL_BYTES = 32 << 20, 256 << 20
#: Shares of languages of more bytes than this are joined by shuffle.
BROADCAST_BYTES = 64 << 20
#: A text is rejected if its cross-entropy is over so many times the 99th percentile of its language's own.
REJECT_AT = 1.5
#: Distinct words that a task keeps; words read at once; words scored at once.
KEPT_WORDS, AT_ONCE, SCORED_AT_ONCE = 250_000, 200_000, 5_000

_BEGIN, _END = "\x02", "\x03"
_MUL = np.uint64(0x9E3779B97F4A7C15)


def letters(word: bytes) -> str:
    """A word's letters, lower-cased."""
    text = word.decode().lower()
    if text.isalpha():
        return text
    inner = text.strip(".,;:!?%&$#*|()'\"-0123456789")
    return inner if inner.isalpha() else "".join(filter(str.isalpha, text))


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Of each predicted symbol: its word, its place in it (from 1), the hashes of the 1 to ORDER symbols that end with it, and whether n symbols would begin before the mark."""
    text = "".join(_BEGIN + w + _END for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
    hashes, total, power = [], np.zeros(len(codes), np.uint64), 1
    for n in range(ORDER):
        total[n:] += (codes[: len(codes) - n] + np.uint64(1)) * np.uint64(power)
        power = power * int(_MUL) & (1 << 64) - 1
        hashes.append(mix(total + np.uint64(n + 1)))
    return word, place, hashes, codes


@dataclass
class Model:
    """Of each order n: sorted hashes of n-grams, their discounted share of their context, and the weight that they as contexts leave to the order below, a column for each language."""

    languages: list[str]
    hashes: list[np.ndarray]
    shares: list[np.ndarray]
    leaves: list[np.ndarray]
    base: np.ndarray

    def __post_init__(self) -> None:
        """For each sorted array where the hashes of each leading-bits value begin, and the most that share one."""
        self.starts = []
        # the row at -1 is of n-grams that no language has: no share, and all weight to the order below
        width = len(self.languages)
        self.padded = [(np.vstack([x, np.zeros((1, width), np.float32)]), np.vstack([y, np.ones((1, width), np.float32)])) for x, y in zip(self.shares, self.leaves, strict=True)]
        for h in self.hashes:
            bits = int(4 * len(h)).bit_length()
            begins = np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
            self.starts.append((np.uint64(64 - bits), begins, int(np.diff(begins).max())))

    def find(self, n: int, grams: np.ndarray) -> np.ndarray:
        """Where n-grams are in their sorted array, or -1."""
        (shift, begins, most), h = self.starts[n - 1], self.hashes[n - 1]
        at, last = begins[grams >> shift], len(h) - 1
        for _ in range(most):
            at = at + (h[np.minimum(at, last)] < grams)
        at = np.minimum(at, last)
        return np.where(h[at] == grams, at, -1)

    def words(self, words: list[str]) -> np.ndarray:
        """Log-probabilities of words under each language."""
        word, place, grams, _ = _grams(words)
        rows = np.flatnonzero(place > 0)
        p = np.broadcast_to(self.base, (len(rows), len(self.languages)))
        left = None
        for n in range(1, ORDER + 1):
            at = np.where(place >= n - 1, self.find(n, grams[n - 1]), -1)
            own, before = at[rows], None if n == 1 else left[rows - 1]
            weight = self.leaves0() if n == 1 else self.padded[n - 2][1][before]
            fits = place[rows] >= n - 1
            higher = self.padded[n - 1][0][own] + weight * p
            p = higher if fits.all() else np.where(fits[:, None], higher, p)
            left = at
        logs = np.log(p)
        out = np.zeros((len(words), len(self.languages)))
        starts = np.flatnonzero(place[rows] == 1)
        if len(starts):
            out[:] = np.add.reduceat(logs, starts)
        return out

    def leaves0(self) -> np.ndarray:
        """The weight that the empty context leaves to the uniform distribution."""
        return self.leaves[ORDER - 1][-1][None, :]


def fit(words: pd.DataFrame, languages: list[str]) -> Model:
    """words: lang, word, n. Modified counts below the highest order: of how many different symbols an n-gram follows."""
    tables = []
    for lang in languages:
        own = words[words["lang"] == lang]
        word, place, grams, codes = _grams(own["word"].tolist())
        times = own["n"].to_numpy(np.int64)[word] if len(own) else np.zeros(0, np.int64)
        by_order = []
        for n in range(1, ORDER + 1):
            rows = np.flatnonzero((place >= n - 1) & (place > 0))
            gram, first = np.unique(grams[n - 1][rows], return_index=True)
            raw = np.zeros(len(gram), np.int64)
            np.add.at(raw, np.searchsorted(gram, grams[n - 1][rows]), times[rows])
            at = rows[first]
            count = raw
            if n < ORDER:
                wider = np.flatnonzero((place >= n) & (place > 0))
                pairs = np.unique(np.stack([grams[n][wider], grams[n - 1][wider]]), axis=1)
                count = np.zeros(len(gram), np.int64)
                np.add.at(count, np.searchsorted(gram, pairs[1]), 1)
                count = np.where(place[at] == n - 1, raw, count)
            context = grams[n - 2][at - 1] if n > 1 else np.zeros(len(at), np.uint64)
            ones, twos = (count == 1).sum(), (count == 2).sum()
            discount = min(0.95, max(0.05, ones / max(1, ones + 2 * twos)))
            held, inverse = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(inverse, count, len(held)), np.bincount(inverse, count > 0, len(held))
            by_order.append((gram, np.maximum(count - discount, 0) / np.maximum(total[inverse], 1), held, discount * kinds / np.maximum(total, 1)))
        tables.append(by_order)
    symbols = max(2, len({c for w in words["word"] for c in w}) + 2)
    hashes, shares, leaves = [], [], []
    for n in range(ORDER):
        every = [t[n][0] for t in tables] + ([t[n + 1][2] for t in tables] if n + 1 < ORDER else [])
        h = np.unique(np.concatenate([np.zeros(1, np.uint64), *every]))
        share, leave = np.zeros((len(h), len(languages)), np.float32), np.ones((len(h), len(languages)), np.float32)
        for k, t in enumerate(tables):
            share[np.searchsorted(h, t[n][0]), k] = t[n][1]
            if n + 1 < ORDER:
                leave[np.searchsorted(h, t[n + 1][2]), k] = t[n + 1][3]
            elif len(t[0][3]):
                leave[-1, k] = t[0][3][0]
        hashes.append(h)
        shares.append(share)
        leaves.append(leave)
    leaves[ORDER - 1] = np.minimum(leaves[ORDER - 1], 1)
    return Model(languages, hashes, shares, leaves, np.full(len(languages), 1 / symbols))


@dataclass
class Models:
    """Models of all languages, in tables of LANGUAGES_AT_ONCE, with what calibration found."""

    tables: list[Model]
    limits: np.ndarray
    sharpness: float = 10.0

    @property
    def languages(self) -> list[str]:
        return [x for t in self.tables for x in t.languages]

    def words(self, words: list[str]) -> np.ndarray:
        return np.hstack([t.words(words) for t in self.tables])


class Scorer:
    """Cross-entropies of texts, with the scores of words kept up to KEPT_WORDS; row 0 of values is of words without letters."""

    def __init__(self, model: Models):
        self.model, self.known, self.stems = model, {}, {"": 0}
        self.values = np.zeros((1, len(model.languages) + 1))

    def _learn(self, words: list[bytes]) -> None:
        new = list(set(words).difference(self.known))
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
            self.stems = {"": 0}
            self.values = self.values[:1]
            new = list(set(words))
        stems = list(map(letters, new))
        fresh = list(set(stems).difference(self.stems))
        self.stems.update(zip(fresh, range(len(self.values), len(self.values) + len(fresh)), strict=True))
        self.known.update(zip(new, map(self.stems.__getitem__, stems), strict=True))
        scored = [self.values]
        for k in range(0, len(fresh), SCORED_AT_ONCE):
            some = fresh[k : k + SCORED_AT_ONCE]
            scored.append(np.hstack([-self.model.words(some), np.array([[len(t) + 1] for t in some], float)]))
        self.values = np.concatenate(scored)

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """Cross-entropy of each text under each language in nats a symbol; NaN without letters."""
        out, run, size = [], [], 0
        for k, text in enumerate(texts):
            run.append((text or "").encode().split())
            size += len(run[-1])
            if size >= AT_ONCE or k == len(texts) - 1:
                self._learn(list(chain.from_iterable(run)))
                for words in run:
                    total = self.values[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))].sum(0)
                    out.append(total[:-1] / total[-1] if total[-1] else np.full(len(total) - 1, np.nan))
                run, size = [], 0
        return np.array(out).reshape(len(texts), len(self.model.languages))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Models:
    """A model of every language of ``docs``, learned from SAMPLE_DOCS documents of each, of which some only calibrate it.

    These are the first by the hash of their id and text, whole texts, as far as they come to SAMPLE_BYTES; a language whose
    first text is longer than that isn't learned. An empty table gives models of no language. Only the distinct words of
    LANGUAGES_AT_ONCE languages with counts, and the scores of calibrating documents, reach the driver at a
    time, so what it holds follows the number of languages and not the corpus. Rows without a language or a
    text take no part; rows that repeat an id are drawn one by one. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("l"))
    docs = docs.where("l is not null and t is not null").withColumn("place", F.xxhash64("i", "t"))
    # about two samples of each language by hash, so that ranking them is as small on any corpus
    share = stored(docs.groupBy("l").agg((2 * SAMPLE_DOCS / F.count("*")).alias("share")), "shares")
    few = (share.agg(F.sum(F.octet_length("l") + 16)).first()[0] or 0) <= BROADCAST_BYTES
    drawn = docs.join(F.broadcast(share) if few else share, "l").where(F.col("place") / 2.0**64 + 0.5 < F.col("share"))
    rank = F.row_number().over(Window.partitionBy("l").orderBy("place", "i", "t"))
    drawn = drawn.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_DOCS)
    upto = F.sum(F.octet_length("t")).over(Window.partitionBy("l").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    sample = stored(drawn.withColumn("upto", upto).where(F.col("upto") <= SAMPLE_BYTES).select("l", "t", "rank"), "sample")
    words = sample.where(F.col("rank") % CALIBRATE_EVERY != 0).select("l", F.explode(F.split("t", r"[\x20\x09-\x0D]+")).alias("w")).groupBy("l", "w").count()
    words = stored(words, "sample_words")
    known = sorted(r["l"] for r in words.where(F.col("w").rlike(r"\p{L}")).select("l").distinct().collect())
    tables = []
    for k in range(0, len(known), LANGUAGES_AT_ONCE):
        some = known[k : k + LANGUAGES_AT_ONCE]
        rows = words.where(F.col("l").isin(some)).toPandas()
        rows = pd.DataFrame({"lang": rows["l"], "word": [letters(w.encode()) for w in rows["w"]], "n": rows["count"]})
        rows = rows[rows["word"] != ""].groupby(["lang", "word"], as_index=False)["n"].sum()
        tables.append(fit(rows, some))
        del rows
        give_back()
    models = Models(tables, np.full(len(known), np.inf))
    return _calibrated(models, sample.where(F.col("rank") % CALIBRATE_EVERY == 0)) if known else models


def _shipped(spark, models: Models):
    """A function that has the models on a worker: by broadcast, or from a file in the shared folder if they are more than MODEL_BYTES."""
    data = pickle.dumps(models)
    if len(data) <= MODEL_BYTES:
        shared = spark.sparkContext.broadcast(models)
        return lambda: shared.value
    path = f"{new_path(spark, 'models')}"
    store, at = pafs.FileSystem.from_uri(path)
    with store.open_output_stream(at) as sink:
        sink.write(data)

    def load() -> Models:
        store, at = pafs.FileSystem.from_uri(path)
        with store.open_input_file(at) as source:
            return pickle.loads(source.read())

    return load


def _scores(spark, models: Models):
    """A function of text columns: cross-entropies under each language, null without letters."""
    shared = _shipped(spark, models)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared())
        for batch in batches:
            yield pd.Series([None if np.isnan(x).any() else x.tolist() for x in scorer.texts(batch.tolist())], dtype=object)
        del scorer
        give_back()

    return F.pandas_udf(run, "array<double>")


def _calibrated(models: Models, own: DataFrame) -> Models:
    """Sets each language's limit and the sharpness of scores by documents (l, t) the models weren't fitted on."""
    small_batches(own.sparkSession)
    rows = own.select("l", _scores(own.sparkSession, models)("t").alias("x")).collect()
    place = {x: k for k, x in enumerate(models.languages)}
    rows = sorted((place[r["l"]], r["x"]) for r in rows if r["l"] in place and r["x"] is not None)
    truth, scores = np.array([k for k, _ in rows], int), np.array([x for _, x in rows]).reshape(len(rows), len(place))
    every = scores[np.arange(len(truth)), truth]
    for k in range(len(place)):
        mine = every[truth == k] if (truth == k).any() else every
        models.limits[k] = REJECT_AT * np.quantile(mine, 0.99) if len(mine) else np.inf

    def loss(sharpness: float) -> float:
        z = -sharpness * scores
        return float((np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1) - z[np.arange(len(truth)), truth]).sum())

    if len(truth):
        models.sharpness = min((0.5, 1, 2, 4, 8, 16, 32), key=loss)
    return models


def predict(docs: DataFrame, models: Models, text_col: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into``: lang_pred, score (0 to 1) and rejected; a column of that name is replaced.

    The language is that of the least cross-entropy over the whole text, the first by name of equals. It is
    'und', with score 0 and rejected, if the text is null or has no letter or no language is known. rejected
    says that even the best model is too surprised by the text to claim it; lang_pred still names it. A very long
    text is scored whole, and an empty table gives no rows. Each row is scored by itself, so null or repeated ids make no difference, and once, however often ``into`` is used.
    """
    small_batches(docs.sparkSession)
    shared = _shipped(docs.sparkSession, models)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        models = shared()
        scorer, languages = Scorer(models), models.languages
        names, limits = np.array([*languages, "und"], object), np.append(models.limits, np.inf)
        for batch in batches:
            ce = scorer.texts(batch.tolist()) if languages else np.full((len(batch), 1), np.nan)
            none = np.isnan(ce).any(1)
            ce = np.where(none[:, None], 0, ce)
            best = ce.argmin(1)
            least = ce[np.arange(len(ce)), best]
            score = 1 / np.exp(-models.sharpness * (ce - least[:, None])).sum(1)
            yield pd.DataFrame({"lang_pred": names[np.where(none, len(names) - 1, best)], "score": np.where(none, 0.0, score), "rejected": none | (least > limits[best])})
        del scorer
        give_back()

    # else a filter on its fields would score each text a second time
    once = F.pandas_udf(run, "lang_pred string, score double, rejected boolean").asNondeterministic()
    return docs.withColumn(into, once(F.col(text_col).cast("string")))
