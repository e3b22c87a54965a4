"""Token counts of a unigram tokenizer, by dynamic programming shared along a trie of pre-tokens.

The vocabulary is that of a sentencepiece file. Its pieces come with ranks and not with probabilities, so
a piece of rank r weighs -ln((r + 1) ln V), as words of rank r do under Zipf's law, unless a file of scores
says otherwise; tokenizers are not trained here, and so weights aren't estimated on the corpus. Characters that are no piece fall back to one token for each UTF-8 byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import give_back, mix, small_batches

MARK = "▁"
#: Longest pre-token that gets into a trie; characters of the levels of one trie; distinct pre-tokens that a task keeps; pre-tokens read at once.
TRIE_CHARS, TRIE_CELLS, KEPT_WORDS, AT_ONCE = 4096, 8_000_000, 400_000, 1_000_000
#: A score is an integer: nats times SCALE. One is taken off for each token, so that of equal scores fewer tokens win.
SCALE = 1 << 32

_MUL = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """Pieces of a sentencepiece vocabulary with integer scores.

    scores: a file with a line for each piece, the piece, a tab and the natural logarithm of its probability; pieces it lacks are no pieces.
    """

    def __init__(self, path: str, scores: str | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        real = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        if scores is None:
            zipf = [-math.log((r + 1) * math.log(size)) for r in range(len(real))]
        else:
            with open(scores, encoding="utf-8") as lines:
                told = {piece: float(x) for piece, x in (line.rstrip("\n").rsplit("\t", 1) for line in lines)}
            real = sorted((i for i in real if model.id_to_piece(i) in told), key=lambda i: (-told[model.id_to_piece(i)], i))
            zipf = [told[model.id_to_piece(i)] for i in real]
        self.score = {model.id_to_piece(i): round(z * SCALE) - 1 for i, z in zip(real, zipf, strict=True)}
        self.byte_score = round((zipf[-1] - 10) * SCALE) - 1
        self.longest = max(map(len, self.score))
        hashes = np.array([_text_hash(p) for p in self.score], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], np.array(list(self.score.values()), np.int64)[order]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Scores of pieces with these hashes, or the least integer."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.values[at], np.iinfo(np.int64).min)


def _text_hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(_MUL) + ord(c) + 1) & (1 << 64) - 1
    return int(mix(np.array([h], np.uint64))[0])


def best_count(word: str, pieces: Pieces) -> int:
    """Tokens of one pre-token, by the forward pass over its own characters."""
    total, tokens = [0], [0]
    for end in range(1, len(word) + 1):
        n_bytes = len(word[end - 1].encode("utf-8", "surrogatepass"))
        best, count = total[-1] + n_bytes * pieces.byte_score, tokens[-1] + n_bytes
        for start in range(max(0, end - pieces.longest), end):
            score = pieces.score.get(word[start:end])
            if score is not None and total[start] + score > best:
                best, count = total[start] + score, tokens[start] + 1
        total.append(best)
        tokens.append(count)
    return tokens[-1]


def trie_counts(words: list[str], pieces: Pieces) -> list[int]:
    """Tokens of each of the distinct pre-tokens ``words``, every node of their trie scored once.

    The trie is laid out level by level: sorted pre-tokens that agree on d characters share a node at
    depth d. A node's forward score is the best of its ancestors' scores plus the piece between.
    """
    if not words:
        return []
    order = sorted(range(len(words)), key=words.__getitem__)
    texts = [words[i] for i in order]
    sizes = np.array([len(t) for t in texts])
    depth = int(sizes.max(initial=0))
    chars = np.array(texts, f"U{max(depth, 1)}").view(np.uint32).reshape(len(texts), -1)
    differs = np.ones((len(texts), depth + 1), bool)
    differs[1:, 0] = False
    if depth:
        differs[1:, 1:] = np.logical_or.accumulate(chars[1:, :depth] != chars[:-1, :depth], axis=1)
    node, hashes, score, tokens = [np.zeros(len(texts), np.int64)], [np.zeros(1, np.uint64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int32)]
    powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(pieces.longest, _MUL, np.uint64)])
    counts = np.zeros(len(texts), np.int64)
    for d in range(1, depth + 1):
        alive = sizes >= d
        new = differs[:, d] & alive
        rows = np.flatnonzero(new)
        node.append(np.cumsum(new) - 1)
        c = chars[rows, d - 1].astype(np.uint64)
        parent = node[d - 1][rows]
        own = hashes[d - 1][parent] * _MUL + c + np.uint64(1)
        n_bytes = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
        best, count = score[d - 1][parent] + n_bytes * pieces.byte_score, tokens[d - 1][parent] + n_bytes.astype(np.int32)
        for k in range(1, min(pieces.longest, d) + 1):
            above = node[d - k][rows]
            piece = pieces.find(mix(own - hashes[d - k][above] * powers[k]))
            found = np.flatnonzero(piece != np.iinfo(np.int64).min)
            value = score[d - k][above[found]] + piece[found]
            better = value > best[found]
            best[found[better]] = value[better]
            count[found[better]] = tokens[d - k][above[found[better]]] + 1
        hashes.append(own)
        score.append(best)
        tokens.append(count)
        ending = np.flatnonzero(sizes == d)
        counts[ending] = count[node[d][ending]]
    out = np.empty(len(words), np.int64)
    out[order] = counts
    return out.tolist()


def tries(words: list[str]) -> Iterator[list[int]]:
    """Places of pre-tokens in groups, by length, of which each makes one trie of bounded size."""
    group, order = [], sorted((i for i, w in enumerate(words) if len(w) <= TRIE_CHARS), key=lambda i: len(words[i]))
    for i in order:
        if group and (len(group) + 1) * len(words[i]) > TRIE_CELLS:
            yield group
            group = []
        group.append(i)
    if group:
        yield group


def _slices(texts: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    """Texts in runs of about AT_ONCE words, so that memory doesn't follow the length of a batch."""
    run, size = [], 0
    for words in texts:
        run.append(words)
        size += len(words)
        if size >= AT_ONCE:
            yield run
            run, size = [], 0
    if run:
        yield run


def _counter(path: str, scores: str | None):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces, known = Pieces(path, scores), {}
        for batch in batches:
            n_words, n_tokens = [], []
            for run_ in _slices((x or "").encode().split() for x in batch):
                new = list(set(chain.from_iterable(run_)).difference(known))
                if len(known) + len(new) > KEPT_WORDS:
                    known.clear()
                    new = list(set(chain.from_iterable(run_)))
                texts = [MARK + w.decode() for w in new]
                for group in tries(texts):
                    known.update(zip([new[i] for i in group], trie_counts([texts[i] for i in group], pieces), strict=True))
                known.update((new[i], best_count(t, pieces)) for i, t in enumerate(texts) if len(t) > TRIE_CHARS)
                n_words += map(len, run_)
                n_tokens += [sum(map(known.__getitem__, words)) for words in run_]
            yield pd.DataFrame({"n_words": n_words, "n_tokens": n_tokens}, dtype="int64")
        del pieces, known
        give_back()

    return F.pandas_udf(run, "n_words long, n_tokens long")


def counts(text: Column, model_path: str, scores_path: str | None = None) -> Column:
    """A struct (n_words, n_tokens) of a text column, for use in a projection."""
    return _counter(model_path, scores_path)(text.cast("string"))


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", scores_path: str | None = None) -> DataFrame:
    """doc_id, n_pretokens and n_tokens of each row's whole text; ``model_path`` is a file on every worker, and so is ``scores_path`` (see Pieces).

    A pre-token is a run of characters other than ASCII white space, with a mark for the space before it. A
    null or empty text has none. There is no shuffle: each task builds the tries of the pre-tokens it meets
    and starts afresh when it holds KEPT_WORDS, so memory is bounded whatever the vocabulary of the corpus.
    Pre-tokens of more than TRIE_CHARS are scored one by one. Rows are counted one by one, whatever their ids;
    other columns are not read, and an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    counted = docs.select(F.col(id_col).alias("doc_id"), counts(F.col(text_col), model_path, scores_path).alias("c"))
    return counted.select("doc_id", F.col("c.n_words").alias("n_pretokens"), F.col("c.n_tokens").alias("n_tokens"))
