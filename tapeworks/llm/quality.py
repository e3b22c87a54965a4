"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words so common in a language that running text has some of them.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "a", "was", "it", "as", "with", "on", "this", "by", "from", "or", "be", "are", "at", "an", "not",
    "der", "die", "und", "das", "zu", "den", "von", "nicht", "mit", "ist", "sich", "auf", "ein", "eine", "dem", "des", "im", "auch", "als", "für",
    "de", "la", "le", "et", "les", "que", "un", "une", "est", "du", "en", "dans", "pas", "au", "pour", "qui", "sur", "il", "ce",
    "el", "los", "y", "se", "del", "las", "por", "con", "para", "no", "su", "al", "lo", "como", "una",
]
#: Rule: metric, least value, greatest value; null: no bound. A document is kept if it meets all.
RULES = [
    ("mean_word_chars", 1.5, 20.0),
    ("symbol_ratio", None, 0.25),
    ("stop_word_ratio", 0.01, 0.8),
    ("dup_line_ratio", None, 0.5),
]
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"


def _windows(words: Column, n: int) -> Column:
    """Of each position the hash of n words."""
    at = F.sequence(F.lit(0), F.size(words) - n)
    return F.when(F.size(words) >= n, F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)])))


def _side_by_side(windows: Column) -> Column:
    """Windows with their positions, sorted, so equal ones lie side by side."""
    return F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _repeated(sorted_windows: Column) -> Column:
    """Sorted positions of windows that are found twice or more."""
    def twice(x: Column, k: Column) -> Column:
        return (F.get(sorted_windows, k - 1)["h"] == x["h"]) | (F.get(sorted_windows, k + 1)["h"] == x["h"])

    # a position outside the array gives null, which or-ed with a false one is not true
    return F.sort_array(F.transform(F.filter(sorted_windows, lambda x, k: F.coalesce(twice(x, k), F.get(sorted_windows, k - 1)["h"] == x["h"], F.get(sorted_windows, k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))


def _covered(positions: Column, n: int) -> Column:
    """Words that windows of n at these sorted positions cover."""
    steps = F.transform(positions, lambda p, k: F.least(F.lit(n), F.coalesce(F.get(positions, k + 1) - p, F.lit(n))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def verdict(rules: list[tuple[str, float | None, float | None]]) -> Column:
    """The rule table as one boolean expression over metric columns; a metric that is null breaks no rule."""
    kept = F.lit(True)
    for metric, least, most in rules:
        if least is not None:
            kept &= F.coalesce(F.col(metric) >= least, F.lit(True))
        if most is not None:
            kept &= F.coalesce(F.col(metric) <= most, F.lit(True))
    return kept


def quality(docs: DataFrame, rules: list | None = None, id_col: str = "doc_id", text_col: str = "text", stop_words: list[str] | None = None) -> DataFrame:
    """Counts, ratios and verdict of each row's whole text; other columns are not read.

    A null or empty text has no words, fails the base and is not kept. Repeated windows are found by 64-bit
    hashes of five words within one text, which for a text of a million words confuses two with a
    probability under 1e-7; a very long text is one row as any other. Rows are judged one by one, whatever
    their ids, and an empty table gives no rows. ``rules`` and ``stop_words`` (RULES and STOP_WORDS by default,
    which know four languages) are those of the corpus. All is one pass without shuffle or user functions.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    words = F.filter(F.split(F.translate("text", SPACES, " " * len(SPACES)), " "), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda s: F.translate(s, SPACES, "") != "")
    docs = docs.select(
        "doc_id",
        words.alias("words"),
        lines.alias("lines"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    docs = docs.select(
        "doc_id", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS if stop_words is None else stop_words))).cast("long").alias("n_stop_words"),
        _windows(F.col("words"), 5).alias("windows"),
    )
    # most texts repeat nothing, and only the others are sorted
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    docs = docs.withColumn("windows", F.when(again, _side_by_side(F.col("windows")))).withColumn("windows", _repeated(F.col("windows")))
    docs = docs.withColumn("n_repeat_words", F.coalesce(_covered(F.col("windows"), 5), F.lit(0)).cast("long")).drop("windows")
    whole = F.when(F.col("n_words") > 0, F.col("n_words"))
    docs = docs.select(
        "*",
        (F.col("word_chars") / whole).alias("mean_word_chars"),
        (F.col("n_symbols") / whole).alias("symbol_ratio"),
        (F.col("n_stop_words") / whole).alias("stop_word_ratio"),
        (F.col("n_dup_lines") / F.when(F.col("n_lines") > 0, F.col("n_lines"))).alias("dup_line_ratio"),
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
    )
    kept = ~F.col("base_failed") & verdict(RULES if rules is None else rules)
    return docs.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
