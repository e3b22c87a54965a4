"""A corpus pipeline of five stages over ``documents``: each stage's rows are the next one's input.

Every function takes (spark, docs, sf_dir). All but the last return the columns of documents, others that the
table has too, under any name; the last returns the packing of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.scratch import stored
from tapeworks.llm import decontaminate, jaccard, langid, lines, packing, token_counts
from tapeworks.llm.registry import tokenizer_file
from tapeworks.llm.words import unused

#: Ids of more bytes than this are joined by shuffle; bytes that one takes.
BROADCAST_BYTES, ID_BYTES = 64 << 20, 32
#: Pages of a source that must share a line before it is taken for boilerplate: near copies in a small source aren't, they are the next stage's business.
LEAST_PAGES = 5
#: SQL can't express the language models of the first stage.
ORACLE_SQL = None


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the ids of ``gone``, which are broadcast below a checked size, so that texts aren't shuffled for a few ids."""
    gone = stored(gone.select("doc_id").distinct(), "gone")
    small = gone.count() * ID_BYTES <= BROADCAST_BYTES
    return docs.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language model claims go, so those with a null text or one without letters; lang becomes the predicted language.

    Null and repeated ids make no difference: each row is judged by itself, its whole text however long; of languages
    with equal scores the first by name is predicted. An empty table stays empty.
    """
    into = unused("language", docs.columns)
    known = langid.predict(docs, langid.train(docs), into=into).where(~F.col(f"{into}.rejected"))
    return known.select(*[F.col(f"{into}.lang_pred").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go; n_chars follows the text. The copies of a document, which the
    next stage reduces to one, count as one page here: else they would lose all their lines and none be left.

    Rows with a null source or text, or an empty text, stay as they are, whatever their id. Columns n_lines and
    n_dropped of the input stay. A very long text is cut into all its lines; an empty table stays empty.
    """
    kept = docs.select("*", *[F.col(c).alias(unused(c, docs.columns)) for c in ("n_lines", "n_dropped") if c in docs.columns])
    out = lines.drop_boilerplate(kept, min_pages=LEAST_PAGES, copies=False)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    names = {c: unused(c, docs.columns) if c in ("n_lines", "n_dropped") else c for c in docs.columns}
    return out.select(*[(n_chars if c == "n_chars" else F.col(f"`{n}`")).alias(c) for c, n in names.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document of least id stays.

    Rows with a null id stay, as they have none to be removed by, and so do documents without words, which are
    near to none. Rows that repeat an id are one document and stay or go together. Whole texts count, however
    long; an empty table stays empty.
    """
    classes = jaccard.near_duplicates(docs)
    return _without(docs, classes.where("doc_id <> component_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; of repeated ids all rows, if one of them holds one.

    Rows with a null id or text, and empty texts, stay. Whole texts are searched, however long; without documents or items nothing goes.
    """
    leaks = decontaminate.contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, leaks)


def length_buckets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed by token counts into batches of optimal length buckets: a row for each row, null ids and texts (no tokens) too.

    A text longer than a batch is one by itself; rows of equal length go in the order of a hash; an empty table gives no rows.
    """
    return packing.pack(docs, length=token_counts.counts(F.col("text"), tokenizer_file("piece_bpe_32k.model"))["n_tokens"])


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("length_buckets", length_buckets),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents, each stored as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
