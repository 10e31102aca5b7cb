"""A corpus from documents: quality, line and document repeats, mixture, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written and read again as the next one's ``docs``.
All but the last keep the columns of ``docs``, whatever they are besides ``doc_id, text, lang, source``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayword.llm import bpe, jaccard, lines, mixing, quality
from wayword.llm.queries import held_out_rows, mix_levels, table, vocabulary_path
from wayword.session import materialise, scratch_path

# The mixture: equal weights in the tree, half of the tokens that are left, a document at most twice.
SHARE = 0.5
EPOCHS = 2


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be of low quality. Labels are learnt from the documents that arrive."""
    labels = table(spark, sf_dir, "labels").where(~held_out_rows(3, 1))
    model = quality.learn(docs.select("doc_id", "text"), labels.select("doc_id", F.col("quality").alias("label")))
    return quality.keep_good(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that nearly repeat another; a document that loses all its text goes."""
    deduped = lines.near_line_dedup(docs, min_words=1)
    emptied = F.col("removed").isNotNull() & ~F.rlike("text", F.lit(r"\S"))
    return with_char_count(deduped.where(~emptied).drop("removed"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return jaccard.one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its source's share of the tokens allows."""
    planned = mixing.plan(docs, mix_levels(), SHARE, EPOCHS)
    mixed = mixing.copies(docs, mix_levels(), planned).where("copies > 0")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return mixed.select(*docs.columns, copy).drop("copy")


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every text, with digests of them and of the text they decode to."""
    return bpe.encode_column(docs.select("doc_id", "lang", "source", "text"), vocabulary_path())


def with_char_count(docs: DataFrame) -> DataFrame:
    """``n_chars``, if there is such a column, follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mixing_sources", mix_sources),
    ("bpe_encoding", bpe_encoding),
]

# The classifier, the joins and the encoder are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
