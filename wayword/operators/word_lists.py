"""Word lists: stop lists and term lists given as Python words or as a one-column table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.lookup import in_words
from .skew import sized_join

# A list within these limits becomes a literal of the plan; a longer one is joined.
LITERAL_WORDS = 100_000
LITERAL_BYTES = 4_000_000
LITERAL_WORD_BYTES = 1_000

WordList = DataFrame | Sequence[str]


def merge_word_lists(*lists: DataFrame) -> DataFrame:
    """Words that are in any of the lists, each once."""
    merged = lists[0].select("word")
    for other in lists[1:]:
        merged = merged.union(other.select("word"))
    return merged.distinct()


def small_rows(table: DataFrame, *text_columns: str) -> list | None:
    """The rows of a table that turns out to be small, otherwise None.

    Its rows and bytes are counted first, so nothing of a large table is brought together.
    """
    lengths = [F.coalesce(F.octet_length(c), F.lit(0)) for c in text_columns]
    longest = F.greatest(*lengths, F.lit(0))
    whole = sum(lengths, F.lit(0).cast("long"))
    sizes = table.agg(F.count(F.lit(1)).alias("rows"), F.sum(whole).alias("bytes"), F.max(longest).alias("longest")).first()
    if sizes["rows"] > LITERAL_WORDS or (sizes["bytes"] or 0) > LITERAL_BYTES or (sizes["longest"] or 0) > LITERAL_WORD_BYTES:
        return None
    return table.collect()


def as_literal(words: WordList) -> list[str] | None:
    """The words as a Python list when there are few enough of them."""
    if not isinstance(words, DataFrame):
        words = list(words)
        small = len(words) <= LITERAL_WORDS and sum(len(w.encode()) for w in words) <= LITERAL_BYTES
        return words if small else None
    rows = small_rows(words.select("word").where("word IS NOT NULL"), "word")
    return None if rows is None else [r["word"] for r in rows]


def as_table(words: WordList, df: DataFrame) -> DataFrame:
    if isinstance(words, DataFrame):
        return words.select("word").distinct()
    return df.sparkSession.createDataFrame([(w,) for w in set(words)], "word string")


def remove_stopwords(tokens: DataFrame, stop: WordList, word: str = "word", by_join: bool = False) -> DataFrame:
    """Rows whose word is on no stop list (exact, case-sensitive).

    A long list (or any with ``by_join``) is joined: broadcast if its counted rows allow it, else shuffled, where
    adaptive execution splits frequent words.
    """
    literal = None if by_join else as_literal(stop)
    if literal is not None:
        return tokens.where(~in_words(F.col(word), literal))
    table = as_table(stop, tokens).select(F.col("word").alias(word))
    return sized_join(tokens, table, [word], "left_anti").select(tokens.columns)
