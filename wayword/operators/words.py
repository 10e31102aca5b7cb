"""Word counts and the words two corpora have in common."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.lookup import in_words
from ..functions.text import words_of
from .word_lists import WordList, as_literal, as_table

# Fixed value: how many common words are reported.
TOP_K = 20


def explode_words(lines: DataFrame, line: str = "value", *keep: str) -> DataFrame:
    """One row per word of a line, with the columns ``keep``.

    The outer explode is for speed: a plain one makes Catalyst add a check for empty arrays below it, which
    splits every line a second time. Lines without words give rows that the filter drops.
    """
    return lines.select(*keep, F.explode_outer(words_of(line)).alias("word")).where("word <> ''")


def word_count(lines: DataFrame, line: str = "value", sorted: bool = True) -> DataFrame:
    """Occurrences of every word, in byte order of the words."""
    counts = explode_words(lines, line).groupBy("word").agg(F.count("*").alias("cnt"))
    return counts.orderBy("word") if sorted else counts


def counts_by_source(tagged: DataFrame, line: str = "value") -> DataFrame:
    """For every word, how often it occurs in source 1 and in all others.

    ``tagged`` has the columns ``src`` and the line. One shuffle over the tagged union serves both counts, and
    each task counts its words first, so that frequent words travel once per task.
    """
    return (
        explode_words(tagged, line, "src")
        .groupBy("word")
        .agg(
            F.count_if(F.col("src") == 1).alias("first_cnt"),
            F.count_if(F.col("src") != 1).alias("second_cnt"),
        )
    )


def common_counts(tagged: DataFrame, stop: WordList | None = None, line: str = "value") -> DataFrame:
    """Words of both sources with the smaller of their two counts, without stop words.

    Stop words go after counting, when every word is a single row and none of them is hot. The check is part of
    the count so that Catalyst does not move it down to every word of every line.
    """
    freq = F.least("first_cnt", "second_cnt")
    literal = None if stop is None else as_literal(stop)
    if literal is not None:
        freq = F.when(~in_words(F.col("word"), literal), freq)
    common = counts_by_source(tagged, line).select(freq.alias("freq"), "word").where("freq > 0")
    if stop is None or literal is not None:
        return common
    return common.join(as_table(stop, tagged), "word", "left_anti").select("freq", "word")


def top_k(counts: DataFrame, k: int = TOP_K, freq: str = "freq", word: str = "word") -> DataFrame:
    """The k most frequent words; words with the same count in descending order."""
    return counts.orderBy(F.desc(freq), F.desc(word)).limit(k)


def topk_common_words(
    tagged: DataFrame, stop: WordList | None = None, k: int = TOP_K, line: str = "value"
) -> DataFrame:
    """The words both sources use most, ranked by the smaller of their two counts."""
    return top_k(common_counts(tagged, stop, line), k)
