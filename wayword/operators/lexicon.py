"""Polarity and subjectivity of a text: the mean over its words that are in a lexicon."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lookup import lookup
from ..functions.scores import sentiment_sign
from ..functions.text import split_on_space
from .per_text import KEY, per_text
from .skew import sized_join
from .word_lists import LITERAL_BYTES, LITERAL_WORDS, small_rows

# word -> (polarity, subjectivity), or a table with the columns word, polarity, subjectivity
Lexicon = Mapping[str, tuple[float, float]] | DataFrame

MEASURES = ("polarity", "subjectivity")


def mean_of(values: Column) -> Column:
    """Mean of an array in the order of its items, 0 for an empty one."""
    total = F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(0.0)


def one_row_per_word(lexicon: DataFrame) -> DataFrame:
    """The lexicon with each word once: the mean of its values, of which nulls do not count."""
    means = [F.avg(F.col(m).cast("double")).alias(m) for m in MEASURES]
    return lexicon.where("word IS NOT NULL").groupBy("word").agg(*means)


def literal_lexicon(lexicon: Lexicon) -> dict[str, tuple[float, float]] | None:
    """The lexicon as a Python mapping when it is small enough."""
    if isinstance(lexicon, DataFrame):
        rows = small_rows(one_row_per_word(lexicon), "word")
        return None if rows is None else {r["word"]: tuple(r[m] for m in MEASURES) for r in rows}
    small = len(lexicon) <= LITERAL_WORDS and sum(len(w.encode()) for w in lexicon) <= LITERAL_BYTES
    return dict(lexicon) if small else None


def _score_by_literal(
    posts: DataFrame, text: str, lexicon: Mapping[str, tuple[float, float]], measure: str, where: Column | None
) -> DataFrame:
    place = MEASURES.index(measure)
    known = {w: float(values[place]) for w, values in lexicon.items() if values[place] is not None}
    found = F.array_compact(F.transform(split_on_space(text), lambda w: lookup(w, known, "double")))
    if where is not None:
        found = F.when(where, found)
    return posts.withColumn("_found", found).withColumn(measure, mean_of(F.col("_found"))).drop("_found")


def _score_by_join(posts: DataFrame, text: str, lexicon: DataFrame, measure: str) -> DataFrame:
    values = one_row_per_word(lexicon).select("word", F.col(measure).alias("_value")).where("_value IS NOT NULL")

    def mean_of_text(words: DataFrame) -> DataFrame:
        # A group is the words of one text, so it is no larger than the row it came from.
        found = (
            sized_join(words, values, ["word"], "inner")
            .groupBy(KEY)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "_value"))).alias("_found"))
        )
        return found.select(KEY, mean_of(F.col("_found._value")).alias(measure))

    scored = per_text(posts, text, split_on_space(text), mean_of_text, "left")
    return scored.select(*posts.columns, F.coalesce(measure, F.lit(0.0)).alias(measure))


def _score(
    posts: DataFrame, lexicon: Lexicon, measure: str, text: str, by_join: bool, where: Column | None = None
) -> DataFrame:
    values = None if by_join else literal_lexicon(lexicon)
    if values is not None:
        return _score_by_literal(posts, text, values, measure, where)
    if not isinstance(lexicon, DataFrame):
        lexicon = posts.sparkSession.createDataFrame(
            [(w, *(None if v is None else float(v) for v in values)) for w, values in lexicon.items()],
            "word string, polarity double, subjectivity double",
        )
    return _score_by_join(posts, text, lexicon, measure)


def polarity(posts: DataFrame, lexicon: Lexicon, text: str = "tweet", by_join: bool = False) -> DataFrame:
    """Add ``polarity``, the mean over the words the lexicon knows, repeats included; 0 without any.

    A lexicon of usual size is part of the plan and a post is scored where it is read, also in a stream. A
    larger one (or ``by_join``) is joined with the words of the texts. Both add up the values in the
    order of the words and so agree to the last bit.
    """
    return _score(posts, lexicon, "polarity", text, by_join)


def subjectivity(posts: DataFrame, lexicon: Lexicon, text: str = "tweet", by_join: bool = False) -> DataFrame:
    """Add ``subjectivity``, in the way of ``polarity``."""
    return _score(posts, lexicon, "subjectivity", text, by_join)


def score_sentiment(
    posts: DataFrame, lexicon: Lexicon, text: str = "tweet", where: Column | None = None
) -> DataFrame:
    """Add ``sentiment``: -1, 0 or 1 by the sign of the polarity.

    Rows for which ``where`` does not hold need no score and may get 0 without a look at the text.
    """
    scored = _score(posts, lexicon, "polarity", text, False, where)
    return scored.withColumn("sentiment", sentiment_sign("polarity")).drop("polarity")
