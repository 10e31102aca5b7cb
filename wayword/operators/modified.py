"""Polarity in which words change the value of those after them, as "very" and "not" do."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lookup import lookup
from ..functions.text import split_on_space
from .lexicon import Lexicon, literal_lexicon, one_row_per_word
from .per_text import KEY, per_text
from .skew import sized_join
from .word_lists import LITERAL_BYTES, LITERAL_WORDS, small_rows

# word -> (factor, reach), or a table with the columns word, factor, reach
Modifiers = Mapping[str, tuple[float, int]] | DataFrame

KNOWN = "struct<value: double, factor: double, reach: int>"


def one_modifier_per_word(modifiers: DataFrame) -> DataFrame:
    """Each word once: the mean of its factors and the largest reach; rows without a factor do not count."""
    known = modifiers.where("word IS NOT NULL AND factor IS NOT NULL")
    reach = F.coalesce(F.max(F.col("reach").cast("int")), F.lit(0)).alias("reach")
    return known.groupBy("word").agg(F.avg(F.col("factor").cast("double")).alias("factor"), reach)


def literal_modifiers(modifiers: Modifiers) -> dict[str, tuple[float, int]] | None:
    if isinstance(modifiers, DataFrame):
        rows = small_rows(one_modifier_per_word(modifiers), "word")
        return None if rows is None else {r["word"]: (r["factor"], r["reach"]) for r in rows}
    small = len(modifiers) <= LITERAL_WORDS and sum(len(w.encode()) for w in modifiers) <= LITERAL_BYTES
    return dict(modifiers) if small else None


def folded_mean(items: Column) -> Column:
    """Mean value of ``pos, value, factor, reach`` in the order of ``pos``, read from left to right.

    A modifier multiplies the value of the next word that has one, up to ``reach`` words without any in between.
    Modifiers within each other's reach multiply. A value stays between -1 and 1. 0 without a value.
    """
    start = F.struct(
        F.lit(0.0).alias("total"), F.lit(0).alias("n"), F.lit(1.0).alias("factor"), F.lit(-1).alias("until")
    )

    def read(state: Column, item: Column) -> Column:
        factor = F.when(item["pos"] <= state["until"], state["factor"]).otherwise(1.0)
        value = F.greatest(F.least(item["value"] * factor, F.lit(1.0)), F.lit(-1.0))
        modifies = item["factor"].isNotNull()
        return F.struct(
            F.when(modifies, state["total"]).otherwise(state["total"] + value).alias("total"),
            F.when(modifies, state["n"]).otherwise(state["n"] + 1).alias("n"),
            F.when(modifies, factor * item["factor"]).otherwise(1.0).alias("factor"),
            F.when(modifies, item["pos"] + 1 + item["reach"]).otherwise(-1).alias("until"),
        )

    def mean(state: Column) -> Column:
        return F.when(state["n"] > 0, state["total"] / state["n"]).otherwise(0.0)

    return F.coalesce(F.aggregate(items, start, read, mean), F.lit(0.0))


def _by_literal(posts: DataFrame, text: str, values: dict, modifiers: dict) -> DataFrame:
    known = {w: {"value": float(v[0])} for w, v in values.items() if v[0] is not None and w not in modifiers}
    known |= {w: {"factor": float(f), "reach": int(reach)} for w, (f, reach) in modifiers.items()}

    def item(word: Column, pos: Column) -> Column:
        found = lookup(word, known, KNOWN)
        return F.when(found.isNotNull(), F.struct(pos.alias("pos"), *(found[c].alias(c) for c in ("value", "factor", "reach"))))

    items = F.array_compact(F.transform(split_on_space(text), item))
    return posts.withColumn("polarity", folded_mean(items))


def _by_join(posts: DataFrame, text: str, lexicon: DataFrame, modifiers: DataFrame) -> DataFrame:
    changes = one_modifier_per_word(modifiers)
    values = one_row_per_word(lexicon).select("word", F.col("polarity").alias("value")).where("value IS NOT NULL")
    nothing = F.lit(None)
    # A modifier that the lexicon has too only modifies.
    known = changes.withColumn("value", nothing.cast("double")).unionByName(
        values.join(changes.select("word"), "word", "left_anti").withColumns(
            {"factor": nothing.cast("double"), "reach": nothing.cast("int")}
        )
    )

    def mean_of_text(words: DataFrame) -> DataFrame:
        # A group is the words of one text, so it is no larger than the row it came from.
        items = F.array_sort(F.collect_list(F.struct("pos", "value", "factor", "reach"))).alias("items")
        found = sized_join(words, known, ["word"], "inner").groupBy(KEY).agg(items)
        return found.select(KEY, folded_mean(F.col("items")).alias("polarity"))

    scored = per_text(posts, text, split_on_space(text), mean_of_text, "left")
    return scored.select(*posts.columns, F.coalesce("polarity", F.lit(0.0)).alias("polarity"))


def modified_polarity(
    posts: DataFrame, lexicon: Lexicon, modifiers: Modifiers, text: str = "tweet", by_join: bool = False
) -> DataFrame:
    """Add ``polarity``: the mean over the words the lexicon knows, each changed by the modifiers before it.

    A modifier has a factor (above 1 strengthens, below weakens, below 0 turns the sign) and a reach. Small tables are
    part of the plan, and a post is scored where it is read; larger ones (or ``by_join``) are joined with the words of the
    texts. Both read a text from left to right and agree to the last bit. Null texts have polarity 0.
    """
    values = None if by_join else literal_lexicon(lexicon)
    changes = None if by_join else literal_modifiers(modifiers)
    if values is not None and changes is not None:
        return _by_literal(posts, text, values, changes)
    spark = posts.sparkSession
    if not isinstance(lexicon, DataFrame):
        rows = [(w, *(None if v is None else float(v) for v in values)) for w, values in lexicon.items()]
        lexicon = spark.createDataFrame(rows, "word string, polarity double, subjectivity double")
    if not isinstance(modifiers, DataFrame):
        rows = [(w, float(factor), int(reach)) for w, (factor, reach) in modifiers.items()]
        modifiers = spark.createDataFrame(rows, "word string, factor double, reach int")
    return _by_join(posts, text, lexicon, modifiers)
