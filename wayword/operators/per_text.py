"""Work on the words of every text, then hand the outcome to the row the text is from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise, scratch_path

KEY = "row_key"


def per_text(
    df: DataFrame, text: str, split: Column, work: Callable[[DataFrame], DataFrame], how: str = "inner"
) -> DataFrame:
    """Join ``df`` with ``work(words)`` on the row.

    ``words`` has the columns ``row_key, pos, word``: the words of each text that is not null, as ``split`` makes them.
    ``work`` returns any number of rows per ``row_key``. A row is named by a number of eight bytes, so texts are not
    moved to be told apart, its words lie in one task and are put together there before they are moved, and a text that
    very many rows share is no group. ``df`` is written down first, as it is read several times.
    """
    keyed = materialise(df.withColumn(KEY, F.monotonically_increasing_id()), scratch_path(df.sparkSession, "per-text"))
    words = keyed.where(F.col(text).isNotNull()).select(KEY, F.posexplode_outer(split).alias("pos", "word"))
    return keyed.join(work(words), KEY, how).drop(KEY)
