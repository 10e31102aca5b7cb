"""Plain text: lines, word lists, path requests and topic terms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import split_on_space


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of all text files at a path, in the column ``value``."""
    return spark.read.text(path)


def read_tagged(spark: SparkSession, paths: Mapping[int, str]) -> DataFrame:
    """Lines of several inputs as ``value, src``; ``paths`` gives the path for every source number."""
    tagged = [read_lines(spark, path).withColumn("src", F.lit(src)) for src, path in paths.items()]
    return reduce(DataFrame.unionByName, tagged)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, taken as it stands: no trimming and no change of case."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Path requests ``pair_id, src, dst`` from lines of two ids with a space between.

    ``pair_id`` rises with the order of the lines in a file. An id that is no number becomes null, and such a
    request has no path.
    """
    ids = split_on_space("value")
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("pair_id"),
        F.get(ids, F.lit(0)).try_cast("bigint").alias("src"),
        F.get(ids, F.lit(1)).try_cast("bigint").alias("dst"),
    )


def read_topics(spark: SparkSession, path: str, topics: Sequence[str]) -> DataFrame:
    """``topic, terms`` from a JSON object of term lists: the named topics only, each term once."""
    whole = spark.read.text(path, wholetext=True)
    entries = whole.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("topic", "terms"))
    return entries.where(F.col("topic").isin(list(topics))).select(
        "topic", F.array_distinct("terms").alias("terms")
    )
