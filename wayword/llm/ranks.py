"""The first rows of every group, found in two steps so that no task gets all rows of a hot group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A group is spread over so many tasks before its best rows come together.
SALTS = 64


def first_ranks(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """``rank`` from 1 in the order given, the first ``k`` rows of every group."""
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    parts = Window.partitionBy(*keys, "_salt").orderBy(*order)
    best = salted.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= k).drop("rank", "_salt")
    whole = Window.partitionBy(*keys).orderBy(*order)
    return best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
