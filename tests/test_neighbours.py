"""Pairs of following rows against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from wayword.operators.neighbours import consecutive_pairs


def expected(rows):
    first_nulls = sorted(rows, key=lambda r: [(x is not None, x if x is not None else 0) for x in r])
    return sorted(((a[0], a[1], a[2], b[2]) for a, b in zip(first_nulls, first_nulls[1:]) if a[0] == b[0]), key=repr)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_pairs_of_a_long_key(spark, parts):
    rnd = random.Random(1)
    rows = [(1, rnd.randrange(500), rnd.randrange(9)) for _ in range(600)]
    rows += [(rnd.choice([None, 2, 3, 4, 5]), rnd.choice([None, *range(20)]), rnd.choice([None, 1, 2])) for _ in range(200)]
    rows += [(9, 1, 1)] + [(10, 5, 5)] * 300
    df = spark.createDataFrame(rows, "key long, at long, thing long").withColumns({"item": F.lit("x"), "kind": F.lit(1)})
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = consecutive_pairs(df.repartition(5), ["key"], ["at"], "thing")
        assert got.columns == ["key", "at", "src", "dst"]
        assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
        assert consecutive_pairs(df.limit(0), ["key"], ["at"], "thing").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_keys_of_several_columns_and_nans(spark):
    rows = [("a", float("nan"), 1, "x"), ("a", float("nan"), 2, "y"), ("a", 1.0, 3, "z"), ("b", 1.0, 4, "u"), ("b", 1.0, 5, None)]
    df = spark.createDataFrame(rows, "name string, value double, at int, thing string")
    got = consecutive_pairs(df, ["name", "value"], ["at"], "thing")
    assert sorted((r["at"], r["src"], r["dst"]) for r in got.collect()) == [(1, "x", "y"), (4, "u", None)]
