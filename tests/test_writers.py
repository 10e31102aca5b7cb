"""Ids for several writers at once, and models that are loaded once per worker."""

import json
import os
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier

import numpy as np
from pyspark.sql import functions as F

from wayword.operators import encode
from wayword.sources import sinks


def test_blocks_are_given_once(spark, tmp_path):
    target, start = str(tmp_path / "t able%20"), Barrier(8)

    def ask(_):
        start.wait()
        return [sinks.reserve_block(spark, target) for _ in range(5)]

    with ThreadPoolExecutor(8) as pool:
        given = [n for numbers in pool.map(ask, range(8)) for n in numbers]
    assert len(given) == 40 and len(set(given)) == 40


def test_appends_that_overlap(spark, tmp_path):
    target, start = str(tmp_path / "archive"), Barrier(3)
    sinks.write_table(sinks.with_row_id(spark.range(20).select(F.col("id").alias("x"))), target)

    def append(part):
        start.wait()
        return sinks.append_with_ids(spark.range(100).select((F.col("id") + 1000 * part).alias("x")).repartition(3), target)

    with ThreadPoolExecutor(3) as pool:
        numbers = list(pool.map(append, (1, 2, 3)))
    assert len(set(numbers)) == 3 and min(numbers) >= 1
    rows = spark.read.parquet(target + "/append=*").collect()
    assert len({r["id"] for r in rows}) == 300 and sorted(r["x"] for r in rows) == [1000 * p + i for p in (1, 2, 3) for i in range(100)]
    first = sinks.next_id(spark, str(tmp_path / "nothing"))
    assert first == 1 and min(r["id"] for r in rows) >= sinks.ID_BLOCK
    # A later append goes on above all blocks.
    assert sinks.append_with_ids(spark.range(2).select(F.col("id").alias("x")), target) == max(numbers) + 1


def test_a_model_is_loaded_once_per_worker(spark, tmp_path):
    model, log = tmp_path / "model-of-this-test.json", tmp_path / "loads"
    model.write_text(json.dumps({"by": 7}))
    log.mkdir()

    def load(file):
        by = json.loads(Path(file).read_text())["by"]
        (log / f"{os.getpid()}-{os.urandom(8).hex()}").touch()
        return lambda ids: ids.sum(axis=1) / by

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        ids = F.expr("IF(id % 5 = 0, NULL, sequence(0, cast(id % 9 as int)))").alias("ids")
        encoded = spark.range(0, 400, 1, 40).select("id", ids)
        got = {r["id"]: r["score"] for r in encode.score_with_model_file(encoded, str(model), load).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {i: (0 if i % 5 == 0 else sum(range(i % 9 + 1))) / 7 for i in range(400)}
    assert got == want
    loads = [name.split("-")[0] for name in os.listdir(log)]
    # 40 tasks of several batches; a worker loads once, however many tasks it gets.
    assert len(loads) == len(set(loads)) < 40


def test_only_the_last_model_is_kept():
    made = []
    for key in ("a", "a", "b", "a"):
        encode.loaded(key, lambda: made.append(key) or np.mean)
    assert made == ["a", "b", "a"] and list(encode._LOADED) == ["a"]
    encode._LOADED.clear()
