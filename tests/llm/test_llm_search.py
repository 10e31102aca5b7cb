"""Exact search and search by collision counting against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayword.llm import ann, topk

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"


def vectors(n, dim=16, seed=1):
    return np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


def listed(matrix):
    return [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]


def brute(rows, queries, k, whole):
    found = []
    for q, v in rows:
        if q not in queries:
            continue
        scores = []
        for i, w in rows:
            if i != q and len(v) == len(w):
                a, b = np.array(v, dtype=np.float64), np.array(w, dtype=np.float64)
                if whole:
                    a, b = np.floor(1024 * a), np.floor(1024 * b)
                scores.append((-float((a * b).sum()), i))
        found += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


BAD = [
    (900, None), (901, []), (902, [1.0, None] + [0.0] * 14), (903, [float("nan")] * 16), (904, [float("inf")] * 16),
    (None, [1.0] * 16),
]


def test_exact_search(spark):
    rows = listed(vectors(300)) + [(500 + i, [1.0, 2.0, float(i % 3)]) for i in range(8)]
    df = frame(spark, rows + BAD + rows[:5])
    got = topk.exact_top_k(df, F.col("id") % 50 == 0, k=7).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, {i for i, _ in rows if i % 50 == 0}, 7, True)


def test_exact_search_with_few_rows_and_ties(spark):
    rows = [(i, [0.5, 0.5]) for i in range(4)]
    got = topk.exact_top_k(frame(spark, rows), F.col("id") == 2, k=10).collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 0), (2, 1), (3, 3)]
    assert topk.exact_top_k(frame(spark, []), F.lit(True)).count() == 0
    assert topk.exact_top_k(frame(spark, BAD), F.lit(True)).count() == 0


def test_large_whole_numbers_are_exact():
    q = np.array([[2.0**30, 3.0]])
    assert topk.products(q, np.array([[2.0**30, 5.0]])).tolist() == [[2**60 + 15]]


def test_scores_beyond_64_bits_are_clamped(spark):
    rows = [(0, [1e12, 1.0]), (1, [1e12, 0.0]), (2, [-1e12, 0.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(df, F.col("id") == 0, k=3).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 2**63 - 1), (3, 1024 * 1024 * 10**12 + 1024 * 1024), (2, -(2**63 - 1))]


@pytest.mark.parametrize("size", [1e-200, 5e-324, 1e-30, 1e200])
def test_near_search_of_tiny_and_huge_vectors(spark, size):
    """Their squares are 0 or infinite, but they are neither null nor zero."""
    rng = np.random.default_rng(7)
    rows = [(i, (size * np.sign(v)).tolist()) for i, v in enumerate(rng.standard_normal((30, 4)))]
    rows += [(100, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.near_search(df, F.col("id").isin(0, 100), k=30).collect()
    assert len(got) == 60
    scores = {i: float(sum(a * b for a, b in zip(v, [1.0, 2.0, 3.0, 4.0]))) for i, v in rows}
    found = [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 100]
    want = sorted(((i, s) for i, s in scores.items() if i != 100), key=lambda x: (-x[1], x[0]))
    assert [s for _, s in found] == pytest.approx([s for _, s in want], rel=1e-12)


def test_blocks_and_salts_give_the_same(spark, monkeypatch):
    rows = listed(vectors(200))
    df = frame(spark, rows).repartition(3)
    plain = {tuple(r) for r in topk.exact_top_k(df, F.col("id") % 10 == 0, k=5).collect()}
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "SHARD", 11)
    monkeypatch.setattr("wayword.llm.vectors.BROADCAST_BYTES", 0)
    monkeypatch.setattr("wayword.llm.vectors.FAN_IN", 2)
    assert {tuple(r) for r in topk.exact_top_k(df, F.col("id") % 10 == 0, k=5).collect()} == plain


@pytest.mark.parametrize("scale", [False, True])
def test_near_search_recall(spark, scale):
    matrix = vectors(1500, 32)
    if scale:  # norms that differ much: the largest inner product is not the smallest angle
        matrix *= np.random.default_rng(3).lognormal(0, 1, (1500, 1)).astype(np.float32)
    rows = listed(matrix)
    df = frame(spark, rows + BAD + [(950, [0.0] * 32)])
    got = ann.near_search(df, F.col("id") % 50 == 0, k=10).collect()
    want = brute(rows, {i for i, _ in rows if i % 50 == 0}, 10, False)
    near = {(q, i): s for q, _, i, s in want}
    assert len(got) == len(want)
    assert sum((r["query_id"], r["vec_id"]) in near for r in got) >= 0.9 * len(near)
    for r in got:
        if (r["query_id"], r["vec_id"]) in near:
            assert r["score"] == pytest.approx(near[r["query_id"], r["vec_id"]], rel=1e-12)


def test_near_search_of_equal_and_few_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(40)] + [(100, [-1.0, 0.0, 0.0])]
    got = ann.near_search(frame(spark, rows + rows[:3]), F.col("id").isin(5, 100), k=20).collect()
    found = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (5, 100)}
    assert found[5] == [i for i in range(21) if i != 5]
    assert found[100] == list(range(20))
    assert ann.near_search(frame(spark, []), F.lit(True)).count() == 0
    assert ann.near_search(frame(spark, [(1, [1.0])]), F.lit(True)).count() == 0
