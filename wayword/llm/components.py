"""Connected groups of pairs, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.skew import BROADCAST_ROWS
from ..session import discard, materialise, materialise_counted, scratch_path


def by_count(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast if the counted rows, a few numbers each, allow it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``id, root`` for every end of an edge; ``root`` is the smallest id of its connected group.

    In each round every vertex moves to its smallest neighbour, if that is smaller than itself, and the edges move
    with their ends. An edge whose ends meet is gone. Each round is written to the shared folder, and the one before deleted.
    Pairs with a null end and pairs of equal ends are ignored.
    """
    spark = edges.sparkSession
    folder = scratch_path(spark, "components")

    def ordered(df: DataFrame) -> DataFrame:
        low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        return df.where("a <> b").select(low, high).distinct()

    left = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    left, n = materialise_counted(ordered(left), f"{folder}/edges-0")
    roots = None
    turn = 0
    while n or roots is None:
        turn += 1
        ends = left.select("a", "b").union(left.select("b", "a"))
        moves = ends.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to"))
        moves, n_moves = materialise_counted(moves.select("id", F.least("id", "to").alias("to")), f"{folder}/moves-{turn}")
        if roots is None:
            roots = materialise(moves.select("id", F.col("to").alias("root")), f"{folder}/roots-{turn}")
        else:
            step = by_count(moves.select(F.col("id").alias("root"), "to"), n_moves)
            roots = roots.join(step, "root", "left").select("id", F.coalesce("to", "root").alias("root"))
            roots = materialise(roots, f"{folder}/roots-{turn}")
            discard(spark, f"{folder}/roots-{turn - 1}")
        if n:
            for end in ("a", "b"):
                step = by_count(moves.select(F.col("id").alias(end), F.col("to").alias("_to")), n_moves)
                left = left.join(step, end).withColumn(end, F.col("_to")).select("a", "b")
            left, n = materialise_counted(ordered(left), f"{folder}/edges-{turn}")
            discard(spark, f"{folder}/edges-{turn - 1}")
        discard(spark, f"{folder}/moves-{turn}")
    discard(spark, f"{folder}/edges-{turn}")
    return roots
