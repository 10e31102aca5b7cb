"""Mixing sources to target weights.

A tree of some levels (such as domain, language, source) gets a budget of tokens. From the root down, every node shares
its budget among its children by their weights. A child whose whole subtree has too few tokens, even repeated for the
allowed number of epochs, takes all of them, and what it cannot use goes to its siblings. Since a node is never given
more than its subtree can use, a shortage is met by siblings first and reaches an ancestor only if none of them has
tokens left.

A leaf then repeats all its documents for the whole epochs that fit in its budget. Of one more epoch it takes the
documents in the order of a seeded hash of epoch and key, as long as their tokens fit. The cut is found by radix
selection: sums of tokens in bins of the hash narrow the place where the budget ends, so no leaf is ever ordered as a
whole.

Tokens are runs of characters other than white space. A null text has none. Null values of a level count as ``none``,
null keys as empty. Rows with the same key have the same place in the order and are taken or left together. An empty
table gives an empty result. Without a positive weight among siblings none of them is taken.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.skew import BROADCAST_ROWS
from ..session import materialise, scratch_path
from .arrow import no_clash

# Hexadecimal digits of the hash that order the documents, and how many of them a bin takes.
DIGITS = 13
BIN_DIGITS = 3

MISSING = "none"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast if the counted rows, which are narrow, allow it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def shares(children: DataFrame, parent: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Whole tokens for every child from ``budget`` (that of its parent), ``weight`` and ``room``."""
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    by_need = family.orderBy(
        F.when(F.col("weight") > 0, F.col("room") / F.col("weight")).otherwise(float("inf")), *names
    )
    before = F.coalesce(F.sum("room").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing))
    fills = F.col("room") * weight_left <= (F.col("budget") - before) * F.col("weight")
    children = children.withColumn("fills", fills & (F.col("weight") > 0))
    left = F.col("budget") - F.sum(F.when(F.col("fills"), F.col("room")).otherwise(0)).over(family)
    weights = F.sum(F.when(F.col("fills"), 0.0).otherwise(F.col("weight"))).over(family)
    part = F.floor(F.coalesce(F.try_divide(left * F.col("weight"), weights), F.lit(0.0))).cast("long")
    given = F.when(F.col("fills"), F.col("room")).otherwise(F.greatest(F.lit(0), F.least("room", part)))
    return children.select(*names, given.alias("budget"))


def weight_of(names: Sequence[str], weights: Mapping[tuple[str, ...], float]) -> Column:
    """The weight of the node on the path ``names``; 1 where none is given."""
    chosen = F.lit(1.0)
    for path, weight in weights.items():
        if len(path) == len(names):
            fits = F.lit(True)
            for name, value in zip(names, path):
                fits &= F.col(name) == F.lit(value)
            chosen = F.when(fits, F.lit(float(weight))).otherwise(chosen)
    return chosen


def budgets(leaves: DataFrame, names: Sequence[str], budget: int, epochs: int,
            weights: Mapping[tuple[str, ...], float]) -> DataFrame:
    """Adds ``budget`` to every leaf; ``leaves`` has the path ``names`` and ``tokens``."""
    room = F.col("tokens") * F.lit(epochs)
    nodes = None
    for depth in range(1, len(names) + 1):
        path, parent = list(names[:depth]), list(names[: depth - 1])
        children = leaves.groupBy(*path).agg(F.sum(room).alias("room"))
        children = children.withColumn("weight", weight_of(path, weights))
        if nodes is None:
            total = Window.partitionBy(F.lit(0))
            children = children.withColumn("budget", F.least(F.lit(int(budget)), F.sum("room").over(total)))
        else:
            children = children.join(nodes, parent)
        nodes = shares(children, parent, path)
    return leaves.join(nodes, list(names))


def order_of(key: Column, epoch: Column, seed: int) -> Column:
    """The place of a document in an epoch of its leaf, as hexadecimal digits."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return F.substring(F.md5(text), 1, DIGITS)


def leaf_rows(df: DataFrame, levels: Mapping[str, Column], key_col: str, text_col: str) -> DataFrame:
    path = [F.coalesce(c.cast("string"), F.lit(MISSING)).alias(f"_{n}") for n, c in levels.items()]
    return df.select(F.col(key_col).alias("_key"), *path, token_count(F.col(text_col)).alias("_tokens"))


def plan(df: DataFrame, levels: Mapping[str, Column], share: float, epochs: int = 1,
         weights: Mapping[tuple[str, ...], float] | None = None, key_col: str = "doc_id", text_col: str = "text",
         seed: int = 42) -> DataFrame:
    """One row per leaf: its path, ``tokens``, ``budget``, ``whole`` epochs and the hash ``cut`` of one more.

    ``levels`` are the levels of the tree from the root on, as columns of ``df``. The budget is ``share`` of all
    tokens. ``weights`` has the weight of nodes by their path; siblings without one weigh 1.
    """
    spark = df.sparkSession
    names = [f"_{n}" for n in levels]
    rows = materialise(leaf_rows(df, levels, key_col, text_col), scratch_path(spark, "mixing-rows"))
    leaves = rows.groupBy(*names).agg(F.sum("_tokens").alias("tokens"))
    total = rows.agg(F.coalesce(F.sum("_tokens"), F.lit(0))).first()[0]
    leaves = budgets(leaves, names, int(total * share), epochs, weights or {})
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long")
    leaves = leaves.withColumn("whole", whole)
    leaves = leaves.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    leaves = materialise(leaves, scratch_path(spark, "mixing-leaves"))
    n_leaves = leaves.count()

    # What is still to be ordered: of every leaf the documents in the bin where its budget ends.
    place = order_of(F.col("_key"), F.col("whole"), seed)
    asked = leaves.where("rest > 0").select(*names, "whole", "rest")
    waiting = rows.join(small(asked, n_leaves), names).select(*names, "rest", "_tokens", place.alias("at"))
    for digits in (BIN_DIGITS, 2 * BIN_DIGITS):
        bins = waiting.groupBy(*names, "rest", F.substring("at", 1, digits).alias("bin"))
        bins = bins.agg(F.sum("_tokens").alias("inside"))
        upto = F.sum("inside").over(Window.partitionBy(*names).orderBy("bin"))
        crossing = bins.withColumn("upto", upto).where(F.col("upto") > F.col("rest"))
        ends = crossing.groupBy(*names).agg(
            F.min(F.struct("upto", "bin", "inside")).alias("end"), F.first("rest").alias("rest")
        )
        ends = ends.select(
            *names, "end.bin", (F.col("rest") - F.col("end.upto") + F.col("end.inside")).alias("left")
        )
        ends = materialise(ends, scratch_path(spark, "mixing-bins"))
        inside = waiting.withColumn("bin", F.substring("at", 1, digits)).join(small(ends, n_leaves), [*names, "bin"])
        waiting = inside.select(*names, F.col("left").alias("rest"), "_tokens", "at")
    upto = F.sum("_tokens").over(Window.partitionBy(*names).orderBy("at").rangeBetween(Window.unboundedPreceding, 0))
    # The first document that does not fit; all before it are taken.
    out = waiting.withColumn("upto", upto).where(F.col("upto") > F.col("rest"))
    cuts = out.groupBy(*names).agg(F.min("at").alias("cut"))
    planned = leaves.join(cuts, names, "left")
    # Without a cut there is no rest, and nothing lies before an empty text.
    planned = planned.select(*names, "tokens", "budget", "whole", F.coalesce("cut", F.lit("")).alias("cut"))
    return materialise(planned, scratch_path(spark, "mixing-plan"))


def copies(df: DataFrame, levels: Mapping[str, Column], planned: DataFrame, key_col: str = "doc_id",
           text_col: str = "text", seed: int = 42) -> DataFrame:
    """Adds ``n_tokens`` and ``copies``: how often each row is taken. No row is moved for it."""
    no_clash(df, ["n_tokens", "copies"])
    names = [f"_{n}" for n in levels]
    path = [F.coalesce(c.cast("string"), F.lit(MISSING)).alias(f"_{n}") for n, c in levels.items()]
    # The row is one column meanwhile, so that no name of it can be mistaken.
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(key_col).alias("key"),
        token_count(F.col(text_col)).alias("n_tokens"), *path,
    )
    rows = rows.join(small(planned.select(*names, "whole", "cut"), planned.count()), names, "left")
    taken = F.col("whole") + (order_of(F.col("key"), F.col("whole"), seed) < F.col("cut")).cast("long")
    return rows.select("row.*", "n_tokens", taken.alias("copies"))
