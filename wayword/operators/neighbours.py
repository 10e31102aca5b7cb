"""Neighbouring rows of long ordered lists."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise, scratch_path

# What a row of the first step is: a pair, or the first or last row of a task, whose partner is in another one.
PAIR, FIRST, LAST = 0, 1, 2


def _same(left: pa.Array, right: pa.Array) -> pa.Array:
    """Equal as keys are: nulls are equal, and so are NaNs."""
    equal = pc.fill_null(pc.equal(left, right), False)
    equal = pc.or_(equal, pc.and_(pc.is_null(left), pc.is_null(right)))
    if pa.types.is_floating(left.type):
        equal = pc.or_(equal, pc.fill_null(pc.and_(pc.is_nan(left), pc.is_nan(right)), False))
    return equal


def consecutive_pairs(df: DataFrame, key: Sequence[str], order: Sequence[str], item: str) -> DataFrame:
    """``(src, dst)`` for every two rows of a key that follow each other, with the key and the order of the first.

    The rows are dealt to tasks by ranges of key and order, so a key with very many rows is spread like many keys with
    few. A task pairs its rows as it reads them; only its first and last row are brought together with those of the
    others. Rows of equal order follow by item; nulls come first, null keys are one key, and a key with one row gives no
    pair. Keys are columns of simple types.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, "neighbours")
    names = [f"k{i}" for i in range(len(key))] + [f"o{i}" for i in range(len(order))] + ["item"]
    chosen = [F.col(f"`{c}`").alias(n) for c, n in zip([*key, *order, item], names)]
    # Written down first, as ranges look at the rows twice.
    rows = materialise(df.select(chosen), f"{folder}/rows")
    # Rows that are equal in all of it are told apart by their place, so that they need not be in one range.
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(*names, "place").sortWithinPartitions(*names, "place").drop("place")
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{n} {t}" for n, t in fields.items()) + f", next {fields['item']}, kind int, task int"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = TaskContext.get().partitionId(), None

        def made(rows: pa.RecordBatch, after: pa.Array, kind: int) -> pa.RecordBatch:
            n = rows.num_rows
            extra = [after, pa.array([kind] * n, pa.int32()), pa.array([task] * n, pa.int32())]
            return pa.RecordBatch.from_arrays([*rows.columns, *extra], [*names, "next", "kind", "task"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is None:
                yield made(batch.slice(0, 1), batch.column("item").slice(0, 1), FIRST)
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            whole = table.to_batches()[0]
            left, right = whole.slice(0, whole.num_rows - 1), whole.slice(1)
            together = pa.array([True] * left.num_rows)
            for i in range(len(key)):
                together = pc.and_(together, _same(left.column(i), right.column(i)))
            yield made(left, right.column("item"), PAIR).filter(together)
            held = whole.slice(whole.num_rows - 1)
        if held is not None:
            yield made(held, held.column("item"), LAST)

    paired = materialise(ranged.mapInArrow(work, schema), f"{folder}/paired")
    # Two rows per task. A last row goes with the first row of the next task that has any.
    edges = paired.where(F.col("kind") != PAIR)
    following = Window.orderBy("task", "kind")
    ahead = {f"next_{n}": F.lead(n).over(following) for n in names}
    ahead["next_kind"] = F.lead("kind").over(following)
    joined = edges.withColumns(ahead).where((F.col("kind") == LAST) & (F.col("next_kind") == FIRST))
    for i in range(len(key)):
        joined = joined.where(F.col(f"k{i}").eqNullSafe(F.col(f"next_k{i}")))
    border = joined.withColumn("next", F.col("next_item")).select(paired.columns)
    pairs = paired.where(F.col("kind") == PAIR).union(border)
    given = [F.col(n).alias(c) for c, n in zip([*key, *order], names)]
    return pairs.select(*given, F.col("item").alias("src"), F.col("next").alias("dst"))
