"""Writers. Every one of them is a distributed write."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.graph import adjacency_line
from ..operators.paths import path_line
from ..operators.words import TOP_K, top_k
from ..session import materialise, scratch_path


def write_counts(counts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``word<TAB>count`` lines in the order of ``counts``."""
    line = F.concat_ws("\t", "word", F.col("cnt").cast("string"))
    counts.select(line.alias("value")).write.mode(mode).text(path)


def write_topk(counts: DataFrame, path: str, k: int = TOP_K, mode: str = "errorifexists") -> None:
    """``freq<TAB>word`` lines in rank order. The k lines make a single file."""
    line = F.concat_ws("\t", F.col("freq").cast("string"), "word")
    top_k(counts, k).coalesce(1).select(line.alias("value")).write.mode(mode).text(path)


def write_adjacency(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One line ``id d1 d2 ...`` per row of ``adjacency``: one per vertex, unless its parts were asked for."""
    rows.select(adjacency_line("id", F.col("dsts")).alias("value")).write.mode(mode).text(path)


def write_paths(paths: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One line ``a -> b -> c`` per pair in the order of the pairs; an empty line where there is no path."""
    line = F.coalesce(path_line("path"), F.lit(""))
    paths.orderBy("pair_id").select(line.alias("value")).write.mode(mode).text(path)


def write_table(
    rows: DataFrame, target: str | None, mode: str = "append", format: str = "parquet", table: bool = False,
    **options: str,
) -> None:
    """Write rows to a path, to a catalog table (``table=True``), or with a connector named by ``format``.

    A connector that knows its target from ``options`` takes None for ``target``. ``overwrite`` replaces the
    target whether or not it exists yet; ``append`` adds to it.
    """
    writer = rows.write.mode(mode).format(format).options(**options)
    if table:
        writer.saveAsTable(target)
    else:
        writer.save(target)


def next_id(spark: SparkSession, target: str, format: str = "parquet", table: bool = False, **options: str) -> int:
    """One more than the largest ``id`` of a sink table, 1 if there is none yet."""
    if table:
        if not spark.catalog.tableExists(target):
            return 1
        rows = spark.table(target)
    else:
        try:
            rows = spark.read.format(format).options(**options).load(target)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return 1
    largest = rows.agg(F.max("id")).first()[0]
    return 1 if largest is None else largest + 1


# Ids that one append may give out.
ID_BLOCK = 1 << 40


def _create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one already, also if another process creates it at the same time."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    whole = fs.makeQualified(target).toUri()
    if whole.getScheme() == "file":  # Hadoop looks and then creates there; the system call does both in one
        try:
            os.close(os.open(whole.getPath(), os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        fs.create(target, False).close()
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    return True


def reserve_block(spark: SparkSession, target: str, format: str = "parquet", **options: str) -> int:
    """The number of a block of ids that no other append to ``target`` has: ids from ``number * ID_BLOCK`` on.

    Every block has a file in the folder ``_ids`` of the target, which the store creates for one caller only. So any
    number of writers may ask at the same time, without a lock. A block is never given twice, even if its append fails.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_ids")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    taken = [int(f.getPath().getName()) for f in fs.listStatus(folder)] if fs.exists(folder) else []
    # The first block lies above the ids of appends that reserved nothing.
    number = max(taken) + 1 if taken else -(-next_id(spark, target, format, **options) // ID_BLOCK)
    while not _create_once(spark, f"{target}/_ids/{number}"):
        number += 1
    return number


def append_with_ids(rows: DataFrame, target: str, format: str = "parquet", **options: str) -> int:
    """Append rows with an ``id`` that no other row has, whatever else is appended meanwhile; the number of the append.

    Each append writes to a folder of its own, ``append=<number>``, as committers of one folder would clear away each
    other's files. Readers of ``target`` see the number as the column ``append``.
    """
    number = reserve_block(rows.sparkSession, target, format, **options)
    numbered = with_dense_row_id(rows, start=number * ID_BLOCK)
    numbered.write.format(format).options(**options).save(f"{target}/append={number}")
    return number


def with_row_id(rows: DataFrame, start: int = 1) -> DataFrame:
    """Add a unique ``id`` that rises from ``start`` with gaps.

    Ids are given by task, without a shuffle. For a later append pass ``next_id``.
    """
    return rows.select((F.monotonically_increasing_id() + start).alias("id"), *rows.columns)


def with_dense_row_id(rows: DataFrame, order_by: list[str] | None = None, start: int = 1) -> DataFrame:
    """Add ``id`` without gaps, in the order of some columns or in no particular order.

    The rows are written down with their place in their task. Only the row count of every task is then brought
    together: each task adds the rows of those before it. Sorting is spread over all tasks; the rows are written
    down before it too, as the sort looks at them twice.
    """
    spark = rows.sparkSession
    position = F.monotonically_increasing_id()
    low_bits = 33
    if order_by:
        whole = materialise(rows, scratch_path(spark, "unsorted-rows"))
        # Ties are spread by the other columns, so that rows that share a place do not make one large task.
        order = [*order_by, *(c for c in rows.columns if c not in order_by)]
        rows = whole.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = rows.select(
        F.shiftright(position, low_bits).alias("_task"),
        position.bitwiseAND((1 << low_bits) - 1).alias("_place"),
        *rows.columns,
    )
    placed = materialise(placed, scratch_path(spark, "placed-rows"))
    counts = placed.groupBy("_task").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(starts), "_task").select(
        (F.col("_before") + F.col("_place") + start).alias("id"), *rows.columns
    )
