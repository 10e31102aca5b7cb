"""CSV whose fields may hold line breaks, read by many tasks per file.

A file is read line by line in splits. Whether a line begins inside a quoted field depends on all lines before it, but
only by one bit, so a split is a map from that bit to the bit at its end:

1. Every split is read once for its map: it keeps the bit, turns it, or sets it.
2. The maps of the splits before it give the bit with which a split begins: what the last one that sets it says, turned as
   often as it was turned since. These are rows per split, not per line.
3. The splits are read again, now as records. A record that crosses borders leaves a piece in each split; the pieces of
   one record, at most two per split, are brought together.

Lines are taken in the order of the task that reads them, so the text is neither sorted nor shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.skew import BROADCAST_ROWS
from ..session import materialise, materialise_counted, scratch_path

SPLIT = ["file", "block"]
LINES = "file string, block bigint"


def quote_state(sep: str = ",", quote: str = '"', escape: str = '"') -> Callable[[bool, str], bool]:
    """A function from "a line begins inside a quoted field" and the line to the same for the next line.

    A quote opens a field only at the field's start. Behind a closing quote anything up to the separator belongs to the
    field, and so do quotes inside a field without quotes.
    """
    s, q, e = (re.escape(c) for c in (sep, quote, escape))
    inner = rf"(?:[^{q}]++|{q}{q})*+" if escape == quote else rf"(?:[^{q}{e}]++|{e}[{q}{e}]?+)*+"
    field = rf"(?:{q}{inner}{q}[^{s}]*+|[^{q}{s}][^{s}]*+|)"
    ends_inside = re.compile(rf"(?:{field}{s})*+{q}{inner}", re.DOTALL).fullmatch

    def after(inside: bool, line: str) -> bool:
        if quote not in line:
            return inside
        return ends_inside(quote + line if inside else line) is not None

    return after


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, block, value``: lines in the order of the file within every split; carriage returns stay."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of a task with the split that they belong to, in stretches."""
    for batch in batches:
        rows = batch.to_pylist()
        start = 0
        while start < len(rows):
            split = rows[start]["file"], rows[start]["block"]
            end = start
            while end < len(rows) and (rows[end]["file"], rows[end]["block"]) == split:
                end += 1
            yield split, rows[start:end]
            start = end


def split_maps(lines: DataFrame, after: Callable[[bool, str], bool]) -> DataFrame:
    """``file, block, outside, inside``: the bit at the end of a split for either bit at its start."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple, list[bool]] = {}
        for split, rows in by_split(batches):
            end = ends.setdefault(split, [False, True])
            for row in rows:
                end[:] = (after(bit, row["value"]) for bit in end)
        yield pa.RecordBatch.from_pylist(
            [{"file": f, "block": b, "outside": x, "inside": y} for (f, b), (x, y) in ends.items()],
            pa.schema([("file", pa.string()), ("block", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_())]),
        )

    return lines.mapInArrow(work, f"{LINES}, outside boolean, inside boolean")


def first_bits(maps: DataFrame) -> DataFrame:
    """``file, block, starts_inside`` for every split."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    turns = (F.col("outside") & ~F.col("inside")).cast("int")
    counted = maps.withColumn("turned", F.sum(turns).over(upto))
    sets = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("int").alias("bit"), "turned"))
    last = F.last(sets, ignorenulls=True).over(before)
    bit = F.coalesce(last["bit"], F.lit(0)) + F.coalesce(F.lag("turned").over(Window.partitionBy("file").orderBy("block")), F.lit(0))
    return counted.select(*SPLIT, ((bit - F.coalesce(last["turned"], F.lit(0))) % 2 != 0).alias("starts_inside"))


def with_first_bits(spark: SparkSession, path: str | list[str], bits: DataFrame, n_splits: int) -> DataFrame:
    """The lines with the bit of their split, still in the order of the file within it."""
    lines = numbered_lines(spark, path)
    if n_splits <= BROADCAST_ROWS:  # a row per split; the join leaves the lines where they are
        return lines.join(F.broadcast(bits), SPLIT)
    placed = lines.withColumn("place", F.monotonically_increasing_id())
    return placed.join(bits, SPLIT).repartition(*SPLIT).sortWithinPartitions(*SPLIT, "place").drop("place")


def pieces(lines: DataFrame, after: Callable[[bool, str], bool]) -> DataFrame:
    """``file, block, begins, ends, header, record``: records, and pieces of those that cross a border."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_split, inside, begins, header, held = None, False, True, False, []

        def piece(ends: bool) -> dict:
            made = {
                "file": open_split[0], "block": open_split[1], "begins": begins, "ends": ends, "header": header,
                "record": "\n".join(held),
            }
            held.clear()
            return made

        for split, rows in by_split(batches):
            made = []
            if split != open_split:
                if held:
                    made.append(piece(ends=False))
                open_split, inside = split, rows[0]["starts_inside"]
                begins, header = not inside, split[1] == 0
            for row in rows:
                held.append(row["value"])
                inside = after(inside, row["value"])
                if not inside:
                    made.append(piece(ends=True))
                    begins, header = True, False
            yield pa.RecordBatch.from_pylist(made, schema)
        if held:
            yield pa.RecordBatch.from_pylist([piece(ends=False)], schema)

    schema = pa.schema(
        [("file", pa.string()), ("block", pa.int64()), ("begins", pa.bool_()), ("ends", pa.bool_()), ("header", pa.bool_()),
         ("record", pa.string())]
    )
    return lines.mapInArrow(work, f"{LINES}, begins boolean, ends boolean, header boolean, record string")


def read_records(
    spark: SparkSession, path: str | list[str], sep: str = ",", quote: str = '"', escape: str = '"'
) -> DataFrame:
    """``record, header``: the text of every record of CSV files, with ``header`` for the first one of a file.

    Empty lines between records are left out. A quote that is never closed makes one record of the rest of its file, as
    it does for any reader.
    """
    after = quote_state(sep, quote, escape)
    folder = scratch_path(spark, "csv-records")
    maps = materialise(split_maps(numbered_lines(spark, path), after), f"{folder}/maps")
    bits, n_splits = materialise_counted(first_bits(maps), f"{folder}/bits")
    read = pieces(with_first_bits(spark, path, bits, n_splits), after)
    whole = read.where("begins AND ends").select("record", "header")
    # Within a split the end of a record comes before the beginning of another.
    crossing = materialise(read.where("NOT (begins AND ends)"), f"{folder}/crossing")
    upto = Window.partitionBy("file").orderBy("block", "begins").rowsBetween(Window.unboundedPreceding, 0)
    parts = F.array_sort(F.collect_list(F.struct("block", "begins", "record")))
    joined = crossing.withColumn("number", F.sum(F.col("begins").cast("int")).over(upto)).groupBy("file", "number").agg(
        F.array_join(F.transform(parts, lambda x: x["record"]), "\n").alias("record"), F.max("header").alias("header")
    )
    records = whole.union(joined.select("record", "header"))
    return records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where("record <> ''")


def read_csv_records(
    spark: SparkSession, path: str | list[str], sep: str = ",", quote: str = '"', escape: str = '"'
) -> DataFrame:
    """CSV with a header, all columns strings, as Spark's reader gives it with ``multiLine``; any number of tasks a file."""
    options = {"sep": sep, "quote": quote, "escape": escape, "multiLine": "true"}
    # Names come from the header of one file, so only its first record is read here.
    names = spark.read.options(header=True, **options).csv(path).schema.names
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    records = read_records(spark, path, sep, quote, escape).where("NOT header")
    return records.select(F.from_csv("record", F.lit(schema), options).alias("row")).select("row.*")
