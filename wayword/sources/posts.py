"""Post files (CSV)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .records import read_csv_records


def read_posts(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, escape: str = '"'
) -> DataFrame:
    """CSV with a header; every column is a string and columns are used by name.

    Quotes inside a field are doubled unless ``escape`` says otherwise (``"\\\\"`` for a backslash). A file
    whose fields may hold line breaks is read by one task here; ``read_posts_in_splits`` has no such bound. Pass
    ``multi_line=False`` where no field holds a line break.
    """
    return spark.read.options(header=True, multiLine=multi_line, escape=escape).csv(path)


def read_posts_in_splits(spark: SparkSession, path: str | list[str], escape: str = '"') -> DataFrame:
    """The same with line breaks in fields, where any number of tasks reads a file.

    The lines are read twice, once to learn which splits begin inside a field. Records may also end with a carriage return
    and a line feed.
    """
    return read_csv_records(spark, path, escape=escape)
