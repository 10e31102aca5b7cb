"""Map files (OpenStreetMap XML)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NODE_SCHEMA = "_id bigint, _lat double, _lon double"
WAY_SCHEMA = "_id bigint, nd array<struct<_ref: bigint>>, tag array<struct<_k: string, _v: string>>"


def _read_elements(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    # A given schema saves the pass that would infer one, and keeps the columns the same for every file: a
    # tag that happens not to repeat would otherwise be read as a struct instead of a list.
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``<node>`` elements: id and position."""
    return _read_elements(spark, path, "node", NODE_SCHEMA)


def read_ways(spark: SparkSession, path: str) -> DataFrame:
    """``<way>`` elements: id, node references in order, and tags."""
    return _read_elements(spark, path, "way", WAY_SCHEMA)
