"""Map elements: tags and node lists held inside one row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def tag_value(tags: Column | str, key: str) -> Column:
    """Value of the first tag with this key, null without one."""
    found = F.filter(tags, lambda t: t["_k"] == key)
    return F.get(found, F.lit(0))["_v"]


def is_highway(tags: Column | str) -> Column:
    """Any tag with the key ``highway``, whatever its value."""
    return F.coalesce(F.exists(tags, lambda t: t["_k"] == "highway"), F.lit(False))


def is_oneway(tags: Column | str) -> Column:
    """A tag ``oneway`` that says exactly ``yes``; ``-1``, ``true`` and ``1`` do not count."""
    return F.coalesce(F.exists(tags, lambda t: (t["_k"] == "oneway") & (t["_v"] == "yes")), F.lit(False))


def consecutive_pairs(items: Column) -> Column:
    """Neighbours ``(src, dst)`` of an ordered list; an empty list for fewer than two items or null."""
    last = F.size(items) - 1
    pairs = F.zip_with(
        F.slice(items, F.lit(1), last),
        F.slice(items, F.lit(2), last),
        lambda a, b: F.struct(a.alias("src"), b.alias("dst")),
    )
    return F.when(F.size(items) >= 2, pairs).otherwise(F.slice(F.array(F.struct(
        F.get(items, F.lit(0)).alias("src"), F.get(items, F.lit(0)).alias("dst"))), 1, 0))
