"""Word sets and word maps as literals inside an expression.

A Spark map or array literal is searched from front to back. Here the words are spread over many short
buckets by CRC-32, so a lookup costs the same for ten words as for a hundred thousand. The whole table is one
JSON literal that Catalyst folds once per query, and no join or shuffle is needed.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

WORDS_PER_BUCKET = 4


def _n_buckets(n_words: int) -> int:
    return max(1, n_words // WORDS_PER_BUCKET)


def _slot(word: str, n: int) -> int:
    return zlib.crc32(word.encode("utf-8")) % n


def _bucket_of(table: Column, word: Column, n: int) -> Column:
    return F.get(table, (F.crc32(word) % n).cast("int"))


def in_words(word: Column, words: Iterable[str]) -> Column:
    """True where ``word`` is one of ``words`` (exact, case-sensitive)."""
    unique = sorted(set(words))
    if not unique:
        return F.lit(False)
    n = _n_buckets(len(unique))
    buckets: list[list[str]] = [[] for _ in range(n)]
    for w in unique:
        buckets[_slot(w, n)].append(w)
    table = F.from_json(F.lit(json.dumps(buckets)), "array<array<string>>")
    return F.array_contains(_bucket_of(table, word, n), word)


def lookup(word: Column, values: Mapping[str, object], value_type: str) -> Column:
    """The value stored for ``word``, null for an unknown word. ``value_type`` is a DDL type."""
    if not values:
        return F.lit(None).cast(value_type)
    n = _n_buckets(len(values))
    buckets: list[dict[str, object]] = [{} for _ in range(n)]
    for w in sorted(values):
        buckets[_slot(w, n)][w] = values[w]
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{value_type}>>")
    return F.try_element_at(_bucket_of(table, word, n), word)
