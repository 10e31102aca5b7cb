"""Near copies by SimHash: all pairs of fingerprints within a radius, by covering locality-sensitive hashing.

1. Every text becomes a fingerprint of 64 bits: a bit is set where more than half of the XXH64 hashes of the three-word
   shingles, repeats included, have it. Equal fingerprints go on as one.
2. Bit ``i`` of a fingerprint is named by a non-zero vector ``m(i)`` of ``radius + 1`` bits. There is a table for each
   non-zero vector ``v``; its mask keeps the bits whose name has an odd product with ``v``. At most ``radius`` differing
   bits have names that leave a dimension free, so for some ``v`` the mask keeps none of them: every pair within the
   radius collides in some table, for certain.
3. A bucket with more than ``LEAF`` fingerprints is split by the same construction over the bits that its table's mask
   leaves open. What is left then agrees on three quarters of the bits, so it holds at most ``2 ** 14`` of them.
4. A bucket gives a spanning forest of its links, never its pairs, and the forests of all buckets give the components.

Null texts and texts without words have the fingerprint zero and are linked like any other. A text of fewer words than a
shingle is one shingle. Rows are never merged: rows that share an id have a fingerprint each, and a repeated row is there
as often as in the input. A null id is never the smallest one; a component of null ids only has the id null. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import BROADCAST_ROWS, hot_keys, sized_join
from ..session import materialise, materialise_counted, scratch_path
from .components import by_count, connected

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 3

# Fingerprints of one bucket that are compared without a further split.
LEAF = 2048

# Hashes whose bits are counted at once.
CHUNK = 1 << 16


def shingles(text: bytes, n: int = SHINGLE) -> Iterator[bytes]:
    """The ``n``-word shingles of UTF-8 text, only A-Z lower-cased; words end at blanks and control blanks."""
    words = text.lower().split()
    if 0 < len(words) < n:
        return iter([b" ".join(words)])
    return map(b" ".join, zip(*[islice(words, i, None) for i in range(n)]))


def fingerprint(text: bytes | None) -> int:
    """The SimHash of a text as an unsigned number."""
    hashes = map(xxhash.xxh64_intdigest, shingles(text or b""), repeat(SEED))
    votes, n = np.zeros(BITS, dtype=np.int64), 0
    while len(chunk := np.fromiter(islice(hashes, CHUNK), dtype="<u8")):
        votes += np.unpackbits(chunk.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(chunk)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint`` of every row; the fingerprint is a signed long with the same bits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), dtype=np.uint64, count=len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return chosen.mapInArrow(work, f"id {kind}, fingerprint bigint")


def covering(positions: list[int], radius: int) -> list[int]:
    """Masks over the given bits of which one leaves out any ``radius`` of them; one mask per table."""
    names = {bit: 1 + place % (2 ** (radius + 1) - 1) for place, bit in enumerate(positions)}
    tables = range(1, 2 ** (radius + 1))
    return [sum(1 << bit for bit, name in names.items() if (name & v).bit_count() % 2) for v in tables]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def first_tables(prints: DataFrame, radius: int) -> DataFrame:
    """``fingerprint, path, key`` for every table; ``path`` counts the tables."""
    masks = F.array(*[F.lit(signed(m)) for m in covering(list(range(BITS)), radius)])
    return keyed(prints.select("fingerprint", F.posexplode(masks).alias("path", "mask")))


def second_tables(crowded: DataFrame, radius: int) -> DataFrame:
    """The same for rows of crowded buckets, over the bits that the masks of their tables leave open."""
    first = covering(list(range(BITS)), radius)
    inner = [[m | w for w in covering([i for i in range(BITS) if not m >> i & 1], radius)] for m in first]
    masks = F.array(*[F.array(*[F.lit(signed(w)) for w in row]) for row in inner])
    split = crowded.select("fingerprint", "path", F.posexplode(F.get(masks, F.col("path"))).alias("inner", "mask"))
    return keyed(split.withColumn("path", F.col("path") * len(first) + F.col("inner")))


def keyed(rows: DataFrame) -> DataFrame:
    return rows.select("fingerprint", "path", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"))


def forest(prints: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Both ends of links that connect all fingerprints of a bucket that are connected within it."""
    left, right, queue = [], [], []
    rest = prints
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        at = queue.pop()
        near = np.bitwise_count(rest ^ at) <= radius
        if near.any():
            met = rest[near]
            left.append(np.full(len(met), at))
            right.append(met)
            queue += list(met)
            rest = rest[~near]
    return left, right


def links_of(buckets: DataFrame, radius: int) -> DataFrame:
    """``a, b`` from ``prints``, the fingerprints of one bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.array([], np.uint64)], [np.array([], np.uint64)]
            lists = batch.column(0)
            # Bits are counted in unsigned numbers; of signed ones numpy takes the absolute value.
            flat, ends = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            for start, end in zip(ends[:-1], ends[1:]):
                left, right = forest(flat[start:end], radius)
                a += left
                b += right
            links = [pa.array(np.concatenate(side).view(np.int64)) for side in (a, b)]
            yield pa.RecordBatch.from_arrays(links, ["a", "b"])

    return buckets.select("prints").mapInArrow(work, "a bigint, b bigint")


def in_buckets(rows: DataFrame, few: DataFrame, n_few: int) -> DataFrame:
    """The buckets named by ``few`` with the list of their fingerprints."""
    chosen = rows.join(by_count(few, n_few), ["path", "key"])
    return chosen.groupBy("path", "key").agg(F.collect_list("fingerprint").alias("prints"))


def near_links(prints: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect all that are connected within the radius."""
    folder = scratch_path(prints.sparkSession, "simhash-links")
    rows = first_tables(prints, radius)
    counts = rows.groupBy("path", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = materialise(counts, f"{folder}/counts")
    few, crowds = counts.where(F.col("n") <= leaf), counts.where(F.col("n") > leaf)
    n_few, n_crowds = few.count(), crowds.count()
    links = links_of(in_buckets(rows, few.select("path", "key"), n_few), radius)
    if n_crowds:
        crowded = rows.join(by_count(crowds.select("path", "key"), n_crowds), ["path", "key"])
        inner = second_tables(crowded, radius)
        counts = inner.groupBy("path", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        few, n_few = materialise_counted(counts.select("path", "key"), f"{folder}/inner")
        links = links.union(links_of(in_buckets(inner, few, n_few), radius))
    return materialise(links, f"{folder}/links")


def near_copies(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint, component`` of every row; ``component`` is the smallest id that links reach."""
    folder = scratch_path(docs.sparkSession, "simhash")
    rows = materialise(fingerprints(docs, id_col, text_col), f"{folder}/prints")
    firsts = rows.groupBy("fingerprint").agg(F.min("id").alias("first"))
    firsts, n = materialise_counted(firsts, f"{folder}/distinct")
    roots = connected(near_links(firsts.select("fingerprint"), radius), "a", "b")
    roots, n_linked = materialise_counted(roots.withColumnRenamed("id", "fingerprint"), f"{folder}/roots")
    members = sized_join(firsts, roots, ["fingerprint"], "left", n_linked)
    members = members.withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = members.groupBy("root").agg(F.min("first").alias("component"))
    named = members.select("fingerprint", "root").join(smallest, "root").select("fingerprint", "component")
    hot = hot_keys(rows, ["fingerprint"]) if n > BROADCAST_ROWS else None
    return sized_join(rows, named, ["fingerprint"], "left", n, hot).select("id", "fingerprint", "component")


def hex_of(fingerprint: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
