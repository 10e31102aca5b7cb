"""Ranked lexical search without an index of the documents: their texts are scanned for the terms of all items.

1. The terms of the items are put into packs of bounded size. An Aho-Corasick automaton of a pack's terms, each between
   two blanks, is broadcast (as the terms; every task builds it). A text is read with every separator as a blank and a
   blank at both ends, so the automaton's hits are whole terms.
2. A first scan counts the documents, their terms, and in how many documents each term is. A second scan scores: each hit
   gives a term's occurrences in the document and leads to the items that hold the term.
3. A task keeps the best of every item while it reads; the lists of all tasks are merged in two steps.

A term is a run of ASCII letters, digits and characters beyond ASCII, only A-Z lower-cased. Null and empty texts have no
terms and are no documents for the counts. Items without terms, and items whose terms no document holds, have no rows.
Rows of one ``item`` id (null is an id too) are one item with the terms of all. Documents may share an id: each row is
ranked; a null id comes after the others. Equal scores go by id. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import materialise, scratch_path
from .ranks import first_ranks

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of terms in one pack, which is broadcast; an item with more is a pack of its own.
PACK_BYTES = 8_000_000

# Scores in memory at once, and hits of a block of documents times their items.
CELLS = 1 << 22
HITS = 1 << 20

# Factors of the score, as the formula of the query has them.
SCALE, K1, LENGTH_SHARE = 1_000_000_000, 8, 90

BLANKED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def guarded(text: bytes) -> bytes:
    """The text with blanks for separators and around it."""
    return b" " + text.translate(BLANKED) + b" "


def n_terms(text: bytes) -> int:
    """The number of terms in a guarded text."""
    inside = np.frombuffer(text, dtype=np.uint8) != 32
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def as_characters(text: bytes) -> str:
    """One character per byte, which is what the automaton reads."""
    return text.decode("latin-1")


class Pack:
    """The terms of some items, and the items of each term."""

    def __init__(self, items: list[tuple[object, list[str]]]):
        self.items = [item for item, _ in items]
        self.terms = sorted({t for _, terms in items for t in terms})
        place = {t: i for i, t in enumerate(self.terms)}
        of_term: list[list[int]] = [[] for _ in self.terms]
        for i, (_, terms) in enumerate(items):
            for t in terms:
                of_term[place[t]].append(i)
        self.sizes = np.array([len(x) for x in of_term], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.owners = np.concatenate([np.array(x, dtype=np.int64) for x in of_term])

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for i, term in enumerate(self.terms):
            made.add_word(as_characters(b" " + term.encode() + b" "), i)
        made.make_automaton()
        return made


def occurrences(automaton: ahocorasick.Automaton, text: bytes) -> Counter:
    """How often each term of the automaton is in a guarded text."""
    return Counter(map(itemgetter(1), automaton.iter(as_characters(text))))


def terms_of_items(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item, terms, bytes``: the distinct terms of every item that has any."""
    lowered = F.translate(F.col(f"`{text_col}`"), UPPER, LOWER)
    each = items.select(F.col(f"`{item_col}`").alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), 0)).alias("term"))
    return each.groupBy("item").agg(
        F.sort_array(F.collect_set("term")).alias("terms")
    ).withColumn("bytes", F.aggregate("terms", F.lit(0).cast("long"), lambda s, t: s + F.octet_length(t) + 2))


def packs_of(items: DataFrame, pack_bytes: int) -> tuple[DataFrame, list[int]]:
    """``items`` with a column ``pack``, and the packs; none with several items is above the bound."""
    total = items.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    n = max(1, math.ceil(2 * total / pack_bytes))
    while True:
        packed = items.withColumn("pack", F.pmod(F.xxhash64("item"), F.lit(n)))
        sizes = packed.groupBy("pack").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("items"))
        if n == 1 or sizes.where((F.col("bytes") > pack_bytes) & (F.col("items") > 1)).isEmpty():
            return packed, [r["pack"] for r in sizes.select("pack").collect()]
        n *= 2


def corpus_counts(docs: DataFrame, pack: Broadcast) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and in how many documents each term of the pack is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = pack.value.automaton()
        holding: Counter = Counter()
        n_docs = n_all = 0
        for batch in batches:
            for text in batch.column("text"):
                text = guarded(text.as_py() or b"")
                n = n_terms(text)
                n_docs += n > 0
                n_all += n
                holding.update(occurrences(automaton, text).keys())
        found = [(-1, n_docs), (-2, n_all), *holding.items()]
        columns = [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n"])

    parts = docs.select("text").mapInArrow(work, "term bigint, n bigint")
    sums = {r["term"]: r["n"] for r in parts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    holding = np.array([sums.get(i, 0) for i in range(len(pack.value.terms))], dtype=np.int64)
    return sums.get(-1, 0), sums.get(-2, 0), holding


class BestLists:
    """The best documents of every item so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.ones(n_items, dtype=np.int64)
        self.rows = [np.zeros((0, 4), dtype=np.int64)]
        self.waiting = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        """A matrix of documents by items. Documents below an item's list so far are left out."""
        doc, item = np.nonzero(scores >= self.least)
        self.rows.append(np.column_stack([item, -scores[doc, item], nulls[doc], ids[doc]]))
        self.waiting += len(doc)
        if self.waiting > max(CELLS // 4, 2 * self.k * len(self.least)):
            self.prune()

    def prune(self) -> np.ndarray:
        rows = np.concatenate(self.rows)
        rows = rows[np.lexsort(rows.T[::-1])]
        starts = np.searchsorted(rows[:, 0], rows[:, 0])
        rows = rows[np.arange(len(rows)) - starts < self.k]
        ends = np.searchsorted(rows[:, 0], np.arange(len(self.least)), "right")
        full = ends - np.searchsorted(rows[:, 0], np.arange(len(self.least))) == self.k
        self.least[full] = -rows[ends[full] - 1, 1]
        self.rows, self.waiting = [rows], 0
        return rows


def best_of_tasks(docs: DataFrame, pack: Broadcast, n_docs: int, n_all: int, weights: np.ndarray, k: int, item_type) -> DataFrame:
    """``item, doc, score``: of every task the best documents of every item of the pack."""
    arrow_item = to_arrow_type(item_type)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = pack.value
        automaton = items.automaton()
        best = BestLists(len(items.items), k)
        most = max(1, CELLS // len(items.items))
        ids, nulls, terms, values, lengths = [], [], [], [], []
        hits = 0

        def flush() -> None:
            nonlocal hits
            scores = np.zeros(len(ids) * len(items.items), dtype=np.int64)
            term = np.concatenate(terms)
            rows = np.repeat(np.arange(len(ids)) * len(items.items), lengths)
            size = items.sizes[term]
            # For each hit the items of its term, all hits after each other.
            owners = np.arange(size.sum()) + np.repeat(items.starts[term] - (np.cumsum(size) - size), size)
            np.add.at(scores, np.repeat(rows, size) + items.owners[owners], np.repeat(np.concatenate(values), size))
            best.add(scores.reshape(len(ids), -1), np.array(ids, dtype=np.int64), np.array(nulls, dtype=np.int64))
            for x in (ids, nulls, terms, values, lengths):
                x.clear()
            hits = 0

        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = guarded(text.as_py() or b"")
                found = occurrences(automaton, text)
                if not found:
                    continue
                term = np.fromiter(found.keys(), dtype=np.int64, count=len(found))
                tf = np.fromiter(found.values(), dtype=np.int64, count=len(found))
                m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n_terms(text) * n_docs) // n_all
                ids.append(doc or 0)
                nulls.append(doc is None)
                terms.append(term)
                values.append(weights[term] * ((SCALE * tf) // (1000 * tf + K1 * m)))
                lengths.append(len(found))
                hits += int(items.sizes[term].sum())
                if len(ids) == most or hits > HITS:
                    flush()
        if ids:
            flush()
        rows = best.prune()
        yield pa.RecordBatch.from_arrays(
            [pa.array([items.items[i] for i in rows[:, 0]], arrow_item), pa.array(rows[:, 3], mask=rows[:, 2] > 0), pa.array(-rows[:, 1])],
            ["item", "doc", "score"],
        )

    return docs.mapInArrow(work, f"item {item_type.simpleString()}, doc bigint, score bigint")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", pack_bytes: int = PACK_BYTES) -> DataFrame:
    """``item, rank, doc, score``: the ``k`` documents with the highest score above 0 for every item."""
    spark = docs.sparkSession
    item_type = items.schema[item_col].dataType
    described = materialise(terms_of_items(items, item_col, item_text_col), scratch_path(spark, "ranked-items"))
    packed, packs = packs_of(described, pack_bytes)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    best = spark.createDataFrame([], f"item {item_type.simpleString()}, doc bigint, score bigint")
    for number in sorted(packs):
        rows = packed.where(F.col("pack") == number).select("item", "terms").collect()
        pack = spark.sparkContext.broadcast(Pack([tuple(r) for r in rows]))
        n_docs, n_all, holding = corpus_counts(texts, pack)
        if not n_all:
            continue
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holding]
        best = best.union(best_of_tasks(texts, pack, n_docs, n_all, np.array(weights, dtype=np.int64), k, item_type))
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    return first_ranks(best, ["item"], order, k).select("item", "rank", "doc", "score")
