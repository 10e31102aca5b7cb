"""How far the sources of a language differ in their words.

1. Single-pass indexing in memory: a task counts the terms of its texts by (language, source) until ``BLOCK`` postings are
   in memory, then writes them as a run: postings sorted by term, cut by hash into shards of (language, term).
2. The runs of up to ``FAN_IN`` tasks are merged with a heap per shard, again and again until one run is left. The last
   merge knows in how many documents of its language a term is, and keeps those in at least ``MIN_DOCS``.
3. Smoothed frequencies ``p = 1 + floor(10**9 * (count + 1) / (N + V))`` compare a group with its language (part ``term``)
   and with every other source of the language (part ``pair``), by ``floor((p - q)**2 / q)``.
4. A pair's sum over all kept terms is taken as if both sources had none of them; corrections are added for the terms of
   one source (from its histogram of counts) and, streamed term by term, for those that both have. So absent terms cost
   nothing, and no vector over the vocabulary is made.

A term is a run of ASCII letters and characters beyond ASCII, only A-Z lower-cased. Null texts, languages and sources are
empty ones; a group without terms takes part with counts of 0. Repeated rows count as often as they are there. A language
with one source has no pairs, one without kept terms has pairs of value 0. An empty table gives no rows; other columns are
not read. All numbers are exact as long as a language has less than 9 * 10**15 terms.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby, repeat
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.skew import salted_join
from ..session import materialise, scratch_path
from .ranks import first_ranks

MIN_DOCS = 3
UNIT = 1_000_000_000

# Postings that a task holds in memory before it writes a run, and bytes of text that are cut into terms at once.
BLOCK = 800_000
PIECE = 1 << 20

# Runs (by the task that wrote them) that are merged at once, and bytes of text for each shard.
FAN_IN = 64
SHARD_BYTES = 16_000_000

# Pairs of postings that are corrected at once.
PAIRS = 1 << 19

# Bytes of names and totals of all groups up to which they are broadcast; beyond it they are joined to the postings.
BROADCAST_BYTES = 8_000_000

# Other sources in one block that a source's histogram is compared with.
SOURCES = 256

BLANKED = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

# A term's postings are the next ``sizes`` ones; a posting is a place in ``names`` and a count.
SEGMENT = (
    "pack bigint, shard int, lang string, names array<string>, terms array<binary>, docs array<bigint>, sizes array<int>, "
    "sources array<int>, counts array<bigint>"
)
SEGMENT_ARROW = pa.schema([
    ("pack", pa.int64()), ("shard", pa.int32()), ("lang", pa.string()), ("names", pa.list_(pa.string())),
    ("terms", pa.list_(pa.binary())), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
    ("sources", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())),
])
KEPT = "lang string, term string, sources array<string>, counts array<bigint>"
KEPT_ARROW = pa.schema([
    ("lang", pa.string()), ("term", pa.string()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    blanked = text.translate(BLANKED)
    start = 0
    while start < len(blanked):
        end = blanked.find(b" ", start + PIECE)
        end = len(blanked) if end < 0 else end
        yield blanked[start:end].split()
        start = end


class Postings:
    """Occurrences of the terms of every (language, source), and in how many documents of a language they are."""

    def __init__(self):
        self.counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, seen = self.counts[lang][source], set()
        before = len(counts)
        for terms in terms_of(text):
            counts.update(terms)
            seen.update(terms)
        self.docs[lang].update(seen)
        self.size += len(counts) - before

    def segments(self, pack: int, shards: int) -> Iterator[tuple]:
        """Rows of ``SEGMENT``, sorted by term."""
        for lang, sources in self.counts.items():
            postings: dict[bytes, list[tuple[str, int]]] = defaultdict(list)
            for source, counts in sources.items():
                for term, count in counts.items():
                    postings[term].append((source, count))
            seed = crc32(lang.encode())
            by_shard: dict[int, list[bytes]] = defaultdict(list)
            for term in sorted(postings):
                by_shard[crc32(term, seed) % shards].append(term)
            for shard, terms in by_shard.items():
                docs = self.docs[lang]
                yield segment(pack, shard, lang, terms, [docs[t] for t in terms], [postings[t] for t in terms])


def segment(pack: int, shard: int, lang: str, terms: list, docs: list, postings: list[Iterable[tuple[str, int]]]) -> tuple:
    sizes, flat = [len(x) for x in postings], [x for of_term in postings for x in of_term]
    names = {name: place for place, name in enumerate(sorted({x[0] for x in flat}))}
    sources = np.fromiter((names[x[0]] for x in flat), dtype=np.int32, count=len(flat))
    counts = np.fromiter((x[1] for x in flat), dtype=np.int64, count=len(flat))
    return pack, shard, lang, list(names), terms, np.array(docs), np.array(sizes, dtype=np.int32), sources, counts


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), schema)], schema=schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), schema)], schema=schema)


def write_runs(docs: DataFrame, shards: int, block: int) -> DataFrame:
    """Runs of all tasks; ``pack`` is the number of the task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings, task = Postings(), TaskContext.get().partitionId()
        for batch in batches:
            groups = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
            texts = batch.column("text")
            # Group by group, so that one group's counts are in the processor's cache.
            for i in sorted(range(len(groups)), key=groups.__getitem__):
                postings.add(*groups[i], texts[i].as_py())
                if postings.size >= block:
                    yield from batches_of(postings.segments(task, shards), SEGMENT_ARROW, 64)
                    postings = Postings()
        yield from batches_of(postings.segments(task, shards), SEGMENT_ARROW, 64)

    return docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(work, SEGMENT)


def merged(segments: list[dict], min_docs: int = 0) -> Iterator[tuple[bytes, int, dict[str, int]]]:
    """Term by term, in how many documents it is and its count in each source, from sorted segments of one language."""
    streams = []
    for place, s in enumerate(segments):
        ends = list(accumulate(s["sizes"]))
        streams.append(zip(s["terms"], repeat(place), [0, *ends], ends, s["docs"]))
    parts = [(s["names"], s["sources"], s["counts"]) for s in segments]
    for term, same in groupby(heapq.merge(*streams), key=itemgetter(0)):
        same = list(same)
        docs = sum(x[4] for x in same)
        if docs < min_docs:
            continue
        sums: dict[str, int] = {}
        for _, place, start, end, _ in same:
            names, sources, counts = parts[place]
            for i in range(start, end):
                name = names[sources[i]]
                sums[name] = sums.get(name, 0) + counts[i]
        yield term, docs, sums


def lists_of(column: pa.ChunkedArray) -> list[list]:
    """The lists of a column; numbers go through numpy, which is many times faster."""
    whole = column.combine_chunks()
    ends = whole.offsets.to_numpy()
    values = whole.values.to_numpy().tolist() if pa.types.is_integer(whole.type.value_type) else whole.values.to_pylist()
    return [values[start:end] for start, end in zip(ends[:-1], ends[1:])]


def by_language(table: pa.Table) -> Iterator[tuple[str, list[dict]]]:
    columns = {name: lists_of(table[name]) for name in ("names", "terms", "docs", "sizes", "sources", "counts")}
    of_lang: dict[str, list[dict]] = defaultdict(list)
    for row, lang in enumerate(table["lang"].to_pylist()):
        of_lang[lang].append({name: column[row] for name, column in columns.items()})
    yield from of_lang.items()


def merge_packs(runs: DataFrame) -> DataFrame:
    """The runs of ``FAN_IN`` packs become one, shard by shard."""

    def work(key: tuple, table: pa.Table) -> pa.Table:
        pack, shard = (x.as_py() for x in key)
        rows = []
        for lang, segments in by_language(table):
            terms, docs, postings = zip(*merged(segments))
            rows.append(segment(pack, shard, lang, list(terms), list(docs), [list(x.items()) for x in postings]))
        return pa.Table.from_batches(batches_of(rows, SEGMENT_ARROW), SEGMENT_ARROW)

    packed = runs.withColumn("next", F.floor(F.col("pack") / FAN_IN))
    return packed.groupBy("next", "shard").applyInArrow(work, SEGMENT)


def merge_last(runs: DataFrame, min_docs: int) -> DataFrame:
    """``KEPT``: the terms in enough documents of their language, with the sources that have them."""

    def work(table: pa.Table) -> pa.Table:
        rows = []
        for lang, segments in by_language(table):
            for term, _, sums in merged(segments, min_docs):
                rows.append((lang, term.decode(), list(sums), list(sums.values())))
        return pa.Table.from_batches(batches_of(rows, KEPT_ARROW, 4096), KEPT_ARROW)

    return runs.groupBy("shard").applyInArrow(work, KEPT)


def index(docs: DataFrame, shards: int, min_docs: int = MIN_DOCS, block: int | None = None) -> DataFrame:
    """The kept terms of ``lang, source, text`` without nulls, as a written table."""
    folder = scratch_path(docs.sparkSession, "divergence-runs")
    runs = materialise(write_runs(docs, shards, block or BLOCK), f"{folder}/0")
    packs = runs.agg(F.coalesce(F.max("pack"), F.lit(0)) + 1).first()[0]
    level = 0
    while packs > FAN_IN:
        level += 1
        runs = materialise(merge_packs(runs), f"{folder}/{level}")
        packs = math.ceil(packs / FAN_IN)
    return materialise(merge_last(runs, min_docs), f"{folder}/kept")


def share(count: Column, total: Column) -> Column:
    """``1 + floor(10**9 * count / total)`` for ``count <= total``, by long division in steps of 1000."""
    whole, rest = F.lit(0).cast("long"), count
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + F.call_function("div", rest, total), rest % total
    return whole + 1


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``share`` for arrays."""
    whole, rest = np.zeros_like(count), count
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // total, rest % total
    return whole + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def totals(docs: DataFrame, kept: DataFrame) -> tuple[DataFrame, bool]:
    """``lang, source, total, vocabulary, lang_total`` of every group, and whether they may be broadcast."""
    postings = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    found = postings.groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    groups = docs.select("lang", "source").distinct().join(found, ["lang", "source"], "left").fillna(0, ["total"])
    whole = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    groups = groups.join(whole, "lang").join(sizes, "lang", "left").fillna(0, ["vocabulary"])
    groups = materialise(groups, scratch_path(kept.sparkSession, "divergence-groups"))
    size = groups.agg(F.coalesce(F.sum(F.octet_length("lang") + F.octet_length("source") + 100), F.lit(0))).first()[0]
    return groups, size <= BROADCAST_BYTES


def with_totals(postings: DataFrame, groups: DataFrame, small: bool) -> DataFrame:
    """The totals of its group for every posting; a hot group is split where they are shuffled."""
    on = ["lang", "source"]
    return postings.join(F.broadcast(groups), on) if small else salted_join(postings, groups, on, "inner")


def term_part(kept: DataFrame, groups: DataFrame, small: bool, ranks: int) -> DataFrame:
    """``lang, source, item, value, rank``: the terms that a group has more of than its language."""
    in_lang = F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("in_lang")
    postings = kept.select("lang", "term", in_lang, F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    postings = postings.select("lang", F.col("x.sources").alias("source"), "term", F.col("x.counts").alias("count"), "in_lang")
    joined = with_totals(postings, groups, small)
    p = share(F.col("count") + 1, F.col("total") + F.col("vocabulary"))
    q = share(F.col("in_lang") + 1, F.col("lang_total") + F.col("vocabulary"))
    compared = joined.select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q")
    value = F.expr("(p - q) * (p - q) div q")
    scored = compared.select("lang", "source", F.col("term").alias("item"), value.alias("value"))
    return first_ranks(scored, ["lang", "source"], [F.desc("value"), F.asc("item")], ranks)


def shared_terms(kept: DataFrame, groups: DataFrame, small: bool) -> DataFrame:
    """``lang, source, item, value``: corrections for the terms that two sources have both."""
    known: Broadcast | None = None
    if small:
        known = kept.sparkSession.sparkContext.broadcast(
            {(r["lang"], r["source"]): (r["total"], r["vocabulary"]) for r in groups.collect()}
        )
        rows = kept.select("lang", "sources", "counts")
    else:
        posting = F.explode(F.arrays_zip("sources", "counts")).alias("x")
        flat = kept.select("lang", "term", posting).select("lang", "term", F.col("x.sources").alias("source"), F.col("x.counts").alias("count"))
        whole = F.collect_list(F.struct("source", "count", "total", "vocabulary")).alias("x")
        rows = with_totals(flat, groups, small).groupBy("lang", "term").agg(whole).select(
            "lang", F.col("x.source").alias("sources"), F.col("x.count").alias("counts"), F.col("x.total").alias("totals"),
            F.col("x.vocabulary").alias("vocabulary"),
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place: dict[tuple[str, str], int] = {}
            lists = batch.column("sources")
            ends = lists.offsets.to_numpy().astype(np.int64)
            sizes = np.diff(ends)
            langs = np.repeat(np.array(batch.column("lang").to_pylist(), dtype=object), sizes)
            owners = list(zip(langs.tolist(), lists.flatten().to_pylist()))
            group = np.array([place.setdefault(x, len(place)) for x in owners], dtype=np.int64)
            names = list(place)
            counts = batch.column("counts").flatten().to_numpy()
            if known:
                both = np.array([known.value[x] for x in names], dtype=np.int64).reshape(-1, 2)[group]
                sums = both[:, 0] + both[:, 1]
            else:
                sums = batch.column("totals").flatten().to_numpy() + batch.column("vocabulary").flatten().to_numpy()
            have, lack = shares(counts + 1, sums), shares(np.ones_like(sums), sums)
            # Every posting next to all postings of its term, a bounded number of pairs at a time.
            width = np.repeat(sizes, sizes)
            first = np.repeat(ends[:-1] - ends[0], sizes)
            reach = np.cumsum(width)
            start = 0
            while start < len(group):
                end = max(start + 1, int(np.searchsorted(reach, (reach[start - 1] if start else 0) + PAIRS, "right")))
                w = width[start:end]
                a = np.repeat(np.arange(start, end), w)
                b = np.arange(len(a)) + np.repeat(first[start:end] - (np.cumsum(w) - w), w)
                a, b = a[group[a] != group[b]], b[group[a] != group[b]]
                value = gap(have[a], have[b]) - gap(have[a], lack[b]) - gap(lack[a], have[b]) + gap(lack[a], lack[b])
                keys, at = np.unique(group[a] * len(names) + group[b], return_inverse=True)
                sum_of = np.zeros(len(keys), dtype=np.int64)
                np.add.at(sum_of, at, value)
                left, right = keys // max(1, len(names)), keys % max(1, len(names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i][0] for i in left], pa.string()), pa.array([names[i][1] for i in left], pa.string()),
                     pa.array([names[i][1] for i in right], pa.string()), pa.array(sum_of)],
                    ["lang", "source", "item", "value"],
                )
                start = end

    return rows.mapInArrow(work, "lang string, source string, item string, value bigint")


def own_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the sums as if the other source had no term, without those of absent terms twice.

    The row of a source and another one holds what the source's own terms change in the sum of (source, other) and in
    that of (other, source); the sum over terms that neither has goes to the first.
    """
    posting = F.explode(F.arrays_zip("sources", "counts")).alias("x")
    flat = kept.select("lang", posting).select("lang", F.col("x.sources").alias("source"), F.col("x.counts").alias("count"))
    histogram = flat.groupBy("lang", "source", "count").agg(F.count(F.lit(1)).alias("n")).groupBy("lang", "source").agg(
        F.collect_list(F.struct("count", "n")).alias("x")
    ).select("lang", "source", F.col("x.count").alias("counts"), F.col("x.n").alias("numbers"))
    one = groups.select("lang", "source", "total", "vocabulary").join(histogram, ["lang", "source"], "left")
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    block = F.pmod(F.xxhash64("source"), F.ceil(F.col("n_sources") / SOURCES))
    blocks = groups.join(sizes, "lang").groupBy("lang", block.alias("block")).agg(
        F.collect_list(F.struct("source", "total")).alias("x")
    ).select("lang", F.col("x.source").alias("others"), F.col("x.total").alias("other_totals"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size = max(1, row["vocabulary"])
                counts, numbers = np.array(row["counts"] or [], dtype=np.int64), np.array(row["numbers"] or [], dtype=np.int64)
                sums = np.array(row["other_totals"], dtype=np.int64) + size
                own = np.full(1, row["total"] + size)
                have, lack = shares(counts + 1, own)[:, None], shares(np.ones_like(own), own)
                other = shares(np.ones_like(sums), sums)[None, :]
                there = (numbers[:, None] * (gap(have, other) - gap(lack, other))).sum(axis=0)
                back = (numbers[:, None] * (gap(other, have) - gap(other, lack))).sum(axis=0)
                there += row["vocabulary"] * gap(lack, other[0])
                chosen = [i for i, other_source in enumerate(row["others"]) if other_source != row["source"]]
                names = [row["others"][i] for i in chosen]
                same = [row["source"]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * 2 * len(names), pa.string()), pa.array(same + names, pa.string()),
                     pa.array(names + same, pa.string()), pa.array(np.concatenate([there[chosen], back[chosen]]))],
                    ["lang", "source", "item", "value"],
                )

    columns = ["lang", "source", "total", "vocabulary", "counts", "numbers", "others", "other_totals"]
    return one.join(blocks, "lang").select(columns).mapInArrow(work, "lang string, source string, item string, value bigint")


def pair_part(kept: DataFrame, groups: DataFrame, small: bool) -> DataFrame:
    """``lang, source, item, value, rank``: the other sources of the language, all of them."""
    parts = own_terms(kept, groups).union(shared_terms(kept, groups, small))
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return sums.withColumn("rank", F.row_number().over(place))


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      ranks: int = 200, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, part, item, value, rank``."""

    def text_of(name: str, alias: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(alias)

    rows = docs.select(text_of(lang_col, "lang"), text_of(source_col, "source"), text_of(text_col, "text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    kept = index(rows, max(1, math.ceil(size / SHARD_BYTES)), min_docs)
    groups, small = totals(rows, kept)
    parts = [("pair", pair_part(kept, groups, small)), ("term", term_part(kept, groups, small, ranks))]
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs, terms = (df.withColumn("part", F.lit(name)).select(columns) for name, df in parts)
    return pairs.union(terms)
