"""Near copies by SimHash, ranked search and the audit of sources, against brute force."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wayword.llm import divergence, ranked, simhash


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Component by place: the smallest place that links of at most three bits reach."""
    names, todo = list(range(len(prints))), set(range(len(prints)))
    while todo:
        first = min(todo)
        queue = [first]
        todo.discard(first)
        while queue:
            at = queue.pop()
            names[at] = first
            met = [x for x in todo if (prints[x] ^ prints[at]).bit_count() <= 3]
            queue += met
            todo -= set(met)
    return names


def test_covering_masks_leave_out_any_three_bits():
    masks = simhash.covering(list(range(64)), 3)
    assert len(masks) == 15
    for bits in itertools.combinations(range(64), 3):
        assert any(not mask & sum(1 << b for b in bits) for mask in masks)
    some = [1, 5, 9, 30, 31, 32, 63]
    for bits in itertools.combinations(some, 2):
        assert any(not mask & sum(1 << b for b in bits) for mask in simhash.covering(some, 2))


def test_fingerprints():
    rnd = random.Random(3)
    texts = [None, "", " \t\n\x0b\f\r", "One", "one  TWO", "a b c", "a b c d e", "ÄÖ ß\x1c x İ Å ſ", "a\x00b c d"]
    texts += [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 60))) for _ in range(50)]
    for text in texts:
        assert simhash.fingerprint(text.encode() if text is not None else None) == brute_fingerprint(text)
    long = " ".join(str(rnd.random()) for _ in range(150_000))
    assert simhash.fingerprint(long.encode()) == brute_fingerprint(long)


def near_rows(rnd):
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.randrange(100, 300))]
        for _ in range(6):
            near = list(base)
            for _ in range(rnd.randrange(3)):
                near[rnd.randrange(len(near))] = rnd.choice(words)
            rows.append(" ".join(near))
    rows += [None, "", "  ", "x", "X", "x y", "Same text here again"] + ["same text here again"] * 20 + ["long " * 20000]
    rnd.shuffle(rows)
    return rows


def test_near_copies(spark):
    rows = near_rows(random.Random(8))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    docs = docs.withColumns({"id": F.lit("x"), "fingerprint": F.lit(1), "component": F.lit(None), "path": F.lit(2)})
    prints = [brute_fingerprint(t) for t in rows]
    names = brute_components(prints)
    assert len(set(names)) < len(set(prints))  # there are links between different fingerprints
    got = simhash.near_copies(docs).withColumn("hex", simhash.hex_of(F.col("fingerprint")))
    want = sorted((i, f"{p:016x}", c) for i, (p, c) in enumerate(zip(prints, names)))
    assert sorted((r["id"], r["hex"], r["component"]) for r in got.collect()) == want


@pytest.mark.parametrize("leaf", [2, 2048])
def test_all_links_in_crowded_buckets(spark, monkeypatch, leaf):
    """Many fingerprints around few centres: a third of all rows in one bucket of each table."""
    monkeypatch.setattr("wayword.llm.components.BROADCAST_ROWS", 0)
    rnd = random.Random(5)
    prints = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(12):
        centre = rnd.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(9))) for _ in range(40)}
    prints = sorted(prints)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fingerprint long")
    links = simhash.near_links(frame, leaf=leaf).collect()
    pairs = [tuple(int(np.int64(x).astype(np.uint64)) for x in r) for r in links]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    up = {p: p for p in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        up[max(find(a), find(b))] = min(find(a), find(b))
    names = brute_components(prints)
    assert [find(p) for p in prints] == [prints[k] for k in names]
    assert len(set(names)) > 12


def test_near_copies_of_odd_tables(spark):
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (2, None), (7, ""), (None, "q r s t u v w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["id"], r["component"]) for r in simhash.near_copies(docs).collect()), key=repr)
    assert got == sorted([(None, 4), (4, 4), (4, 4), (2, 2), (7, 2), (None, None)], key=repr)
    assert simhash.near_copies(docs.limit(0)).count() == 0


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_ranks(docs, items, k=10):
    words = [(i, Counter(re.findall(ranked.TERM, low(t)))) for i, t in docs]
    words = [(i, w, sum(w.values())) for i, w in words if w]
    n_docs, n_all = len(words), sum(n for _, _, n in words)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(re.findall(ranked.TERM, low(text)))
    rows = []
    for item, terms in wanted.items():
        scored = []
        for doc, tf, n in words:
            score = 0
            for t in terms & tf.keys():
                df = sum(t in w for _, w, _ in words)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += w * (10**9 * tf[t] // (1000 * tf[t] + 8 * (10 + 90 * n * n_docs // n_all)))
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        rows += [(item, r, d, -s) for r, (s, _, d) in enumerate(scored[:k], 1)]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_ranked_search(spark, monkeypatch, small):
    if small:  # several packs, blocks and prunings
        monkeypatch.setattr(ranked, "CELLS", 64)
        monkeypatch.setattr(ranked, "HITS", 50)
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ä", "ä", "x\u00a0y", "\u3000", "a1", "A1", "\U0001f600z", "w1w2"]
    ends = [" ", "  ", "-", "\n", "\x00", "_", ".", "\x7f", "@"]

    def text(n):
        return "".join(rnd.choice(vocabulary) + rnd.choice(ends) for _ in range(n))

    docs = [(i, text(rnd.randrange(1, 60))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "-- ."), (None, docs[3][1]), (None, docs[4][1]), (203, docs[3][1]), (204, text(30_000))]
    items = [(i, text(rnd.randrange(1, 12))) for i in range(15)]
    items += [(20, None), (21, ""), (22, "nowhere"), (3, "w7 w8"), (None, "w1 w2"), (None, "w3"), (23, "w1 w1 W1")]
    doc_frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item": F.lit(1), "score": F.lit("x")})
    item_frame = spark.createDataFrame(items, "item_id int, text string").withColumns({"terms": F.lit(1), "pack": F.lit(None)})
    got = ranked.ranked_search(doc_frame.repartition(5), item_frame, pack_bytes=60 if small else ranked.PACK_BYTES)
    assert [c for c, _ in got.dtypes] == ["item", "rank", "doc", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranks(docs, items)
    assert ranked.ranked_search(doc_frame.limit(0), item_frame).count() == 0
    assert ranked.ranked_search(doc_frame, item_frame.limit(0)).count() == 0


def brute_divergence(rows, ranks=200):
    terms_of = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text))) for lang, source, text in rows]
    held, groups = defaultdict(set), defaultdict(Counter)
    for i, (lang, source, terms) in enumerate(terms_of):
        groups[lang, source].update(terms)
        for t in terms:
            held[lang, t].add(i)
    kept = defaultdict(list)
    for (lang, t), docs in held.items():
        if len(docs) >= 3:
            kept[lang].append(t)
    out = []

    def p_of(counts, lang):
        total = sum(counts[t] for t in kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept[lang])) for t in kept[lang]}

    for (lang, source), counts in groups.items():
        p = p_of(counts, lang)
        whole = p_of(sum((c for (other, _), c in groups.items() if other == lang), Counter()), lang)
        found = {"pair": [], "term": []}
        for (other_lang, other), theirs in groups.items():
            if other_lang == lang and other != source:
                q = p_of(theirs, lang)
                found["pair"].append((-sum((p[t] - q[t]) ** 2 // q[t] for t in p), other.encode(), other))
        for t in p:
            if counts[t] and p[t] > whole[t]:
                found["term"].append((-((p[t] - whole[t]) ** 2 // whole[t]), t.encode(), t))
        for part, values in found.items():
            values = sorted(values)[: None if part == "pair" else ranks]
            out += [(lang, source, part, item, -value, r) for r, (value, _, item) in enumerate(values, 1)]
    return sorted(out)


def source_rows():
    rnd = random.Random(6)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Ä", "ä", "\U0001f600", "\uffee", "x\u00a0y", "İ"]
    rows = []
    for _ in range(150):
        lang, source = rnd.choice(["en", "en", "de"]), rnd.choice("abcdefg")
        mine = words[: 30 + 12 * "abcdefg".index(source)]
        rows.append((lang, source, " 9".join(rnd.choice(mine).upper() if rnd.random() < 0.1 else rnd.choice(mine) for _ in range(rnd.randrange(80)))))
    rows += [("en", "a", "hot cold " * 5000)] * 3 + [("en", "h", None), ("fr", "a", "x"), ("fr", "b", ""), ("it", "only", "solo solo")]
    rows += [(None, None, "null words here"), (None, "", "null words here"), ("", "z", "null words"), (None, "y", "12 34")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_source_divergence(spark, monkeypatch, small):
    if small:  # many runs, several merges, blocks of pairs, and totals that are joined
        for name, value in {"BLOCK": 50, "FAN_IN": 2, "SHARD_BYTES": 20_000, "PAIRS": 40, "BROADCAST_BYTES": 0, "PIECE": 20, "SOURCES": 2}.items():
            monkeypatch.setattr(divergence, name, value)
    rows = source_rows()
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(7)
    docs = docs.withColumns({"term": F.lit(1), "pack": F.lit("x"), "counts": F.lit(None), "value": F.lit(0)})
    got = divergence.source_divergence(docs, ranks=20)
    assert got.dtypes[4:] == [("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == brute_divergence(rows, 20)


def test_source_divergence_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.source_divergence(docs).count() == 0


def test_shares_are_exact(spark):
    rnd = random.Random(1)
    cases = [(c, t) for t in (1, 2, 999, 10**9 + 7, 9 * 10**15) for c in (1, t, rnd.randrange(1, t + 1))]
    want = [1 + 10**9 * c // t for c, t in cases]
    assert divergence.shares(*np.array(cases, dtype=np.int64).T).tolist() == want
    frame = spark.createDataFrame(cases, "c long, t long")
    assert [r[0] for r in frame.select(divergence.share(F.col("c"), F.col("t"))).collect()] == want
