"""Joins of similar lines and texts against brute force."""

import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayword.llm import jaccard, lines
from wayword.llm.components import connected
from wayword.session import shared_dir

VOCABULARY = [f"w{i}" for i in range(400)]


def text_of(rnd, n):
    return " ".join(rnd.choice(VOCABULARY) for _ in range(n))


def changed(rnd, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rnd.randrange(len(words))] = rnd.choice(VOCABULARY) + "x"
    return " ".join(words)


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def test_connected(spark):
    rnd = random.Random(4)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)]
    pairs += [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(50)] + [(5, 5), (None, 7), (1, None)]
    groups = Groups()
    for a, b in pairs:
        if a is not None and b is not None and a != b:
            groups.join(a, b)
    df = spark.createDataFrame(pairs + pairs[:9], "x long, y long")
    assert {tuple(r) for r in connected(df, "x", "y").collect()} == {(v, groups.find(v)) for v in groups.up}
    assert connected(df.limit(0), "x", "y").count() == 0


def brute_texts(rows):
    sets, classes = {}, defaultdict(list)
    for i, text in rows:
        words = (text or "").lower().split()
        n = min(5, len(words))
        s = frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if words else None
        sets[i] = s
        if s:
            classes[s].append(i)
    names = list(classes)
    groups, links = Groups(), defaultdict(int)
    for a in range(len(names)):
        groups.find(a)
        for b in range(a):
            common = len(names[a] & names[b])
            if common >= 0.8 * (len(names[a]) + len(names[b]) - common) - 1e-9:
                groups.join(a, b)
                links[a] += 1
                links[b] += 1
    members = defaultdict(list)
    for a, s in enumerate(names):
        members[groups.find(a)] += classes[s]
    place = {s: a for a, s in enumerate(names)}
    return {
        i: (min(members[groups.find(place[s])]), min(classes[s]), links[place[s]], len(classes[s])) if s else (i, i, 0, 1)
        for i, s in sets.items()
    }


def near_texts():
    rnd = random.Random(11)
    shared = text_of(rnd, 30)  # a passage in many texts that are not alike
    rows = [text_of(rnd, 60) + " " + shared for _ in range(60)]
    base = text_of(rnd, 200)
    rows += [changed(rnd, base, rnd.randrange(1, 4)) for _ in range(50)]
    rows += [base.upper()] * 30
    rows += ["one two three", "One  two\nthree", "one two", "", None, "  \n", "", "x" * 20000, text_of(rnd, 20000)]
    return list(enumerate(rows))


@pytest.mark.parametrize("small", [False, True])
def test_similar_texts(spark, monkeypatch, small):
    if small:  # several tiles and levels, and no broadcast
        monkeypatch.setattr(jaccard, "LEAF", 8)
        monkeypatch.setattr(jaccard, "TILE", 7)
        monkeypatch.setattr(jaccard, "CHUNK", 100)
        monkeypatch.setattr("wayword.llm.components.BROADCAST_ROWS", 0)
    rows = near_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"class": F.lit(1), "n": F.lit("x")})
    got = jaccard.similar_texts(df).collect()
    want = brute_texts(rows)
    assert {r["doc_id"]: (r["class_id"], r["copy_id"], r["n_links"], r["n_copies"]) for r in got} == want
    assert len(got) == len(rows)
    kept = jaccard.one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in want if want[i][0] == i)


def test_rows_that_share_a_key(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (1, "other words are in this text"), (None, text + " i"), (None, "no key here at all"), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert jaccard.similar_texts(df).count() == len(rows)
    kept = [tuple(r) for r in jaccard.one_of_each_group(df).collect()]
    # The null key comes first and stands for the group of similar texts.
    assert sorted(kept, key=repr) == sorted(
        [(None, text + " i"), (1, "other words are in this text"), (None, "no key here at all"), (2, None), (2, None)]
        if 0.8 <= 4 / 5 else [], key=repr
    )


def test_no_texts(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similar_texts(df).count() == 0
    assert jaccard.one_of_each_group(df).count() == 0
    assert lines.near_line_dedup(df).count() == 0


def test_runs_for_the_recall():
    assert jaccard.runs_needed(0.995, 1) < jaccard.runs_needed(0.995, 3)
    assert 1 - (1 - 0.632) ** jaccard.runs_needed(0.9, 1) >= 0.9


def test_shared_shingles():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(9)] + [np.empty(0, np.uint64)]
    common = jaccard.shared(sets, columns=7)
    for a in range(9):
        for b in range(9):
            if a != b:
                assert common[a, b] == len(np.intersect1d(sets[a], sets[b]))


# Lines


def words_of(line):
    return tuple(w for w in line.lower().replace("\t", " ").replace("\r", " ").split(" ") if w)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_lines(rows, near=True):
    first, seen = {}, []
    for i, text in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        for p, line in enumerate(text.split("\n")):
            words = words_of(line)
            if len(words) >= 5:
                seen.append((i, p, words))
                first.setdefault(words, (i, p))
    groups, names = Groups(), list(first)
    for a in range(len(names)):
        groups.find(a)
        for b in range(a if near else 0):
            long = max(len(names[a]), len(names[b]))
            if min(len(names[a]), len(names[b])) >= 0.8 * long and edits(names[a], names[b]) <= int(0.2 * long + 1e-9):
                groups.join(a, b)
    head, place = {}, {w: a for a, w in enumerate(names)}
    for w, at in first.items():
        g = groups.find(place[w])
        head[g] = min(head.get(g, at), at)
    gone = defaultdict(list)
    for i, p, w in seen:
        if (i, p) != head[groups.find(place[w])]:
            gone[i].append(p)
    return {i: sorted(p) for i, p in gone.items()}


def line_rows():
    rnd = random.Random(3)
    common = text_of(rnd, 40)
    rows = []
    for _ in range(40):
        parts = [text_of(rnd, rnd.randrange(5, 60)) for _ in range(3)] + ["short line", "short line"]
        if rnd.random() < 0.5:
            parts.insert(1, "  " + common.upper().replace(" ", " \t"))
        if rnd.random() < 0.7:
            parts.append(changed(rnd, common, 1))
        rows.append("\n".join(parts))
    rows += [None, "", "\n\n", rows[0], text_of(rnd, 3000), text_of(rnd, 600) + "\n" + text_of(rnd, 600)]
    return list(enumerate(rows))


def test_near_lines(spark):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"pos": F.lit(1), "id": F.lit("x")})
    got = {r["doc_id"]: r for r in lines.near_line_dedup(df).collect()}
    assert len(got) == len(rows)
    want, exact = brute_lines(rows), brute_lines(rows, near=False)
    removed = {i: r["removed"] or [] for i, r in got.items()}
    for i, text in rows:
        assert set(exact.get(i, [])) <= set(removed[i]) <= set(want.get(i, []))
        if text is None:
            assert got[i]["text"] is None
        else:
            parts = text.split("\n")
            assert got[i]["text"] == "\n".join(x for p, x in enumerate(parts) if p not in removed[i])
        assert got[i]["pos"] == 1 and got[i]["id"] == "x"
    # One changed word of forty is nearly always found.
    assert sum(map(len, removed.values())) >= 0.95 * sum(map(len, want.values()))


def test_large_group_of_near_lines(spark, monkeypatch):
    monkeypatch.setattr("wayword.llm.components.BROADCAST_ROWS", 0)
    rnd = random.Random(8)
    base = text_of(rnd, 80)
    rows = [(i, changed(rnd, base, 1) + "\nown words of text number " + " ".join(rnd.sample(VOCABULARY, 30))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    removed = {r["doc_id"]: r["removed"] for r in lines.near_line_dedup(df).collect()}
    assert removed.pop(0) is None
    assert sum(r == [0] for r in removed.values()) >= 0.97 * len(removed)


def test_equal_rows_lose_the_same_lines(spark):
    line = "one two three four five six"
    rows = [(2, line), (1, line + "\n" + line), (1, line + "\n" + line), (None, line.upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["text"]) for r in lines.near_line_dedup(df).collect()]
    assert sorted(got, key=repr) == sorted([(2, ""), (1, ""), (1, ""), (None, line.upper())], key=repr)


def test_simhashes_are_majorities_of_chosen_words(spark):
    rnd = random.Random(6)
    texts = [" ".join(f"u{rnd.randrange(9000)}" for _ in range(n)) for n in (5, 6, 9, 30, 100, 3000)] + ["a " * 9, "a b a b a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    words = lines.words_of(F.col("text"))
    chosen = df.select(lines.simhashes(words).alias("sims"), F.transform(words, lambda w: F.xxhash64(w)).alias("h"))
    for r in chosen.collect():
        circle = sorted(set(r["h"]))
        for k, sim in enumerate(r["sims"]):
            mark = -(1 << 63) + (k << 64) // lines.ORDERS
            begun = [h for h in circle if h >= mark] + [h for h in circle if h < mark]
            some = begun[:5] if len(begun) >= 5 else (begun * 5)[:5]
            assert sim == sum(1 << b for b in range(60) if sum(h >> b & 1 for h in some) >= 3)


def test_blocks_meet_by_pigeonhole(spark):
    rnd = random.Random(9)
    rows = []
    for _ in range(50):
        sims = [rnd.getrandbits(60) for _ in range(lines.ORDERS)]
        others = [rnd.getrandbits(60) for _ in range(lines.ORDERS)]
        order = rnd.randrange(lines.ORDERS)
        others[order] = sims[order]
        for bit in rnd.sample(range(60), lines.BLOCKS - 1):
            others[order] ^= 1 << bit
        rows.append((sims, others))
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    keys = [lines.block_keys(F.col(c)) for c in "ab"]
    assert df.where(F.arrays_overlap(*keys)).count() == len(rows)


def met_by_length(spark, cases):
    """The share of pairs with replaced words that meet, by words and replaced words."""
    rnd = random.Random(12)
    fresh = lambda: f"r{rnd.getrandbits(60)}"
    rows = []
    for n, d in cases:
        for _ in range(300):
            a = [fresh() for _ in range(n)]
            b = list(a)
            for i in rnd.sample(range(n), d):
                b[i] = fresh()
            rows.append((n, d, a, b))
    df = spark.createDataFrame(rows, "n int, d int, a array<string>, b array<string>")
    for c in "ab":
        df = lines.with_keys(df.withColumn("hashes", lines.hashes_of(F.col(c)))).withColumnRenamed("keys", f"keys_{c}")
        df = df.drop("hashes")
    met = df.select("n", "d", F.arrays_overlap("keys_a", "keys_b").cast("int").alias("met")).groupBy("n", "d").agg(F.avg("met"))
    return {(r[0], r[1]): r[2] for r in met.collect()}


def test_near_lines_meet_at_every_length(spark):
    exact = [(5, 1), (6, 1), (8, 1), (10, 1), (10, 2), (14, 2)]
    sampled = [(15, 3), (20, 2), (20, 4), (40, 4), (40, 8), (100, 10), (100, 20)]
    met = met_by_length(spark, exact + sampled)
    print(met)
    assert all(met[case] == 1 for case in exact)
    assert all(met[case] >= 0.9 for case in sampled), met


def test_short_lines_and_scripts_without_blanks(spark):
    chinese = "今天天气很好我们去公园散步"
    rows = [(1, "Les."), (2, " les. \nown"), (3, chinese), (4, chinese.replace("散", "跑")), (5, "完全不同的一句话在这里写着")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in lines.near_line_dedup(df, min_words=1).collect()}
    assert got == {1: None, 2: [0], 3: None, 4: [0], 5: None}


def test_lines_that_differ_in_an_inserted_word(spark):
    rows = [(1, "a b c d e f g h"), (2, "a x b c d e f g h"), (3, "a x b c d e f y g h"), (4, "k l m n o"), (5, "k l z n o")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in lines.near_line_dedup(df).collect()}
    assert got == {1: None, 2: [0], 3: [0], 4: None, 5: [0]}


def test_lines_that_share_words_only_are_no_pairs(spark, monkeypatch):
    """Of lines that meet, those whose words exclude the similarity are told apart before they are paired."""
    rnd = random.Random(21)
    shared = text_of(rnd, 30)
    texts = [shared + " " + " ".join(f"own{i}x{k}" for k in range(30)) for i in range(60)]
    texts += [changed(rnd, text, 1) for text in texts[:20]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = {}

    def counted(self, df, name, before=lines.Lines.counted):
        table, n = before(self, df, name)
        counts[name] = n
        return table, n

    monkeypatch.setattr(lines.Lines, "counted", counted)
    removed = {r["doc_id"]: r["removed"] for r in lines.near_line_dedup(df).collect()}
    assert all(removed[i] is None for i in range(60))
    assert sum(removed[i] == [0] for i in range(60, 80)) >= 19
    assert counts["pairs-rest"] <= 200, counts


@pytest.mark.parametrize("broadcast", [64_000_000, 0])
def test_crowded_buckets_give_the_same(spark, monkeypatch, broadcast):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r["doc_id"]: r["removed"] for r in lines.near_line_dedup(df).collect()}
    monkeypatch.setattr(lines, "HOT_SAMPLE", 1, raising=False)
    monkeypatch.setattr(lines, "HOT_MEMBERS", 3, raising=False)
    monkeypatch.setattr(lines, "BROADCAST_BYTES", broadcast)
    assert {r["doc_id"]: r["removed"] for r in lines.near_line_dedup(df).collect()} == want


def test_parities_exclude_no_similar_line(spark):
    rnd = random.Random(22)
    rows = []
    for n in (1, 5, 12, 40, 200, 700):
        for edits in {0, 1, n // 10, n // 5}:
            a = text_of(rnd, n)
            b = changed(rnd, a, edits)
            rows.append((a.split(), b.split(), edits))
    df = spark.createDataFrame(rows, "a array<string>, b array<string>, most int")
    df = df.select("most", *[lines.parities(lines.codes_of(F.col(c))).alias(c) for c in "ab"])
    assert df.where(~lines.near_parities("a", "b", F.col("most"))).count() == 0


def test_only_the_removed_places_stay_on_disk(spark):
    """Tables of single steps are deleted when no later step reads them."""
    folder = Path(shared_dir(spark)) / "wayword"
    before = set(folder.glob("*"))
    df = spark.createDataFrame(line_rows(), "doc_id long, text string")
    assert lines.near_line_dedup(df).where("removed IS NOT NULL").count() > 0
    left = [path.name.rsplit("-", 1)[0] for path in set(folder.glob("*")) - before]
    assert left.count("lines") == 0 and left.count("lines-removed") == 1
    assert not list(folder.glob("components-*/moves-*"))
