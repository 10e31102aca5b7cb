"""URL filters, mixing and personal data, and the registered queries."""

import hashlib
import itertools
import random
import re

import pytest
from oracle_check import DATA, compare, oracle_connection
from pyspark.sql import functions as F

from wayword.llm import mixing, private, urls
from wayword.llm.queries import ORACLE, QUERIES, URL_RULES

SF_DIR = DATA / "sf0.001"


# URLs

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://A.Example.ORG/es/1?x#y", "http://example.org/en/12", "x://org",
    "http://org/", "http://example.org?/es/", "http://xorg/", "a://b.com/fr/://c.com/de/", "http://É.com/de/1\n2",
    "http://a.com:80/de/", "http://a.com/de", "http://sub.example.org/es/", "http://..com/de/#", "http://com/de/?a",
]


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in URL_RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if best is None or len(rule) > len(best[0]):
                best = rule, verdict
    return host, path, best


def test_given_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS)], "page_id long, url string")
    index = spark.createDataFrame([], "anchor string, tokens array<string>, confidence double")
    got = {r["page_id"]: r for r in urls.judge(df, index, URL_RULES).collect()}
    assert len(got) == 2 * len(URLS)
    for i, url in enumerate(URLS + URLS):
        host, path, best = brute_rule(url)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert (got[i]["rule"], got[i]["verdict"]) == (best or (None, "allow"))


def labelled_urls():
    rnd = random.Random(2)
    rows = []
    for i in range(600):
        host = rnd.choice(["a.net", "b.net", "c.net"])
        kind = rnd.choice(["news", "offers"])
        bad = host == "b.net" and kind == "offers" and rnd.random() < 0.9
        rows.append((f"http://www.{host}/{kind}/{i}", bad))
    return rows


def test_mined_rules(spark):
    rows = labelled_urls() + [(None, True), ("http://b.net/offers", None)]
    index = urls.mine(spark.createDataFrame(rows, "url string, bad boolean"))
    rules = [(set(r["tokens"]), r["confidence"], r["anchor"]) for r in index.collect()]
    ordinary = {"host:net", "host:www", "path:0"}
    assert rules and all({"host:b", "path:offers"} <= t and a not in ordinary for t, _, a in rules)
    # The most general rule stays, and no rule that says the same with more tokens.
    assert {"host:b", "path:offers"} in [t for t, _, _ in rules]
    assert not [t for t, _, _ in rules if t > {"host:b", "path:offers"} and _ <= rules[0][1]]
    plain = [(u, b) for u, b in rows if u and b is not None]
    hits = [b for u, b in plain if "www.b.net/offers" in u]
    found = next(c for t, c, _ in rules if t == {"host:b", "path:offers"})
    assert found == pytest.approx(sum(hits) / len(hits))
    asked = spark.createDataFrame(
        [("http://x.b.net/offers/9",), ("http://b.net/news/9",), ("http://a.net/offers",), ("http://x.b.net/offers/9",)],
        "url string",
    )
    got = sorted((r["url"], r["verdict"]) for r in urls.judge(asked, index, []).collect())
    assert got == [
        ("http://a.net/offers", "allow"), ("http://b.net/news/9", "allow"),
        ("http://x.b.net/offers/9", "block"), ("http://x.b.net/offers/9", "block"),
    ]


def test_a_bad_host_stays_a_rule_as_the_table_grows(spark):
    good = [(f"http://h{i % 500}.example/x{i % 700}", False) for i in range(6000)]
    rows = [(f"http://spam.example/{i}", True) for i in range(10)]
    rows += [(f"http://few.example/{i}", True) for i in range(9)]
    index = urls.mine(spark.createDataFrame(rows + good, "url string, bad boolean"))
    asked = spark.createDataFrame([("http://spam.example/y",), ("http://few.example/y",), ("http://h1.example/x1",)], "url string")
    got = {r["url"]: r["verdict"] for r in urls.judge(asked, index, []).collect()}
    assert got == {"http://spam.example/y": "block", "http://few.example/y": "allow", "http://h1.example/x1": "allow"}


def test_equal_bad_urls_with_many_words(spark):
    """Ten equal bad URLs of 40 words, and again with each word in some good URL too."""
    words = [f"word{i}" for i in range(40)]
    rows = [("http://spam.example/" + "/".join(words), True)] * 10
    index = urls.mine(spark.createDataFrame(rows, "url string, bad boolean"))
    asked = [("http://x.net/word7",), ("http://x.net/other",), ("http://spam.example/",)]
    got = {r["url"]: r["verdict"] for r in urls.judge(spark.createDataFrame(asked, "url string"), index, []).collect()}
    assert got == {"http://x.net/word7": "block", "http://x.net/other": "allow", "http://spam.example/": "block"}
    assert {r["confidence"] for r in index.collect()} == {1.0} and index.count() == 42


def brute_rules(rows, min_count, min_confidence):
    """All sets of tokens with enough bad URLs and confidence, but those with a proper subset as confident."""
    sets = [(frozenset(t), bad) for t, bad in rows]
    tokens = sorted(set().union(*(s for s, _ in sets)))
    rules = {}
    for size in range(1, len(tokens) + 1):
        for combination in itertools.combinations(tokens, size):
            wanted = frozenset(combination)
            labels = [bad for s, bad in sets if wanted <= s]
            if sum(labels) >= min_count and sum(labels) / len(labels) >= min_confidence:
                rules[wanted] = sum(labels) / len(labels)
    return {r: c for r, c in rules.items() if not any(o < r and rules[o] >= c for o in rules)}


@pytest.mark.parametrize("seed", range(3))
def test_mined_verdicts_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = list("abcdefgh")
    texts = []
    for _ in range(60):
        chosen = [w for w in words if rnd.random() < 0.4]
        chosen += ["x", "y"] if "a" in chosen else []  # always together
        texts.append((chosen, "b" in chosen and "c" in chosen and rnd.random() < 0.8 or rnd.random() < 0.1))
    rows = [("http://h/" + "/".join(t), bad) for t, bad in texts]
    index = urls.mine(spark.createDataFrame(rows + rows[:7], "url string, bad boolean"), min_confidence=0.5, min_count=4)
    sets = [([*t, "host"], bad) for t, bad in texts + texts[:7]]
    rules = brute_rules(sets, 4, 0.5)
    asked = [[w for w in [*words, "x", "y"] if rnd.random() < 0.3] for _ in range(80)]
    frame = spark.createDataFrame([("http://h/" + "/".join(t),) for t in asked], "url string")
    got = {r["url"]: r["verdict"] for r in urls.judge(frame, index, []).collect()}
    for t in asked:
        want = "block" if any(r <= {*t, "host"} for r in rules) else "allow"
        assert got["http://h/" + "/".join(t)] == want, t


def test_nothing_to_mine(spark):
    index = urls.mine(spark.createDataFrame([], "url string, bad boolean"))
    assert index.count() == 0
    assert urls.judge(spark.createDataFrame([], "url string"), index, URL_RULES).count() == 0


# Mixing

def levels():
    return {"domain": F.col("d"), "lang": F.col("l"), "source": F.col("s")}


def mix_rows(n=400):
    rnd = random.Random(1)
    rows = [(i, "w " * rnd.randrange(0, 30), rnd.choice("ab"), rnd.choice(["x", "y", None]), rnd.choice(["1", "1", "1", "2"])) for i in range(n)]
    return rows + [(5, None, "a", "x", "1"), (None, "some words", None, None, None), (7, "w w w", "a", "x", "1"), (7, "w w w", "a", "x", "1")]


def brute_mix(rows, share, epochs, weights):
    leaves = {}
    for key, text, *path in rows:
        path = tuple(p if p is not None else "none" for p in path)
        leaves.setdefault(path, []).append((key, len((text or "").split())))
    size = {p: sum(n for _, n in docs) for p, docs in leaves.items()}
    budget = {(): min(int(sum(size.values()) * share), sum(size.values()) * epochs)}
    for depth in range(3):
        for parent in [p for p in budget if len(p) == depth]:
            children = sorted({p[: depth + 1] for p in size if p[:depth] == parent})
            room = {c: epochs * sum(n for p, n in size.items() if p[: depth + 1] == c) for c in children}
            left, waiting, given = budget[parent], children, {}
            while True:  # fill the children that need less than their share, until none is left
                total = sum(weights.get(c, 1.0) for c in waiting)
                full = [c for c in waiting if room[c] * total <= left * weights.get(c, 1.0)]
                if not full:
                    break
                first = min(full, key=lambda c: (room[c] / weights.get(c, 1.0), c[-1]))
                given[first] = room[first]
                left -= room[first]
                waiting = [c for c in waiting if c != first]
            given |= {c: int(left * weights.get(c, 1.0) / total) for c in waiting}
            budget |= given
    out = []
    for path, docs in leaves.items():
        whole = budget[path] // size[path] if size[path] else 0
        rest = budget[path] - whole * size[path]
        at = {k: hashlib.md5(f"42|{whole}|{'' if k is None else k}".encode()).hexdigest()[:13] for k, _ in docs}
        cut, used = "", 0
        if rest:
            for place in sorted(set(at.values())):
                used += sum(n for k, n in docs if at[k] == place)
                if used > rest:
                    cut = place
                    break
        out += [(k, n, whole + (at[k] < cut)) for k, n in docs]
    return sorted(out, key=repr), sum(budget[p] for p in leaves)


@pytest.mark.parametrize("share, epochs, weights", [
    (0.5, 1, {}), (1.2, 2, {("a",): 3.0, ("a", "x"): 0.5}), (0.9, 3, {("b",): 9.0, ("b", "y", "2"): 4.0}), (5.0, 2, {}), (0.0, 1, {}),
])
def test_mixing(spark, share, epochs, weights):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, d string, l string, s string").withColumn("whole", F.lit(1))
    plan = mixing.plan(df, levels(), share, epochs, weights)
    got = mixing.copies(df, levels(), plan)
    assert got.columns == [*df.columns, "n_tokens", "copies"]
    want, budget = brute_mix(rows, share, epochs, weights)
    assert sorted(((r["doc_id"], r["n_tokens"], r["copies"]) for r in got.collect()), key=repr) == want
    taken = sum(n * c for _, n, c in want)
    assert taken <= budget


def test_a_shortage_goes_to_siblings_first(spark):
    rows = [(i, "w " * 100, "a", "x", "small" if i == 0 else "large") for i in range(20)]
    rows += [(100 + i, "w " * 100, "b", "x", "other") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, d string, l string, s string")
    plan = {tuple(r[:3]): r["budget"] for r in mixing.plan(df, levels(), 0.5).collect()}
    assert plan == {("a", "x", "small"): 100, ("a", "x", "large"): 900, ("b", "x", "other"): 1000}


def test_no_rows_to_mix(spark):
    df = spark.createDataFrame([], "doc_id long, text string, d string, l string, s string")
    assert mixing.copies(df, levels(), mixing.plan(df, levels(), 0.5)).count() == 0


# Personal data

FORMS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute_spans(text):
    found = []
    for n, (kind, form) in enumerate(FORMS.items()):
        found += [(m.start(), n, m.end()) for m in form.finditer(text or "") if good(kind, m[0])]
    return ",".join(f"{private.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_forms(spark):
    rnd = random.Random(1)
    letters = "a1@.+- (é😀\n0_5%B-"
    rows = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randrange(0, 60)))) for i in range(1500)]
    rows += [
        (9001, None), (9002, ""), (9003, "9" * 4000 + " 1.2.3.4.5.6.7.8 a@b.c_d@e.f 4111 1111-1111 1111"),
        (9004, "a" * 30000 + "@x.y"), (9005, "1 " * 10000), (9006, "+" * 500 + "+1 (456) 555-2186 256.1.1.1 0255.1.1.1"),
        (9006, "+" * 500 + "+1 (456) 555-2186 256.1.1.1 0255.1.1.1"), (9006, "a@b.c"), (None, "a@b.c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("x"))
    got = private.find_private(df).select("doc_id", private.span_list(F.col("base")).alias("base")).collect()
    assert sorted(((r[0], r[1]) for r in got), key=repr) == sorted(((i, brute_spans(t)) for i, t in rows), key=repr)


def test_contexts_discover_identifiers(spark):
    rnd = random.Random(4)
    name = lambda: "".join(rnd.choice("abcdefgh") for _ in range(8))
    rows = [(i, f"please write to {name()}@mail.example.com today") for i in range(40)]
    rows += [(100 + i, f"it uses version {rnd.randrange(10, 99)}.{rnd.randrange(1000, 9999)} today") for i in range(40)]
    rows += [(200, "please write to jane77[at]example9 today"), (201, "we saw 4711-0815-X yesterday evening")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in private.find_private(df).select(
        "doc_id", private.span_list(F.col("base")).alias("base"), private.span_list(F.col("spans")).alias("spans")
    ).collect()}
    assert got[200]["base"] == "" and got[200]["spans"] == "email:16:34"
    assert [i for i, r in got.items() if r["base"] != r["spans"]] == [200]
    assert all(r["base"] for i, r in got.items() if i < 40)


def spans_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = private.find_private(df).select("doc_id", private.span_list(F.col("spans")).alias("spans"))
    return {r["doc_id"]: r["spans"] for r in found.collect()}


def test_discovered_identifiers_lead_to_new_patterns(spark):
    rows = [(i, f"please write to name{i}x@mail.example.com today") for i in range(40)]
    for i in range(8):
        # Known by the first pattern only, then the second has these as its seeds.
        rows += [(100 + i, f"please write to user1{i}[at]home today"), (200 + i, f"my contact address user1{i}[at]home works")]
    rows += [(300, "my contact address other99[at]home works"), (301, "the year contact 1999[at]home works")]
    got = spans_of(spark, rows)
    assert got[300] == "email:19:34" and got[200] == "email:19:33" and got[301] == ""


def test_contexts_and_groups_of_digits(spark):
    rows = [(i, f"call me at +49 30 {1234567 + i} tonight") for i in range(40)]
    rows += [(100, "call me at (555) 123-4567 tonight"), (101, "in 1999 call me at 078 05 1120. tonight")]
    rows += [(102, "10.0.0.1 call me at 4711-0815 tonight")]
    got = spans_of(spark, rows)
    assert got[100] == "phone:12:25" and got[101] == "phone:19:30"
    assert got[102] == "ip:0:8,phone:20:29"


def test_no_texts_to_search(spark):
    assert private.find_private(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# Queries


@pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")
@pytest.mark.parametrize("name", list(ORACLE))
def test_query_against_sql(spark, name):
    assert compare(QUERIES[name](spark, str(SF_DIR)), oracle_connection(SF_DIR), ORACLE[name]) is None


@pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_query_runs(spark, name):
    rows = QUERIES[name](spark, str(SF_DIR))
    source = {"op2_url_filter": "pages", "op4_near_search": None}.get(name, "documents")
    if source:
        assert rows.count() == spark.read.parquet(str(SF_DIR / f"{source}.parquet")).count()
    else:
        assert rows.count() > 0


@pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")
def test_pipeline(spark):
    import corpus_pipeline

    documents = spark.read.parquet(str(SF_DIR / "documents.parquet"))
    docs = documents.withColumns({"class": F.lit(1), "row": F.lit("x"), "key": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(SF_DIR))
        assert kept.columns == docs.columns
        before = docs.count()
        docs = spark.createDataFrame(kept.collect(), docs.schema)
        assert 0 < docs.count() <= 2 * before, name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, str(SF_DIR))
    assert out.count() == docs.count()
    assert {r[0] for r in docs.select("doc_id").distinct().collect()} <= {r[0] for r in documents.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, str(SF_DIR)).columns == out.columns
    empty = documents.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(SF_DIR)).count() == 0, name
