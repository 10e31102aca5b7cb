"""BPE, language and quality of texts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayword.llm import arrow, bpe, language, quality
from wayword.llm.queries import vocabulary_path

ODD = [
    "", None, "a" * 3001, " " * 2000 + "x", "<|endoftext|>a<|endoftext|><|endoftext|>", "a <|endoftext|> b  \n\n c",
    "it's I'LL we've  'd", "\x1c\x85\xa0 x y​", "ab" * 1500, "\0a�", "日本語 テスト🙂🙂",
    "͸㿃b \U0003fc3b Ᲊx 1\U00010d40",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def random_texts(n):
    rnd = random.Random(7)
    letters = "ab é1 \n'st.,THEre🙂ßñ_-"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(80))) for _ in range(n)]


def test_bpe_is_the_library_s(library):
    vocabulary = bpe.Vocabulary(vocabulary_path())
    texts = random_texts(400) + ODD
    for ids, text in zip(vocabulary.encoder.encode(texts), texts):
        known = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == known
        assert bpe.decode(ids, vocabulary) == library.decode(known, skip_special_tokens=False) == (text or "")


def test_bpe_table(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(random_texts(30) + ODD)] + [(0, "again", "y"), (None, "no key", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a b` string")
    got = bpe.encode_column(df, vocabulary_path()).collect()
    assert len(got) == len(rows)
    texts = sorted(((k, e or "", t or "") for k, t, e in rows), key=repr)
    assert sorted(((r["doc_id"], r["a b"] or "", bpe_text(library, r["ids"])) for r in got), key=repr) == texts
    for r in got:
        ids = np.array(r["ids"], dtype="<u4").tobytes()
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(bpe_text(library, r["ids"]).encode()).hexdigest()
    assert bpe.encode_column(df.limit(0), vocabulary_path()).count() == 0
    with pytest.raises(ValueError, match="there already"):
        bpe.encode_column(df.withColumn("n_tokens", F.lit(1)), vocabulary_path())


def bpe_text(library, ids):
    return library.decode(ids, skip_special_tokens=False)


def test_remembered_words_are_forgotten(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.Encoder(bpe.Vocabulary(vocabulary_path()))
    texts = ["one two three four five", "six seven one", "two"]
    for text in texts:
        (ids,) = encoder.encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_groups_are_bounded():
    texts = ["a" * 10, None, "b" * 50, "c", "d", "e"]
    made = list(arrow.groups(texts, most=2, characters=20))
    assert [t for g in made for t in g] == texts
    assert all(len(g) <= 2 and (len(g) == 1 or sum(len(t or "") for t in g) <= 20) for g in made)


WORDS = {"en": "the of and house water stone", "de": "der die und haus wasser stein", "fr": "le la et maison eau pierre"}


def sentences(lang, n, seed):
    rnd = random.Random(seed)
    return [" ".join(rnd.choices(WORDS[lang].split(), k=12)) for _ in range(n)]


def test_language(spark):
    rows = [(f"{lang}{i}", t, lang) for lang in WORDS for i, t in enumerate(sentences(lang, 20, lang))]
    learnt = spark.createDataFrame(rows + [("n", None, "en"), ("m", "x", None)], "doc_id string, text string, lang string")
    model = language.learn(learnt, per_language=15)
    asked = [("a", "THE stones of WATERS"), ("b", "häuser und wassers"), ("c", "maisons et les eaux"), ("d", None),
             ("e", "12 ... !"), ("f", ""), ("g", "日本"), ("a", "der stein")]
    df = spark.createDataFrame(asked, "doc_id string, text string").withColumn("extra", F.lit(1))
    got = language.predict(df, model).collect()
    found = {(r["doc_id"], r["lang_pred"]) for r in got}
    assert {("a", "en"), ("b", "de"), ("c", "fr"), ("d", "und"), ("e", "und"), ("f", "und"), ("a", "de")} <= found
    assert len(got) == len(asked) and all(0 <= r["score"] <= 1 and r["extra"] == 1 for r in got)
    assert ("g", "de") in found  # nothing is known: the first language by name


def test_only_letters_make_words():
    assert language.words("½ ² ① ⅷ") == []
    assert language.words("x² m½n Ab_c1d ªº") == ["x", "m", "n", "ab", "c", "d", "ªº"]


def test_language_backs_off_by_length():
    table = np.log(np.array([[0.9, 0.1], [0.2, 0.8]]))
    model = language.Model(["a", "b"], {"known": 0}, {" k": 1, "kn": 0}, table)
    assert model.score("known").tolist() == table[0].tolist()
    assert model.score("knows").tolist() == table.mean(axis=0).tolist()  # both n-grams of two characters
    assert model.score("zzz").tolist() == [0, 0]


def test_language_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language.learn(empty)
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert [(r["lang_pred"], r["score"]) for r in language.predict(df, model).collect()] == [("und", 0.0)]


def test_language_sample_is_bounded(spark):
    df = spark.range(500).selectExpr("id AS doc_id", "'word' AS text", "IF(id % 10 = 0, 'a', 'b') AS lang")
    counts = dict(language.sample(df, "text", "lang", "doc_id", 40).groupBy("lang").count().collect())
    assert counts == {"a": 40, "b": 40}


def quality_rows():
    rnd = random.Random(5)
    rows = []
    for i in range(160):
        words = [rnd.choice("river stone green walks slowly under morning light and rain".split()) for _ in range(40)]
        bad = i % 4 == 0
        text = " ".join(w.upper() + "!!" if bad and i % 8 else (words[0] if bad else w) for w in words)
        rows.append((i, text, 0 if bad else 1))
    return rows


def test_quality(spark):
    rows = quality_rows()
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 3] + [(1, None), (None, 1)], "doc_id long, label int")
    model = quality.learn(documents, labels)
    asked = documents.withColumn("other", F.lit("x")).unionByName(
        spark.createDataFrame([(900, None, "x"), (901, "", "x"), (902, "ab", "x")], "doc_id long, text string, other string")
    )
    got = {r["doc_id"]: r for r in quality.score(asked, model).collect()}
    right = sum(got[i]["predicted"] == label for i, _, label in rows if i % 3 == 0)
    assert right >= 0.95 * len([r for r in rows if r[0] % 3 == 0])
    assert {got[i]["score"] for i in (900, 901, 902)} == {model.mean}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["other"] == "x" for r in got.values())
    kept = quality.keep_good(asked, model)
    assert kept.columns == asked.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"]}


def test_quality_votes_by_similarity():
    """The score is the vote over all neighbours at or above the last similarity."""
    rng = np.random.default_rng(0)
    vectors = quality.unit(rng.standard_normal((60, 8)))
    labels = rng.integers(0, 2, 60).astype(float)
    model = quality.Model(np.ones(1), np.ones((1, 1)), vectors, labels)
    asked = quality.unit(rng.standard_normal((700, 8)))
    for vector, score in zip(asked, model.scores(asked)):
        near = sorted(((float(v @ vector), y) for v, y in zip(vectors, labels)), reverse=True)[: quality.NEIGHBOURS]
        weight = [max(c, 0) ** quality.POWER for c, _ in near]
        assert score == pytest.approx(sum(w * y for w, (_, y) in zip(weight, near)) / sum(weight))


def test_quality_without_labels(spark):
    documents = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, label int")
    model = quality.learn(documents, labels)
    assert [(r["score"], r["predicted"]) for r in quality.score(documents, model).collect()] == [(0.5, 1)]
