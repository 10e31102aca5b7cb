import json
from datetime import datetime

import numpy as np
import pytest
from conftest import column, rows
from pyspark.sql import functions as F

from wayword.functions import scores
from wayword.operators import encode, lexicon, posts as ops, skew, word_lists
from wayword.plans import jobs
from wayword.sources import posts as post_files, sinks, text as files
from wayword.streaming import posts as stream

TOPICS = {"cats": ["cat", "kitten"], "dogs": ["dog", "cat"], "none": ["emu"]}
LEXICON = {"good": (0.5, 0.25), "bad": (-0.75, 1.0), "so": (0.0, 0.5)}
STOP = ["the", "a"]
POSTS = [
    ("ann", "2021-01-02 03:04:05", "The good CAT, https://x.y/z a good cat!"),
    ("bob", "2-1-2021 3:04", "a bad dog\nand a bad \"kitten\" "),
    ("cat", "02/01/2021 03:04", "nothing here"),
    ("dan", "2.1.2021 03:04", "the a"),
    ("eve", "2021/01/02", "cat"),
    ("fay", None, "cat"),
    ("gus", "2021-01-02 03:04:05", None),
    ("ann", "2021-01-02 03:04:05", "The good CAT, https://x.y/z a good cat!"),
    ("hal", "2021-01-02 03:04:05", "so good, so bad dog"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(POSTS, "user_name string, date string, text string").withColumn("source", F.lit("x"))


@pytest.fixture
def clean(raw):
    return ops.clean_posts(raw, STOP)


def test_clean_posts(clean, raw):
    assert clean.columns == ["user", "date", "tweet"]
    assert rows(clean.select("user", "tweet")) == [
        ("ann", "good cat good cat"), ("ann", "good cat good cat"), ("bob", "bad dog and bad kitten"),
        ("cat", "nothing here"), ("dan", ""), ("hal", "so good so bad dog"),
    ]
    extra = ops.clean_posts(raw, STOP, placeholders=True)
    assert extra.dtypes[3:] == [("topic", "string"), ("terms", "string")]


def test_long_stop_list_gives_the_same(raw, clean, texts, monkeypatch):
    stop = texts(*STOP, "cannot", name="word")
    assert rows(ops.clean_posts(raw, stop)) == rows(clean)
    want = ops.cleanse_column(texts("cannot the a", "", None, "a", "gonna b"), "text", ["the", "a", "not"])
    monkeypatch.setattr(word_lists, "LITERAL_WORDS", 1)
    monkeypatch.setattr(skew, "HOT_ROWS", 1)
    assert rows(ops.clean_posts(raw, stop)) == rows(clean)
    longer = texts("the", "a", "not", name="word")
    again = ops.cleanse_column(texts("cannot the a", "", None, "a", "gonna b"), "text", longer)
    assert rows(again) == rows(want)


@pytest.mark.parametrize("by_join", [False, True])
@pytest.mark.parametrize("hot_rows", [10_000, 0])
def test_tag_topics(clean, by_join, hot_rows, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    tagged = ops.tag_topics(clean, TOPICS, by_join)
    assert tagged.columns == ["topic", "time", "user", "tweet", "terms"]
    assert rows(tagged.select("topic", "user", "terms")) == [
        ("cats", "ann", ["cat", "kitten"]), ("cats", "ann", ["cat", "kitten"]), ("cats", "bob", ["cat", "kitten"]),
        ("dogs", "ann", ["cat", "dog"]), ("dogs", "ann", ["cat", "dog"]), ("dogs", "bob", ["cat", "dog"]),
        ("dogs", "hal", ["cat", "dog"]),
    ]


@pytest.mark.parametrize("by_join", [False, True])
def test_empty_and_missing_tweets_have_no_topic(spark, by_join):
    tweets = [("u", "d", ""), ("u", "d", None), ("u", "d", "x  y")]
    df = spark.createDataFrame(tweets, "user string, date string, tweet string")
    assert column(ops.tag_topics(df, {"t": [""]}, by_join), "tweet") == ["x  y"]
    assert ops.tag_topics(df.limit(0), {"t": ["x"]}, by_join).count() == 0


def test_topics_file(spark, clean, tmp_path):
    path = tmp_path / "topics.json"
    path.write_text(json.dumps({**TOPICS, "cats": ["cat", "kitten", "cat"], "other": ["nothing"]}, indent=2))
    topics = files.read_topics(spark, str(path), ["cats", "dogs", "absent"])
    assert rows(topics) == [("cats", ["cat", "kitten"]), ("dogs", ["dog", "cat"])]
    assert rows(ops.tag_topics(clean, topics)) == rows(ops.tag_topics(clean, TOPICS))


@pytest.mark.parametrize("measure", ["polarity", "subjectivity"])
def test_lexicon_means(spark, clean, measure, monkeypatch):
    score = getattr(lexicon, measure)
    got = {r["user"]: r[measure] for r in score(clean, LEXICON).collect()}
    want = {"polarity": (0.5, -0.75, 0.0, -0.0625), "subjectivity": (0.25, 1.0, 0.0, 0.5625)}[measure]
    assert (got["ann"], got["bob"], got["cat"], got["hal"]) == want
    values = [(w, *v) for w, v in LEXICON.items()]
    table = spark.createDataFrame(values, "word string, polarity double, subjectivity double")
    assert rows(score(clean, table)) == rows(score(clean, LEXICON))
    monkeypatch.setattr(skew, "HOT_ROWS", 0)
    assert rows(score(clean, table, by_join=True)) == rows(score(clean, LEXICON))


def test_both_lexicon_forms_agree_to_the_last_bit(spark, texts):
    words = {f"w{i}": (1 / (i + 3), 0.1 * i) for i in range(30)}
    df = texts(*(" ".join(f"w{(i * j * 7) % 37}" for i in range(50)) for j in range(20)), name="tweet")
    assert rows(lexicon.polarity(df, words)) == rows(lexicon.polarity(df, words, by_join=True))


@pytest.mark.parametrize("words", [100_000, 0])
def test_lists_with_repeats_and_nulls(spark, texts, words, monkeypatch):
    """A list gives the same as a literal of the plan and as a join."""
    monkeypatch.setattr(word_lists, "LITERAL_WORDS", words)
    df = texts("a b c d", "d", "", None, name="tweet")
    values = [("a", 0.5, None), ("a", -0.25, 1.0), ("b", None, 0.5), (None, 1.0, 1.0), ("c", 1.0, 0.0), ("c", None, None)]
    table = spark.createDataFrame(values, "word string, polarity double, subjectivity double")
    got = {r["tweet"]: (r["polarity"], r["subjectivity"]) for r in lexicon.subjectivity(lexicon.polarity(df, table), table).collect()}
    assert got == {"a b c d": ((0.125 + 1.0) / 2, (1.0 + 0.5 + 0.0) / 3), "d": (0, 0), "": (0, 0), None: (0, 0)}
    none = {"a": (None, None)}
    assert rows(lexicon.polarity(df, none).select("polarity")) == [(0.0,)] * 4
    ids = spark.createDataFrame([("a", 7), ("a", 3), ("b", None), (None, 1), ("d", 9)], "word string, id int")
    assert {r["tweet"]: r["ids"] for r in encode.encode_tokens(df, ids).collect()} == {
        "a b c d": [3, 9], "d": [9], "": [], None: [],
    }
    empty = table.limit(0)
    assert rows(lexicon.polarity(df, empty).select("polarity")) == [(0.0,)] * 4
    stop = spark.createDataFrame([("a",), ("a",), (None,), ("d",)], "word string")
    kept = ops.cleanse_column(df.withColumnRenamed("tweet", "text"), "text", stop)
    assert rows(kept) == rows(texts("b c", "", "", None))
    assert rows(ops.cleanse_column(texts("x y"), "text", stop.limit(0))) == [("x y",)]


def test_signs_and_classes(spark):
    df = spark.createDataFrame([(0.61,), (0.6,), (0.41,), (0.4,), (0.0,), (-0.1,)], "p double")
    assert column(df.select(scores.sentiment_sign("p"))) == [1, 1, 1, 1, 0, -1]
    assert column(df.select(scores.sentiment_from_score(F.col("p")))) == [1, 0, 0, -1, -1, -1]


def test_pad_pre(spark):
    df = spark.createDataFrame([([1, 2],), ([1, 2, 3],), ([1, 2, 3, 4],), ([],)], "n array<int>")
    assert column(df.select(scores.pad_pre(F.col("n"), 3))) == [[0, 1, 2], [1, 2, 3], [2, 3, 4], [0, 0, 0]]


@pytest.mark.parametrize("by_join", [False, True])
def test_encode_tokens(spark, texts, by_join):
    df = texts("b a zz a", "zz", "", None, name="tweet")
    got = dict(rows(encode.encode_tokens(df, {"a": 1, "b": 2}, by_join=by_join).where("tweet IS NOT NULL")))
    assert got == {"b a zz a": [2, 1, 1], "zz": [], "": []}


def test_encode_with_the_smallest_ids_broadcast(spark, texts, monkeypatch):
    """Any ids, shared and negative ones too; the words of a text are put together without moving the text."""
    df = texts("b a zz a c", "zz", "", None, "c", "c", name="tweet")
    ids = {"a": -3, "b": 7, "c": 7, "d": -3, "zzz": 2**31 - 1, "e": -(2**31)}
    want = rows(encode.encode_tokens(df, ids))
    for most in (1, 2, 4, 10):
        monkeypatch.setattr(skew, "BROADCAST_ROWS", most)
        got = encode.encode_tokens(df, ids, by_join=True)
        assert rows(got) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "tweet" in line.split("ENSURE")[0]]


def test_a_stop_list_join_does_not_move_texts(texts):
    got = ops.remove_stopwords_by_join(texts("the cat a", "the", None, ""), "text", STOP)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "text#" in line]
    assert rows(got) == [("",), ("",), ("cat",), (None,)]


def test_model_hook(spark, texts):
    def predict(ids: np.ndarray) -> np.ndarray:
        assert ids.shape[1] == 4
        return ids[:, -1:] / 10

    encoded = encode.encode_tokens(texts("a", "b", "c", "d d d d d", None, name="tweet"), {"a": 4, "b": 5, "c": 7})
    encoded = encoded.withColumn("ids", F.when(F.col("tweet").isNotNull(), F.col("ids")))
    got = encode.score_with_model(encoded, predict, length=4)
    assert {r["tweet"]: (r["score"], r["sentiment"]) for r in got.collect()} == {
        "a": (0.4, -1), "b": (0.5, 0), "c": (0.7, 1), "d d d d d": (0.0, -1), None: (0.0, -1),
    }


def sink_rows_of(raw):
    return stream.sink_rows(raw, STOP, TOPICS, LEXICON)


def test_sink_rows(raw, clean):
    got = sink_rows_of(raw)
    assert got.dtypes == [("posted_at", "timestamp_ntz"), ("post", "string"), ("topic", "string"), ("sentiment", "int")]
    assert {tuple(r) for r in got.where("topic = 'dogs'").collect()} == {
        (datetime(2021, 1, 2, 3, 4, 5), "good cat good cat", "dogs", 1),
        (datetime(2021, 1, 2, 3, 4), "bad dog and bad kitten", "dogs", -1),
        (datetime(2021, 1, 2, 3, 4, 5), "so good so bad dog", "dogs", -1),
    }
    apart = ops.to_sink_rows(lexicon.score_sentiment(ops.tag_topics(clean, TOPICS), LEXICON))
    assert rows(got) == rows(apart)


def test_csv_to_archive(spark, raw, tmp_path):
    raw.coalesce(1).write.options(header=True, quoteAll=True, escape='"').csv(str(tmp_path / "csv"))
    (tmp_path / "stop.txt").write_text("the\n")
    (tmp_path / "more.txt").write_text("a\nthe\n")
    (tmp_path / "topics.json").write_text(json.dumps(TOPICS))
    scored = jobs.scored_posts(
        spark, str(tmp_path / "csv"), [str(tmp_path / "stop.txt"), str(tmp_path / "more.txt")],
        str(tmp_path / "topics.json"), list(TOPICS), LEXICON,
    )
    assert scored.columns == ["topic", "time", "user", "tweet", "terms", "sentiment"]
    archive = str(tmp_path / "archive")
    for _ in range(2):
        jobs.archive_posts(scored, archive)
    got = spark.read.parquet(archive)
    assert rows(got.drop("id")) == rows(sink_rows_of(raw))
    assert got.select("id").distinct().count() == got.count()


def test_ids_go_on_over_appends(spark, raw, tmp_path):
    archive = str(tmp_path / "archive")
    scored = ops.tag_and_score(ops.clean_posts(raw, STOP), TOPICS, LEXICON)
    jobs.archive_posts(scored, archive, "append")
    first = column(spark.read.parquet(archive), "id")
    jobs.archive_posts(scored, archive)
    assert sorted(column(spark.read.parquet(archive), "id")) == sorted(first)
    largest = max(first)
    for n in (2, 3):
        jobs.archive_posts(scored, archive, "append")
        ids = column(spark.read.parquet(archive), "id")
        assert len(set(ids)) == len(ids) == n * len(first)
        assert sum(i > largest for i in ids) == len(first)
        largest = max(ids)


def test_csv_columns_by_name_and_quotes(spark, tmp_path):
    (tmp_path / "p.csv").write_text('text,x,date,user_name\n"he said ""hi""\nline two",1,2021-01-02 03:04:05,ann\n')
    got = post_files.read_posts(spark, str(tmp_path / "p.csv")).select("user_name", "date", "text")
    assert rows(got) == [("ann", "2021-01-02 03:04:05", 'he said "hi"\nline two')]
    (tmp_path / "q.csv").write_text('text,date\n"a \\"b\\" c",2021\n')
    assert column(post_files.read_posts(spark, str(tmp_path / "q.csv"), escape="\\"), "text") == ['a "b" c']


def test_write_table_modes(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "x int")
    path = str(tmp_path / "t")
    sinks.write_table(one, path, "overwrite")
    sinks.write_table(one, path, "overwrite")
    sinks.write_table(one, path)
    sinks.write_table(one.limit(0), path)
    assert column(spark.read.parquet(path)) == [1, 1]
    sinks.write_table(one, path, "overwrite", format="json")
    assert spark.read.json(path).count() == 1


def test_row_ids(spark):
    df = spark.range(1000).selectExpr("1000 - id AS x").repartition(7)
    unique = sinks.with_row_id(df, 5)
    assert unique.select("id").distinct().count() == 1000 and unique.agg({"id": "min"}).first()[0] == 5
    dense = sinks.with_dense_row_id(df, ["x"])
    assert rows(dense.orderBy("x").select("id", "x")) == sorted(((i, i) for i in range(1, 1001)), key=repr)
    loose = sinks.with_dense_row_id(df, start=0)
    assert sorted(column(loose, "id")) == list(range(1000))
    assert sinks.with_dense_row_id(df.limit(0)).count() == 0


def test_stream_equals_batch(spark, raw, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    raw.repartition(3).write.parquet(source)
    posts = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(source)
    writer = stream.batch_folder_writer(out)
    checkpoint = str(tmp_path / "checkpoint")
    query = stream.write_batches(sink_rows_of(posts), writer, checkpoint, available_now=True)
    query.awaitTermination()
    got = spark.read.parquet(out)
    assert rows(got.drop("batch_id", "id")) == rows(sink_rows_of(raw))
    assert got.select("id").distinct().count() == got.count()


@pytest.mark.parametrize("words", [100_000, 1])
@pytest.mark.parametrize("one_file", [True, False])
def test_stream_job(spark, raw, tmp_path, monkeypatch, words, one_file):
    """Word lists of any size, and a source that is one file or a folder of files."""
    want = rows(sink_rows_of(raw))
    monkeypatch.setattr(word_lists, "LITERAL_WORDS", words)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    raw.repartition(1 if one_file else 3).write.parquet(source)
    if one_file:
        (part,) = (tmp_path / "in").glob("part-*.parquet")
        source = str(part)[:-1] + "[t]"
    posts = spark.readStream.schema(raw.schema).parquet(source)
    jobs.stream_posts(posts, STOP, TOPICS, LEXICON, out, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert rows(spark.read.parquet(out).drop("batch_id", "id")) == want


def test_a_repeated_batch_replaces_itself(spark, raw, tmp_path):
    write = stream.batch_folder_writer(str(tmp_path / "out"))
    for _ in range(2):
        write(sink_rows_of(raw), 0)
    write(sink_rows_of(raw), 1)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 2 * sink_rows_of(raw).count()
