import pytest
from conftest import column, rows

from wayword.operators import skew, word_lists, words
from wayword.plans import jobs
from wayword.sources import sinks, text as files


def write(folder, **named):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in named.items():
        (folder / f"{name}.txt").write_bytes(content.encode())
    return str(folder)


def test_word_count_job(spark, tmp_path):
    source = write(tmp_path / "in", a="red blue green red", b="blue fox\r\nfox fox\rred\n\n")
    jobs.count_words(spark, source, str(tmp_path / "out"))
    lines = column(files.read_lines(spark, str(tmp_path / "out")))
    assert lines == ["blue\t2", "fox\t3", "green\t1", "red\t3"]


def test_word_count_is_in_byte_order(spark, texts):
    df = words.word_count(texts("b B é a Z 中", name="value"))
    assert column(df) == ["B", "Z", "a", "b", "é", "中"]


@pytest.fixture
def tagged(spark):
    first = "it it. It the the owl owl bat bat elk ant"
    second = "It the owl owl owl bat bat bat elk cow"
    return spark.createDataFrame([(first, 1), (second, 2), (None, 2), ("", 1)], "value string, src int")


def test_counts_by_source(tagged):
    counts = {r["word"]: (r["first_cnt"], r["second_cnt"]) for r in words.counts_by_source(tagged).collect()}
    assert counts["the"] == (2, 1) and counts["it."] == (1, 0) and counts["cow"] == (0, 1)


def test_other_sources_count_as_second(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 7)], "value string, src int")
    assert rows(words.counts_by_source(df)) == [("a", 1, 2)]


def test_common_words_equal_intersect_all(tagged):
    first = words.explode_words(tagged.where("src = 1"))
    second = words.explode_words(tagged.where("src = 2"))
    bag = first.intersectAll(second).groupBy("word").count().select("count", "word")
    assert rows(words.common_counts(tagged)) == rows(bag)


def test_top_k_ties_and_limits(tagged):
    ranked = [tuple(r) for r in words.topk_common_words(tagged, ["the"], k=3).collect()]
    assert ranked == [(2, "owl"), (2, "bat"), (1, "elk")]
    assert len(words.topk_common_words(tagged, k=50).collect()) == 5
    assert column(words.topk_common_words(tagged, ["The", "it"], k=50), "word") == ["owl", "bat", "the", "elk", "It"]


def test_stop_list_as_table(spark, tagged, texts, monkeypatch):
    stop = texts("the", "It", "the", None, name="word")
    want = rows(words.common_counts(tagged, ["the", "It"]))
    assert rows(words.common_counts(tagged, stop)) == want
    monkeypatch.setattr(word_lists, "LITERAL_WORDS", 1)
    assert rows(words.common_counts(tagged, stop)) == want
    assert rows(words.common_counts(tagged, ["the", "It"])) == want


def test_remove_stopwords_short_and_long_list(tagged, texts, monkeypatch):
    tokens = words.explode_words(tagged, "value", "src")
    stop = texts("owl", "It", "absent", name="word")
    want = rows(tokens.where("word NOT IN ('owl', 'It')"))
    assert rows(word_lists.remove_stopwords(tokens, stop)) == want
    monkeypatch.setattr(word_lists, "LITERAL_WORDS", 1)
    assert rows(word_lists.remove_stopwords(tokens, stop)) == want


def test_overlong_words_are_not_fetched(texts, monkeypatch):
    monkeypatch.setattr(word_lists, "LITERAL_WORD_BYTES", 5)
    assert word_lists.as_literal(texts("short", name="word")) == ["short"]
    assert word_lists.as_literal(texts("longer", name="word")) is None


def test_merge_word_lists(texts):
    merged = word_lists.merge_word_lists(texts("a", "b", name="word"), texts("b", "b", "c", name="word"))
    assert rows(merged) == [("a",), ("b",), ("c",)]


def test_word_list_lines_are_exact(spark, tmp_path):
    path = write(tmp_path, stop=" a\nThe\nsure\tt\nyou've\n")
    assert column(files.read_word_list(spark, path)) == [" a", "The", "sure\tt", "you've"]


def test_common_words_job(spark, tmp_path):
    one = write(tmp_path / "one", t="The owl saw the owl\nand I saw I")
    two = write(tmp_path / "two", t="I saw the owl and the owl saw the bat")
    stop = write(tmp_path / "stop", t="the\nand\n")
    jobs.rank_common_words(spark, one, two, stop, str(tmp_path / "out"))
    assert column(files.read_lines(spark, str(tmp_path / "out"))) == ["2\tsaw", "2\towl", "1\tI"]
    assert len(list((tmp_path / "out").glob("part-*"))) == 1


def test_read_tagged(spark, tmp_path):
    paths = {1: write(tmp_path / "a", t="x\ny"), 2: write(tmp_path / "b", t="z")}
    assert rows(files.read_tagged(spark, paths)) == [("x", 1), ("y", 1), ("z", 2)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    left = spark.range(400).selectExpr("CASE WHEN id < 200 THEN 7 ELSE id % 40 END AS k", "id % 3 AS v")
    left = left.unionByName(spark.createDataFrame([(None, 1)], "k bigint, v bigint"))
    right = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (99, "d"), (None, "e")], "k bigint, w string")
    assert len(skew.hot_keys(left, ["k"])) == 1
    assert rows(skew.salted_join(left, right, ["k"], how)) == rows(left.join(right, "k", how))


def test_salts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 1)
    monkeypatch.setattr(skew, "HOT_SHARE", 0.1)
    df = spark.range(1000).selectExpr("CASE WHEN id < 500 THEN -1 ELSE id END AS k")
    hot = skew.hot_keys(df, ["k"])
    assert list(hot.values()) == [5]
    salted = df.withColumn("_salt", skew.row_salt(df, skew.n_salts(["k"], hot)))
    assert salted.where("k <> -1").agg({"_salt": "max"}).first()[0] == 0
    assert salted.where("k = -1").select("_salt").distinct().count() > 1


def test_sized_join_over_the_bound(spark, monkeypatch):
    left = spark.range(50).selectExpr("id % 5 AS k", "id AS v")
    right = spark.range(3).selectExpr("id AS k", "id * 10 AS w")
    want = rows(skew.sized_join(left, right, ["k"], "left"))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    assert rows(skew.sized_join(left, right, ["k"], "left")) == want


def test_unsupported_join_kind(spark):
    with pytest.raises(ValueError):
        skew.salted_join(spark.range(1), spark.range(1), ["id"], "right")


def test_write_counts_quotes_nothing(spark, tmp_path):
    df = spark.createDataFrame([('a"b', 2), ("c,d", 1)], "word string, cnt bigint")
    sinks.write_counts(df.orderBy("word"), str(tmp_path / "out"))
    assert column(files.read_lines(spark, str(tmp_path / "out"))) == ['a"b\t2', "c,d\t1"]
