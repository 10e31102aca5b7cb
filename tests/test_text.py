import pytest
from conftest import column
from pyspark.sql import functions as F

from wayword.functions import text
from wayword.functions.lookup import in_words, lookup


def test_tokenize_ws_delimiters(texts):
    df = texts("a\tb\x0cc\rd\ne  f", " lead trail ", "vert\x0bical", "", None)
    got = column(df.select(text.tokenize_ws("text")))
    assert got == [["a", "b", "c", "d", "e", "f"], ["lead", "trail"], ["vert\x0bical"], [], None]


@pytest.mark.parametrize(
    ("post", "plain"),
    [
        ("hello @user bye", "hello user bye"),  # a blank before the name makes it a run of signs
        ("@user hi", "hi"),
        ("\t @User hi", "hi"),
        ("a@user.x hi", "a  hi"),
        ("htt:abc", "bc"),
        ("http:abc", ""),
        ("see https://t.co/abc now", "see   now"),
        ("(https://t.co/x) y", "y"),
        ("don't", "don t"),
        ("Café über", "caf ber"),
        ("\U0001f600@bob x", "x"),
        ("a\nb", "a b"),
        ("!!!", ""),
        ("", ""),
    ],
)
def test_normalise(texts, post, plain):
    assert column(texts(post).select(text.normalise("text"))) == [plain]


def test_normalise_steps(texts):
    df = texts("\xa0\x1c Ab\nCé\U0001f600  D 　")
    assert column(df.select(text.lower_trim("text"))) == ["ab\ncé\U0001f600  d"]
    assert column(df.select(text.newline_to_space("text"))) == ["\xa0\x1c Ab Cé\U0001f600  D 　"]
    assert column(df.select(text.ascii_only("text"))) == ["\x1c Ab\nC  D "]
    assert column(texts("a   b c").select(text.collapse_spaces("text"))) == ["a b c"]


def test_fused_words(texts):
    df = texts("cannot gonna scannot cannots wanna")
    want = ["can", "not", "gon", "na", "scannot", "cannots", "wan", "na"]
    assert column(df.select(text.tokenize_clean(F.col("text")))) == [want]
    assert column(df.select(text.cleanse("text", []))) == [" ".join(want)]
    assert column(df.select(text.cleanse("text", ["not", "na", "cannot", "wan"]))) == ["can gon scannot cannots"]


def test_stop_words_keep_order_and_repeats(texts):
    df = texts("the cat the dog cat", "the the", "you've The")
    got = column(df.select(text.cleanse("text", ["the", "you've"])))
    assert got == ["cat dog cat", "", "you ve"]


def test_split_on_space_keeps_empty_items(texts):
    assert column(texts("a  b").select(text.split_on_space("text"))) == [["a", "", "b"]]


def test_lookup_of_many_words(texts):
    words = {f"wörd{i}": i for i in range(2000)}
    df = texts("wörd0", "wörd1999", "wörd2000", "", "quote\"'\\", None)
    assert column(df.select(lookup(F.col("text"), words, "int"))) == [0, 1999, None, None, None, None]
    assert column(df.select(in_words(F.col("text"), [*words, "quote\"'\\"]))) == [True, True, False, False, True, None]
    assert column(df.select(in_words(F.col("text"), []))) == [False] * 6
    assert column(df.select(lookup(F.col("text"), {}, "int"))) == [None] * 6


def test_lookup_table_is_folded(texts):
    df = texts("a").select(in_words(F.col("text"), ["a", "b"]).alias("found"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "[a,b]" in plan and "from_json" not in plan
