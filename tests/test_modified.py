"""Polarity with modifiers against a plain loop."""

import random

import pytest
from conftest import rows

from wayword.operators import word_lists
from wayword.operators.modified import modified_polarity

LEXICON = {"good": (0.5, 0.1), "bad": (-0.75, 0.2), "fine": (0.25, None), "odd": (None, 0.5), "most": (1.0, 1.0)}
MODIFIERS = {"very": (2.0, 0), "not": (-0.5, 1), "rather": (0.5, 0), "most": (1.5, 2)}


def slow(text):
    total, n, factor, until = 0.0, 0, 1.0, -1
    for pos, word in enumerate((text or "").split(" ")):
        held = factor if pos <= until else 1.0
        if word in MODIFIERS:
            factor, until = held * MODIFIERS[word][0], pos + 1 + MODIFIERS[word][1]
        elif LEXICON.get(word, (None,))[0] is not None:
            total, n, until = total + max(-1.0, min(1.0, LEXICON[word][0] * held)), n + 1, -1
    return total / n if n else 0.0


@pytest.mark.parametrize("words", [100_000, 0])
def test_modified_polarity(spark, texts, monkeypatch, words):
    monkeypatch.setattr(word_lists, "LITERAL_WORDS", words)
    monkeypatch.setattr("wayword.operators.modified.LITERAL_WORDS", words)
    rnd = random.Random(2)
    vocabulary = [*LEXICON, *MODIFIERS, "x", "y", "very", "not"]
    values = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 25))) for _ in range(150)]
    values += ["", None, "very", "good", "not a good", "not quite a good", "not very good", "very very bad", values[0]]
    df = texts(*values, name="tweet")
    want = sorted(((v, slow(v)) for v in values), key=repr)
    lexicon = spark.createDataFrame([(w, *v) for w, v in LEXICON.items()] + [(None, 1.0, 1.0)], "word string, polarity double, subjectivity double")
    changes = [(w, *v) for w, v in MODIFIERS.items()] + [(None, 2.0, 1), ("x", None, 3), ("very", 2.0, None)]
    table = spark.createDataFrame(changes, "word string, factor double, reach int")
    assert rows(modified_polarity(df, LEXICON, MODIFIERS)) == want
    assert rows(modified_polarity(df, lexicon, table)) == want
    assert rows(modified_polarity(df, lexicon, MODIFIERS, by_join=True)) == want
    assert slow("not a good") == -0.25 and slow("not quite a good") == 0.5 and slow("very very bad") == -1.0


def test_no_modifiers_and_no_lexicon(spark, texts):
    df = texts("good bad", None, name="tweet")
    assert rows(modified_polarity(df, LEXICON, {})) == [("good bad", -0.125), (None, 0.0)]
    assert rows(modified_polarity(df, {}, MODIFIERS)) == [("good bad", 0.0), (None, 0.0)]
