"""Language of texts: known words first, then shorter and shorter character n-grams.

A word of the model adds the logarithm of its relative frequency in each language. A word that the model does not know
is looked up by its character n-grams, longest first: the first length of which any n-gram is known counts, with the
mean over the known ones. A word none of whose characters is known says nothing.

The model is learnt from at most ``PER_LANGUAGE`` texts of each language (by the order of a hash of the key), so its
size is bounded; every text is scored whole. Null texts and texts without a letter are ``und`` with score 0, and so is
everything if nothing could be learnt. Ties go to the language that comes first by name. Repeated rows are scored like
others; no other column than those named is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .arrow import with_columns_of_texts
from .components import by_count

# The bound of the sample that is learnt from: so many texts of each language.
PER_LANGUAGE = 500

# Lengths of n-grams, longest first. A word is looked up with a blank at both ends.
LENGTHS = (5, 4, 3, 2, 1)

# Added to every count, so that a word of one language only does not rule out the others.
SMOOTHING = 0.1

# Words whose scores a task remembers; beyond it, it starts anew.
REMEMBERED = 300_000

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def words(text: str | None) -> list[str]:
    """Runs of letters, in lower case; numbers of any kind (as in ``x²`` or ``½``) end a word."""
    found = WORD.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    return [word for run in found for word in "".join(c if c.isalpha() else " " for c in run).split()]


def grams(word: str, length: int) -> list[str]:
    # A single character is one of the word itself; a blank would be known everywhere.
    padded = f" {word} " if length > 1 else word
    return [padded[i : i + length] for i in range(len(padded) - length + 1)]


@dataclass
class Model:
    """For every word and n-gram a row of ``scores``, and in it the log frequency in each language."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray

    def score(self, word: str) -> np.ndarray:
        if (row := self.words.get(word)) is not None:
            return self.scores[row]
        for length in LENGTHS:
            known = [row for g in grams(word, length) if (row := self.grams.get(g)) is not None]
            if known:
                return self.scores[known].mean(axis=0)
        return np.zeros(len(self.languages))


def sample(df: DataFrame, text_col: str, lang_col: str, key_col: str, per_language: int) -> DataFrame:
    """At most ``per_language`` texts of each language, by the order of a hash."""
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(key_col).alias("turn"))
    sizes = rows.groupBy("lang").count()
    # Twice the share that is needed passes the first filter, so the ranking sees few rows of a frequent language.
    share = F.least(F.lit(1.0), F.lit(2.0 * per_language + 20) / F.col("count"))
    few = rows.join(by_count(sizes, sizes.count()), "lang").where(F.pmod("turn", F.lit(1_000_003)) < share * 1_000_003)
    order = Window.partitionBy("lang").orderBy("turn", F.xxhash64("text"))
    return few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).select("lang", "text")


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
          per_language: int = PER_LANGUAGE) -> Model:
    """The model of the rows of ``df``. It is collected: the sample bounds it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found = words(text)
                if found:
                    yield pa.RecordBatch.from_pydict({"lang": [lang] * len(found), "word": found})

    counted = sample(df, text_col, lang_col, key_col, per_language).mapInArrow(count, "lang string, word string")
    counted = counted.groupBy("lang", "word").agg(F.count("*").alias("n"))
    rows = counted.orderBy("word", "lang").toArrow().to_pydict()
    languages = sorted(set(rows["lang"]))
    place = {lang: i for i, lang in enumerate(languages)}
    tables: list[dict[str, np.ndarray]] = [{} for _ in range(1 + len(LENGTHS))]
    for lang, word, n in zip(rows["lang"], rows["word"], rows["n"]):
        at = place[lang]
        for table, names in zip(tables, [[word], *(grams(word, length) for length in LENGTHS)]):
            for name in names:
                if name not in table:
                    table[name] = np.zeros(len(languages))
                table[name][at] += n
    scores = []
    for table in tables:
        counts = np.array(list(table.values())).reshape(len(table), len(languages))
        scores.append(np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * (len(table) + 1))))
    known = {name: i for i, name in enumerate(tables[0])}
    parts: dict[str, int] = {}
    row = len(known)
    for table in tables[1:]:
        for name in table:
            parts[name] = row
            row += 1
    return Model(languages, known, parts, np.concatenate(scores) if languages else np.zeros((0, 0)))


class Scorer:
    """Scores texts and remembers the scores of words."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.languages)))

    def rows(self, found: list[str]) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.forget()
        known = self.known
        for word in set(found).difference(known):
            if len(known) == len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.scores[len(known)] = self.model.score(word)
            known[word] = len(known)
        return list(map(known.__getitem__, found))

    def predict(self, text: str | None) -> tuple[str, float]:
        found = words(text)
        if not found or not self.model.languages:
            return UNKNOWN, 0.0
        total = self.scores_of(found)
        best = int(np.argmax(total))
        # Words of a text are not independent; the root keeps the score of a long text from being always 1.
        odds = np.exp((total - total[best]) / np.sqrt(len(found)))
        return self.model.languages[best], float(1 / odds.sum())

    def scores_of(self, found: list[str]) -> np.ndarray:
        rows = self.rows(found)
        return self.scores[rows].sum(axis=0)


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``df`` but the text, with ``lang_pred`` and ``score`` (0 to 1)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c != text_col]

    def start():
        scorer = Scorer(shared.value)

        def predict_group(texts):
            found = [scorer.predict(t) for t in texts]
            return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

        return predict_group

    made = {"lang_pred": ("string", pa.string()), "score": ("double", pa.float64())}
    return with_columns_of_texts(df, text_col, keep, made, start)
