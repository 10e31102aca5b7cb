"""Model input and the hook for a model."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from ..functions.lookup import lookup
from ..functions.scores import MODEL_LENGTH, pad_pre, sentiment_from_score
from ..functions.text import split_on_space
from ..session import materialise_counted, scratch_path
from . import skew
from .per_text import KEY, per_text
from .word_lists import LITERAL_BYTES, LITERAL_WORDS, small_rows

Predict = Callable[[np.ndarray], np.ndarray]

# The model that this Python worker has loaded last, by the call that asked for it.
_LOADED: dict[str, Predict] = {}

# word -> id, or a table with the columns word, id
Vocabulary = Mapping[str, int] | DataFrame


def one_id_per_word(vocabulary: DataFrame) -> DataFrame:
    """The vocabulary with each word once, with the smallest of its ids."""
    known = vocabulary.where("word IS NOT NULL AND id IS NOT NULL")
    return known.groupBy("word").agg(F.min(F.col("id").cast("int")).alias("id"))


def _literal(vocabulary: Vocabulary) -> dict[str, int] | None:
    if isinstance(vocabulary, DataFrame):
        rows = small_rows(one_id_per_word(vocabulary), "word")
        return None if rows is None else {r["word"]: r["id"] for r in rows}
    if len(vocabulary) > LITERAL_WORDS or sum(len(w.encode()) for w in vocabulary) > LITERAL_BYTES:
        return None
    return dict(vocabulary)


def _known_words(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``row_key, pos, id`` of the words that the vocabulary has.

    Of a vocabulary that is too long for a broadcast, the words with the smallest ids are broadcast all the same: ids
    mostly go by frequency, so that few words are left to be moved. Any other order of the ids gives the same result.
    """
    known, n = materialise_counted(one_id_per_word(vocabulary), scratch_path(words.sparkSession, "vocabulary"))
    if n <= skew.BROADCAST_ROWS:
        return words.join(F.broadcast(known), "word").select(KEY, "pos", "id")
    # Fewer rows than so many have a smaller id than this one, however many share it.
    cut = known.agg(F.percentile_approx("id", skew.BROADCAST_ROWS / n, 10_000)).first()[0]
    tried = words.join(F.broadcast(known.where(F.col("id") < cut)), "word", "left")
    rare = tried.where("id IS NULL").drop("id").join(known.where(F.col("id") >= cut), "word")
    return tried.where("id IS NOT NULL").select(KEY, "pos", "id").unionByName(rare.select(KEY, "pos", "id"))


def _encode_by_join(posts: DataFrame, vocabulary: DataFrame, text: str) -> DataFrame:
    def ids_of(words: DataFrame) -> DataFrame:
        # A group is the words of one text, so it is no larger than the row it came from. Place and id are one number.
        at = F.col("pos").cast("long") * (1 << 32) + (F.col("id").cast("long") + (1 << 31))
        found = _known_words(words, vocabulary).groupBy(KEY).agg(F.sort_array(F.collect_list(at)).alias("_found"))
        ids = F.transform("_found", lambda x: (x.bitwiseAND(F.lit((1 << 32) - 1)) - (1 << 31)).cast("int"))
        return found.select(KEY, ids.alias("ids"))

    encoded = per_text(posts, text, split_on_space(text), ids_of, "left")
    return encoded.select(*posts.columns, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))


def encode_tokens(
    posts: DataFrame, vocabulary: Vocabulary, text: str = "tweet", by_join: bool = False
) -> DataFrame:
    """Add ``ids``: the id of every word of the text in order; unknown words are left out. No text has no ids."""
    ids = None if by_join else _literal(vocabulary)
    if ids is not None:
        found = F.transform(split_on_space(text), lambda w: lookup(w, ids, "int"))
        return posts.withColumn("ids", F.coalesce(F.array_compact(found), F.array().cast("array<int>")))
    if not isinstance(vocabulary, DataFrame):
        vocabulary = posts.sparkSession.createDataFrame(list(vocabulary.items()), "word string, id int")
    return _encode_by_join(posts, vocabulary, text)


def score_with_model(
    encoded: DataFrame, predict: Callable[[np.ndarray], np.ndarray], length: int = MODEL_LENGTH
) -> DataFrame:
    """Add ``score`` and ``sentiment`` from a model the caller brings.

    ``predict`` takes an integer matrix with one padded post per row and returns one score per row. It is
    called once per Arrow batch.
    """

    @F.pandas_udf("double")
    def score(padded: pd.Series) -> pd.Series:
        if padded.empty:
            return pd.Series([], dtype="float64")
        return pd.Series(np.asarray(predict(np.stack(padded.to_numpy())), dtype="float64").reshape(-1))

    ids = F.coalesce("ids", F.array().cast("array<int>"))
    scored = encoded.withColumn("score", score(pad_pre(ids, length)))
    return scored.withColumn("sentiment", sentiment_from_score(F.col("score")))


def loaded(key: str, load: Callable[[], Predict]) -> Predict:
    """The model of a call, loaded the first time that this worker needs it; an earlier call's model is let go."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = load()
    return _LOADED[key]


def score_with_model_file(
    encoded: DataFrame, model_file: str, load: Callable[[str], Predict], length: int = MODEL_LENGTH
) -> DataFrame:
    """``score_with_model`` for a model that is a file, of any size.

    Every executor fetches the file once, from any store that Spark reads, and ``load`` makes the model from its path
    there, once for each Python worker. Tasks carry only ``load`` and the file's name, by which Spark knows it: two
    different files of a session need different names.
    """
    key = uuid.uuid4().hex
    encoded.sparkSession.sparkContext.addFile(model_file)
    name = os.path.basename(model_file)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = loaded(key, lambda: load(SparkFiles.get(name)))
        for padded in batches:
            if padded.empty:
                yield pd.Series([], dtype="float64")
            else:
                yield pd.Series(np.asarray(predict(np.stack(padded.to_numpy())), dtype="float64").reshape(-1))

    ids = F.coalesce("ids", F.array().cast("array<int>"))
    scored = encoded.withColumn("score", score(pad_pre(ids, length)))
    return scored.withColumn("sentiment", sentiment_from_score(F.col("score")))
