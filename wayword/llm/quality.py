"""Quality of texts by a vote of the most similar labelled texts.

A text becomes the weights of its terms: byte trigrams, hashed to ``TERMS`` places, and how much of it repeats (words
that follow themselves, words and lines that came before). A weight is the logarithm of the count times the rarity of
the term among the labelled texts. A truncated singular value decomposition of the labelled texts maps these
to ``TOPICS`` numbers. The cosine of every text with every labelled text is computed in blocks, and the ``NEIGHBOURS``
most similar ones (and all that tie with the last of them) vote with their label, weighted by a power of the cosine.

It is learnt from at most ``SAMPLE`` labelled texts (by the order of a hash of the key), which bounds what is
broadcast; every text is scored whole. Null and empty texts, and texts that resemble no labelled text, get the mean
label. If nothing is labelled, all scores are 0.5. Of several labels of one text their mean counts. Repeated rows are
scored like others; no other column than those named is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrow import groups, with_columns_of_texts

# The bound of the sample that is learnt from.
SAMPLE = 2000

TERMS = 4096
REPEATS = 3
REPEAT_WEIGHT = 3.0
TOPICS = 64
NEIGHBOURS = 15
POWER = 4
BLOCK = 512
SEED = 42


def repetition(text: str) -> list[float]:
    """Shares, in thousandths: words that follow themselves, words and lines that came before."""
    words, lines = text.split(), text.split("\n")
    if not words:
        return [0.0] * REPEATS
    again = sum(map(eq, words, islice(words, 1, None)))
    return [
        1000 * again / len(words),
        1000 * (1 - len(set(words)) / len(words)),
        1000 * (1 - len(set(lines)) / len(lines)),
    ]


def term_counts(text: str | None) -> np.ndarray:
    """How often each hashed byte trigram occurs, and the shares of what repeats."""
    return np.concatenate([trigram_counts(text), repetition(text or "")]).astype(np.float32)


def trigram_counts(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(TERMS)
    code = (data[:-2] << np.uint32(16)) + (data[1:-1] << np.uint32(8)) + data[2:]
    # Fixed value: a multiplier that spreads whole numbers over the upper bits.
    code = (code * np.uint32(2654435769)) >> np.uint32(32 - 12)
    return np.bincount(code, minlength=TERMS).astype(np.float64)


@dataclass
class Model:
    rarity: np.ndarray  # by term
    axes: np.ndarray  # terms x topics
    vectors: np.ndarray  # labelled texts x topics, of length 1
    labels: np.ndarray

    @property
    def mean(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def vectors_of(self, counts: np.ndarray) -> np.ndarray:
        return unit(weights(counts, self.rarity) @ self.axes)

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Vote of the nearest labelled texts, a block of texts at a time."""
        out = np.full(len(vectors), self.mean)
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(vectors) if k else 0, BLOCK):
            near = vectors[a : a + BLOCK] @ self.vectors.T
            least = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            vote = np.where(near >= least[:, None], np.maximum(near, 0) ** POWER, 0)
            total = vote.sum(axis=1)
            some = total > 0
            out[a : a + BLOCK][some] = (vote @ self.labels)[some] / total[some]
        return np.clip(out, 0.0, 1.0)


def weights(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Weights of the terms, in the place of their counts."""
    rows = np.log1p(counts, out=counts)
    rows[:, :TERMS] *= rarity[:TERMS]
    # Nearly every text repeats some word, so its rarity says nothing.
    rows[:, TERMS:] *= REPEAT_WEIGHT
    return unit(rows)


def unit(rows: np.ndarray) -> np.ndarray:
    """The rows at length 1, in place; empty ones stay empty."""
    length = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    rows /= np.where(length > 0, length, 1)[:, None].astype(rows.dtype)
    return rows


def main_axes(rows: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` main right singular vectors, by a few rounds of subspace iteration."""
    n = min(n, *rows.shape)
    found = np.random.default_rng(SEED).standard_normal((rows.shape[1], n + min(16, rows.shape[1] - n)))
    found = found.astype(rows.dtype)
    for _ in range(4):
        found, _ = np.linalg.qr(rows.T @ (rows @ found))
    _, _, turn = np.linalg.svd(rows @ found, full_matrices=False)
    return (found @ turn.T)[:, :n]


def learn(documents: DataFrame, labels: DataFrame, text_col: str = "text", key_col: str = "doc_id",
          sample: int = SAMPLE) -> Model:
    """The model of the labelled documents; ``labels`` has the key and ``label`` (0 to 1)."""
    chosen = labels.where(F.col("label").isNotNull() & F.col(key_col).isNotNull())
    chosen = chosen.groupBy(key_col).agg(F.avg("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64(key_col), key_col).limit(sample)
    rows = documents.where(F.col(text_col).isNotNull()).join(F.broadcast(chosen), key_col)
    rows = rows.select("label", F.col(text_col).alias("text"), F.xxhash64(key_col).alias("turn"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text, turn in zip(*(batch.column(c).to_pylist() for c in ("label", "text", "turn"))):
                # Half precision is enough for logarithms, and halves what the driver gets.
                counts = np.minimum(term_counts(text), 60_000).astype("<f2").tobytes()
                yield pa.RecordBatch.from_pydict({"label": [label], "counts": [counts], "turn": [turn]})

    # A key may stand for several rows; the limit holds for rows too.
    counted = rows.mapInArrow(count, "label double, counts binary, turn bigint")
    counted = counted.orderBy("turn", F.xxhash64("counts")).limit(sample).select("label", "counts").toArrow()
    given = np.array(counted["label"].to_pylist(), dtype=np.float64)
    # One row after the other goes into the matrix, and the collected table is let go: the driver holds little else.
    counts = np.empty((len(given), TERMS + REPEATS), dtype=np.float32)
    for row, data in enumerate(counted["counts"]):
        counts[row] = np.frombuffer(data.as_buffer(), dtype="<f2")
    del counted
    known = np.count_nonzero(counts, axis=0)
    rarity = np.log((1 + len(counts)) / (1 + known)).astype(np.float32)
    if not len(given):
        return Model(rarity, np.zeros((TERMS + REPEATS, 1), dtype=np.float32), np.zeros((0, 1)), given)
    rows_of = weights(counts, rarity)
    axes = main_axes(rows_of, TOPICS)
    return Model(rarity, axes, unit(rows_of @ axes), given)


def score(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text) with ``score`` and ``predicted`` (1 from a score of one half on)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c != text_col] if keep is None else keep

    def start():
        model = shared.value

        def score_group(texts):
            scores = model.scores(model.vectors_of(np.stack([term_counts(t) for t in texts])))
            return {"score": scores, "predicted": (scores >= 0.5).astype(np.int32)}

        return score_group

    made = {"score": ("double", pa.float64()), "predicted": ("int", pa.int32())}
    return with_columns_of_texts(df, text_col, keep, made, start)


def keep_good(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text is not predicted to be bad, with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            row = 0
            for group in groups(texts):
                good = model.scores(model.vectors_of(np.stack([term_counts(t) for t in group]))) >= 0.5
                yield batch.slice(row, len(group)).filter(pa.array(good))
                row += len(group)

    return df.mapInArrow(keep, df.schema)
