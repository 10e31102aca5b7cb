"""Sentiment classes and model input."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Score limits of the classes, and the input length of the model.
POSITIVE_ABOVE = 0.6
NEUTRAL_ABOVE = 0.4
MODEL_LENGTH = 70


def sentiment_sign(polarity: Column | str) -> Column:
    """1 above zero, 0 at zero, -1 below."""
    return F.signum(polarity).cast("int")


def sentiment_from_score(score: Column) -> Column:
    """1 above 0.6, 0 above 0.4, otherwise -1."""
    return F.when(score > POSITIVE_ABOVE, 1).when(score > NEUTRAL_ABOVE, 0).otherwise(-1)


def pad_pre(ids: Column, length: int = MODEL_LENGTH) -> Column:
    """Exactly ``length`` ids: zeros in front of a short list, the last ids of a long one."""
    n = F.size(ids)
    kept = F.slice(ids, F.greatest(n - length, F.lit(0)) + 1, F.lit(length))
    return F.concat(F.array_repeat(F.lit(0), F.greatest(F.lit(length) - n, F.lit(0))), kept)
