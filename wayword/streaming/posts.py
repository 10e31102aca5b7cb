"""Posts as an unbounded stream.

Cleansing, tagging and scoring look at one post at a time, so they need no state, watermark or late-data rule. Short word
lists are part of the plan and run on a stream unchanged; with lists of any size each batch is worked on as a batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.lexicon import Lexicon
from ..operators.posts import Topics, clean_posts, tag_and_score, to_sink_rows
from ..operators.word_lists import WordList
from ..sources.sinks import with_dense_row_id


def sink_rows(
    posts: DataFrame,
    stop: WordList,
    topics: Topics,
    lexicon: Lexicon,
) -> DataFrame:
    """From raw posts to the rows of the sink table, for a batch, or for a stream if the lists are short."""
    return to_sink_rows(tag_and_score(clean_posts(posts, stop), topics, lexicon))


def write_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Hand every micro-batch and its number to ``write``.

    A batch may come again after a failure, with the same number and rows; ``write`` should then replace what
    it wrote before (see ``batch_folder_writer``).
    """
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


# Rows of one batch that have ids of their own.
BATCH_IDS = 1 << 40


def batch_folder_writer(path: str, format: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to a folder of its own, which a repeated batch replaces.

    Rows get an ``id``: the number of the batch and the place in it, so ids rise from batch to batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = with_dense_row_id(batch, batch.columns, batch_id * BATCH_IDS + 1)
        numbered.write.mode("overwrite").format(format).save(f"{path}/batch_id={batch_id}")

    return write
