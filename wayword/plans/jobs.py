"""The four jobs, from input paths to output paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.graph import adjacency, drop_isolated, road_graph, written
from ..operators.lexicon import Lexicon
from ..operators.paths import shortest_paths
from ..operators.posts import Topics, clean_posts, tag_and_score, to_sink_rows
from ..operators.word_lists import WordList, merge_word_lists
from ..operators.words import TOP_K, common_counts, word_count
from ..sources.osm import read_nodes, read_ways
from ..sources.posts import read_posts_in_splits
from ..sources.sinks import (
    append_with_ids, next_id, with_row_id, write_adjacency, write_counts, write_paths, write_table, write_topk,
)
from ..sources.text import read_lines, read_pairs, read_tagged, read_topics, read_word_list
from ..streaming.posts import batch_folder_writer, sink_rows, write_batches


def count_words(spark: SparkSession, lines: str, out: str) -> None:
    """Occurrences of every word in a folder of text."""
    write_counts(word_count(read_lines(spark, lines)), out)


def rank_common_words(
    spark: SparkSession, first: str, second: str, stop: str, out: str, k: int = TOP_K
) -> None:
    """The k words that two texts use most in common, without stop words."""
    tagged = read_tagged(spark, {1: first, 2: second})
    write_topk(common_counts(tagged, read_word_list(spark, stop)), out, k)


def map_roads(
    spark: SparkSession, osm: str, pairs: str, adjacency_out: str, paths_out: str, max_hops: int | None = None
) -> None:
    """Adjacency list of the road graph of a map, and a shortest path for every request.

    The map is parsed once: vertices and edges are written down and read from there.
    """
    graph = drop_isolated(written(road_graph(read_nodes(spark, osm), read_ways(spark, osm))))
    write_adjacency(adjacency(graph), adjacency_out)
    write_paths(shortest_paths(graph, read_pairs(spark, pairs), max_hops), paths_out)


def scored_posts(
    spark: SparkSession, posts: str, stop_lists: Sequence[str], topic_file: str, topics: Sequence[str],
    lexicon: Lexicon,
) -> DataFrame:
    """Tagged and scored posts of a CSV file: ``topic, time, user, tweet, terms, sentiment``."""
    stop = merge_word_lists(*(read_word_list(spark, path) for path in stop_lists))
    clean = clean_posts(read_posts_in_splits(spark, posts), stop)
    return tag_and_score(clean, read_topics(spark, topic_file, topics), lexicon)


def archive_posts(scored: DataFrame, target: str, mode: str = "overwrite", **options: str) -> None:
    """Write scored posts to the sink table with a generated id; appended rows go on above the largest id."""
    start = next_id(scored.sparkSession, target, **options) if mode == "append" else 1
    write_table(with_row_id(to_sink_rows(scored), start), target, mode, **options)


def append_posts(scored: DataFrame, target: str, **options: str) -> int:
    """Append scored posts to the sink table; any number of jobs may do so at the same time."""
    return append_with_ids(to_sink_rows(scored), target, **options)


def stream_posts(
    posts: DataFrame, stop: WordList, topics: Topics, lexicon: Lexicon, target: str, checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Tag and score a stream of raw posts, and write every batch to a folder of its own below ``target``.

    A batch goes through the batch operators, so the lists may be of any size.
    """
    write = batch_folder_writer(target)

    def work(batch: DataFrame, batch_id: int) -> None:
        write(sink_rows(batch, stop, topics, lexicon), batch_id)

    return write_batches(posts, work, checkpoint, available_now)
