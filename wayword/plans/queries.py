"""One query per operator over the test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import dates, scores, tags, text
from ..operators import distances, encode, graph as roads, lexicon, modified, neighbours, paths, posts as post_ops, word_lists, words
from ..session import materialise, scratch_path
from ..sources import osm, posts as post_files, sinks, text as text_files
from ..streaming import posts as stream
from . import jobs, standins as given

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# Words


@query
def word_count(spark, sf_dir):
    return words.word_count(given.table(spark, sf_dir, "documents"), "text")


@query
def counts_by_source(spark, sf_dir):
    return words.counts_by_source(given.tagged_lines(spark, sf_dir))


@query
def common_word_bag(spark, sf_dir):
    return words.common_counts(given.tagged_lines(spark, sf_dir))


@query
def topk_common_words(spark, sf_dir):
    return words.topk_common_words(given.tagged_lines(spark, sf_dir), given.LINE_STOP_WORDS)


@query
def words_without_stop_list(spark, sf_dir):
    """Kept words per document, with the stop list as a table."""
    tokens = words.explode_words(given.table(spark, sf_dir, "documents"), "text", "doc_id")
    kept = word_lists.remove_stopwords(tokens, given.stop_table(spark), by_join=True)
    return kept.groupBy("doc_id").agg(F.count("*").alias("n_kept"), F.max("word").alias("last_word"))


@query
def merged_word_list(spark, sf_dir):
    """Words of the part names and of the chat roles as one list."""
    names = words.explode_words(given.table(spark, sf_dir, "part"), "p_name")
    roles = given.table(spark, sf_dir, "conversations").select(F.col("role").alias("word"))
    return word_lists.merge_word_lists(names, roles)


@query
def text_file_counts(spark, sf_dir):
    """Documents written as text files, counted by the word count job, and its output read back."""
    folder = scratch_path(spark, "text-file-counts")
    given.table(spark, sf_dir, "documents").select("text").write.text(f"{folder}/lines")
    jobs.count_words(spark, f"{folder}/lines", f"{folder}/counts")
    return text_files.read_lines(spark, f"{folder}/counts").select(F.col("value").alias("line"))


@query
def text_file_common_words(spark, sf_dir):
    """Two corpora and a stop list as files, ranked by the common words job, and its output read back."""
    folder = scratch_path(spark, "text-file-common-words")
    given.table(spark, sf_dir, "documents").select("text").write.text(f"{folder}/first")
    given.table(spark, sf_dir, "conversations").select("text").write.text(f"{folder}/second")
    given.stop_table(spark).write.text(f"{folder}/stop")
    jobs.rank_common_words(
        spark, f"{folder}/first", f"{folder}/second", f"{folder}/stop", f"{folder}/ranked"
    )
    return text_files.read_lines(spark, f"{folder}/ranked").select(F.col("value").alias("line"))


# Cleansing and dates


@query
def noise_free_pages(spark, sf_dir):
    """Web pages, which are full of links and signs, without them."""
    pages = given.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.collapse_spaces(text.normalise("html")).alias("plain"))


@query
def cleansed_text(spark, sf_dir):
    documents = given.table(spark, sf_dir, "documents").select("doc_id", "text")
    return post_ops.cleanse_column(documents, "text", given.STOP_WORDS)


@query
def cleansed_text_by_join(spark, sf_dir):
    """The same with a stop list that is joined, as is done for a very long one."""
    documents = given.table(spark, sf_dir, "documents").select("doc_id", text.normalise("text").alias("text"))
    return post_ops.remove_stopwords_by_join(documents, "text", given.stop_table(spark))


@query
def dated_posts(spark, sf_dir):
    kept = post_ops.keep_dated_posts(given.event_posts(spark, sf_dir))
    return kept.select("event_id", "user_name", dates.parse_post_time("date").alias("posted_at"))


@query
def epoch_dates(spark, sf_dir):
    """Order dates with two-digit years, some in a form that is not read."""
    orders = given.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        f"""CASE o_orderkey % 4
              WHEN 0 THEN {given.day_first('o_orderdate', '-', 2)}
              WHEN 1 THEN {given.day_first('o_orderdate', '/', 2)}
              WHEN 2 THEN {given.day_first('o_orderdate', '.', 2, padded=False)}
              ELSE {given.day_first('o_orderdate', '-')} END AS date""",
    )
    return orders.select("o_orderkey", "date", dates.parse_epoch("date").alias("epoch"))


# Posts


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_ops.clean_posts(given.posts(spark, sf_dir), given.STOP_WORDS)


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_ops.tag_topics(_clean(spark, sf_dir), given.TOPICS)


def _sink_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.sink_rows(given.posts(spark, sf_dir), given.STOP_WORDS, given.TOPICS, given.LEXICON)


def _show_terms(tagged: DataFrame) -> DataFrame:
    return tagged.withColumn("terms", F.array_join("terms", " "))


@query
def clean_posts(spark, sf_dir):
    return post_ops.clean_posts(given.posts(spark, sf_dir), given.STOP_WORDS, placeholders=True)


@query
def topic_posts(spark, sf_dir):
    return _show_terms(_tagged(spark, sf_dir))


@query
def topic_posts_by_join(spark, sf_dir):
    """The same with topics read from a JSON file and joined, as is done for a very long dictionary."""
    path = scratch_path(spark, "topics")
    whole = json.dumps({**given.TOPICS, "other": ["thon"]})
    spark.createDataFrame([(whole,)], "value string").write.text(path)
    topics = text_files.read_topics(spark, path, list(given.TOPICS))
    return _show_terms(post_ops.tag_topics(_clean(spark, sf_dir), topics, by_join=True))


@query
def post_polarity(spark, sf_dir):
    scored = lexicon.polarity(_clean(spark, sf_dir), given.LEXICON)
    return scored.withColumn("sentiment", scores.sentiment_sign("polarity"))


@query
def post_polarity_by_join(spark, sf_dir):
    """The same with a lexicon that is joined, as is done for a very large one."""
    scored = lexicon.polarity(_clean(spark, sf_dir), given.lexicon_table(spark), by_join=True)
    return scored.withColumn("sentiment", scores.sentiment_sign("polarity"))


@query
def post_subjectivity(spark, sf_dir):
    return lexicon.subjectivity(_clean(spark, sf_dir), given.LEXICON)


@query
def modified_polarity(spark, sf_dir):
    """Words strengthen, weaken or turn the values of those after them."""
    return modified.modified_polarity(_clean(spark, sf_dir), given.LEXICON, given.MODIFIERS)


@query
def modified_polarity_by_join(spark, sf_dir):
    """The same with tables that are joined, as is done for very large ones."""
    tables = given.lexicon_table(spark), given.modifier_table(spark)
    return modified.modified_polarity(_clean(spark, sf_dir), *tables, by_join=True)


@query
def score_classes(spark, sf_dir):
    events = given.table(spark, sf_dir, "events").selectExpr("event_id", "value / (value + 20) AS score")
    return events.withColumn("sentiment", scores.sentiment_from_score(F.col("score")))


def _vocabulary(clean: DataFrame) -> DataFrame:
    """All words with their rank by frequency."""
    counts = words.word_count(clean, "text", sorted=False).select((-F.col("cnt")).alias("rarity"), "word")
    return sinks.with_dense_row_id(counts, ["rarity", "word"]).select("word", F.col("id").cast("int").alias("id"))


def _encoded(spark: SparkSession, sf_dir: str, by_join: bool = False) -> DataFrame:
    documents = materialise(cleansed_text(spark, sf_dir), scratch_path(spark, "cleansed"))
    return encode.encode_tokens(documents, _vocabulary(documents), "text", by_join)


@query
def encoded_tokens(spark, sf_dir):
    padded = F.array_join(scores.pad_pre(F.col("ids")).cast("array<string>"), " ")
    return _encoded(spark, sf_dir).select("doc_id", F.size("ids").alias("n_ids"), padded.alias("padded"))


@query
def encoded_tokens_by_join(spark, sf_dir):
    """The same with a vocabulary that is joined, as is done for a very large one."""
    padded = F.array_join(scores.pad_pre(F.col("ids")).cast("array<string>"), " ")
    encoded = _encoded(spark, sf_dir, by_join=True)
    return encoded.select("doc_id", F.size("ids").alias("n_ids"), padded.alias("padded"))


@query
def model_scores(spark, sf_dir):
    """The model hook with a stand-in model."""

    def predict(ids: np.ndarray) -> np.ndarray:
        return ids.sum(axis=1) % 1000 / 1000

    scored = encode.score_with_model(_encoded(spark, sf_dir).select("doc_id", "ids"), predict)
    return scored.select("doc_id", "score", "sentiment")


@query
def loaded_model_scores(spark, sf_dir):
    """The same stand-in model, read from a file by every worker."""
    folder = scratch_path(spark, "model")
    spark.createDataFrame([(json.dumps({"modulus": 1000}),)], "value string").coalesce(1).write.text(folder)
    (model,) = spark.read.text(folder).inputFiles()

    def load(file: str) -> Callable[[np.ndarray], np.ndarray]:
        modulus = json.loads(Path(file).read_text())["modulus"]
        return lambda ids: ids.sum(axis=1) % modulus / modulus

    scored = encode.score_with_model_file(_encoded(spark, sf_dir).select("doc_id", "ids"), model, load)
    return scored.select("doc_id", "score", "sentiment")


@query
def sentiment_sink_rows(spark, sf_dir):
    return _sink_rows(spark, sf_dir)


@query
def numbered_sink_rows(spark, sf_dir):
    order = ["posted_at", "topic", "sentiment", "post"]
    return sinks.with_dense_row_id(_sink_rows(spark, sf_dir), order)


@query
def archived_posts(spark, sf_dir):
    """Sink rows in a table: replaced by the first two topics, then the others appended."""
    folder = scratch_path(spark, "archive")
    scored = post_ops.tag_and_score(_clean(spark, sf_dir), given.TOPICS, given.LEXICON)
    scored = materialise(scored, f"{folder}/scored")
    early = F.col("topic").isin("harbour", "market")
    archive = f"{folder}/archive"
    jobs.archive_posts(scored.where(~early), archive)
    jobs.archive_posts(scored.where(early), archive)
    jobs.archive_posts(scored.where("topic = 'transit'"), archive, "append")
    jobs.archive_posts(scored.where("topic = 'weather'"), archive, "append")
    return _with_id_check(spark.read.parquet(archive))


@query
def appended_posts(spark, sf_dir):
    """Sink rows of four topics, appended by four writers at the same time."""
    folder = scratch_path(spark, "appended")
    scored = post_ops.tag_and_score(_clean(spark, sf_dir), given.TOPICS, given.LEXICON)
    scored = materialise(scored, f"{folder}/scored")
    with ThreadPoolExecutor(len(given.TOPICS)) as writers:
        parts = [scored.where(F.col("topic") == topic) for topic in given.TOPICS]
        list(writers.map(lambda part: jobs.append_posts(part, f"{folder}/archive"), parts))
    return _with_id_check(spark.read.parquet(f"{folder}/archive").drop("append"))


def _with_id_check(rows: DataFrame) -> DataFrame:
    """Each row with the number of rows that share its id instead of the id, which has gaps."""
    return rows.withColumn("rows_with_id", F.count("*").over(Window.partitionBy("id"))).drop("id")


@query
def post_job(spark, sf_dir):
    """The whole job on files: posts, stop lists and topics are read, tagged and scored posts are archived."""
    folder = scratch_path(spark, "post-job")
    given.posts(spark, sf_dir).write.options(header=True, quoteAll=True, escape='"').csv(f"{folder}/posts")
    stop = given.stop_table(spark)
    stop.where("word < 'e'").write.text(f"{folder}/stop-1")
    stop.where("word > 'd'").write.text(f"{folder}/stop-2")
    spark.createDataFrame([(json.dumps(given.TOPICS),)], "value string").write.text(f"{folder}/topics")
    scored = jobs.scored_posts(
        spark, f"{folder}/posts", [f"{folder}/stop-1", f"{folder}/stop-2"], f"{folder}/topics", list(given.TOPICS),
        given.LEXICON,
    )
    jobs.archive_posts(scored, f"{folder}/archive")
    return _with_id_check(spark.read.parquet(f"{folder}/archive"))


@query
def csv_posts(spark, sf_dir):
    """Posts written as CSV with quotes and line breaks inside, read back and cleansed."""
    path = scratch_path(spark, "csv-posts")
    given.posts(spark, sf_dir).write.options(header=True, quoteAll=True, escape='"').csv(path)
    return post_ops.clean_posts(post_files.read_posts(spark, path), given.STOP_WORDS)


@query
def csv_posts_in_splits(spark, sf_dir):
    """The same, where every file may be read by many tasks."""
    path = scratch_path(spark, "csv-posts-in-splits")
    given.posts(spark, sf_dir).write.options(header=True, quoteAll=True, escape='"').csv(path)
    return post_ops.clean_posts(post_files.read_posts_in_splits(spark, path), given.STOP_WORDS)


@query
def streamed_topic_posts(spark, sf_dir):
    """The sink rows again, from a stream over the documents that is run to its end."""
    folder = scratch_path(spark, "stream")
    reader = spark.readStream.schema(given.table(spark, sf_dir, "documents").schema)
    # The table is a file or a folder of files; a stream takes a file only by a pattern.
    documents = reader.parquet(f"{sf_dir}/documents.parque[t]")
    jobs.stream_posts(
        given.as_posts(documents), given.STOP_WORDS, given.TOPICS, given.LEXICON, f"{folder}/rows",
        f"{folder}/checkpoint", available_now=True,
    ).awaitTermination()
    schema = "id bigint, posted_at timestamp_ntz, post string, topic string, sentiment int, batch_id int"
    return _with_id_check(spark.read.schema(schema).parquet(f"{folder}/rows").drop("batch_id"))


# Roads


@query
def way_pairs(spark, sf_dir):
    """Neighbouring nodes of every way, highway or not."""
    pairs = F.inline_outer(tags.consecutive_pairs(F.col("nd._ref")))
    return given.map_ways(spark, sf_dir).select(F.col("_id").alias("way_id"), pairs).where("src IS NOT NULL")


@query
def order_way_pairs(spark, sf_dir):
    """Neighbouring nodes of ways of any length: the parts of an order, line by line."""
    lines = given.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("line")
    )
    pairs = F.posexplode(tags.consecutive_pairs(F.col("line.l_partkey"))).alias("pos", "pair")
    return lines.select("l_orderkey", pairs).select("l_orderkey", "pos", "pair.src", "pair.dst")


@query
def event_successions(spark, sf_dir):
    """Which event follows which; half of the events have one key."""
    events = given.table(spark, sf_dir, "events").withColumn("user_group", F.expr("if(user_id % 2 = 0, 0, user_id)"))
    return neighbours.consecutive_pairs(events, ["user_group"], ["ts", "event_id"], "event_type").drop("ts")


@query
def way_tags(spark, sf_dir):
    return given.map_ways(spark, sf_dir).select(
        F.col("_id").alias("way_id"),
        tags.tag_value("tag", "highway").alias("highway"),
        tags.is_highway("tag").alias("is_highway"),
        tags.is_oneway("tag").alias("is_oneway"),
    )


@query
def road_edges(spark, sf_dir):
    return roads.ways_to_edges(given.map_ways(spark, sf_dir))


@query
def connected_vertices(spark, sf_dir):
    return roads.drop_isolated(given.graph(spark, sf_dir)).vertices


@query
def adjacency(spark, sf_dir):
    rows = roads.adjacency(given.connected_graph(spark, sf_dir))
    return rows.select(
        "id", "part", F.size("dsts").alias("degree"), roads.adjacency_line("id", F.col("dsts")).alias("line")
    )


@query
def edge_lengths(spark, sf_dir):
    edges = roads.with_edge_length(roads.written(given.graph(spark, sf_dir)))
    return edges.withColumn("length_m", F.round("length_m", 2))


@query
def shortest_paths(spark, sf_dir):
    found = paths.shortest_paths(given.connected_graph(spark, sf_dir), given.path_pairs(spark, sf_dir))
    return found.withColumn("path", paths.path_line("path"))


@query
def shortest_by_length(spark, sf_dir):
    """The fewest metres for the same requests. In whole ones, as sines differ in their last bits."""
    found = distances.shortest_by_length(given.connected_graph(spark, sf_dir), given.path_pairs(spark, sf_dir))
    return found.select("pair_id", "src", "dst", F.round("length_m").alias("length_m"))


# An XML file is read by one task, so each holds so many elements at most, one in a line.
MAP_FILE_ELEMENTS = 100_000


def _write_map(spark: SparkSession, sf_dir: str, folder: str) -> None:
    for name, tag in (("nodes", "node"), ("ways", "way")):
        elements = given.map_nodes(spark, sf_dir) if tag == "node" else given.map_ways(spark, sf_dir)
        options = {"rootTag": "osm", "rowTag": tag, "indent": "", "maxRecordsPerFile": MAP_FILE_ELEMENTS}
        elements.write.format("xml").options(**options).save(f"{folder}/{name}")


@query
def osm_road_edges(spark, sf_dir):
    """Edges of a map that was written as XML and read back."""
    folder = scratch_path(spark, "osm")
    _write_map(spark, sf_dir, folder)
    return roads.ways_to_edges(osm.read_ways(spark, f"{folder}/ways"))


@query
def osm_adjacency_lines(spark, sf_dir):
    """Adjacency file of a map that was written as XML and read back."""
    folder = scratch_path(spark, "osm-adjacency")
    _write_map(spark, sf_dir, folder)
    graph = roads.road_graph(
        osm.read_nodes(spark, f"{folder}/nodes"), osm.read_ways(spark, f"{folder}/ways")
    )
    graph = roads.drop_isolated(roads.written(graph))
    sinks.write_adjacency(roads.adjacency(graph), f"{folder}/adjacency")
    return text_files.read_lines(spark, f"{folder}/adjacency").select(F.col("value").alias("line"))


@query
def path_file_lines(spark, sf_dir):
    """Requests read from a file, and the path file read back."""
    folder = scratch_path(spark, "path-file")
    requests = given.path_pairs(spark, sf_dir)
    requests.select(F.concat_ws(" ", "src", "dst")).write.text(f"{folder}/requests")
    pairs = text_files.read_pairs(spark, f"{folder}/requests")
    found = paths.shortest_paths(given.connected_graph(spark, sf_dir), pairs)
    sinks.write_paths(found, f"{folder}/paths")
    return text_files.read_lines(spark, f"{folder}/paths").select(F.col("value").alias("line"))
