"""Posts: choosing, cleansing, topic tags and the rows of the sink table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import has_valid_date, parse_post_time
from ..functions.lookup import lookup
from ..functions.text import cleanse, normalise, split_on_space, tokenize_clean
from .lexicon import Lexicon, literal_lexicon, score_sentiment
from .per_text import KEY, per_text
from .skew import sized_join
from .word_lists import LITERAL_BYTES, LITERAL_WORDS, WordList, as_literal, remove_stopwords, small_rows

Topics = Mapping[str, Sequence[str]] | DataFrame


def select_post_columns(df: DataFrame) -> DataFrame:
    """The three columns that are used; the scan reads no others."""
    return df.select("user_name", "date", "text")


def keep_dated_posts(df: DataFrame) -> DataFrame:
    """Posts that have a text and a date in one of the known forms."""
    return df.where(F.col("text").isNotNull() & has_valid_date("date"))


def remove_stopwords_by_join(df: DataFrame, text: str, stop: WordList) -> DataFrame:
    """Replace a normalised text by its tokens that are in no stop list, for lists too long for a literal."""

    def without_stop_words(words: DataFrame) -> DataFrame:
        # A group is the words of one text, so it is no larger than the row it came from.
        kept = (
            remove_stopwords(words.where("word <> ''"), stop, by_join=True)
            .groupBy(KEY)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("kept"))
        )
        return kept.select(KEY, F.array_join(F.col("kept.word"), " ").alias("_kept"))

    # A text of stop words alone is left empty; a missing text stays missing. The text itself is not moved.
    flagged = df.withColumn("_there", F.col(text).isNotNull())
    whole = per_text(flagged, text, tokenize_clean(F.col(text)), without_stop_words, "left")
    left = F.when(F.col("_there"), F.coalesce("_kept", F.lit("")))
    return whole.withColumn(text, left).select(df.columns)


def cleanse_column(df: DataFrame, text: str, stop: WordList) -> DataFrame:
    """Replace a text by its cleansed form."""
    literal = as_literal(stop)
    if literal is not None:
        return df.withColumn(text, cleanse(text, literal))
    return remove_stopwords_by_join(df.withColumn(text, normalise(text)), text, stop)


def clean_posts(df: DataFrame, stop: WordList, placeholders: bool = False) -> DataFrame:
    """Columns ``user, date, tweet`` of the dated posts, the tweet being the cleansed text.

    ``placeholders`` adds the empty columns ``topic`` and ``terms``.
    """
    posts = cleanse_column(keep_dated_posts(select_post_columns(df)), "text", stop)
    posts = posts.select(F.col("user_name").alias("user"), "date", F.col("text").alias("tweet"))
    if placeholders:
        empty = F.lit(None).cast("string")
        posts = posts.withColumns({"topic": empty, "terms": empty})
    return posts


def _topic_lists(topics: Topics) -> dict[str, list[str]] | None:
    if not isinstance(topics, DataFrame):
        lists = {t: sorted(set(terms)) for t, terms in topics.items()}
        size = sum(len(term.encode()) for terms in lists.values() for term in terms)
        return lists if sum(map(len, lists.values())) <= LITERAL_WORDS and size <= LITERAL_BYTES else None
    flat = topics.select("topic", F.explode(F.array_distinct("terms")).alias("term")).where("term IS NOT NULL")
    rows = small_rows(flat, "topic", "term")
    if rows is None:
        return None
    lists: dict[str, list[str]] = {}
    for r in rows:
        lists.setdefault(r["topic"], []).append(r["term"])
    return {t: sorted(set(terms)) for t, terms in lists.items()}


def _match(posts: DataFrame, lists: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add ``_topics``, the topics of a post; null or empty without any."""
    topics_of: dict[str, list[str]] = {}
    for topic, terms in lists.items():
        for term in terms:
            topics_of.setdefault(term, []).append(topic)
    found = F.transform(split_on_space("tweet"), lambda w: lookup(w, topics_of, "array<string>"))
    topics = F.array_distinct(F.flatten(F.array_compact(found)))
    return posts.withColumn("_topics", F.when(F.col("tweet") != "", topics))


def _one_row_per_topic(matched: DataFrame, lists: Mapping[str, Sequence[str]]) -> DataFrame:
    # Posts without a topic go after the outer explode. A filter on the tweet or its topics would be moved
    # below them by Catalyst, and the post would be cleansed and matched twice.
    rows = matched.withColumn("topic", F.explode_outer("_topics")).where("topic IS NOT NULL").drop("_topics")
    return _tagged(rows, lookup(F.col("topic"), lists, "array<string>"))


def _tagged(rows: DataFrame, terms: Column) -> DataFrame:
    named = ("topic", "date", "user", "tweet", "terms")
    others = [c for c in rows.columns if c not in named]
    return rows.select("topic", F.col("date").alias("time"), "user", "tweet", terms.alias("terms"), *others)


def _tag_by_join(posts: DataFrame, topics: DataFrame) -> DataFrame:
    flat = topics.select("topic", F.explode("terms").alias("word")).where("word IS NOT NULL").distinct()
    n_terms = flat.count()

    def topics_of(words: DataFrame) -> DataFrame:
        return sized_join(words.drop("pos").distinct(), flat, ["word"], "inner", n_terms).select(KEY, "topic").distinct()

    # Of an empty tweet no word is left to match.
    words = F.filter(split_on_space("tweet"), lambda w: (w != "") | (F.col("tweet") != ""))
    matched = per_text(posts, "tweet", words, topics_of)
    terms = topics.groupBy("topic").agg(
        F.array_sort(F.array_compact(F.array_distinct(F.flatten(F.collect_list("terms"))))).alias("terms")
    )
    # A topic row is as wide as its terms are many, so the terms are what the broadcast bound counts.
    return _tagged(sized_join(matched, terms, ["topic"], "inner", n_terms), F.col("terms"))


def tag_topics(posts: DataFrame, topics: Topics, by_join: bool = False) -> DataFrame:
    """One row per post and topic of which the post holds at least one term, with the topic's terms.

    Posts without a topic and posts without text are dropped, copies of a post are kept. The usual short
    dictionary is part of the plan, so that a post is tagged where it is read. A longer one (or ``by_join``)
    is joined with the distinct tokens of every text.
    """
    lists = None if by_join else _topic_lists(topics)
    if lists:
        return _one_row_per_topic(_match(posts, lists), lists)
    if not isinstance(topics, DataFrame):
        topics = posts.sparkSession.createDataFrame(
            [(t, list(terms)) for t, terms in topics.items()], "topic string, terms array<string>"
        )
    return _tag_by_join(posts, topics)


def tag_and_score(posts: DataFrame, topics: Topics, lexicon: Lexicon) -> DataFrame:
    """``tag_topics`` with ``sentiment`` added: -1, 0 or 1 by the sign of the polarity.

    Only posts with a topic are scored, and each of them once, whatever the number of its topics.
    """
    lists = _topic_lists(topics)
    values = literal_lexicon(lexicon)
    if lists and values is not None:
        scored = score_sentiment(_match(posts, lists), values, where=F.size("_topics") > 0)
        return _one_row_per_topic(scored, lists)
    return score_sentiment(tag_topics(posts, topics), lexicon)


def to_sink_rows(scored: DataFrame) -> DataFrame:
    """Columns ``posted_at, post, topic, sentiment`` of scored posts."""
    return scored.select(
        parse_post_time("time").alias("posted_at"),
        F.col("tweet").alias("post"),
        "topic",
        F.col("sentiment").cast("int").alias("sentiment"),
    )
