"""The inputs of the four jobs, derived from the test tables row by row.

There are no posts and no road map among the tables. A document stands for a post, a line item for a way of
three nodes, a part for two map nodes, a customer for a path request. Each stand-in is a projection of one
table, so it needs no shuffle and grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.graph import Graph, drop_isolated, road_graph, written

STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "das", "de", "der", "die", "en", "for", "from", "in",
    "is", "it", "la", "le", "of", "on", "que", "that", "the", "this", "to", "und", "was", "with",
]

# Words of common-word ranking are compared with their case and punctuation.
LINE_STOP_WORDS = ["The", "and", "in", "is", "of", "of,", "that", "the", "the,", "the.", "to"]

TOPICS = {
    "harbour": ["sich", "than", "ther", "thor"],
    "market": ["avec", "ein", "thing", "thtion"],
    "transit": ["ingly", "los", "nicht", "thnd"],
    "weather": ["auf", "des", "erst", "thst"],
}

# Multiples of 1/8, so that sums are exact.
LEXICON = {
    "auf": (-0.25, 0.125),
    "des": (0.375, 0.5),
    "ein": (0.5, 0.75),
    "erst": (-0.625, 1.0),
    "los": (-0.125, 0.25),
    "nicht": (-0.75, 0.875),
    "or": (0.0, 0.0),
    "than": (-0.5, 0.375),
    "ther": (0.125, 0.625),
    "thing": (1.0, 0.125),
    "thnd": (-1.0, 0.25),
    "thon": (0.25, 0.5),
    "thre": (-0.375, 0.75),
    "you": (0.625, 0.25),
}

# Powers of two, so that products are exact: factor, and how many other words may stand in between.
MODIFIERS = {
    "er": (2.0, 0),
    "re": (0.5, 2),
    "ou": (-0.5, 1),
    "les": (-1.0, 3),
    "un": (4.0, 1),
    "thon": (-2.0, 0),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two corpora: documents (1) and conversations (2)."""
    first = table(spark, sf_dir, "documents").select(F.col("text").alias("value"), F.lit(1).alias("src"))
    second = table(spark, sf_dir, "conversations").select(F.col("text").alias("value"), F.lit(2).alias("src"))
    return first.unionByName(second)


def day_first(ts: str, sep: str, year_digits: int = 4, padded: bool = True) -> str:
    """SQL for a time written ``d-m-Y H:M``. It is cut out of the text of the time, so no time zone matters."""
    text = f"CAST({ts} AS STRING)"
    day, month, hour = (f"substring({text}, {at}, 2)" for at in (9, 6, 12))
    if not padded:
        day, month, hour = (f"CAST({part} AS INT)" for part in (day, month, hour))
    year = f"substring({text}, {5 - year_digits}, {year_digits})"
    return f"concat({day}, '{sep}', {month}, '{sep}', {year}, ' ', {hour}, substring({text}, 14, 3))"


def date_forms(key: str, ts: str, unreadable: str, missing: str) -> str:
    """SQL for a date in one of four forms, or in a form that is none of them, or null."""
    return f"""
        CASE
          WHEN {missing} THEN NULL
          WHEN {unreadable} THEN replace(substring(CAST({ts} AS STRING), 1, 10), '-', '/')
          WHEN {key} % 4 = 0 THEN substring(CAST({ts} AS STRING), 1, 19)
          WHEN {key} % 4 = 1 THEN {day_first(ts, '-')}
          WHEN {key} % 4 = 2 THEN {day_first(ts, '/')}
          ELSE {day_first(ts, '.', padded=False)}
        END"""


def as_posts(documents: DataFrame) -> DataFrame:
    """Raw posts of the documents, a batch or a stream. Two sources give no usable dates."""
    posted = "timestampadd(SECOND, CAST(doc_id % 1000000 * 433 AS INT), TIMESTAMP_NTZ '2010-01-01 00:00:00')"
    date = date_forms("doc_id", posted, unreadable="source = 'src7'", missing="source = 'src13'")
    return documents.selectExpr(
        "source AS user_name", "lang AS user_location", f"{date} AS date", "text",
        "CAST(n_chars AS STRING) AS user_followers",
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_posts(table(spark, sf_dir, "documents"))


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short posts with the real times of the events. Two users give no usable dates, errors have no text."""
    date = date_forms("event_id", "ts", unreadable="user_id = 7", missing="user_id = 13")
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "CAST(user_id AS STRING) AS user_name", f"{date} AS date",
        "nullif(event_type, 'error') AS text",
    )


def map_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two map nodes per part: one with its key, and one with a negative id that no way touches."""
    return table(spark, sf_dir, "part").selectExpr(
        "explode(array(p_partkey, -1 - p_partkey)) AS _id",
        "p_size * 1.5D - 40 AS _lat",
        "p_partkey % 3600 / 10D - 180 AS _lon",
    )


def map_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as ways: from a part over a near part to the next one.

    Some ways have one node or none, some no tags, some a ``oneway`` that does not count; some nodes lie
    beyond the last part. A way may visit a node twice, and ways may run in parallel.
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS _id",
        """transform(
             CASE CAST(round(l_tax * 100) AS INT)
               WHEN 8 THEN array(l_partkey)
               WHEN 7 THEN CAST(array() AS ARRAY<BIGINT>)
               ELSE array(l_partkey, l_partkey + l_linenumber, l_partkey + l_linenumber + l_suppkey % 5)
             END, r -> named_struct('_ref', r)) AS nd""",
        """CASE WHEN round(l_discount * 100) <> 10 THEN array_compact(array(
             CASE l_returnflag
               WHEN 'A' THEN named_struct('_k', 'highway', '_v', 'residential')
               WHEN 'R' THEN named_struct('_k', 'highway', '_v', 'primary')
               ELSE named_struct('_k', 'building', '_v', 'yes') END,
             CASE WHEN l_linestatus = 'F' THEN named_struct('_k', 'oneway', '_v', 'yes')
                  WHEN l_quantity > 25 THEN named_struct('_k', 'oneway', '_v', '-1') END)) END AS tag""",
    )


def graph(spark: SparkSession, sf_dir: str) -> Graph:
    return road_graph(map_nodes(spark, sf_dir), map_ways(spark, sf_dir))


def connected_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """The graph without isolated vertices, written down as the road job does."""
    return drop_isolated(written(graph(spark, sf_dir)))


def path_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer: near and far ends, the same end, ends that are no vertex."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS pair_id",
        "c_custkey AS src",
        """CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey - 2 * c_nationkey
                ELSE c_custkey + 4 * c_nationkey END AS dst""",
    )


def stop_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")


def lexicon_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(w, p, s) for w, (p, s) in LEXICON.items()], "word string, polarity double, subjectivity double"
    )


def modifier_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w, f, r) for w, (f, r) in MODIFIERS.items()], "word string, factor double, reach int")


def topic_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TOPICS.items()), "topic string, terms array<string>")
