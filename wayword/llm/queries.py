"""One query per operator, over whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import ann, bpe, divergence, jaccard, language, lines, mixing, private, quality, ranked, simhash, topk, urls

# The tree of op9_mixing, the share of all tokens that is taken, and how often a document may be.
MIX_WEIGHTS = {
    ("0",): 2.0,
    ("0", "en"): 1.0,
    ("0", "de"): 3.0,
    ("1", "en"): 4.0,
}
MIX_SHARE = 0.5
MIX_EPOCHS = 3


def mix_levels() -> dict[str, Column]:
    """Domain (every fourth source together), language and source."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,9})$", 1)
    domain = F.when(number != "", (F.try_to_number(number, F.lit("9" * 9)).cast("long") % 4).cast("string"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


# Where the installed vocabulary files are; an operator takes any path.
VOCABULARY = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.near_line_dedup(documents, min_words=1)
    return kept.select(
        "doc_id", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
        F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


# The rules that op2_url_filter is given.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


@query
def op2_url_filter(spark, sf_dir):
    """The last number in a page's path is the document it shows, which may be labelled."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(urls.path_of(F.col("url")), r"([0-9]{1,18})[^0-9]*\z", 1)
    shown = pages.select("url", F.try_to_number(number, F.lit("9" * 18)).cast("long").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 0).alias("bad"))
    index = urls.mine(shown.join(labels, "doc_id"))
    judged = urls.judge(pages, index, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.array_join("mined", " ").alias("mined"))


@query
def op3_ngram_jaccard(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = jaccard.similar_texts(documents)
    return joined.select("doc_id", "class_id", "copy_id", "n_links", "n_copies")


@query
def op4_near_search(spark, sf_dir):
    return ann.near_search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op5_bpe(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_column(documents, vocabulary_path(), keep=["doc_id"], with_ids=False)


@query
def op6_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = held_out_rows(4, 2)
    model = language.learn(documents.where(~held_out), "text", "lang", "doc_id")
    scored = language.predict(documents.select("doc_id", held_out.alias("held_out"), "text"), model)
    return scored.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op7_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = held_out_rows(3, 1)
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = quality.learn(documents, labels.select("doc_id", F.col("quality").alias("label")))
    scored = quality.score(documents.select("doc_id", held_out.alias("held_out"), "text"), model)
    return scored.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "score", "predicted")


def held_out_rows(parts: int, part: int) -> Column:
    """Whether a document is kept back from learning; null without an id."""
    return F.crc32(F.col("doc_id").cast("string")) % parts == part


@query
def op8_exact_top_k(spark, sf_dir):
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


@query
def op9_mixing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    planned = mixing.plan(documents, mix_levels(), MIX_SHARE, MIX_EPOCHS, MIX_WEIGHTS)
    mixed = mixing.copies(documents, mix_levels(), planned)
    return mixed.select("doc_id", mix_levels()["domain"].alias("domain"), "lang", "source", "n_tokens", "copies")


ORACLE["op9_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, lang, source,
         CAST(CAST(nullif(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1), '') AS BIGINT) % 4 AS VARCHAR) AS domain,
         CAST(coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0) AS BIGINT) AS n_tokens
  FROM documents
),
named AS (
  SELECT *, coalesce(domain, 'none') AS d, coalesce(lang, 'none') AS l, coalesce(source, 'none') AS s FROM docs
),
leaves AS (SELECT d, l, s, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM named GROUP BY ALL),
d1 AS (
  SELECT d, CAST(sum(tokens) AS BIGINT) * 3 AS room, CASE d WHEN '0' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         least((SELECT CAST(floor(sum(tokens) * 0.5::DOUBLE) AS BIGINT) FROM leaves),
               CAST(sum(sum(tokens)) OVER () AS BIGINT) * 3) AS budget
  FROM leaves GROUP BY d
),
d2 AS (
  SELECT *, room * sum(weight) OVER (ORDER BY room / weight, d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (budget - coalesce(sum(room) OVER (ORDER BY room / weight, d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS fills
  FROM d1
),
d3 AS (
  SELECT d, CASE WHEN fills THEN room ELSE greatest(0, least(room, CAST(floor(
           (budget - sum(CASE WHEN fills THEN room ELSE 0 END) OVER ())::BIGINT * weight / sum(CASE WHEN fills THEN 0 ELSE weight END) OVER ()) AS BIGINT))) END AS budget
  FROM d2
),
l1 AS (
  SELECT leaves.d, l, CAST(sum(tokens) AS BIGINT) * 3 AS room, any_value(d3.budget) AS budget,
         CASE WHEN leaves.d = '0' AND l = 'de' THEN 3.0::DOUBLE WHEN leaves.d = '1' AND l = 'en' THEN 4.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM leaves JOIN d3 USING (d) GROUP BY leaves.d, l
),
l2 AS (
  SELECT *, room * sum(weight) OVER (PARTITION BY d ORDER BY room / weight, l ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (budget - coalesce(sum(room) OVER (PARTITION BY d ORDER BY room / weight, l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS fills
  FROM l1
),
l3 AS (
  SELECT d, l, CASE WHEN fills THEN room ELSE greatest(0, least(room, CAST(floor(
           (budget - sum(CASE WHEN fills THEN room ELSE 0 END) OVER f)::BIGINT * weight / sum(CASE WHEN fills THEN 0 ELSE weight END) OVER f) AS BIGINT))) END AS budget
  FROM l2 WINDOW f AS (PARTITION BY d)
),
s1 AS (
  SELECT leaves.d, leaves.l, s, tokens, tokens * 3 AS room, budget, 1.0::DOUBLE AS weight FROM leaves JOIN l3 USING (d, l)
),
s2 AS (
  SELECT *, room * sum(weight) OVER (PARTITION BY d, l ORDER BY room / weight, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (budget - coalesce(sum(room) OVER (PARTITION BY d, l ORDER BY room / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS fills
  FROM s1
),
s3 AS (
  SELECT d, l, s, tokens, CASE WHEN fills THEN room ELSE greatest(0, least(room, CAST(floor(
           (budget - sum(CASE WHEN fills THEN room ELSE 0 END) OVER f)::BIGINT * weight / sum(CASE WHEN fills THEN 0 ELSE weight END) OVER f) AS BIGINT))) END AS budget
  FROM s2 WINDOW f AS (PARTITION BY d, l)
),
planned AS (
  SELECT d, l, s, whole, budget - whole * tokens AS rest
  FROM (SELECT *, CASE WHEN tokens > 0 THEN CAST(floor(budget / tokens) AS BIGINT) ELSE 0 END AS whole FROM s3)
),
placed AS (
  SELECT named.*, whole, rest,
         substr(md5('42|' || whole || '|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS spot
  FROM named JOIN planned USING (d, l, s)
),
upto AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY d, l, s ORDER BY spot RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM placed
)
SELECT doc_id, domain, lang, source, n_tokens,
       CAST(whole + CASE WHEN rest > 0 AND spot < (
         SELECT min(x.spot) FROM upto x WHERE x.d = u.d AND x.l = u.l AND x.s = u.s AND x.upto > x.rest
       ) THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM upto u
"""

ORACLE["op8_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM (
    SELECT vec_id, min(embedding) AS embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id
  )
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op10_private(spark, sf_dir):
    marked = private.find_private(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [private.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in private.KINDS]
    return marked.select(
        "doc_id", *counts, F.sha2(private.span_list(F.col("base")), 256).alias("base_sha256"),
        private.span_list(F.col("spans")).alias("spans"),
    )


@query
def op11_simhash_near_dedup(spark, sf_dir):
    linked = simhash.near_copies(table(spark, sf_dir, "documents"))
    return linked.select(
        F.col("id").alias("doc_id"), simhash.hex_of(F.col("fingerprint")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op12_ranked_search(spark, sf_dir):
    found = ranked.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


# The letters that are lower-cased, and the term of op12_ranked_search.
LOWERED = f"translate(text, '{ranked.UPPER}', '{ranked.LOWER}')"

ORACLE["op12_ranked_search"] = f"""
WITH terms AS (
  SELECT item_id, unnest(list_distinct(regexp_extract_all({LOWERED}, '{ranked.TERM}'))) AS term FROM benchmark
),
item_terms AS (SELECT DISTINCT item_id, term FROM terms),
docs AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{ranked.TERM}') AS words FROM documents),
sizes AS (SELECT doc_id, len(words) AS n FROM docs WHERE len(words) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM sizes),
hits AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM docs)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM hits GROUP BY term), corpus
),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_all)))) AS BIGINT) AS score
  FROM item_terms JOIN hits USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus
  GROUP BY item_id, doc_id
),
placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 10
"""


@query
def op13_source_divergence(spark, sf_dir):
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


ORACLE["op13_source_divergence"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{ranked.UPPER}', '{ranked.LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
),
words AS (SELECT doc, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
in_lang AS (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY lang, term),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (
  SELECT lang, source, CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
),
lang_totals AS (SELECT lang, CAST(sum(total) AS BIGINT) AS total FROM totals GROUP BY lang),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 1)) // (total + v) AS p
  FROM totals JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
),
q AS (
  SELECT lang, term, 1 + (1000000000 * (n + 1)) // (total + v) AS q FROM in_lang JOIN lang_totals USING (lang) JOIN sizes USING (lang)
),
pair AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  WHERE (x.term IS NULL) = (y.term IS NULL)
  GROUP BY ALL
),
term AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM term)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
