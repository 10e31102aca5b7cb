"""The queries again as DuckDB SQL over the same tables.

The SQL is written on its own terms (list functions, recursive CTEs), not derived from the Spark plans.
"""

from __future__ import annotations

from . import standins as given


def _words(items) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in items)


# Words

DOCUMENT_WORDS = r"""
    SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents"""
CHAT_WORDS = r"""
    SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM conversations"""

COUNTS = f"SELECT word, count(*) AS cnt FROM ({DOCUMENT_WORDS}) WHERE word <> '' GROUP BY word"

BY_SOURCE = f"""
    SELECT coalesce(a.word, b.word) AS word, coalesce(a.cnt, 0) AS first_cnt, coalesce(b.cnt, 0) AS second_cnt
    FROM ({COUNTS}) a
    FULL JOIN (SELECT word, count(*) AS cnt FROM ({CHAT_WORDS}) WHERE word <> '' GROUP BY word) b
      ON a.word = b.word"""

COMMON = f"""
    SELECT count(*) AS freq, word FROM (
      (SELECT word FROM ({DOCUMENT_WORDS}) WHERE word <> '')
      INTERSECT ALL
      (SELECT word FROM ({CHAT_WORDS}) WHERE word <> ''))
    GROUP BY word"""


def _top_common(stop) -> str:
    return f"SELECT * FROM ({COMMON}) WHERE word NOT IN ({_words(stop)}) ORDER BY freq DESC, word DESC LIMIT 20"


# Cleansing

# Blanks, noise and joined words of the texts' cleansing.
BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
NOT_BLANK = r"[^\t-\r\x1c-\x20]"
NOISE = rf"@{NOT_BLANK}+|https?:{NOT_BLANK}+|http?:{NOT_BLANK}|[^A-Za-z0-9]+"
FUSED = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"))


def _normalised(text: str) -> str:
    ends = rf"regexp_replace(lower({text}), '\A[{BLANK}]+|[{BLANK}]+\z', '', 'g')"
    ascii_text = rf"regexp_replace(replace({ends}, chr(10), ' '), '[^\x00-\x7F]+', '', 'g')"
    return f"trim(regexp_replace({ascii_text}, '{NOISE}', ' ', 'g'), ' ')"


def _cleansed(text: str) -> str:
    whole = _normalised(text)
    for a, b in FUSED:
        whole = rf"regexp_replace({whole}, '\b({a})({b})\b', '\1 \2', 'g')"
    return f"""array_to_string(list_filter(string_split_regex({whole}, ' +'),
        lambda w: w <> '' AND w NOT IN ({_words(given.STOP_WORDS)})), ' ')"""


# Dates


def _date_forms(key: str, ts: str, unreadable: str, missing: str) -> str:
    return f"""CASE
        WHEN {missing} THEN NULL
        WHEN {unreadable} THEN strftime({ts}, '%Y/%m/%d')
        WHEN {key} % 4 = 0 THEN strftime({ts}, '%Y-%m-%d %H:%M:%S')
        WHEN {key} % 4 = 1 THEN strftime({ts}, '%d-%m-%Y %H:%M')
        WHEN {key} % 4 = 2 THEN strftime({ts}, '%d/%m/%Y %H:%M')
        ELSE strftime({ts}, '%-d.%-m.%Y %-H:%M') END"""


def _parsed(date: str) -> str:
    # The forms of dates that are read.
    forms = (
        (r"\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}", "%Y-%m-%d %H:%M:%S"),
        (r"\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}", "%d-%m-%Y %H:%M"),
        (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}", "%d/%m/%Y %H:%M"),
        (r"\d{1,2}\.\d{1,2}\.\d{4} \d{1,2}:\d{1,2}", "%d.%m.%Y %H:%M"),
    )
    tries = ", ".join(
        f"CASE WHEN regexp_full_match({date}, '{shape}') THEN try_strptime({date}, '{form}') END"
        for shape, form in forms
    )
    return f"coalesce({tries})"


EVENT_DATE = _date_forms("event_id", "ts", "user_id = 7", "user_id = 13")
EVENT_POSTS = f"""
    SELECT event_id, CAST(user_id AS VARCHAR) AS user_name, {EVENT_DATE} AS date,
           nullif(event_type, 'error') AS text
    FROM events"""

POSTED = "TIMESTAMP '2010-01-01 00:00:00' + to_seconds(doc_id % 1000000 * 433)"
POST_DATE = _date_forms("doc_id", POSTED, "source = 'src7'", "source = 'src13'")
POSTS = f"SELECT source AS user_name, {POST_DATE} AS date, text FROM documents"
CLEAN = f"""
    SELECT user_name AS "user", date, {_cleansed('text')} AS tweet
    FROM ({POSTS}) WHERE text IS NOT NULL AND {_parsed('date')} IS NOT NULL"""

TOPIC_TERMS = "VALUES " + ", ".join(
    f"('{topic}', [{_words(terms)}], '{' '.join(terms)}')" for topic, terms in given.TOPICS.items()
)
TAGGED = f"""
    SELECT t.topic, p.date AS time, p."user", p.tweet, t.terms
    FROM ({CLEAN}) p JOIN ({TOPIC_TERMS}) t(topic, words, terms)
      ON list_has_any(string_split(p.tweet, ' '), t.words)
    WHERE p.tweet <> ''"""

LEXICON = "VALUES " + ", ".join(
    f"('{w}', CAST({p} AS DOUBLE), CAST({s} AS DOUBLE))" for w, (p, s) in given.LEXICON.items()
)


def _mean(measure: str, text: str) -> str:
    """Mean of a measure over the words of a text, as a correlated subquery over distinct texts."""
    return f"""
      SELECT tweet, avg(l.{measure}) AS {measure}
      FROM (SELECT tweet, unnest(string_split(tweet, ' ')) AS word FROM (SELECT DISTINCT tweet FROM ({text})))
      JOIN ({LEXICON}) l(word, polarity, subjectivity) USING (word)
      GROUP BY tweet"""


POLARITY = f"""
    SELECT c."user", c.date, c.tweet, coalesce(m.polarity, 0) AS polarity,
           CAST(sign(coalesce(m.polarity, 0)) AS INTEGER) AS sentiment
    FROM ({CLEAN}) c LEFT JOIN ({_mean('polarity', CLEAN)}) m USING (tweet)"""

SUBJECTIVITY = f"""
    SELECT c."user", c.date, c.tweet, coalesce(m.subjectivity, 0) AS subjectivity
    FROM ({CLEAN}) c LEFT JOIN ({_mean('subjectivity', CLEAN)}) m USING (tweet)"""

MODIFIERS = "VALUES " + ", ".join(
    [f"('{w}', CAST({p} AS DOUBLE), NULL, NULL)" for w, (p, _) in given.LEXICON.items() if w not in given.MODIFIERS]
    + [f"('{w}', NULL, CAST({f} AS DOUBLE), {r})" for w, (f, r) in given.MODIFIERS.items()]
)
HELD = "CASE WHEN x.pos <= s.until THEN s.held ELSE 1.0::DOUBLE END"
MODIFIED = f"""
    SELECT c."user", c.date, c.tweet, coalesce(m.polarity, 0) AS polarity
    FROM ({CLEAN}) c LEFT JOIN (
      SELECT tweet, CASE WHEN r.n > 0 THEN r.total / r.n ELSE 0 END AS polarity
      FROM (
        SELECT tweet, list_reduce(items, lambda s, x: {{
            'total': s.total + CASE WHEN x.factor IS NULL THEN greatest(least(x.value * {HELD}, 1), -1) ELSE 0 END,
            'n': s.n + CASE WHEN x.factor IS NULL THEN 1 ELSE 0 END,
            'held': CASE WHEN x.factor IS NULL THEN 1 ELSE x.factor * {HELD} END,
            'until': CASE WHEN x.factor IS NULL THEN -1 ELSE x.pos + 1 + x.reach END,
            'pos': x.pos, 'value': x.value, 'factor': x.factor, 'reach': x.reach}}, empty) AS r
        FROM (
          SELECT tweet,
                 {{'total': 0.0::DOUBLE, 'n': 0::BIGINT, 'held': 1.0::DOUBLE, 'until': -1::BIGINT, 'pos': 0::BIGINT,
                   'value': 0.0::DOUBLE, 'factor': 0.0::DOUBLE, 'reach': 0::BIGINT}} AS empty,
                 list({{'total': 0.0::DOUBLE, 'n': 0::BIGINT, 'held': 1.0::DOUBLE, 'until': -1::BIGINT, 'pos': pos,
                        'value': value, 'factor': factor, 'reach': reach::BIGINT}} ORDER BY pos) AS items
          FROM (
            SELECT tweet, unnest(w) AS word, generate_subscripts(w, 1)::BIGINT AS pos
            FROM (SELECT tweet, string_split(tweet, ' ') AS w FROM (SELECT DISTINCT tweet FROM ({CLEAN}))))
          JOIN ({MODIFIERS}) k(word, value, factor, reach) USING (word)
          GROUP BY tweet))
    ) m USING (tweet)"""

SINK_ROWS = f"""
    SELECT {_parsed('t.time')} AS posted_at, t.tweet AS post, t.topic,
           CAST(sign(coalesce(m.polarity, 0)) AS INTEGER) AS sentiment
    FROM ({TAGGED}) t LEFT JOIN ({_mean('polarity', CLEAN)}) m USING (tweet)"""


def _classes(score: str) -> str:
    return f"CASE WHEN {score} > 0.6 THEN 1 WHEN {score} > 0.4 THEN 0 ELSE -1 END"


CLEAN_DOCUMENTS = f"SELECT doc_id, {_cleansed('text')} AS text FROM documents"
IDS = f"""
    WITH docs AS MATERIALIZED ({CLEAN_DOCUMENTS}),
    tokens AS MATERIALIZED (
      SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
      FROM (SELECT doc_id, string_split(text, ' ') AS w FROM docs)),
    vocabulary AS (
      SELECT word, row_number() OVER (ORDER BY cnt DESC, word) AS id
      FROM (SELECT word, count(*) AS cnt FROM tokens WHERE word <> '' GROUP BY word)),
    ids AS (
      SELECT docs.doc_id, coalesce(k.ids, []) AS ids
      FROM docs LEFT JOIN (
        SELECT doc_id, list(id ORDER BY pos) AS ids FROM tokens JOIN vocabulary USING (word) GROUP BY doc_id
      ) k USING (doc_id))"""
LAST_IDS = "ids[-70:]"

# Roads

WAYS = """
    SELECT l_orderkey * 8 + l_linenumber AS way_id, l_partkey AS a, l_partkey + l_linenumber AS b,
           l_partkey + l_linenumber + l_suppkey % 5 AS c,
           round(l_tax * 100) NOT IN (7, 8) AS has_nodes,
           round(l_discount * 100) <> 10 AS has_tags,
           l_returnflag, l_linestatus
    FROM lineitem"""
PAIRS = f"""
    SELECT way_id, has_tags, l_returnflag, l_linestatus, a AS src, b AS dst FROM ({WAYS}) WHERE has_nodes
    UNION ALL
    SELECT way_id, has_tags, l_returnflag, l_linestatus, b, c FROM ({WAYS}) WHERE has_nodes"""
EDGES = f"""
    SELECT src, dst FROM ({PAIRS}) WHERE has_tags AND l_returnflag IN ('A', 'R')
    UNION ALL
    SELECT dst, src FROM ({PAIRS}) WHERE has_tags AND l_returnflag IN ('A', 'R') AND l_linestatus <> 'F'"""
VERTICES = """
    SELECT unnest([p_partkey, -1 - p_partkey]) AS id, p_size * CAST(1.5 AS DOUBLE) - 40 AS lat,
           p_partkey % 3600 / CAST(10 AS DOUBLE) - 180 AS lon FROM part"""
CONNECTED = f"""
    SELECT v.* FROM ({VERTICES}) v
    WHERE EXISTS (SELECT 1 FROM ({EDGES}) e WHERE e.src = v.id)
       OR EXISTS (SELECT 1 FROM ({EDGES}) e WHERE e.dst = v.id)"""
ADJACENCY = f"""
    SELECT v.id, 0 AS part, count(DISTINCT e.dst) AS degree,
           v.id || ' ' || coalesce(array_to_string(
             list_sort(list(DISTINCT e.dst) FILTER (e.dst IS NOT NULL)), ' '), '') AS line
    FROM ({CONNECTED}) v LEFT JOIN ({EDGES}) e ON e.src = v.id
    GROUP BY v.id"""
# Fixed value: the radius of the earth in kilometres.
HAVERSINE = """
    2 * 6371 * 1000 * asin(sqrt(
      pow(sin(radians(b.lat - a.lat) / 2), 2)
      + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))"""
LENGTHS = f"""
    SELECT e.src, e.dst, round({HAVERSINE}, 2) AS length_m
    FROM ({EDGES}) e LEFT JOIN ({VERTICES}) a ON a.id = e.src LEFT JOIN ({VERTICES}) b ON b.id = e.dst"""
REQUESTS = """
    SELECT c_custkey AS pair_id, c_custkey AS src,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey - 2 * c_nationkey
                ELSE c_custkey + 4 * c_nationkey END AS dst
    FROM customer"""
# Forward from every start: first visits, of which those on a shortest path to a wanted end are kept, and the smallest
# path to each of them.
PATHS = f"""
    WITH RECURSIVE
    v AS MATERIALIZED (SELECT id FROM ({CONNECTED})),
    e AS MATERIALIZED (
      SELECT DISTINCT src, dst FROM ({EDGES}) SEMI JOIN v ON v.id = src WHERE dst IN (SELECT id FROM v)),
    req AS MATERIALIZED ({REQUESTS}),
    reach(start, node, hops) USING KEY (start, node) AS (
      SELECT DISTINCT src, src, 0 FROM req WHERE src IN (SELECT id FROM v)
      UNION
      SELECT n.start, n.dst, n.hops FROM (
        SELECT DISTINCT r.start, e.dst, r.hops + 1 AS hops FROM reach r JOIN e ON e.src = r.node) n
      ANTI JOIN recurring.reach o ON o.start = n.start AND o.node = n.dst),
    first AS MATERIALIZED (SELECT start, node, hops FROM reach),
    need(start, node, hops) AS (
      SELECT DISTINCT f.start, f.node, f.hops FROM req JOIN first f ON f.start = req.src AND f.node = req.dst
      UNION
      SELECT f.start, f.node, f.hops FROM need n JOIN e ON e.dst = n.node
        JOIN first f ON f.start = n.start AND f.node = e.src AND f.hops = n.hops - 1),
    kept AS MATERIALIZED (SELECT * FROM need),
    grown(start, node, hops, path) AS (
      SELECT start, node, 0, [node] FROM kept WHERE hops = 0
      UNION ALL
      SELECT g.start, e.dst, g.hops + 1, min(list_append(g.path, e.dst))
      FROM grown g JOIN e ON e.src = g.node
        JOIN kept f ON f.start = g.start AND f.node = e.dst AND f.hops = g.hops + 1
      GROUP BY g.start, e.dst, g.hops)
    SELECT req.pair_id, req.src, req.dst, CAST(g.hops AS INTEGER) AS hops,
           array_to_string(g.path, ' -> ') AS path
    FROM req LEFT JOIN grown g ON g.start = req.src AND g.node = req.dst"""

# The way of the fewest hops bounds how far a start has to be followed.
DISTANCES = f"""
    WITH RECURSIVE
    v AS MATERIALIZED (SELECT * FROM ({CONNECTED})),
    e AS MATERIALIZED (
      SELECT src, dst, min(CAST(round({HAVERSINE} * 1000) AS BIGINT)) AS mm
      FROM ({EDGES}) e JOIN v a ON a.id = e.src JOIN v b ON b.id = e.dst WHERE src <> dst GROUP BY src, dst),
    req AS MATERIALIZED ({REQUESTS}),
    visits(start, node, mm) USING KEY (start, node) AS (
      SELECT DISTINCT src, src, 0::BIGINT FROM req WHERE src IN (SELECT id FROM v) AND dst IN (SELECT id FROM v)
      UNION
      SELECT n.start, n.node, n.mm FROM (
        SELECT r.start, e.dst AS node, min(r.mm + e.mm) AS mm
        FROM visits r JOIN e ON e.src = r.node GROUP BY r.start, e.dst) n
      ANTI JOIN recurring.visits o ON o.start = n.start AND o.node = n.node),
    bound AS MATERIALIZED (
      SELECT start, max(mm) AS most FROM req JOIN visits ON start = src AND node = dst GROUP BY start),
    reach(start, node, mm) USING KEY (start, node) AS (
      SELECT start, start, 0::BIGINT FROM bound
      UNION
      SELECT n.start, n.node, n.mm FROM (
        SELECT r.start, e.dst AS node, min(r.mm + e.mm) AS mm
        FROM reach r JOIN e ON e.src = r.node JOIN bound b ON b.start = r.start
        WHERE r.mm + e.mm <= b.most GROUP BY r.start, e.dst) n
      LEFT JOIN recurring.reach o ON o.start = n.start AND o.node = n.node
      WHERE o.start IS NULL OR n.mm < o.mm)
    SELECT req.pair_id, req.src, req.dst, round(r.mm / 1000.0::DOUBLE) AS length_m
    FROM req LEFT JOIN reach r ON r.start = req.src AND r.node = req.dst"""

ORACLE: dict[str, str] = {
    "word_count": COUNTS,
    "counts_by_source": BY_SOURCE,
    "common_word_bag": COMMON,
    "topk_common_words": _top_common(given.LINE_STOP_WORDS),
    "words_without_stop_list": rf"""
        SELECT doc_id, count(*) AS n_kept, max(word) AS last_word
        FROM (SELECT doc_id, unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents)
        WHERE word <> '' AND word NOT IN ({_words(given.STOP_WORDS)}) GROUP BY doc_id""",
    "merged_word_list": r"""
        SELECT unnest(string_split_regex(p_name, '[ \t\n\r\f]+')) AS word FROM part
        UNION SELECT role FROM conversations""",
    "text_file_counts": f"SELECT word || chr(9) || cnt AS line FROM ({COUNTS})",
    "text_file_common_words": f"SELECT freq || chr(9) || word AS line FROM ({_top_common(given.STOP_WORDS)})",
    "noise_free_pages": f"""
        SELECT page_id, regexp_replace({_normalised('html')}, ' +', ' ', 'g') AS plain FROM pages""",
    "cleansed_text": CLEAN_DOCUMENTS,
    "cleansed_text_by_join": CLEAN_DOCUMENTS,
    "dated_posts": f"""
        SELECT event_id, user_name, {_parsed('date')} AS posted_at
        FROM ({EVENT_POSTS}) WHERE text IS NOT NULL AND {_parsed('date')} IS NOT NULL""",
    "epoch_dates": """
        SELECT o_orderkey,
               CASE o_orderkey % 4
                 WHEN 0 THEN strftime(o_orderdate, '%d-%m-%y %H:%M')
                 WHEN 1 THEN strftime(o_orderdate, '%d/%m/%y %H:%M')
                 WHEN 2 THEN strftime(o_orderdate, '%-d.%-m.%y %-H:%M')
                 ELSE strftime(o_orderdate, '%d-%m-%Y %H:%M') END AS date,
               CASE WHEN o_orderkey % 4 = 3 THEN 0 ELSE CAST(epoch(o_orderdate) AS BIGINT) END AS epoch
        FROM orders""",
    "clean_posts": f"""
        SELECT *, CAST(NULL AS VARCHAR) AS topic, CAST(NULL AS VARCHAR) AS terms FROM ({CLEAN})""",
    "topic_posts": TAGGED,
    "topic_posts_by_join": TAGGED,
    "post_polarity": POLARITY,
    "post_polarity_by_join": POLARITY,
    "post_subjectivity": SUBJECTIVITY,
    "modified_polarity": MODIFIED,
    "modified_polarity_by_join": MODIFIED,
    "score_classes": f"""
        SELECT event_id, score, {_classes('score')} AS sentiment
        FROM (SELECT event_id, value / (value + 20) AS score FROM events)""",
    "encoded_tokens": f"""
        {IDS}
        SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_ids,
               repeat('0 ', greatest(70 - len(ids), 0) - CASE WHEN len(ids) = 0 THEN 1 ELSE 0 END)
               || CASE WHEN len(ids) = 0 THEN '0' ELSE array_to_string({LAST_IDS}, ' ') END AS padded
        FROM ids""",
    "model_scores": f"""
        {IDS}
        SELECT doc_id, score, {_classes('score')} AS sentiment
        FROM (SELECT doc_id, CAST(coalesce(list_sum({LAST_IDS}), 0) % 1000 AS DOUBLE) / 1000 AS score FROM ids)""",
    "sentiment_sink_rows": SINK_ROWS,
    "numbered_sink_rows": f"""
        SELECT row_number() OVER (ORDER BY posted_at, topic, sentiment, post) AS id, * FROM ({SINK_ROWS})""",
    "archived_posts": f"SELECT *, CAST(1 AS BIGINT) AS rows_with_id FROM ({SINK_ROWS})",
    "appended_posts": f"SELECT *, CAST(1 AS BIGINT) AS rows_with_id FROM ({SINK_ROWS})",
    "post_job": f"SELECT *, CAST(1 AS BIGINT) AS rows_with_id FROM ({SINK_ROWS})",
    "csv_posts": CLEAN,
    "csv_posts_in_splits": CLEAN,
    "streamed_topic_posts": f"SELECT *, CAST(1 AS BIGINT) AS rows_with_id FROM ({SINK_ROWS})",
    "order_way_pairs": """
        SELECT l_orderkey, CAST(pos AS INTEGER) AS pos, src, dst FROM (
          SELECT l_orderkey, row_number() OVER w - 1 AS pos, l_partkey AS src, lead(l_partkey) OVER w AS dst
          FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey))
        WHERE dst IS NOT NULL""",
    "event_successions": """
        SELECT user_group, event_id, src, dst FROM (
          SELECT user_group, event_id, event_type AS src, lead(event_type) OVER w AS dst, lead(event_id) OVER w AS next_id
          FROM (SELECT *, CASE WHEN user_id % 2 = 0 THEN 0 ELSE user_id END AS user_group FROM events)
          WINDOW w AS (PARTITION BY user_group ORDER BY ts, event_id))
        WHERE next_id IS NOT NULL""",
    "way_pairs": f"SELECT way_id, src, dst FROM ({PAIRS})",
    "way_tags": f"""
        SELECT way_id,
               CASE WHEN has_tags THEN CASE l_returnflag WHEN 'A' THEN 'residential' WHEN 'R' THEN 'primary' END
               END AS highway,
               has_tags AND l_returnflag IN ('A', 'R') AS is_highway,
               has_tags AND l_linestatus = 'F' AS is_oneway
        FROM ({WAYS})""",
    "road_edges": EDGES,
    "connected_vertices": CONNECTED,
    "adjacency": ADJACENCY,
    "edge_lengths": LENGTHS,
    "shortest_paths": PATHS,
    "shortest_by_length": DISTANCES,
    "osm_road_edges": EDGES,
    "osm_adjacency_lines": f"SELECT line FROM ({ADJACENCY})",
    "path_file_lines": f"SELECT coalesce(path, '') AS line FROM ({PATHS})",
}
ORACLE["loaded_model_scores"] = ORACLE["model_scores"]
ORACLE["encoded_tokens_by_join"] = ORACLE["encoded_tokens"]
