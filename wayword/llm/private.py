"""Personal data: fixed forms first, then identifiers in contexts like theirs, without Python in the tasks.

E-mail addresses, IP addresses, card numbers and phone numbers are found by their form; these are the seeds. The words
around them are lexical patterns. Identifier-like tokens of other forms are candidates, and they share patterns with
the seeds. Over this graph scores are passed on for ``ROUNDS`` rounds: a pattern is as sure of a kind as the instances
in it are on average, an instance as sure as its patterns make it together. A pattern is trusted in a round if enough
different instances in it are seeds or are sure by then, so what was found leads on to new patterns. Candidates in a sure
pattern become spans of the pattern's kind. Groups of digits with single blanks between are one candidate.

Places are in code points, ends exclusive. Matches of one kind do not overlap, those of different kinds may; a
candidate never overlaps a seed. Null and empty texts have no spans. Rows may share a key: they are told apart by their
text, and equal rows have equal spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise, materialise_counted, scratch_path
from .components import by_count

# The kinds in their order, and the form of each. A possessive quantifier matches what a greedy one
# matches here, without steps back; a run of characters is tried at its start or where the last match ended.
KINDS = ["email", "ip", "card", "phone"]
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATE = "candidate"
CANDIDATE_FORM = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"

# Two to 32 groups of digits with a single blank between; a group is a whole token, but for punctuation at its end.
JOINED = "joined"
GROUP = r"[(+]?[0-9](?:[0-9().+/-]*[0-9)])?"
JOINED_FORM = r"(?<!\S)[\p{P}\p{S}&&[^@+(]]*+" + GROUP + r"(?:\x20" + GROUP + r"(?=[\p{P}\p{S}&&[^@]]*+(?!\S))){1,31}+"

# A text without this has no match of the kind.
HINTS = {"email": "@", "phone": "+"}

# Rounds of scoring; how sure a pattern and an instance must be, and how many different seeds a pattern needs.
ROUNDS = 3
SURE = 0.8
SEEDS = 5

# Characters of a context that are looked at, and matches that these can hold: each takes two with its gap.
CONTEXT = 60
PIECES = CONTEXT // 2

# What stands for a run of tokens with a digit or ``@`` in a pattern.
PLACEHOLDER = " 0 "


def found(text: Column, kind: str) -> Column:
    """All matches of a form: ``kind, k, gap`` (characters since the last match), ``match, left, right``.

    ``left`` and ``right`` are the text around the match, earlier and later matches included.
    """
    name = {CANDIDATE: CANDIDATE_FORM, JOINED: JOINED_FORM}.get(kind) or FORMS[kind]
    gaps = F.split(text, name, -1)
    matches = F.regexp_extract_all(text, F.lit(name), F.lit(0))
    # A gap belongs to the match behind it; the last gap has none.
    pairs = F.arrays_zip(matches.alias("match"), gaps.alias("gap"))
    # Of a piece no more counts than a context holds; what several steps use is bound first, as an array of one.
    def pieces(of: Column, side: int) -> Column:
        whole = F.concat(of["gap"], F.coalesce(of["match"], F.lit("")))
        return F.substring(whole, side, CONTEXT)

    bound = F.transform(F.array(pairs), lambda x: F.struct(
        x.alias("pairs"), F.transform(x, lambda y: pieces(y, -CONTEXT)).alias("tails"),
        F.transform(x, lambda y: pieces(y, 1)).alias("heads"),
    ))

    def rows_of(one: Column) -> Column:
        def row(x: Column, k: Column) -> Column:
            before = F.slice(one["tails"], F.greatest(k - PIECES, F.lit(0)) + 1, F.least(k, F.lit(PIECES)))
            left = F.concat(F.array_join(before, ""), F.substring(x["gap"], -CONTEXT, CONTEXT))
            right = F.array_join(F.slice(one["heads"], k + 2, PIECES), "")
            return F.struct(
                F.lit(kind).alias("kind"), k.alias("k"), F.length(x["gap"]).alias("gap"), x["match"].alias("match"),
                F.substring(left, -CONTEXT, CONTEXT).alias("left"), F.substring(right, 1, CONTEXT).alias("right"),
            )

        return F.filter(F.transform(one["pairs"], row), lambda x: x["match"].isNotNull())

    rows = F.transform(bound, rows_of)[0]
    if kind in HINTS:
        hint = F.contains(text, F.lit(HINTS[kind]))
    else:
        hint = F.rlike(text, F.lit("[0-9]" if kind in FORMS else "[0-9@]"))
    return F.when(hint, rows)


def luhn(digits: Column) -> Column:
    """Whether the check digit is right."""

    def add(total, i):
        digit = F.substr(digits, -i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    small = F.lit(r"\A0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(\.0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])){3}\z")
    n = F.length(digits)
    core = F.regexp_count(match, F.lit("[0-9]"))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", F.rlike(match, small))
        .when(kind == "card", n.between(14, 19) & F.when(n.between(14, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(10, 15))
        .otherwise((F.length(match) >= 6) & ((core >= 2) | F.contains(match, F.lit("@"))))
    )


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def patterns(left: Column, right: Column) -> Column:
    """The patterns of a context: two words before, or one word before and one behind."""
    shown = lambda x: words(F.regexp_replace(x, r"(?:\S*[0-9@]\S*\s*)+", PLACEHOLDER))
    before, behind = shown(left), shown(right)
    last = F.try_element_at(before, F.lit(-1))
    two = F.concat(F.lit("L:"), F.try_element_at(before, F.lit(-2)), F.lit(" "), last)
    around = F.concat(F.lit("B:"), last, F.lit(" _ "), F.try_element_at(behind, F.lit(1)))
    return F.array_compact(F.array(two, around))


def occurrences(df: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """``doc, place, kind, start, end, match, patterns`` of every seed and candidate."""
    text = F.col("text")
    rows = df.select(
        F.col(key_col).alias("doc"), F.xxhash64(text_col).alias("place"), F.col(text_col).alias("text"),
    ).where(F.rlike("text", F.lit("[0-9@]")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    everything = F.flatten(F.array_compact(F.array(*[found(text, kind) for kind in [*KINDS, CANDIDATE, JOINED]])))
    rows = rows.select("doc", "place", "row", F.inline(everything))
    before = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap") + F.length("match")).over(before), F.lit(0)) + F.col("gap")
    rows = rows.withColumn("start", start.cast("long"))
    # The punctuation around a candidate is not part of it; forms match without it.
    bare = F.regexp_replace("match", r"[\p{P}\p{S}&&[^@]]+\z", "")
    lead = F.length(F.regexp_extract(bare, r"\A[\p{P}\p{S}&&[^@+]]*", 0))
    is_candidate = F.col("kind").isin(CANDIDATE, JOINED)
    rows = rows.withColumns({
        "start": F.when(is_candidate, F.col("start") + lead).otherwise(F.col("start")),
        "match": F.when(is_candidate, F.substr(bare, lead + 1)).otherwise(F.col("match")),
    })
    rows = rows.withColumn("end", F.col("start") + F.length("match")).where(valid(F.col("kind"), F.col("match")))
    # A candidate goes if a seed that begins before its end ends behind its start.
    order = Window.partitionBy("row").orderBy("start", "end")
    seed_end = F.max(F.when(~is_candidate, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    seed_start = F.min(F.when(~is_candidate, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    overlaps = (F.coalesce(seed_end, F.lit(-1)) > F.col("start")) | (
        F.coalesce(seed_start, F.col("end")) < F.col("end")
    )
    rows = rows.withColumn("overlaps", overlaps).where(~(is_candidate & F.col("overlaps")))
    # Of what is left, a token goes if it is part of joined groups.
    is_joined = F.col("kind") == JOINED
    joined_end = F.max(F.when(is_joined, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined_start = F.min(F.when(is_joined, F.col("start"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    part = (F.coalesce(joined_end, F.lit(-1)) > F.col("start")) | (F.coalesce(joined_start, F.col("end")) < F.col("end"))
    rows = rows.withColumn("part", part).where(~((F.col("kind") == CANDIDATE) & F.col("part")))
    rows = rows.withColumn("kind", F.when(is_joined, CANDIDATE).otherwise(F.col("kind")))
    return rows.select("doc", "place", "kind", "start", "end", "match", patterns(F.col("left"), F.col("right")).alias("patterns"))


def sure_patterns(seen: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """``pattern, kind, sure`` of the patterns, and ``match, kind, score`` of the candidates after all rounds."""
    edges = seen.select("kind", F.lower("match").alias("match"), F.explode("patterns").alias("pattern")).distinct()
    seeds, candidates = F.col("kind") != CANDIDATE, F.col("kind") == CANDIDATE
    sizes = edges.groupBy("pattern").agg(
        F.count_if(seeds).alias("n_seeds"), F.count_if(candidates).alias("n_candidates")
    )
    # A pattern without candidates finds nothing, and one with few instances cannot get enough seeds in any round.
    useful, n_useful = materialise_counted(
        sizes.where((F.col("n_seeds") + F.col("n_candidates") >= SEEDS) & (F.col("n_candidates") > 0)), f"{folder}/useful"
    )
    edges = materialise(edges.join(by_count(useful, n_useful), "pattern"), f"{folder}/edges")
    seed_votes = edges.where(seeds).groupBy("pattern", "kind").agg(
        F.count("*").cast("double").alias("votes"), F.count("*").alias("n_sure")
    )
    candidate_edges = edges.where(candidates).select("pattern", "match")
    scores = None
    for turn in range(ROUNDS):
        votes = seed_votes
        if scores is not None:
            # A candidate that is sure counts as a seed, of its surest kind.
            surest = F.row_number().over(Window.partitionBy("match").orderBy(F.desc("score"), "kind")) == 1
            found_so_far = scores.withColumn("n_sure", (surest & (F.col("score") >= SURE)).cast("long"))
            given = candidate_edges.join(found_so_far, "match").select(
                "pattern", "kind", F.col("score").alias("votes"), "n_sure"
            )
            given = given.groupBy("pattern", "kind").agg(F.sum("votes").alias("votes"), F.sum("n_sure").alias("n_sure"))
            votes = votes.unionByName(given)
        sure = votes.groupBy("pattern", "kind").agg(F.sum("votes").alias("votes"), F.sum("n_sure").alias("n_sure"))
        sure = sure.withColumn("n_sure", F.sum("n_sure").over(Window.partitionBy("pattern")))
        sure = sure.where(F.col("n_sure") >= SEEDS).join(useful, "pattern")
        # Not more than almost sure, so that the logarithm below is defined.
        share = F.least(F.lit(0.999), F.col("votes") / (F.col("n_seeds") + F.col("n_candidates")))
        sure = materialise(sure.select("pattern", "kind", share.alias("sure")), f"{folder}/patterns-{turn}")
        together = candidate_edges.join(sure, "pattern").groupBy("match", "kind").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("sure"))))).alias("score")
        )
        scores = materialise(together, f"{folder}/scores-{turn}")
    return sure, scores


def find_private(df: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the key, and ``base`` and ``spans`` as sorted arrays of ``start, kind, end``.

    ``kind`` is the place of the kind in ``KINDS``. ``base`` has the matches of the fixed forms, ``spans`` these and what
    the patterns found.
    """
    folder = scratch_path(df.sparkSession, "private")
    seen = materialise(occurrences(df, key_col, text_col), f"{folder}/seen")
    sure, scores = sure_patterns(seen, folder)
    ranked = sure.where(F.col("sure") >= SURE)
    ranked, n_ranked = materialise_counted(ranked, f"{folder}/sure")
    scored, n_scored = materialise_counted(scores.where(F.col("score") >= SURE), f"{folder}/scored")
    candidates = seen.where(F.col("kind") == CANDIDATE).drop("kind")
    candidates = candidates.select("doc", "place", "start", "end", F.lower("match").alias("match"), F.explode("patterns").alias("pattern"))
    new = candidates.join(by_count(ranked, n_ranked), "pattern").join(by_count(scored, n_scored), ["match", "kind"])
    best = F.max(F.struct("score", (-F.array_position(F.lit(KINDS), F.col("kind"))).alias("place_of_kind"), "kind"))
    new = new.groupBy("doc", "place", "start", "end").agg(best.alias("best"))
    new = new.select("doc", "place", F.col("best.kind").alias("kind"), "start", "end", F.lit(False).alias("base"))
    base = seen.where(F.col("kind") != CANDIDATE).select("doc", "place", "kind", "start", "end", F.lit(True).alias("base"))
    number = (F.array_position(F.lit(KINDS), F.col("kind")) - 1).cast("int")
    span = F.struct("start", number.alias("kind"), "end")
    spans = base.unionByName(new).groupBy("doc", "place").agg(
        F.array_sort(F.collect_set(F.when(F.col("base"), span))).alias("base"),
        F.array_sort(F.collect_set(span)).alias("spans"),
    )
    rows = df.select(F.col(key_col), F.xxhash64(text_col).alias("_here"))
    same = rows[key_col].eqNullSafe(spans["doc"]) & (rows["_here"] == spans["place"])
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.join(spans, same, "left").select(
        rows[key_col], F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans")
    )


def span_list(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    one = lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")
