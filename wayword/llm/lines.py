"""Removal of lines that nearly repeat another line, without Python in the tasks.

1. A line is normalised to its words (in lower case, parted by blanks, tabs or carriage returns; a character of a script
   that is written without blanks is a word). Lines of fewer than ``min_words`` words are left alone; equal lines of any
   other length meet by their hashes.
2. Lines of fewer than ``FEW_WORDS`` words meet for certain. Where one word may differ (5 to 9 words), a line is looked up
   with none or one of its words left out. Where two may (10 to 14), the shorter line is cut into three runs of words;
   two edits leave one of them whole (pigeonhole), and the longer line is looked up by the words that may be that run.
3. Lines of ``LONG_WORDS`` words or more get samples: ``ORDERS`` SimHashes of 60 bits, each made of five of the line's
   distinct words, those that come first in an order of its own (the circle of word hashes, begun at another mark); their
   bits are cut into ``BLOCKS`` blocks, and SimHashes that differ in fewer bits than there are blocks agree on one
   (pigeonhole). Then ``RUNS`` runs of ``RUN`` words of the line, each from the word on that follows one more mark of the
   circle. Lines are hashed where they are read; no text is moved.
4. Lines that meet are verified: the edit similarity of all their words must reach ``SIMILARITY`` (one minus the edit
   distance, as a share of the longer line). Before, pairs go whose lengths exclude it, or the parities of their words: an
   edit changes two of ``64 * PARITIES`` bits at most.
5. Of every connected group the first occurrence stays, by document and place; all others go.

Pairs inside a bucket are not all made. Each member meets two hubs of its bucket. Members of a large bucket that are still
not connected to the first hub's group meet a further hub, as long as that halves their number. Then all others that are
not connected to it meet all members of the bucket. Whatever all pairs would connect is connected.

Tables that no later step reads are deleted, so that disk holds the steps at hand only.

Null texts have no lines. Rows may share a key: they are told apart by their text, and equal rows lose the same lines,
which keeps one of them whole at most as often as the row is repeated. Columns that are not named are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import discard, materialise, materialise_counted, scratch_path
from .arrow import no_clash
from .components import by_count, connected

MIN_WORDS = 5
SIMILARITY = 0.8
ORDERS = 2
BLOCKS = 2

# Lines of fewer words are looked up with words left out; from so many words on lines have samples. A line of
# ``FEW_WORDS`` words is similar to one of ``LONG_WORDS`` words at the least.
FEW_WORDS = 15
LONG_WORDS = 12

# Runs of words in a line's keys: how many, and the words in each.
RUNS = 8
RUN = 4

# Lines with at least this share of all lines are given their numbers once only; they are ``HOT`` at most.
HOT = 100_000

# A bucket with so many of the lines whose ``h1`` is divisible by ``HOT_SAMPLE`` is no group of one task, but of ``PARTS``.
HOT_SAMPLE = 64
HOT_MEMBERS = 16
PARTS = 1024

# Buckets with so many members that are not connected to the first hub meet further hubs.
OPEN_MEMBERS = 16

# Bits of a SimHash.
SIM_BITS = 60

# Numbers of 64 bits in a line's parities.
PARITIES = 4

BREAK = "\n"
BROADCAST_BYTES = 64_000_000

# Bytes that a line takes which is looked for in its document.
WANTED_BYTES = 96


# Whether a text may have such a character: the scripts' own pattern costs ten times as much on texts in other scripts.
PERHAPS_ALONE = r"[\x{0E00}-\x{1FFF}\x{2E80}-\x{10FFFF}]"

# A character of a script without blanks between words, with its marks.
ALONE = (
    r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]\p{M}*+)"
)


def lines_of(text: Column) -> Column:
    """The lines of a text, with blanks between words, and around characters that are words."""
    apart = F.regexp_replace(text, ALONE, " $1 ")
    text = F.when((F.octet_length(text) > F.length(text)) & F.rlike(text, F.lit(PERHAPS_ALONE)), apart).otherwise(text)
    for other in ("\t", "\r"):
        text = F.replace(text, F.lit(other), F.lit(" "))
    return F.split(text, BREAK)


def words_of(line: Column) -> Column:
    """The words of a line, in lower case. A single blank needs no pattern."""
    return F.array_remove(F.split(F.lower(line), " "), "")


def codes_of(words: Column) -> Column:
    """A number for every word: 20,480 characters from U+1000 on, none of which is half of a pair."""
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(0x5000)) + 0x1000)


def coded(codes: Column) -> Column:
    """A string with one character per word, for an edit distance in words."""
    return F.decode(F.unhex(F.array_join(F.transform(codes, lambda c: F.hex(c)), "")), "UTF-16BE")


def parities(codes: Column) -> Column:
    """``PARITIES`` numbers of 64 bits: whether the words of each of so many classes are odd in number."""
    def odd(k: int) -> Column:
        def turn(a: Column, c: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), c.bitwiseAND(F.lit(63)).cast("int"))
            return F.when(c.bitwiseAND(F.lit((PARITIES - 1) * 64)) == k * 64, a.bitwiseXOR(bit)).otherwise(a)

        return F.aggregate(codes, F.lit(0).cast("long"), turn)

    return F.struct(*[odd(k).alias(f"p{k}") for k in range(PARITIES)])


def near_parities(a: str, b: str, most: Column) -> Column:
    """Whether so many edits may lie between two lines: one edit changes two bits at most."""
    bits = [F.bit_count(F.col(f"{a}.p{k}").bitwiseXOR(F.col(f"{b}.p{k}"))) for k in range(PARITIES)]
    return sum(bits[1:], bits[0]) <= 2 * most


def majority(five: Column) -> Column:
    """Of every bit what at least three of five hashes have, by adding up all bits at once."""
    a, b, c, d, e = (five[k] for k in range(5))
    three = a.bitwiseXOR(b).bitwiseXOR(c)
    carry = a.bitwiseAND(b).bitwiseOR(c.bitwiseAND(a.bitwiseXOR(b)))
    ones = three.bitwiseXOR(d).bitwiseXOR(e)
    carry2 = three.bitwiseAND(d).bitwiseOR(e.bitwiseAND(three.bitwiseXOR(d)))
    most = carry.bitwiseAND(carry2).bitwiseOR(carry.bitwiseXOR(carry2).bitwiseAND(ones))
    return most.bitwiseAND(F.lit((1 << SIM_BITS) - 1))


def marks_of(n: int, of: int, first: int = 0) -> list[int]:
    """``n`` marks of the circle of hashes out of ``of`` evenly spaced ones."""
    return [-(1 << 63) + ((first + k) << 64) // of for k in range(n)]


SIM_MARKS = marks_of(ORDERS, ORDERS)
RUN_MARKS = marks_of(RUNS, RUNS + 1, 1)
ALL_MARKS = sorted(SIM_MARKS + RUN_MARKS)


def with_marks(circle: Column, marks: list[int]) -> Column:
    return F.sort_array(F.concat(circle, F.array(*[F.lit(mark).cast("long") for mark in marks])))


def around(circle: Column) -> Column:
    """A sorted circle as often as windows of five words need."""
    return F.when(F.size(circle) < 5, F.concat(*[circle] * 6)).otherwise(F.concat(circle, circle))


def windows(turns: Column, placed: Column, marks: list[int], among: list[int], n: int) -> list[Column]:
    """For each of ``marks`` the next ``n`` hashes: of a circle ``around``, and ``with_marks`` of all those ``among``."""
    # Before the mark of rank k are k marks, which the circle itself does not have.
    starts = [(F.array_position(placed, F.lit(mark).cast("long")) - among.index(mark)).cast("int") for mark in marks]
    return [F.slice(turns, start, n) for start in starts]


def bound(value: Column, use) -> Column:
    """``use(value)``, with one evaluation of the value."""
    return F.transform(F.array(value), use)[0]


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def simhashes(words: Column) -> Column:
    """One SimHash for every order."""
    return simhashes_of(F.array_distinct(hashes_of(words)))


def simhashes_of(distinct: Column) -> Column:
    return bound(F.sort_array(distinct), lambda c: F.transform(
        F.array(*windows(around(c), with_marks(c, SIM_MARKS), SIM_MARKS, SIM_MARKS, 5)), majority
    ))


def mark_keys(hashes: Column, turns: Column, placed: Column, marks: list[int], among: list[int]) -> Column:
    """A number for the run of words that begins with the next word after each mark, or for the line's last words."""
    last = F.size(hashes) - RUN + 1
    begins = [F.array_position(hashes, word[0]).cast("int") for word in windows(turns, placed, marks, among, 1)]
    runs = F.array(*[F.slice(hashes, F.least(begin, last), RUN) for begin in begins])
    return F.array_distinct(F.transform(runs, lambda run: F.xxhash64(F.lit("mark"), run)))


def run_keys(hashes: Column, n: Column) -> Column:
    """A number for every run of words by which a line of 8 to 14 words meets others with two edits at most.

    A line of ``length`` words is cut into three runs. A longer line by ``more`` words has one of them: the first at its
    place, the last moved by ``more`` words, or the middle one moved so far that neither side needs more than one edit.
    """
    runs = []
    for more in range(3):
        length = n - more
        second = F.floor(length / 3).cast("int")
        third = F.floor(length * 2 / 3).cast("int")
        moves = [(0, F.lit(0), second, [0]), (1, second, third, range(more - 1, 2)), (2, third, length, [more])]
        for which, start, end, by in moves:
            runs += [
                F.xxhash64(F.lit("run"), length, F.lit(which), F.slice(hashes, start + 1 + move, end - start))
                for move in by
            ]
    # Lines of 8 and 9 words are only looked for by longer ones.
    return F.slice(F.array(*runs), 1, F.when(n >= 10, len(runs)).otherwise(5))


def deletion_keys(hashes: Column) -> Column:
    """A number for the bag of a line's words, and for it without one word.

    Lines with one edit keep a bag of words in common that each has here.
    """
    # Sums of nine numbers of 55 bits do not overflow. What several steps use is bound first, as an array of one.
    small = F.transform(hashes, lambda h: F.shiftrightunsigned(h, 9))
    total = F.aggregate(small, F.lit(0).cast("long"), lambda a, h: a + h)
    bags = F.transform(F.array(F.struct(small.alias("words"), total.alias("total"))), lambda bag: F.concat(
        F.array(bag["total"]), F.transform(bag["words"], lambda h: bag["total"] - h)
    ))[0]
    return F.array_distinct(F.transform(bags, lambda k: F.xxhash64(F.lit("bag"), k)))


def with_keys(df: DataFrame) -> DataFrame:
    """``keys``: the numbers by which a line of ``hashes`` meets others; none where no edit is allowed.

    What several numbers use is a column meanwhile, so that it is made once.
    """
    n, others = F.size("hashes"), [c for c in df.columns]
    df = df.select(*others, F.when(n >= LONG_WORDS, F.sort_array(F.array_distinct("hashes"))).alias("_circle"))
    df = df.select(*others, around(F.col("_circle")).alias("_around"), with_marks(F.col("_circle"), ALL_MARKS).alias("_placed"))
    circle = F.col("_around"), F.col("_placed")
    none = F.array().cast("array<bigint>")
    keys = [
        F.when(n.between(4, 9), deletion_keys(F.col("hashes"))),
        F.when(n.between(8, FEW_WORDS - 1), run_keys(F.col("hashes"), n)),
        F.when(n >= LONG_WORDS, bound(F.transform(F.array(*windows(*circle, SIM_MARKS, ALL_MARKS, 5)), majority), block_keys)),
        F.when(n >= LONG_WORDS, mark_keys(F.col("hashes"), *circle, RUN_MARKS, ALL_MARKS)),
    ]
    return df.select(*others, F.concat(*[F.coalesce(some, none) for some in keys]).alias("keys"))


def hashed_lines(df: DataFrame, key_col: str, text_col: str, min_words: int) -> DataFrame:
    """``doc, place, pos, h1, h2, n_words, odd, keys, row`` for every line that is long enough. No shuffle."""
    rows = df.select(
        F.col(key_col).alias("doc"), F.xxhash64(text_col).alias("place"), lines_of(F.col(text_col)).alias("lines")
    ).select("doc", "place", F.posexplode("lines").alias("pos", "line"))
    # Beside a row's number the hashes are made once, and not for the condition again.
    rows = rows.select(
        "doc", "place", "pos", hashes_of(words_of(F.col("line"))).alias("hashes"), F.monotonically_increasing_id().alias("row")
    )
    rows = with_keys(rows.where(F.size("hashes") >= max(1, min_words)))
    return rows.select(
        "doc", "place", "pos", F.xxhash64("hashes").alias("h1"), F.xxhash64(F.lit(1), "hashes").alias("h2"),
        F.size("hashes").alias("n_words"), parities(F.col("hashes")).alias("odd"), "keys", "row",
    )


def block_keys(sims: Column) -> Column:
    """A number for every block of every SimHash, made of the block's place and bits."""
    edges = [round(SIM_BITS * b / BLOCKS) for b in range(BLOCKS + 1)]
    keys = []
    for order in range(ORDERS):
        for block, (low, high) in enumerate(zip(edges, edges[1:])):
            bits = F.shiftrightunsigned(sims[order], low).bitwiseAND(F.lit((1 << (high - low)) - 1))
            keys.append(F.xxhash64(F.lit(order * BLOCKS + block), bits))
    return F.array(*keys)


def most_edits(similarity: float) -> Column:
    """The edits that the similarity allows to two lines."""
    return F.floor(F.greatest("n_words", "n_words2") * F.lit(1 - similarity) + F.lit(1e-9))


def possible(similarity: float) -> Column:
    """Whether the lengths of two lines allow the similarity."""
    return F.greatest("n_words", "n_words2") - F.least("n_words", "n_words2") <= most_edits(similarity)


class Lines:
    """The steps, each a table in the shared folder. A distinct line is named by its two hashes."""

    def __init__(self, df: DataFrame, key_col: str, text_col: str, min_words: int, similarity: float):
        self.df, self.key_col, self.text_col, self.similarity = df, key_col, text_col, similarity
        self.spark = df.sparkSession
        self.folder = scratch_path(self.spark, "lines")
        self.rows, self.n_rows = self.counted(hashed_lines(df, key_col, text_col, min_words), "rows")
        parts = [f"p{k}" for k in range(PARITIES)]
        lines = self.rows.groupBy("h1", "h2").agg(
            F.count("*").alias("n"), F.min("n_words").alias("n_words"), F.min("row").alias("row"),
            *[F.min(f"odd.{p}").alias(p) for p in parts],
        )
        self.lines = self.write(lines.select("h1", "h2", "n", "n_words", "row", F.struct(*parts).alias("odd")), "distinct")
        self.coded = None

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return materialise(df, f"{self.folder}/{name}")

    def counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        return materialise_counted(df, f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        for name in names:
            discard(self.spark, f"{self.folder}/{name}")

    def crowded(self) -> DataFrame:
        """``key, low, high`` of the buckets that are too large for one task, as a sample of the lines has them.

        They are ``HOT`` at most; ``low`` and ``high`` are the least and greatest ``h1`` in the sample.
        """
        some = self.rows.where(F.col("h1") % HOT_SAMPLE == 0).select("h1", F.explode("keys").alias("key")).distinct()
        some = some.groupBy("key").agg(F.count("*").alias("n"), F.min("h1").alias("low"), F.max("h1").alias("high"))
        some, _ = self.counted(some.where(F.col("n") >= HOT_MEMBERS), "sampled")
        least = some.groupBy("n").agg(F.count("*").alias("keys")).orderBy(F.desc("n")).collect()
        total, bound = 0, HOT_MEMBERS
        for size, keys in least:
            total += keys
            if total > HOT:
                bound = size + 1
                break
        return some.where(F.col("n") >= bound).select("key", "low", "high")

    def buckets(self) -> DataFrame:
        """``key, h1, low, high`` of all buckets with several lines; the hubs are those of the least and greatest ``h1``.

        Keys are moved once. A crowded bucket is moved in parts; its hubs are known before. Of a line that is there very
        often only the first row takes part.
        """
        often = self.lines.where(F.col("n") >= max(2, -(-self.n_rows // HOT))).select("h1", "h2", F.col("row").alias("first"))
        rows = self.rows.where(F.size("keys") > 0).join(F.broadcast(often), ["h1", "h2"], "left")
        rows = rows.where(F.col("first").isNull() | (F.col("first") == F.col("row")))
        crowded = F.broadcast(self.crowded())
        keyed = rows.select("h1", F.explode("keys").alias("key")).join(crowded, "key", "left")
        part = F.when(F.col("low").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("h1"), F.lit(PARTS))).cast("int")
        keyed = keyed.select("key", "h1", part.alias("part"))
        ordered = Window.partitionBy("key", "part").orderBy("h1")
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        keyed = keyed.select(
            "key", "h1", F.lag("h1").over(ordered).alias("before"),
            F.first("h1").over(whole).alias("first"), F.last("h1").over(whole).alias("last"),
        )
        members = keyed.where(F.col("before").isNull() | (F.col("before") != F.col("h1"))).join(crowded, "key", "left")
        members = members.select("key", "h1", F.coalesce("low", "first").alias("low"), F.coalesce("high", "last").alias("high"))
        return self.write(members.where("low < high"), "buckets")

    def described(self, pairs: DataFrame) -> DataFrame:
        """Pairs ``a, b`` of lines that may be similar by their lengths and words, of pairs ``h1, other``."""
        known = self.lines.select("h1", F.struct("h1", "h2").alias("a"), "n_words", "odd")
        others = self.lines.select(
            F.col("h1").alias("other"), F.struct("h1", "h2").alias("b"), F.col("n_words").alias("n_words2"), F.col("odd").alias("odd2")
        )
        both = pairs.repartition("h1").distinct().join(known, "h1").join(others, "other")
        both = both.where(possible(self.similarity) & near_parities("odd", "odd2", most_edits(self.similarity)))
        # Two lines that are hubs of each other meet once.
        return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def near_hubs(self, buckets: DataFrame) -> DataFrame:
        """Pairs ``a, b`` of members and hubs that may be similar. The last hub has met the first one as its member."""
        met = buckets.where("h1 <> high").select("h1", F.explode(F.array("low", "high")).alias("other"))
        return self.described(met.where("h1 <> other"))

    def code(self, pairs: DataFrame, name: str) -> None:
        """Add to ``coded``, ``id`` and ``line``, the lines of ``pairs`` that it lacks. A document that holds some is split once."""
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        if self.coded is not None:
            ids = ids.join(self.coded.select("id"), "id", "left_anti")
        ids, n_ids = self.counted(ids.select("id.h1", "id.h2"), f"ids-{name}")
        if not n_ids and self.coded is not None:
            return
        ids = self.lines.select("h1", "h2", "row").join(by_count(ids, n_ids), ["h1", "h2"])
        ids = self.write(ids.select("row", F.struct("h1", "h2").alias("id")), f"numbers-{name}")
        wanted = self.write(self.rows.select("row", "doc", "place", "pos").join(by_count(ids, n_ids), "row"), f"wanted-{name}")
        by_text = wanted.groupBy("doc", "place").agg(F.collect_list(F.struct("id", "pos")).alias("wanted"))
        texts = self.df.select(
            F.col(self.key_col).alias("doc2"), F.xxhash64(self.text_col).alias("place2"),
            F.col(self.text_col).alias("text"),
        )
        same = F.col("doc2").eqNullSafe(F.col("doc")) & (F.col("place2") == F.col("place"))
        at = texts.join(F.broadcast(by_text) if n_ids * WANTED_BYTES <= BROADCAST_BYTES else by_text, same)
        found = bound(lines_of(F.col("text")), lambda lines: F.transform("wanted", lambda w: F.struct(
            w["id"].alias("id"), F.element_at(lines, w["pos"] + 1).alias("line")
        )))
        at = at.select(F.explode(found).alias("found")).select("found.id", "found.line")
        at = at.select("id", coded(codes_of(words_of(F.col("line")))).alias("line"))
        lines, n_lines = self.counted(at, f"coded-{name}")
        if n_lines > n_ids:
            # A row that is there several times gives its lines as often.
            lines = self.write(lines.dropDuplicates(["id"]), f"coded-once-{name}")
        self.coded = lines if self.coded is None else self.coded.unionByName(lines)
        self.drop(f"ids-{name}", f"numbers-{name}", f"wanted-{name}")

    def verified(self, pairs: DataFrame, n_pairs: int, name: str) -> DataFrame:
        """Pairs of lines whose words are similar."""
        self.code(pairs, name)
        lines = self.coded
        hubs = lines.join(pairs.select(F.col("b").alias("id")).distinct(), "id", "left_semi")
        hubs = hubs.select(F.col("id").alias("b"), F.col("line").alias("line2"))
        size = hubs.agg(F.coalesce(F.sum(F.octet_length("line2") + 64), F.lit(0))).first()[0]
        hubs = F.broadcast(hubs) if size <= BROADCAST_BYTES else hubs
        both = lines.withColumnRenamed("id", "a").join(by_count(pairs, n_pairs), "a").join(hubs, "b")
        longest = F.greatest(F.length("line"), F.length("line2"))
        most = F.floor(longest * F.lit(1 - self.similarity) + F.lit(1e-9)).cast("int")
        # Beyond the threshold the function gives -1.
        similar = both.withColumn("most", most).where(F.expr("levenshtein(line, line2, most) >= 0"))
        return self.write(similar.select("a", "b"), f"verified-{name}")

    def open_members(self, inner: DataFrame, roots: DataFrame, n_roots: int, name: str) -> tuple[DataFrame, int]:
        """``key, h1, root, hub`` of the ``inner`` members of buckets where some are in another group than the first hub."""
        def label(line: str, root: str) -> DataFrame:
            return by_count(roots.select(F.col("id.h1").alias(line), F.col("root.h1").alias(root)), n_roots)

        members = inner.join(label("h1", "root"), "h1", "left").join(label("low", "hub"), "low", "left")
        members = members.select("key", "h1", F.coalesce("root", "h1").alias("root"), F.coalesce("hub", "low").alias("hub"))
        members = self.write(members, f"members-{name}")
        apart = members.groupBy("key").agg(
            F.min("root").alias("least"), F.max("root").alias("most"),
            F.sum((F.col("root") != F.col("hub")).cast("long")).alias("n_open"),
        )
        apart, n = self.counted(apart.where("least <> most").select("key", "n_open"), f"apart-{name}")
        return members.join(by_count(apart, n), "key"), n

    def groups(self) -> tuple[DataFrame, int]:
        """``id, root`` of all lines that are connected to another."""
        buckets = self.buckets()
        self.rows = self.write(self.rows.select("doc", "place", "pos", "h1", "h2", "row"), "places")
        self.drop("rows", "sampled")
        pairs, n_pairs = self.counted(self.near_hubs(buckets), "pairs-hubs")
        edges = self.verified(pairs, n_pairs, "hubs")
        roots, n_roots = self.counted(connected(edges, "a", "b"), "roots-hubs")

        # Both hubs have met all others; what is not compared yet are two members that are no hubs.
        inner = self.write(buckets.where("h1 <> low AND h1 <> high").select("key", "h1", "low"), "inner")
        self.drop("buckets")
        turn, n_before = 0, None
        while True:
            members, n_apart = self.open_members(inner, roots, n_roots, str(turn))
            if not n_apart:
                return roots, n_roots
            large = members.where((F.col("n_open") >= OPEN_MEMBERS) & (F.col("root") != F.col("hub")))
            by_turn = F.min_by("h1", F.xxhash64(F.col("h1"), F.lit(turn))).alias("other")
            hubs, n_hubs = self.counted(large.groupBy("key").agg(by_turn, F.count("*").alias("n")), f"hubs-{turn}")
            n_open = hubs.agg(F.sum("n")).first()[0]
            # A further hub is worth its scan as long as the last one halved what is open.
            if not n_hubs or n_before is not None and n_open > n_before / 2:
                break
            n_before = n_open
            near = members.join(by_count(hubs.drop("n"), n_hubs), "key").where("h1 <> other").select("h1", "other")
            near, n_near = self.counted(self.described(near).join(pairs, ["a", "b"], "left_anti"), f"pairs-{turn}")
            found = self.verified(near, n_near, str(turn)) if n_near else None
            if found is None or found.isEmpty():
                break
            pairs, edges = pairs.unionByName(near), edges.unionByName(found)
            roots, n_roots = self.counted(connected(edges, "a", "b"), f"roots-{turn}")
            turn += 1

        known = self.lines.select("h1", F.struct("h1", "h2").alias("id"), "n_words", "odd")
        open_members = self.write(members.select("key", "h1", "root", "hub").join(known, "h1"), "open-members")
        others = open_members.select(
            "key", F.col("id").alias("b"), F.col("n_words").alias("n_words2"), F.col("root").alias("root2"),
            F.col("odd").alias("odd2"),
        )
        # Two members that are both apart from the hub meet once.
        rest = open_members.where("root <> hub").join(others, "key").where(
            (F.col("root") != F.col("root2")) & ((F.col("root2") == F.col("hub")) | (F.col("id") < F.col("b")))
            & possible(self.similarity) & near_parities("odd", "odd2", most_edits(self.similarity))
        )
        rest = rest.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
        rest, n_rest = self.counted(rest, "pairs-rest")
        if not n_rest:
            return roots, n_roots
        edges = edges.unionByName(self.verified(rest, n_rest, "rest"))
        return self.counted(connected(edges, "a", "b"), "roots-rest")

    def removed(self) -> DataFrame:
        """``doc, place, removed``: the places of the lines that go."""
        roots, n_roots = self.groups()
        ids = F.struct("h1", "h2").alias("id")
        repeated = self.lines.where("n > 1").select(ids)
        several = roots.join(repeated, "id", "full").select("id.h1", "id.h2", F.coalesce("root", "id").alias("root"))
        several, n = self.counted(several, "several")
        rows = self.rows.select("doc", "place", "pos", "h1", "h2").join(by_count(several, n), ["h1", "h2"])
        rows = self.write(rows.select("doc", "place", "pos", "root"), "repeats")
        heads, n_heads = self.counted(
            rows.groupBy("root").agg(F.min(F.struct("doc", "place", "pos")).alias("head")), "heads"
        )
        rows = rows.join(by_count(heads, n_heads), "root")
        head = F.col("head")
        stays = F.col("doc").eqNullSafe(head["doc"]) & (F.col("place") == head["place"]) & (F.col("pos") == head["pos"])
        gone = rows.where(~stays).groupBy("doc", "place").agg(F.collect_set("pos").alias("removed"))
        gone = materialise(gone, scratch_path(self.spark, "lines-removed"))
        discard(self.spark, self.folder)
        return gone


def near_line_dedup(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                    similarity: float = SIMILARITY) -> DataFrame:
    """All columns of ``df``, the text without repeated lines, and ``removed``: the places of lines that went, sorted.

    ``removed`` is null where nothing went; its places count from 0.
    """
    no_clash(df, ["removed"])
    gone = Lines(df, key_col, text_col, min_words, similarity).removed()
    size = gone.agg(F.coalesce(F.sum(F.size("removed") * 4 + 64), F.lit(0)).alias("size")).first()[0]
    gone = F.broadcast(gone) if size <= BROADCAST_BYTES else gone
    # The other columns are one column meanwhile, so that no name of them can be mistaken.
    others = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    rows = df.select(
        F.struct(*others).alias("row"), F.col(text_col).alias("text"), F.col(key_col).alias("key"),
        F.xxhash64(text_col).alias("here"),
    )
    same = F.col("key").eqNullSafe(F.col("doc")) & (F.col("here") == F.col("place"))
    kept = F.filter(F.split("text", BREAK), lambda x, i: ~F.array_contains("removed", i))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, BREAK))
    columns = [text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in df.columns]
    return rows.join(gone, same, "left").select(*columns, F.array_sort("removed").alias("removed"))
