"""Text cleansing and tokenising."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from .lookup import in_words, lookup

# The delimiters between words of a text line. The vertical tab is not among them.
WORD_DELIMITERS = r"[ \t\n\r\f]+"

# The characters that count as blank at the ends of a post, and as a regex class body.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
BLANK = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Noise in a lower-case ASCII post is a mention, a link, or a run of signs, where letters and
# digits are the ASCII ones. The first alternative that fits at a position wins, so " @" before a name is a run
# of signs and the name stays. (The class is one property on purpose: Java matches a negated union of several
# ranges many times slower as soon as several threads do it.)
NOT_BLANK_ASCII = r"[^\t-\r\x1c-\x20]"
NOISE = rf"@{NOT_BLANK_ASCII}+|https?:{NOT_BLANK_ASCII}+|http?:{NOT_BLANK_ASCII}|[^\p{{Alnum}}]+"

# Words that the tokeniser cuts in two.
FUSED = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}
FUSED_HEAD = r"\b(" + "|".join(rf"{a}(?={b}\b)" for a, b in FUSED.values()) + ")"


def words_of(line: Column | str) -> Column:
    """Split a line at word delimiters. The first and last item may be empty: see ``tokenize_ws``."""
    return F.split(line, WORD_DELIMITERS)


def tokenize_ws(line: Column | str) -> Column:
    """Words of a text line; case and punctuation are kept, there are no empty words."""
    return F.filter(words_of(line), lambda w: w != "")


def lower_trim(text: Column | str) -> Column:
    """Lower case, without blanks at either end."""
    return F.btrim(F.lower(text), F.lit(BLANKS))


def newline_to_space(text: Column | str) -> Column:
    return F.replace(F.col(text) if isinstance(text, str) else text, F.lit("\n"), F.lit(" "))


def ascii_only(text: Column | str) -> Column:
    """Drop every non-ASCII character, such as emoji and accented letters."""
    return F.regexp_replace(text, r"\P{ASCII}+", "")


def strip_noise(text: Column | str) -> Column:
    """Mentions, links and runs of signs become one blank each; the ends are trimmed."""
    return F.trim(F.regexp_replace(text, NOISE, " "))


def collapse_spaces(text: Column | str) -> Column:
    return F.regexp_replace(text, " {2,}", " ")


def normalise(text: Column | str) -> Column:
    """Everything the cleansing does before stop words are taken out."""
    return strip_noise(ascii_only(newline_to_space(lower_trim(text))))


def tokenize_clean(text: Column | str) -> Column:
    """Tokens of a normalised text; the six fused words are cut in two."""
    return F.split(F.regexp_replace(text, FUSED_HEAD, "$1 "), " +")


def split_on_space(text: Column | str) -> Column:
    """Split on every single space; neighbouring spaces give empty items."""
    return F.split(text, " ")


def remove_stopwords_text(tokens: Column, stop: Iterable[str]) -> Column:
    """Join the tokens that are no stop word; their order and repeats are kept."""
    stop = list(stop)
    return F.array_join(F.filter(tokens, lambda w: (w != "") & ~in_words(w, stop)), " ")


def cleanse(text: Column | str, stop: Iterable[str]) -> Column:
    """The whole cleansing of a post.

    Cutting fused words and dropping stop words is one lookup per word: both are known before the first post
    is read.
    """
    stop = set(stop)
    instead = dict.fromkeys(stop, "")
    for word, pieces in FUSED.items():
        instead[word] = " ".join(p for p in pieces if p not in stop)
    words = F.split(normalise(text), " +")
    kept = F.transform(words, lambda w: F.coalesce(lookup(w, instead, "string"), w))
    return F.array_join(F.filter(kept, lambda w: w != ""), " ")
