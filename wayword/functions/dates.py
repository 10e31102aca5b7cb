"""Post dates: several written forms, read without regard to the session time zone.

Each form is checked by a pattern and rewritten as an ISO string, which ``try_cast`` then accepts or turns into
null. The pattern is needed because the cast alone would also accept other forms.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import BLANK

_GAP = rf"[{BLANK}]+"
# A day may be padded with a blank instead of a zero.
_DAY = r"(?: ?([1-9])|([0-3][0-9]))"
_MONTH = r"([0-1]?[0-9])"
_HOUR = r"([0-2]?[0-9])"
_SIXTIETH = r"([0-5]?[0-9])"
_YEAR = r"(?!0000)([0-9]{4})"

YEAR_FIRST = rf"\A{_YEAR}-{_MONTH}-{_DAY}{_GAP}{_HOUR}:{_SIXTIETH}:{_SIXTIETH}\z"
DAY_FIRST = rf"\A{_DAY}([-/.]){_MONTH}\3{_YEAR}{_GAP}{_HOUR}:{_SIXTIETH}\z"
DAY_FIRST_SHORT = rf"\A{_DAY}([-/.]){_MONTH}\3([0-9]{{2}}){_GAP}{_HOUR}:{_SIXTIETH}\z"

# Fixed value: two-digit years up to this one belong to the 2000s, the later ones to the 1900s.
LAST_SHORT_YEAR_OF_2000S = 68


def parse_post_time(date: Column | str) -> Column:
    """Read ``Y-m-d H:M:S``, ``d-m-Y H:M``, ``d/m/Y H:M`` or ``d.m.Y H:M``; null for anything else."""
    date = F.col(date) if isinstance(date, str) else date
    iso = F.when(
        date.rlike(YEAR_FIRST), F.regexp_replace(date, YEAR_FIRST, "$1-$2-$3$4 $5:$6:$7")
    ).when(date.rlike(DAY_FIRST), F.regexp_replace(date, DAY_FIRST, "$5-$4-$1$2 $6:$7:00"))
    return iso.try_cast("timestamp_ntz")


def has_valid_date(date: Column | str) -> Column:
    """True where ``parse_post_time`` finds a date, false otherwise and for null."""
    return parse_post_time(date).isNotNull()


def parse_epoch(date: Column | str) -> Column:
    """Read ``d-m-y H:M``, ``d/m/y H:M`` or ``d.m.y H:M`` as seconds since 1970 in UTC; 0 for anything else."""
    date = F.col(date) if isinstance(date, str) else date
    short = F.regexp_extract(date, DAY_FIRST_SHORT, 5).try_cast("int")
    century = F.when(short <= LAST_SHORT_YEAR_OF_2000S, "20").otherwise("19")
    iso = F.when(
        date.rlike(DAY_FIRST_SHORT),
        F.concat(century, F.regexp_replace(date, DAY_FIRST_SHORT, "$5-$4-$1$2 $6:$7:00Z")),
    )
    return F.coalesce(F.unix_seconds(iso.try_cast("timestamp")), F.lit(0).cast("bigint"))
