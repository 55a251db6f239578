"""Numbers out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, strip


def to_number(x: Column) -> Column:
    """Digits and points only, rounded half to even; signs and units vanish; null if that is no number."""
    digits = F.regexp_replace(x.cast("string"), "[^0-9.]", "")
    return F.bround(F.when(digits != "", digits).try_cast("double")).try_cast("long")


def number_of_first(*xs: Column) -> Column:
    """The first column that is a number."""
    return F.coalesce(*[to_number(x) for x in xs])


def number_of_first_given(*xs: Column) -> Column:
    """The first column that is given, as a number (null if that one is none)."""
    return to_number(F.coalesce(*[F.when((x.cast("string") != "") & (x.cast("string") != "0"), x.cast("string")) for x in xs]))


def half_even(x: Column) -> Column:
    return F.bround(x.cast("double")).try_cast("long")


def _number(text: Column, pattern: str, group: int) -> Column:
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found).try_cast("double")


def wait_days(x: Column) -> Column:
    """Days to wait: stock words are 0; then weeks (upper end of a range), months of 30 days, days, bare digits."""
    n = r"(\d+(?:\.\d+)?)\s*"
    whole = lambda v, k: F.floor(v * k).cast("long")  # noqa: E731  all are positive

    def days(t: Column) -> Column:
        return F.coalesce(
            F.when(t.rlike("现车|现货|即提|立即可提|有车") | t.isin("0", "0天"), F.lit(0).cast("long")),
            whole(_number(t, rf"(?U){n}[-~至]\s*{n}周", 2), 7),
            whole(_number(t, rf"(?U){n}周", 1), 7),
            whole(_number(t, rf"(?U){n}[-~至]\s*{n}个?月", 2), 30),
            whole(_number(t, rf"(?U){n}个?月", 1), 30),
            whole(_number(t, r"(?U)(\d+)\s*[-~至]\s*(\d+)\s*天", 2), 1),
            whole(_number(t, r"(?U)(\d+)\s*天", 1), 1),
            F.when(t.rlike(r"^\d+$"), t).try_cast("long"),
        )

    return let(strip(x.cast("string")), days)
