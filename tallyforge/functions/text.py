"""Text helpers and the cleaning of names: all case-insensitive patterns are Unicode-aware, as the rules expect."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed

#: A position that is no word boundary inside CJK text either.
LEFT, RIGHT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def let(x: Column, body) -> Column:
    """``body`` of ``x`` with ``x`` computed once."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def strip(x: Column) -> Column:
    """Without white space at both ends, Unicode spaces included."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def or_null(x: Column) -> Column:
    """Null for null and blank."""
    s = strip(x.cast("string"))
    return F.when(s != "", s)


def first_given(*xs: Column) -> Column:
    """The first value that is neither null nor ""."""
    return F.coalesce(*[F.when(x != "", x) for x in xs])


def quoted(x: Column) -> Column:
    """A text as a literal pattern."""
    return F.regexp_replace(x, r"([\\.\[\]{}()*+?^$|#&~\-])", r"\\$1")


def has_word(x: Column, word: Column) -> Column:
    """Whether ``word`` stands in ``x`` as a whole word. The pattern is a column, which is compiled for each row, so only texts
    that contain the word get that far."""
    return x.contains(word) & F.rlike(x, F.concat(F.lit(LEFT), quoted(word), F.lit(RIGHT)))


def any_of(words) -> str:
    """A pattern that matches any of some literal words."""
    return "|".join(re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", w) for w in words)


def clean_noise(x: Column) -> Column:
    """Without price-table words, trade terms, file suffixes, emission standards and model years."""
    return F.btrim(F.regexp_replace(x, "(?iuU)" + fixed.NOISE_WORDS, ""), F.lit(" _-.\n\r"))


def is_invalid_model(x: Column) -> Column:
    """Empty, longer than 40, or a footer line."""
    s = strip(x)
    return F.coalesce((x == "") | (F.length(s) > 40) | s.rlike("(?iuU)" + fixed.FOOTER_NOISE), F.lit(True))


def compact_key(x: Column) -> Column:
    """C14: lower case without spaces, hyphens, underscores, slashes and colons."""
    return F.lower(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)[\s_\-/：:]+", ""))


def squeezed(x: Column) -> Column:
    """Lower case without blanks."""
    return F.lower(F.replace(F.coalesce(x, F.lit("")), F.lit(" "), F.lit("")))


def safe_name(x: Column) -> Column:
    """Characters that file names can't hold become underscores."""
    return F.regexp_replace(x, r'[\\/*?:"<>|]', "_")


def comparable(x: Column) -> Column:
    """Trimmed text, null for blank."""
    return or_null(x)
