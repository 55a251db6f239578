"""Fill-in-the-middle: texts cut into prefix, middle and suffix, and put together again in another order."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SEPARATORS, each_text, fresh

_BLANK = np.zeros(256, bool)
_BLANK[list(SEPARATORS)] = True
#: Bytes of transformed texts that are handed to Arrow at once.
OUTPUT_BYTES = 8 << 20
CUT = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>"


@dataclass(frozen=True)
class Plan:
    """How texts are cut. ``unit`` is "token" (words with the blanks before them) or "char" (code points); the rates are in
    percent: of texts that are transformed, and of those that put the suffix first."""

    seed: str = "42"
    unit: str = "token"
    rate: int = 50
    suffix_first: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if self.unit not in ("token", "char"):
            raise ValueError(f"unit {self.unit!r}")
        # a mark must be found where it was put: no proper end of one may be the beginning of one
        if not all(marks) or any(b.startswith(a[k:]) for a in marks for b in marks for k in range(1, len(a))) or any(a in b for a in marks for b in marks if a is not b):
            raise ValueError(f"marks that can be mistaken: {marks}")


class ExceptionIndex:
    """The multibyte characters of a UTF-8 text: where each begins and how many bytes beyond one it takes. Between them a
    code point is a byte, so a cut is converted by one binary search and a subtraction; an ASCII text has no entries."""

    def __init__(self, text: bytes):
        self.size = len(text)
        b = np.frombuffer(b"" if text.isascii() else text, np.uint8)
        self.at_byte = np.flatnonzero(b >= 0xC0)
        lead = b[self.at_byte]
        self.excess = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64)])
        self.at_char = self.at_byte - self.excess[:-1]

    def chars(self, byte_cuts: np.ndarray) -> np.ndarray:
        """Code points before each cut, given in bytes, between characters."""
        return byte_cuts - self.excess[np.searchsorted(self.at_byte, byte_cuts)]

    def bytes(self, char_cuts: np.ndarray) -> np.ndarray:
        """Bytes before each cut, given in code points."""
        return char_cuts + self.excess[np.searchsorted(self.at_char, char_cuts)]


def token_ends(text: bytes) -> np.ndarray:
    """Byte ends of the tokens ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+`` from left to right: one behind
    each word, and one behind blanks that no word follows."""
    blank = np.append(_BLANK[np.frombuffer(text, np.uint8)], True)
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(text)) if text and blank[-2] else ends


def cut(text: bytes, digest: str, plan: Plan) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix_chars, middle_chars, output) of one text; ``digest`` is the hex hash that draws for it."""
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    index = ends = None
    if plan.unit == "token":
        ends = token_ends(text)
        n = len(ends)
    else:
        index = ExceptionIndex(text)
        n = int(index.chars(np.array([index.size]))[0])
    marks = [m.encode() for m in (plan.prefix, plan.suffix, plan.middle)]
    if not text or h[2] % 100 >= plan.rate or any(m in text for m in marks):
        return n, "plain", None, None, text
    units = np.sort(np.array([h[0] % (n + 1), h[1] % (n + 1)]))
    if plan.unit == "token":
        at = np.where(units > 0, ends[np.maximum(units, 1) - 1], 0)
        chars = ExceptionIndex(text).chars(at)
    else:
        at, chars = index.bytes(units), units
    before, inside, behind = text[: at[0]], text[at[0] : at[1]], text[at[1] :]
    p, s, m = marks
    form = "spm" if h[3] % 100 < plan.suffix_first else "psm"
    parts = (s, behind, p, before, m, inside) if form == "spm" else (p, before, s, behind, m, inside)
    return n, form, int(chars[0]), int(chars[1] - chars[0]), b"".join(parts)


def _cutter(plan: Plan):
    def run(texts: pa.Array, digests: pa.Array) -> pa.Array:
        done, rows, outputs, held = [], [], [], 0

        def flush():
            n, form, prefix, middle = zip(*rows) if rows else ((), (), (), ())
            # (a view: the bytes are those of Spark's strings, which Arrow need not check again)
            columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(outputs, pa.binary()).view(pa.string())]
            done.append(pa.StructArray.from_arrays(columns, ["n", "form", "prefix_chars", "middle_chars", "output"]))
            rows.clear(), outputs.clear()

        for text, digest in zip(each_text(texts), digests.to_pylist()):
            *row, output = cut(text, digest, plan)
            rows.append(row)
            outputs.append(output)
            held += len(output)
            if held > OUTPUT_BYTES:
                flush()
                held = 0
        flush()
        return pa.concat_arrays(done)

    return F.arrow_udf(run, CUT)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``docs`` with n (units of the text), form ("plain", "psm" or "spm"), prefix_chars and middle_chars (code points, null
    if plain) and output, the transformed text.

    Draws come from the SHA-256 of seed, colon and id alone, so reruns and other partitionings agree; a null id draws as an
    empty one, rows equal in id and text come out alike. A null text counts as empty; an empty text stays plain, and so does
    one that holds a mark. A text is cut whole, whatever its length. An empty table gives none. Columns of ``docs`` named like
    a result are replaced, other names can't clash.
    """
    results = ["n", "form", "prefix_chars", "middle_chars", "output"]
    kept = [c for c in docs.columns if c not in results]
    (done,) = fresh(docs, "cut")
    digest = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    out = docs.withColumn(done, _cutter(plan)(F.col(f"`{text_col}`"), digest))
    return out.select(*[F.col(f"`{c}`") for c in kept], *[F.col(done)[c].alias(c) for c in results])


def restore(output: Column, form: Column, plan: Plan = Plan()) -> Column:
    """The text from which ``transform`` made ``output``. A transformed text holds each mark once."""
    marks = "|".join(rf"\Q{m}\E" for m in (plan.prefix, plan.suffix, plan.middle))
    parts = F.split(output, marks, -1)  # an empty part before the first mark, then the three in their order
    prefix, suffix = (F.when(form == "spm", parts[a]).otherwise(parts[b]) for a, b in ((2, 1), (1, 2)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
t AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (
  SELECT *, len(tokens) AS n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS a, greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
s AS (
  SELECT *, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle, array_to_string(tokens[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256 FROM s
"""
