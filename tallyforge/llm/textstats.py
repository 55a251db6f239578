"""Dense statistics of a whole text, shared by the quality and toxicity classifiers."""

from __future__ import annotations

from operator import eq

import numpy as np

_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _BANG, _SYMBOL, _HIGH = range(9)
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = _SPACE
_CLASS[0x0A] = _LINE
_CLASS[[ord(c) for c in ".,;:'\"-?()"]] = _STOP
_CLASS[ord("!")] = _BANG
_CLASS[0x80:] = _HIGH

#: Words in a window; the worst window of a text counts beside its mean, since junk may fill only a part of it.
WINDOW = 40

SHAPE_NAMES = (
    "log_words", "word_length", "upper", "digit", "stop", "bang", "symbol", "high", "distinct", "repeats", "trigram_repeats",
    "caps_words", "odd_words", "worst_caps", "worst_odd", "worst_repeats", "log_line_length",
)


def _rate(hits: float, total: float) -> float:
    """Log of a rate over a floor: the same for no hits in a short and in a long text, which plain log odds are not."""
    return float(np.log(hits / (total + 2.0) + 0.01))


def _worst(flags: np.ndarray) -> float:
    """Largest share of set flags in a window (the whole text, if shorter)."""
    n = len(flags)
    if n <= WINDOW:
        return float(flags.sum() + 0.0) / WINDOW
    sums = np.concatenate([[0], np.cumsum(flags)])
    return float((sums[WINDOW:] - sums[:-WINDOW]).max()) / WINDOW


def shape(text: bytes) -> list[float]:
    """The ``SHAPE_NAMES`` of one text, already transformed (logs of sizes, floored logs of rates). Works on empty texts."""
    b = np.frombuffer(text, np.uint8)
    cls = _CLASS[b]
    c = np.bincount(cls, minlength=9)
    visible = len(b) - c[_SPACE] - c[_LINE]
    words = text.split()
    n = len(words)
    gap = np.ones(len(b) + 2, bool)
    gap[1:-1] = (cls == _SPACE) | (cls == _LINE)
    starts, ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    marks = np.zeros((3, len(b) + 1), np.int32)
    for row, which in zip(marks, (_UPPER, _LOWER, _SYMBOL)):
        np.cumsum(cls == which, out=row[1:])
    per = marks[:, ends] - marks[:, starts]
    bangs = np.zeros(len(b) + 1, np.int32)
    np.cumsum(cls == _BANG, out=bangs[1:])
    caps = (per[0] >= 2) & (per[1] == 0)
    odd = per[2] + (bangs[ends] - bangs[starts]) >= 2
    same = np.fromiter(map(eq, words[1:], words), bool, max(0, n - 1))
    distinct = len(set(words))
    trigrams = len(set(zip(words, words[1:], words[2:])))
    lines = text.count(b"\n") + 1
    return [
        float(np.log1p(n)), float(np.log1p(visible / max(n, 1))), _rate(c[_UPPER], visible), _rate(c[_DIGIT], visible), _rate(c[_STOP], visible),
        _rate(c[_BANG], visible), _rate(c[_SYMBOL], visible), _rate(c[_HIGH], visible), float(np.log(distinct + 2) / np.log(n + 2)), _rate(same.sum(), n),
        _rate(max(0, n - 2) - trigrams, n), _rate(caps.sum(), n), _rate(odd.sum(), n), _worst(caps), _worst(odd), _worst(same),
        float(np.log1p(len(b) / lines)),
    ]
