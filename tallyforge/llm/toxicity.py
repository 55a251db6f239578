"""Toxicity: boosted trees over dense features (lexicon, second person, capitals, punctuation, obfuscation), calibrated."""

from __future__ import annotations

from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import each_text, held_out, staged, text_bytes

FOLDS = 5
#: At most so many labelled rows are used to fit, chosen by a seeded hash.
MAX_LABELLED = 20_000
PREFIXES = (4, 5, 6)
NEAR = 6
SECOND_PERSON = frozenset(
    w.encode()
    for w in "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te ti tú usted ustedes vosotros os su toi vous votre vos ton ta tes".split()
)
_LEET = bytes.maketrans(b"013457@$!|", b"oieastasil")
_PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_INNER = frozenset(b"0123456789@$!|*#%_-")
FEATURES = (
    "lexicon_rate", "lexicon_log", "lexicon_distinct", "weight_rate", "weight_log", "hidden_rate", "second_rate", "near_rate", "near_log",
    "capital_rate", "bang_rate", "question_rate", "symbol_rate", "obfuscated_rate", "log_words",
)


def _units(word: bytes):
    yield word
    for k in PREFIXES:
        if len(word) > k:
            yield word[:k] + b"~"


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters and non-ASCII characters."""
    return text.translate(_PLAIN).split()


class Lexicon:
    """Weights of words and word beginnings that stand in toxic documents far more often than in others."""

    def __init__(self, counts: dict[bytes, tuple[int, int]], toxic: int, clean: int):
        self.counts, self.toxic, self.clean = counts, toxic, clean
        self.least = max(3, round(0.003 * toxic))
        self.tables = {own: self._table(own) for own in (None, 0, 1)}

    def _table(self, own: int | None) -> dict[bytes, float]:
        """The table for new texts, or the one that leaves out a training text's own count (own: its label)."""
        a, b, out = int(own == 1), int(own == 0), {}
        for unit, (t, c) in self.counts.items():
            t, c = t - a, c - b
            w = log((t + 0.5) / (self.toxic - a + 1)) - log((max(c, 0) + 0.5) / (self.clean - b + 1))
            if t >= self.least - a and w >= 2.5:
                out[unit] = w
        return out

    def weigh(self, word: bytes, own: int | None = None) -> float:
        get = self.tables[own].get
        return max(get(word, 0.0), get(word[:4] + b"~", 0.0), get(word[:5] + b"~", 0.0), get(word[:6] + b"~", 0.0))


def features(text: bytes, lexicon: Lexicon, own: int | None = None) -> list[float]:
    """The ``FEATURES`` of one whole text."""
    words = plain_words(text)
    n = len(words)
    table = lexicon.tables[own]
    hits = [i for i, w in enumerate(words) if w in table or w[:4] + b"~" in table or w[:5] + b"~" in table or w[:6] + b"~" in table] if table else []
    weights = [lexicon.weigh(words[i], own) for i in hits]
    seconds = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if hits and seconds:
        at = np.searchsorted(s := np.array(seconds), h := np.array(hits))
        left, right = s[np.maximum(at - 1, 0)], s[np.minimum(at, len(s) - 1)]
        near = int((np.minimum(np.abs(h - left), np.abs(right - h)) <= NEAR).sum())
    obfuscated = hidden = 0
    if any(c in text for c in (b"@", b"$", b"*", b"0", b"1", b"3", b"4", b"5", b"7", b"!", b"|", b"#", b"%", b"_", b"-")):
        for token in text.split():
            core = token.strip(b".,;:'\"!?()*#%&$-_")
            if not core.isalpha() and any(c in _INNER for c in core[1:-1]) and any(97 <= c | 32 <= 122 for c in core) and sum(48 <= c <= 57 for c in core) * 2 < len(core):
                obfuscated += 1
                lowered = core.translate(_LEET).lower()
                hidden += max(lexicon.weigh(lowered, own), lexicon.weigh(lowered.translate(None, b"*-_#%"), own)) > 0
    b = np.frombuffer(text, np.uint8)
    size = len(b) + 1
    upper = int(((b >= 65) & (b <= 90)).sum())
    bangs, questions = text.count(b"!"), text.count(b"?")
    symbols = int((((b >= 35) & (b <= 38)) | (b == 42) | (b == 64) | (b == 94) | (b == 124)).sum())
    per = n + 5.0
    found, heavy = len(hits) + hidden, sum(weights)
    return [
        found / per, log(1 + found), float(len({words[i] for i in hits})), heavy / per, log(1 + heavy), hidden / per, len(seconds) / per, near / per, log(1 + near),
        upper / size, bangs / size, questions / size, symbols / size, obfuscated / per, log(1 + n),
    ]


def labelled_sample(labels: DataFrame, label_col: str, id_col: str = "doc_id", most: int = MAX_LABELLED) -> DataFrame:
    """(id, y) of at most ``most`` labelled rows outside the held-out fold, the first by a hash of the id."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col, FOLDS))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    return known.orderBy(F.xxhash64("id"), "id").limit(most)


def learn_lexicon(train: DataFrame) -> Lexicon:
    """Count, for each word and word beginning, the toxic and the other documents of ``train`` (y, text) that hold it."""

    def run(batches):
        counts = (Counter(), Counter())
        rows = [0, 0]
        for batch in batches:
            for text, y in zip(text_bytes(batch.column(1)), batch.column(0).to_pylist()):
                rows[y] += 1
                counts[y].update({u for w in set(plain_words(text)) for u in _units(w)})
        units = list(counts[1])
        totals = [b""], [rows[1]], [rows[0]]
        yield pa.RecordBatch.from_arrays([pa.array(totals[0] + units, pa.binary()), pa.array(totals[1] + [counts[1][u] for u in units], pa.int64()), pa.array(totals[2] + [counts[0][u] for u in units], pa.int64())], ["unit", "t", "c"])
        only = [u for u in counts[0] if u not in counts[1]]
        yield pa.RecordBatch.from_arrays([pa.array(only, pa.binary()), pa.array([0] * len(only), pa.int64()), pa.array([counts[0][u] for u in only], pa.int64())], ["unit", "t", "c"])

    counted = staged(train.select("y", "text").mapInArrow(run, "unit binary, t long, c long").groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c")), "lexicon")
    total = counted.where(F.length("unit") == 0).collect()
    toxic, clean = (total[0].t, total[0].c) if total else (0, 0)
    lift = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    strong = counted.where((F.length("unit") > 0) & (F.col("t") >= 3) & (lift >= 2.5))
    return Lexicon({bytes(r.unit): (r.t, r.c) for r in strong.collect()}, toxic, clean)


def dense_features(docs: DataFrame, lexicon: Lexicon, with_label: bool = False) -> DataFrame:
    """(id, x) or (id, y, x) from (id, text) or (id, y, text); labelled rows leave their own count out of the lexicon."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        for batch in batches:
            owns = batch.column(1).to_pylist() if with_label else [None] * batch.num_rows
            x = pa.array([features(t, shared.value, y) for t, y in zip(each_text(batch.column(batch.num_columns - 1)), owns)], pa.list_(pa.float64()))
            names = ["id", "y", "x"] if with_label else ["id", "x"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], x], names)

    kinds = dict(docs.dtypes)
    return docs.mapInArrow(run, f"id {kinds['id']}, " + ("y int, " if with_label else "") + "x array<double>")


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, score) of every row of ``docs``, 0 to 1.

    Fitting uses at most ``MAX_LABELLED`` labelled rows outside the held-out fold: a lexicon is counted on them, boosted
    trees are grown on four fifths and an isotonic curve calibrates them on the rest. Scoring covers every whole text.
    Null and empty texts are scored like others and very long ones whole, repeated rows repeat, ties of several labels for
    an id go to the largest; an empty table gives none; other columns are not read. Without three rows of each class all
    scores are the smoothed prior. The lexicon holds the words of a bounded sample, so its size is bounded too.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = staged(labelled_sample(labels, label_col, id_col), "toxic-sample")
    train = texts.join(F.broadcast(sample), "id").select("id", "y", "text")  # bounded by MAX_LABELLED rows
    lexicon = learn_lexicon(train)
    fitted = staged(dense_features(train, lexicon, True), "toxic-train")
    scored = dense_features(texts, lexicon).select("id", array_to_vector("x").alias("features"))
    part = F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(5))
    rows = fitted.select(F.col("y").cast("double").alias("label"), array_to_vector("x").alias("features"), (part == 0).alias("held")).coalesce(4)
    n = {(r.held, r.label): r["count"] for r in rows.groupBy("held", "label").count().collect()}
    one, zero = (sum(v for (_, y), v in n.items() if y == k) for k in (1, 0))
    if min(n.get((False, 0), 0), n.get((False, 1), 0)) < 3:
        return texts.select("id", F.lit((one + 1.0) / (one + zero + 2.0)).alias("score"))
    trees = GBTClassifier(maxIter=24, maxDepth=3, stepSize=0.25, maxBins=64, seed=7).fit(rows.where("not held"))
    raw = vector_to_array("probability")[1]
    if min(n.get((True, 0), 0), n.get((True, 1), 0)) < 3:  # too few to set aside: calibrate on the rows that the trees have seen
        rows = rows.withColumn("held", F.lit(True))
    curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(trees.transform(rows.where("held")).select(raw.alias("raw"), "label"))
    out = curve.transform(trees.transform(scored).select("id", raw.alias("raw")))
    return out.select("id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "prediction")).alias("score"))
