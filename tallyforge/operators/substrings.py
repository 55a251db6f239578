"""Which patterns stand inside which texts, for many of both: an inverted index of character runs instead of a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..materialize import written

#: Characters by which the places of texts are told where a run of the index may begin; shorter runs are their own heads.
GRAM = 3
#: Patterns up to so many characters are filed as a whole, longer ones under a run of so many.
RUN = 12
#: Indexes and tables of heads up to so many rows are broadcast.
SMALL = 10_000


def _pieces(text: Column, size: int, whole: bool) -> Column:
    """The runs of ``size`` characters of a text, in order; with ``whole``, also the shorter ones at its end. Linear in the
    text: it is cut into characters once."""
    last = F.length(text) - (0 if whole else size - 1)
    cut = lambda chars: F.transform(F.sequence(F.lit(1), last), lambda at: F.array_join(F.slice(chars, at, size), ""))
    return F.when(last >= 1, F.flatten(F.transform(F.array(F.split(text, "")), cut))).otherwise(F.array().cast("array<string>"))


def windows(texts: list[Column], size: int = RUN) -> Column:
    """The distinct runs that begin at any place of any of the texts, of ``size`` characters or up to the text's end, and the
    empty one."""
    return F.array_distinct(F.concat(F.array(F.lit("")), *[F.coalesce(_pieces(t, size, True), F.array().cast("array<string>")) for t in texts]))


def _rarest_runs(keys: DataFrame, texts: list[str], long: DataFrame, size: int, most: int) -> DataFrame:
    """(_p, _run): each pattern, all of them longer than ``most``, with ``most`` of its characters around the run of ``size``
    that the fewest keys hold. Patterns of which no key holds some run are left out: no key holds them."""
    places = long.select("_p", F.posexplode(_pieces(F.col("_p"), size, False)).alias("_at", "_gram"))
    grams = keys.select(F.explode(F.array_distinct(F.concat(*[F.coalesce(_pieces(F.col(t), size, False), F.array().cast("array<string>")) for t in texts]))).alias("_gram"))
    held = grams.join(places.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count("*").alias("_n"))
    found = places.join(held, "_gram", "left").groupBy("_p").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_at")).alias("_r")).where("_r.n > 0")
    return found.select("_p", F.substring("_p", F.least(F.col("_r._at"), F.length("_p") - most) + 1, F.lit(most)).alias("_run"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def candidates(keys: DataFrame, rules: DataFrame, within: list[tuple[list[str], Column]], size: int = GRAM, most: int = RUN) -> DataFrame:
    """``keys`` joined to every rule that can match: for one of the pairs (text columns, pattern) of ``within``, the pattern is
    inside one of the texts. Rules that can't match any key are left out; a pair may come more than once.

    A pattern of up to ``most`` characters is filed as it is, so keys meet it only where they hold it. A longer one is filed
    under a part of it, around the run of ``size`` characters that the fewest keys hold. The keys look up the parts that begin
    at their places: in the lengths that occur among those of the same first characters. All joins are by equality; what is
    shuffled is the numbers of keys with such parts, or nothing where the index is small. A null pattern is never inside a
    text, an empty one always.
    """
    texts = sorted({t for ts, _ in within for t in ts})
    keyed = written(keys.withColumn("_key", F.monotonically_increasing_id()), "keys")
    rows = written(rules.withColumn("_pattern", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), p.alias("p")) for i, (_, p) in enumerate(within)]))).where("_pattern.p is not null"), "patterns")
    is_long = F.length("_pattern.p") > most
    index = rows.where(~is_long).withColumn("_run", F.col("_pattern.p"))
    long = rows.where(is_long)
    if long.limit(1).count():
        runs = _rarest_runs(keyed, texts, long.select(F.col("_pattern.p").alias("_p")).distinct(), size, most)
        index = written(index.unionByName(long.join(runs, F.col("_pattern.p") == F.col("_p")).drop("_p")), "index")
    heads = written(index.select("_run").distinct().groupBy(F.left("_run", F.lit(size)).alias("_head")).agg(F.collect_set(F.length("_run")).alias("_sizes")), "heads")
    small = _small(index)
    found = F.explode(windows([F.col(t) for t in texts], most)).alias("_window")
    places = keyed.select("*" if small is not index else "_key", found)
    sizes = [r.n for r in heads.select(F.length("_head").alias("n")).distinct().collect()]
    at = F.filter(F.array(*[F.when(F.length("_window") >= n, F.left("_window", F.lit(n))) for n in sizes]), lambda h: h.isNotNull())
    held = places.withColumn("_head", F.explode(at)).join(_small(heads), "_head").withColumn("_size", F.explode("_sizes")).where(F.length("_window") >= F.col("_size"))
    met = held.withColumn("_run", F.left("_window", F.col("_size"))).drop("_window", "_head", "_sizes", "_size").join(small, "_run")
    if small is index:
        met = met.join(keyed, "_key")
    inside = F.lit(False)
    for i, (ts, _) in enumerate(within):
        for t in ts:
            inside = inside | ((F.col("_pattern.i") == i) & F.contains(F.col(t), F.col("_pattern.p")))
    return met.where(F.coalesce(inside, F.lit(False))).drop("_key", "_run", "_pattern")
