"""First-match rules: one generic join, and the lookups made of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import compact_key, has_word, or_null, strip
from ..materialize import written
from . import substrings

#: Rule tables up to this many rows are broadcast; of larger ones, candidates are found by their character runs.
BROADCAST_RULES = 10_000

#: Of more rules, so many of the lowest prio are looked up before the others.
FIRST_RULES = 10_000

#: Pairs (text columns, pattern): what a condition says of a key implies that one of the patterns is inside one of its texts.
Within = list[tuple[list[str], Column]]


def _won(keys: DataFrame, rules: DataFrame, matches: Callable[[], Column], outputs: list[str], prio: str, within: Within | None, most: int | None, reads: list[str] | None) -> DataFrame:
    """(keys..., _won): the first rule of each distinct key that one matches. Few rules meet every key; many are looked up, if
    ``within`` tells how."""
    most = BROADCAST_RULES if most is None else most
    first = F.min(F.struct(prio, *outputs)).alias("_won")
    if rules.limit(most + 1).count() <= most:
        return keys.join(F.broadcast(rules), matches()).groupBy(*keys.columns).agg(first)
    if within is None:
        return keys.join(rules, matches()).groupBy(*keys.columns).agg(first)
    if reads is not None:
        folded = rules.groupBy(*reads).agg(first)
        rules = folded.select(*[c for c in reads if c not in (prio, *outputs)], "_won.*")
    look_up = lambda keys, rules: substrings.candidates(keys, rules, within).where(matches()).groupBy(*keys.columns).agg(first)
    rules = written(rules, "rules")
    cut = rules.select(prio).orderBy(prio).offset(FIRST_RULES).limit(1).collect()
    if not cut or cut[0][0] is None:
        return look_up(keys, rules)
    early = F.col(prio).isNull() | (F.col(prio) < F.lit(cut[0][0]))
    keys = written(keys, "distinct-keys")
    done = written(look_up(keys, rules.where(early)), "first-won")
    held = done.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys.columns)])
    left = written(keys.join(held, _same(keys, held, keys.columns), "left_anti"), "keys-left")
    return done.unionByName(look_up(left, rules.where(~early))) if left.limit(1).count() else done


def _same(df: DataFrame, side: DataFrame, keys: list[str]) -> Column:
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(side[f"_k{i}"])
    return same


def first_match_join(df: DataFrame, keys: list[str], rules: DataFrame, matches: Callable[[], Column], outputs: list[str], prio: str = "prio", within: Within | None = None, most: int | None = None, reads: list[str] | None = None) -> DataFrame:
    """``df`` with the outputs of the first rule (lowest prio) that matches, null where none does.

    ``matches`` is a condition over the key columns and the rule columns. Only distinct keys meet the rules, one aggregate
    finds the first, and one equality join brings its outputs back, so long tables see no theta join; of rules equal in prio
    one wins. Rule columns must not be named like the keys. Null keys match what the condition says for null.

    More than ``most`` rules (``BROADCAST_RULES``) are not compared with every key: with ``within`` they are found through an
    index of character runs (see ``substrings.candidates``) and then held against the condition. The ``FIRST_RULES`` of the
    lowest prio are looked up before the others, which then meet only keys that none of them matches. ``reads`` names the
    rule columns that the condition reads: of rules equal in them only the first is looked up.
    """
    won = _won(df.select(*keys).distinct(), rules, matches, outputs, prio, within, most, reads)
    side = won.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(f"_won.{o}").alias(o) for o in outputs])
    return df.join(side, _same(df, side, keys), "left").drop(*[f"_k{i}" for i in range(len(keys))])


def first_match_on_keys(keys: DataFrame, rules: DataFrame, matches: Callable[[], Column], outputs: list[str], prio: str = "prio", within: Within | None = None, most: int | None = None) -> DataFrame:
    """J12 for a table of distinct keys: it meets the rules as it is, so a chain of lookups stays one linear plan."""
    few = BROADCAST_RULES if most is None else most
    found = F.min(F.when(F.col(prio).isNotNull(), F.struct(prio, *outputs))).alias("_won")
    small = rules.limit(few + 1).count() <= few
    if small or within is None:
        looked_up = keys.join(F.broadcast(rules) if small else rules, matches(), "left")
        return looked_up.groupBy(*keys.columns).agg(found).select(*keys.columns, *[F.col(f"_won.{o}").alias(o) for o in outputs])
    keys = written(keys, "distinct-keys")
    won = _won(keys, rules.where(F.col(prio).isNotNull()), matches, outputs, prio, within, few, None)
    every = won.unionByName(keys, allowMissingColumns=True).groupBy(*keys.columns).agg(F.min("_won").alias("_won"))  # (a minimum passes over nulls)
    return every.select(*keys.columns, *[F.col(f"_won.{o}").alias(o) for o in outputs])


Lookup = Callable[..., DataFrame]


def on_keys(df: DataFrame, keys: list[str], rules: DataFrame, matches: Callable[[], Column], outputs: list[str], within: Within | None = None) -> DataFrame:
    """``first_match_on_keys`` in the form of ``first_match_join``."""
    return first_match_on_keys(df, rules, matches, outputs, within=within)


def translate_brand(df: DataFrame, brand: str, names: DataFrame, out: str = "brand_en", lookup: Lookup = first_match_join) -> DataFrame:
    """The English name of the first Chinese name inside the brand text."""
    rules = names.select("prio", "zh", F.col("en").alias(out))
    return lookup(df, [brand], rules, lambda: F.col(brand).contains(F.col("zh")), [out], within=[([brand], F.col("zh"))])


def model_in_brand(df: DataFrame, brand: str, models: DataFrame, lookup: Lookup = first_match_join) -> DataFrame:
    """mapped_brand, mapped_model of the first raw model that stands as a whole word in the brand text."""
    rules = models.where(F.length("raw_model") >= 2).select("prio", "raw_model", F.col("brand").alias("mapped_brand"), F.col("model").alias("mapped_model"))
    lowered = df.withColumn("_lowered", F.lower(F.col(brand)))
    keys = [brand, "_lowered"]
    return lookup(lowered, keys, rules, lambda: has_word(F.col("_lowered"), F.col("raw_model")), ["mapped_brand", "mapped_model"], within=[(["_lowered"], F.col("raw_model"))]).drop("_lowered")


def resolve_code(df: DataFrame, code: str, prefixes: DataFrame, out: str = "code_name", lookup: Lookup = first_match_join) -> DataFrame:
    """The name of the first code prefix (or exact code) of a model code."""
    c = F.upper(strip(F.col(code)))
    rules = prefixes.select("prio", "kind", F.col("code").alias("_prefix"), F.col("name").alias(out))
    hit = lambda: ((F.col("kind") == "prefix") & F.col("_c").startswith(F.col("_prefix"))) | ((F.col("kind") == "equals") & (F.col("_c") == F.col("_prefix")))
    coded = df.withColumn("_c", c)
    return lookup(coded, [code, "_c"], rules, hit, [out], within=[(["_c"], F.col("_prefix"))]).drop("_c")


def canonical_place_join(df: DataFrame, key: str, places: DataFrame, out: str = "place") -> DataFrame:
    """C27 with a rule table: ``key`` is the text after ``functions.location.place_key``."""
    rules = places.select("prio", F.col("key").alias("_place_key"), F.col("canonical").alias(out))
    found = first_match_join(df, [key], rules, lambda: F.col(key).contains(F.col("_place_key")), [out], within=[([key], F.col("_place_key"))])
    return found.withColumn(out, F.coalesce(out, key))


def map_headers(df: DataFrame, header: str, rules: DataFrame, out: str = "field") -> DataFrame:
    """B1: the field of a header cell; null for blank, ignored and summary cells."""
    h = F.lower(or_null(F.col(header)))
    skip = h.isin(*fixed.HEADER_IGNORED) | h.rlike("|".join(fixed.SUMMARY_WORDS))
    marked = df.withColumn("_header", F.when(~skip, h))
    table = rules.select("prio", "kind", F.col("pattern").alias("_pattern"), F.col("field").alias(out))
    hit = lambda: ((F.col("kind") == "equals") & (F.col("_header") == F.col("_pattern"))) | ((F.col("kind") == "contains") & F.col("_header").contains(F.col("_pattern")))
    return first_match_join(marked, ["_header"], table, hit, [out], within=[(["_header"], F.col("_pattern"))]).drop("_header")


def with_valid_brand(df: DataFrame, brand: str, valid: DataFrame) -> DataFrame:
    """Rows whose brand is in the valid set."""
    return df.join(valid.select(F.col("brand").alias(brand)), brand, "left_semi")


def family_keys(models: DataFrame) -> DataFrame:
    """(brand_key, keys): compact model keys, raw and mapped, for each compact brand key."""
    both = models.select(
        F.array_distinct(F.array(compact_key(F.col("raw_brand")), compact_key(F.col("brand")))).alias("bs"),
        F.filter(F.array("raw_model", "model"), lambda m: F.length(F.trim(m)) >= 2).alias("ms"),
    )
    pairs = both.select(F.explode("bs").alias("brand_key"), "ms").select("brand_key", F.explode("ms").alias("m"))
    return pairs.where("brand_key <> ''").groupBy("brand_key").agg(F.array_sort(F.collect_set(compact_key(F.col("m")))).alias("keys"))


def lookup_with_fallback(df: DataFrame, dimension: DataFrame, brand: str, model: str, out: str = "model_id") -> DataFrame:
    """The id of (brand, model) in lower case, else of the model alone (dimension rows with brand '')."""
    b, m = F.lower(strip(F.coalesce(F.col(brand), F.lit("")))), F.lower(strip(F.col(model)))
    exact = dimension.select(F.col("brand").alias("_b1"), F.col("model").alias("_m1"), F.col("id").alias("_id1"))
    loose = dimension.where("brand = ''").select(F.col("model").alias("_m2"), F.col("id").alias("_id2"))
    keyed = df.withColumn("_b", b).withColumn("_m", m)
    joined = keyed.join(exact, (F.col("_b") == F.col("_b1")) & (F.col("_m") == F.col("_m1")), "left").join(loose, F.col("_m") == F.col("_m2"), "left")
    return joined.withColumn(out, F.coalesce("_id1", "_id2")).drop("_b", "_m", "_b1", "_m1", "_id1", "_m2", "_id2")


def lookup_by_containment(df: DataFrame, dimension: DataFrame, model_id: str, variant: str, out: str = "variant_id") -> DataFrame:
    """The id of (model_id, variant), else the first entry (by prio) of that model where either text contains the other."""
    v = F.lower(strip(F.coalesce(F.col(variant), F.lit(""))))
    keyed = df.withColumn("_v", v)
    rules = dimension.select(F.col("prio"), F.col("model_id").alias("_model_id"), F.col("variant").alias("_variant"), F.col("id").alias(out))
    same = F.col(model_id) == F.col("_model_id")
    close = F.col("_v").contains(F.col("_variant")) | F.col("_variant").contains(F.col("_v"))
    ranked = rules.withColumn("prio", F.col("prio").cast("long"))
    exact = ranked.withColumn("prio", F.col("prio") - F.lit(1 << 40)).withColumn("_exact", F.lit(True)).unionByName(ranked.withColumn("_exact", F.lit(False)))
    hit = lambda: same & F.when(F.col("_exact"), F.col("_v") == F.col("_variant")).otherwise(close)
    return first_match_join(keyed, [model_id, "_v"], exact, hit, [out]).drop("_v")
