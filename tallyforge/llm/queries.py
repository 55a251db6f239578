"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embeddings, fim, licenses, lines, lm, mixing, quality, resample, secrets, simhash, toxicity, urls
from .shared import held_out, read_table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return out.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint("fp").alias("fingerprint"), F.col("component").alias("component_id"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return _decided(scores, toxicity.FOLDS, 0.5)


def _decided(scores: DataFrame, folds: int, threshold: float) -> DataFrame:
    return scores.select(F.col("id").alias("doc_id"), held_out("id", folds).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", licenses.document_path().alias("path"))
    return licenses.scan_licences(docs, "path").select("doc_id", "path", "licence", "licence_score", "licence_from")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs).select("doc_id", "n_lines", "n_dropped", "text")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return _decided(scores, quality.FOLDS, quality.THRESHOLD)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = secrets.scan_all(docs)
    of = lambda kind: F.coalesce(F.size(F.filter("spans", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return out.select(
        F.col("id").alias("doc_id"),
        *[F.when(F.col("spans").isNull(), F.lit(0)).otherwise(of(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embeddings.near_vectors(read_table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, read_table(spark, sf_dir, "benchmark"))
    items = decontaminate.item_list(F.col("matches"))
    # (array_join leaves a null item out)
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.words_hit(F.col("matches")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample.importance_resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is the quality of the document of its number."""
    quality_ = F.col("quality")
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.when(quality_ == 1, "allow").when(quality_ == 0, "block").alias("label"))
    return urls.filter_urls(read_table(spark, sf_dir, "pages"), labels).withColumnRenamed("id", "page_id")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fim.restore(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_license_scan": op3_license_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_mix_sources": op5_mix_sources,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality": op7_quality,
    "op8_secret_scan": op8_secret_scan,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_url_filter": op12_url_filter,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op3_license_scan": licenses.SQL,
    "op4_line_dedup": lines.SQL,
    "op5_mix_sources": mixing.SQL,
    "op8_secret_scan": secrets.SQL,
    "op9_embedding_near_dedup": embeddings.SQL,
    "op10_benchmark_decontamination": decontaminate.SQL,
    "op11_importance_resampling": resample.SQL,
    "op12_url_filter": urls.SQL,
    "op13_fill_in_middle": fim.SQL,
}
