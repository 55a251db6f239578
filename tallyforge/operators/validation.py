"""Checks on rows and on extraction responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.state import in_domain

DOMAINS = {"steering_setup": fixed.STEERING, "version_type": fixed.VERSIONS, "status_vehicle": fixed.STATUSES}


def enum_violations(rows: DataFrame, domains: dict[str, tuple[str, ...]] = DOMAINS) -> DataFrame:
    """V3: with violations: the names of columns whose value is outside its domain."""
    bad = F.array_compact(F.array(*[F.when(~in_domain(F.col(c), allowed), F.lit(c)) for c, allowed in domains.items()]))
    return rows.withColumn("violations", bad)


def check_responses(attempts: DataFrame, max_attempts: int = 3) -> DataFrame:
    """V4: (doc_id, attempt, payload, feedback) of response envelopes: the inner JSON, and why it is not valid (null: valid).

    An empty candidate list is accepted on the last attempt only; a quantity that is an object never is.
    """
    text = F.get_json_object("response", "$.candidates[0].content.parts[0].text")
    parsed = F.try_parse_json(text)
    items = F.get_json_object(text, "$.candidates")
    quantities = F.from_json(items, "array<struct<stockQuantity:string>>")
    is_object = F.exists(quantities, lambda c: F.coalesce(c["stockQuantity"].startswith("{"), F.lit(False)))
    empty = F.coalesce(F.size(quantities) == 0, F.lit(False)) | (items == "[]")
    feedback = (
        F.when(text.isNull(), "no content")
        .when(parsed.isNull(), "Validation Error: not JSON")
        .when(items.isNull(), "no candidates")
        .when(empty & (F.col("attempt") < max_attempts), "Validation Error: empty candidates array")
        .when(F.coalesce(is_object, F.lit(False)), "Validation Error: stockQuantity must be integer or null")
    )
    return attempts.select("doc_id", "attempt", text.alias("payload"), feedback.alias("feedback"))


def first_valid(checked: DataFrame, max_attempts: int = 3) -> DataFrame:
    """V5: one row per document: the first valid attempt, or a review row."""
    tried = checked.where(F.col("attempt") <= max_attempts).withColumn("valid", F.col("feedback").isNull())
    best = tried.where("valid").withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("attempt"))).where("n = 1").select("doc_id", "attempt", "payload")
    docs = checked.select("doc_id").distinct()
    out = docs.join(best, "doc_id", "left")
    return out.withColumn("needs_human_review", F.col("attempt").isNull()).withColumn("review_reason", F.when(F.col("attempt").isNull(), "Pydantic validation failed after retries"))


def parse_payload(payloads: DataFrame) -> DataFrame:
    """The candidates of valid payloads as rows of the extraction schema."""
    fields = "brand string, modelName string, variant string, trimConfig string, exteriorColor string, interiorColor string, priceExw double, priceFob double, priceFca double, supplierPriceCny double, officialSuggestedPriceCny double, stockQuantity bigint, location string, steering string, vinStatus string, notes string"
    parsed = F.from_json("payload", f"candidates array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>")
    return payloads.where("payload is not null").select("doc_id", F.explode(parsed["candidates"]).alias("c")).select("doc_id", "c.*")
