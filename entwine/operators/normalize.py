"""Clean records: ten string columns for each entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

CLEAN = ("entity_id", "original_name", "normalized_name", "clean_name_no_suffix", "original_address", "normalized_address", "postal_code", "address_digits", "original_country", "normalized_country")


def clean_records(entities: DataFrame, *keep: str) -> DataFrame:
    """entities (entity_id, business_name, business_address, country) as clean records; columns in keep stay."""
    first = entities.select(
        *keep,
        F.trim(T.present(F.col("entity_id"))).alias("entity_id"),
        F.trim(T.present(F.col("business_name"))).alias("original_name"),
        T.name(F.col("business_name")).alias("normalized_name"),
        F.trim(T.present(F.col("business_address"))).alias("original_address"),
        T.address(F.col("business_address")).alias("normalized_address"),
        T.postal_code(F.col("business_address")).alias("postal_code"),
        T.digit_runs(F.col("business_address")).alias("address_digits"),
        F.trim(T.present(F.col("country"))).alias("original_country"),
        T.country(F.col("country")).alias("normalized_country"),
    )
    return first.withColumn("clean_name_no_suffix", T.without_suffix(F.col("normalized_name"))).select(*keep, *CLEAN)
