"""Staging models (M-01, M-02): rename, cast, basic quality filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_products(bronze: DataFrame) -> DataFrame:
    """M-01: landed product records -> snake_case staging rows.

    The reference unions one scan per store; over one Hive-partitioned table that
    is a single scan (``supermarket`` is a partition column), see SET-01.
    """
    return (bronze
            .where(F.col("productId").isNotNull())
            .select(
                F.col("productId").alias("product_id"),
                F.col("productName").alias("product_name"),
                "brand",
                F.col("link").alias("product_url"),
                "items",
                "supermarket",
                "region",
                F.col("_metadata_postal_code").alias("postal_code"),
                F.col("_metadata_hub_id").alias("hub_id"),
                F.col("_metadata_run_id").alias("run_id"),
                F.col("_metadata_scraped_at").cast("timestamp").alias("scraped_at"),
            ))


def stg_reference_products(ref: DataFrame) -> DataFrame:
    """M-02: barcode reference records, trimmed; only valid barcode lengths."""
    return (ref
            .where(F.col("code").isNotNull() & F.length("code").isin(8, 13, 14))
            .select(
                F.col("code").alias("ean_code"),
                F.trim("product_name").alias("product_name"),
                F.trim("brands").alias("brands"),
                "categories", "quantity", "countries",
                F.lower("nutriscore_grade").alias("nutriscore_grade"),
                "ingredients_text", "allergens", "labels", "packaging", "image_url",
                F.col("_metadata_run_id").alias("run_id"),
                F.col("_metadata_scraped_at").cast("timestamp").alias("scraped_at"),
            ))
