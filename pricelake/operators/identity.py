"""Cross-retailer product identity: the same barcode, else the same attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions import keys
from pricelake.functions.numbers import valid_gtin
from pricelake.functions.text import identity_text
from pricelake.sources.shared import small_side, staged


def attribute_key() -> Column:
    """Null where every attribute is empty."""
    parts = [identity_text(F.col(c)) for c in ("brand", "product_name", "measurement_type")]
    parts += [keys.part(F.col("measurement_base_quantity"), numeric=True), identity_text(F.col("measurement_base_unit")), keys.part(F.col("selling_unit_count"), numeric=True)]
    key = F.concat_ws("|", *parts)
    return F.when(F.regexp_replace(key, r"\|", "") != "", key)


def _shared(products: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that stand at more than one retailer; aggregated before any join."""
    return products.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("retailer_id").alias("low"), F.max("retailer_id").alias("high")).filter("low <> high").select(key, F.lit(True).alias(f"{key}_shared"))


def _with_shared(rows: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """``rows`` with whether their key is shared; rows without a key meet in no join."""
    shared = small_side(staged(_shared(keyed, key), "identity-shared"))
    met = rows.filter(F.col(key).isNotNull()).join(shared, key, "left")
    return met.unionByName(rows.filter(F.col(key).isNull()).withColumn(f"{key}_shared", F.lit(None).cast("boolean")))


def map_products(products: DataFrame) -> DataFrame:
    """One mapping row per listing. A barcode match outranks an attribute match, and rows that
    a barcode already matches still count as evidence for attributes. The keys are made once, in
    a staged table; only values that several retailers share are joined back."""
    keyed = products.select("retailer_product_id", "retailer_id", valid_gtin(F.col("barcode")).alias("gtin"), attribute_key().alias("attributes"))
    keyed = staged(keyed, "identity-keys")
    rows = _with_shared(_with_shared(keyed, keyed, "gtin"), keyed, "attributes")
    method = F.when(F.col("gtin_shared"), "barcode_exact").when(F.col("attributes_shared"), "attributes_exact").otherwise("none")
    matched = F.col("match_method") != "none"
    return rows.withColumn("match_method", method).select(
        keys.identity_key(F.lit("mapping"), F.col("retailer_product_id")).alias("mapping_id"),
        *["retailer_product_id", "retailer_id"],
        F.when(matched, keys.identity_key(F.col("match_method"), F.when(F.col("match_method") == "barcode_exact", F.col("gtin")).otherwise(F.col("attributes")))).alias("canonical_product_id"),
        "match_method",
        F.when(matched, 100).otherwise(0).alias("match_score"),
        F.when(F.col("match_method") == "barcode_exact", "high").when(matched, "medium").otherwise("none").alias("match_confidence"),
        F.when(matched, "matched").otherwise("unmatched").alias("review_status"),
    )
