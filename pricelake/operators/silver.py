"""Silver: products and price observations out of Bronze envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions import keys
from pricelake.functions.numbers import exact, rounded, valid_gtin
from pricelake.functions.package import PACKAGE_COLUMNS, with_package
from pricelake.functions.text import first_non_empty, trimmed
from pricelake.operators.bronze import text_at
from pricelake.operators.dedupe import dedupe


def select_datasets(bronze: DataFrame) -> DataFrame:
    """Of each run the best datasets only: products_enriched, products, *_promotions_*, any."""
    name = F.col("source_dataset")
    rank = F.when(name == "products_enriched", 1).when(name == "products", 2).when(name.contains("_promotions_"), 3).otherwise(4)
    ranked = bronze.withColumn("_rank", rank)
    best = ranked.groupBy("run_id").agg(F.min("_rank").alias("_rank"))  # a row for each run, combined before the shuffle
    return ranked.join(best.withColumnRenamed("run_id", "_run"), F.col("run_id").eqNullSafe(F.col("_run")) & (ranked["_rank"] == best["_rank"]), "left_semi").drop("_rank")


def number_at(payload: Column, field: str) -> Column:
    """A JSON number; null for text, objects and missing fields."""
    kind = F.schema_of_variant(F.variant_get(payload, f"$.{field}", "variant"))
    return F.when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT)"), F.try_variant_get(payload, f"$.{field}", "double"))


def flag_at(payload: Column, field: str) -> Column:
    """Truthiness of a field; null and absent are false."""
    return F.coalesce(~text_at(payload, field).isin("", "0", "false"), F.lit(False))


def skip_reason(payload: Column, status: Column) -> Column:
    """Why a row of the chosen datasets gives no observation; null if it does."""
    price = F.variant_get(payload, "$.current_price", "variant")
    return F.when(status == "QUARANTINE", "quarantine").when(price.isNull() | F.is_variant_null(price), "missing_current_price")


def _leaf_and_path(payload: Column) -> tuple[Column, Column]:
    """Category leaf and path: the first usable of three fields; text is a path of one."""

    def one(field: str) -> Column:
        value = F.variant_get(payload, f"$.{field}", "variant")
        listed = F.try_variant_get(payload, f"$.{field}", "array<string>")
        clean = F.filter(F.transform(listed, trimmed), lambda x: x != "")
        text = F.nullif(trimmed(text_at(payload, field)), F.lit(""))
        path = F.when(F.schema_of_variant(value) == "STRING", F.when(text.isNotNull(), F.array(text))).otherwise(F.when(F.size(clean) > 0, clean))
        return path

    path = F.coalesce(one("source_category_name"), one("category_raw"), one("raw_product.categoryName"))
    return F.element_at(path, -1), path


def with_listing(bronze: DataFrame) -> DataFrame:
    """Records that give an observation, with their listing's key and package."""
    p = F.col("raw_payload")
    t = lambda f: text_at(p, f)
    source_id = first_non_empty(t("item_no"), t("raw_product.itemNo"), t("source_product_id"), t("raw_product.id"))
    sku = first_non_empty(t("raw_product.sku"), t("sku"))
    uom = first_non_empty(t("unit_raw"), t("raw_product.uom"), t("raw_product.uomName"))
    unit = first_non_empty(t("unit_raw"), t("raw_product.uomName"), t("raw_product.uom"))
    rows = bronze.filter(skip_reason(p, F.col("quality_status")).isNull()).select(
        "*",
        source_id.alias("source_product_id"),
        keys.listing_key(F.col("retailer_id"), source_id, sku, uom).alias("retailer_product_id"),
    )
    return with_package(rows, first_non_empty(t("product_name_raw"), t("raw_product.name")), t("package_size_raw"), unit)


def products(bronze: DataFrame, normalized_at: str) -> DataFrame:
    """One row per valid record; ``latest_products`` keeps one per listing."""
    p = F.col("raw_payload")
    t = lambda f: text_at(p, f)
    own, from_sku = valid_gtin(t("raw_product.barcode")), valid_gtin(first_non_empty(t("raw_product.sku"), t("sku")))
    leaf, path = _leaf_and_path(p)
    images = [t(f) for f in ("image_url", "image", "thumbnail_url", "thumbnail")] + [t(f"raw_product.{f}") for f in ("image_url", "image", "mediaUrl", "thumbnail_url", "thumbnail")]
    urls = [t("product_url"), t("url"), t("raw_product.product_url"), t("raw_product.url"), t("source_url")]
    return with_listing(bronze).select(
        "retailer_product_id",
        "retailer_id",
        "source_product_id",
        first_non_empty(t("item_no"), t("raw_product.itemNo")).alias("item_no"),
        t("raw_product.sku").alias("sku"),
        F.coalesce(own, from_sku).alias("barcode"),
        F.when(own.isNotNull(), "source_barcode").when(from_sku.isNotNull(), "sku_gtin_checksum").alias("barcode_source"),
        first_non_empty(t("product_name_raw"), t("raw_product.name"), t("raw_product.description")).alias("product_name"),
        first_non_empty(t("brand_raw"), t("raw_product.brandName")).alias("brand"),
        leaf.alias("category_raw"),
        path.alias("category_path_raw"),
        first_non_empty(*images).alias("image_url"),
        first_non_empty(*urls).alias("source_url"),
        F.col("run_id").alias("source_run_id"),
        F.col("bronze_record_key").alias("source_bronze_record_key"),
        "source_file",
        "source_line_number",
        F.col("observed_at").alias("first_seen_at"),
        F.col("observed_at").alias("last_seen_at"),
        F.lit(True).alias("is_active"),
        F.lit(normalized_at).alias("normalized_at"),
        *PACKAGE_COLUMNS,
    )


def latest_products(rows: DataFrame) -> DataFrame:
    """The last record of each listing in (file, line) order."""
    return dedupe(rows, ["retailer_product_id"], [F.col("source_file"), F.col("source_line_number")], keep="last")


def discount(current: Column, listed: Column) -> tuple[Column, Column]:
    """(amount, percent to 4 places); both null unless the listed price is positive."""
    amount = F.when((listed > 0) & current.isNotNull(), F.greatest(exact(listed) - exact(current), F.lit(0).cast("decimal(28,12)")))
    return amount, rounded(amount.cast("double") / listed * 100, 4)


def availability(stock: Column) -> Column:
    return F.when(stock > 0, "in_stock").when(stock <= 0, "out_of_stock").otherwise("unknown")


def row_quality(bronze_status: Column, parse_status: Column) -> Column:
    return (
        F.when(bronze_status == "QUARANTINE", "quarantined")
        .when((bronze_status == "WARN") | parse_status.isin("parse_failed", "selling_unit_fallback"), "warning")
        .otherwise("valid")
    )


def observations(bronze: DataFrame, normalized_at: str) -> DataFrame:
    """One price observation per valid record."""
    p = F.col("raw_payload")
    current, listed = number_at(p, "current_price"), number_at(p, "listed_price")
    amount, percent = discount(current, listed)
    cut, mechanic = flag_at(p, "is_price_discount"), flag_at(p, "has_promo_mechanic")
    observed = first_non_empty(F.col("observed_at"), text_at(p, "crawled_at"), F.col("ingested_at"))
    return with_listing(bronze).select(
        keys.observation_key(F.col("retailer_product_id"), F.col("store_code"), observed, F.col("bronze_record_key")).alias("observation_id"),
        "retailer_product_id",
        "retailer_id",
        "store_code",
        observed.alias("observed_at"),
        F.substring(observed, 1, 10).alias("observation_date"),
        listed.alias("listed_price"),
        number_at(p, "promo_price").alias("promo_price"),
        current.alias("current_price"),
        F.coalesce(F.nullif(text_at(p, "currency"), F.lit("")), F.lit("VND")).alias("currency"),
        amount.alias("discount_amount"),
        percent.alias("discount_percent"),
        availability(number_at(p, "stock_quantity")).alias("availability_status"),
        cut.alias("is_price_discount"),
        mechanic.alias("has_promo_mechanic"),
        (flag_at(p, "is_on_promotion") | cut | mechanic).alias("is_on_promotion"),
        F.col("run_id").alias("source_run_id"),
        F.col("bronze_record_key").alias("source_bronze_record_key"),
        row_quality(F.col("quality_status"), F.col("package_parse_status")).alias("data_quality_status"),
        F.lit(normalized_at).alias("normalized_at"),
    )


def skip_counts(bronze: DataFrame) -> DataFrame:
    reason = F.coalesce(skip_reason(F.col("raw_payload"), F.col("quality_status")), F.lit("kept"))
    return bronze.groupBy(reason.alias("skip_reason")).agg(F.count("*").alias("records"))
