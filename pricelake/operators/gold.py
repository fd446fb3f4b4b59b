"""Gold: the daily price fact, dimensions and the promotion fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.functions import keys
from pricelake.functions.numbers import exact

GRAIN = ["observation_date", "retailer_id", "store_code", "retailer_product_id"]

#: Display names of retailers.
RETAILER_NAMES = {"winmart": "WinMart", "go": "GO!", "lottemart": "Lotte Mart", "mmvietnam": "MM Mega Market", "bachhoaxanh": "Bach Hoa Xanh"}


def latest_observations(observations: DataFrame) -> DataFrame:
    """Of each date, retailer, store and listing the newest; a quarantined newest removes the grain.

    Ties go to the later normalisation, then to the larger id. Nulls come last. The quality
    filter stays above the choice, so an older good row never stands in.
    """
    order = [F.col(c).desc_nulls_last() for c in ("observed_at", "normalized_at", "observation_id")]
    place = F.row_number().over(Window.partitionBy("observation_date", "retailer_id", "_store", "retailer_product_id").orderBy(*order))
    ranked = observations.withColumn("_store", keys.store_or_unknown(F.col("store_code"))).withColumn("_place", place)
    latest = ranked.filter("_place = 1").withColumn("store_code", F.col("_store")).drop("_place", "_store")
    return latest.filter(F.col("data_quality_status").isNull() | (F.col("data_quality_status") != "quarantined"))


def selection_stats(observations: DataFrame) -> DataFrame:
    """Rows, grains, grains with several rows, and rows that lose, in one pass."""
    store = keys.store_or_unknown(F.col("store_code")).alias("_store")
    groups = observations.groupBy("observation_date", "retailer_id", store, "retailer_product_id").agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("observations"),
        F.count("*").alias("grains"),
        F.count_if(F.col("n") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dropped_rows"),
    )


def unit_price(price: Column, quantity: Column, unit: Column, publishable: Column) -> tuple[Column, Column]:
    """(price per base unit to 6 places, unit); both null unless it may be published."""
    ok = publishable & (price > 0) & (quantity > 0) & (F.coalesce(unit, F.lit("")) != "")
    return F.when(ok, F.round((exact(price) / exact(quantity)).cast("decimal(28,12)"), 6)), F.when(ok, unit)


def price_snapshot(observations: DataFrame, products: DataFrame, mappings: DataFrame | None = None) -> DataFrame:
    """The daily price fact. ``products`` has one row per listing; mappings may repeat."""
    listing = products.select(
        "retailer_product_id", "product_name", "brand", "category_raw", "unit_price_publishable", "package_total_base_quantity", "measurement_base_unit", "measurement_type"
    )
    rows = latest_observations(observations).join(listing, "retailer_product_id")
    if mappings is not None:
        approved = mappings.filter("review_status = 'matched'").groupBy("retailer_id", "retailer_product_id").agg(F.min("canonical_product_id").alias("canonical_product_id"))
        rows = rows.join(approved, ["retailer_id", "retailer_product_id"], "left")
    else:
        rows = rows.withColumn("canonical_product_id", F.lit(None).cast("string"))
    price, unit = unit_price(*[F.col(c) for c in ("current_price", "package_total_base_quantity", "measurement_base_unit", "unit_price_publishable")])
    date = F.col("observation_date").cast("string")
    return rows.select(
        keys.snapshot_key(date, F.col("retailer_id"), F.col("store_code"), F.col("retailer_product_id")).alias("price_snapshot_id"),
        F.regexp_replace(date, "-", "").cast("int").alias("date_key"),
        date.alias("snapshot_date"),
        keys.surrogate("ret", F.col("retailer_id")).alias("retailer_key"),
        keys.surrogate("store", F.col("retailer_id"), F.col("store_code")).alias("store_key"),
        keys.surrogate("retprod", F.col("retailer_id"), F.col("retailer_product_id")).alias("retailer_product_key"),
        F.when(F.col("canonical_product_id").isNotNull(), keys.surrogate("prod", F.col("canonical_product_id"))).alias("product_key"),
        *["retailer_id", "store_code", "retailer_product_id", "canonical_product_id", "observation_id", "observed_at", "product_name", "brand", "category_raw"],
        *["listed_price", "promo_price", "current_price", "discount_amount", "discount_percent", "availability_status", "is_on_promotion", "unit_price_publishable"],
        *["measurement_type", "package_total_base_quantity"],
        price.alias("effective_unit_price"),
        unit.alias("comparison_unit"),
        F.col("data_quality_status").alias("silver_data_quality_status"),
        *["source_run_id", "source_bronze_record_key"],
    )


def missing_products(observations: DataFrame, products: DataFrame) -> DataFrame:
    """Chosen observations without a listing."""
    return latest_observations(observations).join(products, "retailer_product_id", "left_anti")


def dim_retailer(products: DataFrame, observations: DataFrame) -> DataFrame:
    ids = products.select("retailer_id").union(observations.select("retailer_id")).distinct()
    first = products.groupBy("retailer_id").agg(F.min_by("source_run_id", F.struct("source_file", "source_line_number")).alias("source_run_id"))
    names = F.create_map(*[F.lit(x) for pair in RETAILER_NAMES.items() for x in pair])
    return ids.join(first, "retailer_id", "left").select(
        keys.surrogate("ret", F.col("retailer_id")).alias("retailer_key"),
        "retailer_id",
        F.coalesce(F.try_element_at(names, F.col("retailer_id")), F.col("retailer_id")).alias("retailer_name"),
        F.lit(True).alias("is_active"),
        "source_run_id",
    )


def dim_store(observations: DataFrame) -> DataFrame:
    """One row per retailer and store; group and region of its latest observation."""
    newest = F.struct("observed_at", "observation_id")
    rows = observations.withColumn("store_code", keys.store_or_unknown(F.col("store_code")))
    return rows.groupBy("retailer_id", "store_code").agg(
        *[F.max_by(c, newest).alias(c) for c in ("store_group_code", "region")], F.min_by("source_run_id", newest).alias("source_run_id")
    ).select(keys.surrogate("store", F.col("retailer_id"), F.col("store_code")).alias("store_key"), "*", F.lit(True).alias("is_active"))


def dim_date(observations: DataFrame) -> DataFrame:
    day = F.col("observation_date").cast("date")
    return observations.filter(day.isNotNull()).select(day.alias("d")).distinct().select(
        F.date_format("d", "yyyyMMdd").cast("int").alias("date_key"),
        F.col("d").cast("string").alias("calendar_date"),
        F.year("d").alias("year"),
        F.month("d").alias("month"),
        F.day("d").alias("day"),
        (F.weekday("d") + 1).alias("day_of_week"),
        (F.weekday("d") + 1 >= 6).alias("is_weekend"),
    )


def dim_retailer_product(products: DataFrame, mappings: DataFrame) -> DataFrame:
    matched = mappings.filter("review_status = 'matched'").groupBy("retailer_id", "retailer_product_id").agg(F.min("canonical_product_id").alias("canonical_product_id"))
    return products.join(matched, ["retailer_id", "retailer_product_id"], "left").select(
        keys.surrogate("retprod", F.col("retailer_id"), F.col("retailer_product_id")).alias("retailer_product_key"),
        *["retailer_product_id", "canonical_product_id", "retailer_id", "product_name", "barcode", "source_run_id"],
    )


def dim_product(products: DataFrame, mappings: DataFrame) -> DataFrame:
    """A canonical product is shown by its member with a barcode, then by name and retailer."""
    matched = mappings.filter("review_status = 'matched'").select("retailer_id", "retailer_product_id", "canonical_product_id").distinct()
    order = F.struct(F.coalesce("barcode", F.lit("")) == "", F.col("product_name"), F.col("retailer_id"), F.col("retailer_product_id"))
    shown = ["product_name", "brand", "measurement_type", "package_total_base_quantity", "measurement_base_unit", "source_run_id"]
    best = products.join(matched, ["retailer_id", "retailer_product_id"]).groupBy("canonical_product_id").agg(F.min_by(F.struct(*shown), order).alias("m"))
    return best.select(keys.surrogate("prod", F.col("canonical_product_id")).alias("product_key"), "canonical_product_id", "m.*").withColumnRenamed("product_name", "canonical_name")


def dim_promotion(promotions: DataFrame) -> DataFrame:
    return promotions.select(
        keys.surrogate("promo", F.col("promotion_id")).alias("promotion_key"),
        *["promotion_id", "retailer_id", "store_code", "promotion_type", "offer_text_raw", "offer_text_available", "observation_date", "source_run_id"],
    )


def fact_promotion_item(items: DataFrame, promotions: DataFrame) -> DataFrame:
    """Items with their offer's terms; ``quality.orphans`` must give none before it is published."""
    offer = promotions.select("promotion_id", "promotion_type", "listed_price", "promo_price", "current_price", "currency")
    return items.join(offer, "promotion_id").select(
        keys.surrogate("promofact", F.col("promotion_item_id")).alias("promotion_item_fact_id"),
        F.regexp_replace(F.col("observation_date").cast("string"), "-", "").cast("int").alias("date_key"),
        keys.surrogate("promo", F.col("promotion_id")).alias("promotion_key"),
        keys.surrogate("ret", F.col("retailer_id")).alias("retailer_key"),
        keys.surrogate("store", F.col("retailer_id"), F.col("store_code")).alias("store_key"),
        keys.surrogate("retprod", F.col("retailer_id"), F.col("retailer_product_id")).alias("retailer_product_key"),
        *["promotion_id", "retailer_id", "store_code", "retailer_product_id", "promotion_type", "listed_price", "promo_price", "current_price", "currency"],
    )


def publish_status(df: DataFrame, key: str) -> DataFrame:
    """One row: n_rows, n_keys and whether the table may be published, or why not."""
    counts = df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"))
    why = F.when(F.col("n_rows") == 0, "nothing to publish").when(F.col("n_rows") != F.col("n_keys"), "key is repeated or null").otherwise("publishable")
    return counts.withColumn("status", why)


def check_publishable(df: DataFrame, key: str) -> None:
    """Raises unless the table has rows and its key is unique and not null."""
    status = publish_status(df, key).first().status
    if status != "publishable":
        raise ValueError(f"{key}: {status}")
