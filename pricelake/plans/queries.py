"""Queries over the given tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import keys, numbers, text
from pricelake.functions.package import selling_unit
from pricelake.operators import bronze, entities, gold, identity, quality, reconcile, serving, silver, taxonomy
from pricelake.plans import views
from pricelake.plans.views import with_views

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison between engines."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


def fact(spark: SparkSession, sf_dir: str, mapped: bool = False) -> DataFrame:
    mappings = identity.map_products(views.listings_x(spark, sf_dir)) if mapped else None
    return gold.price_snapshot(views.dealt_observations(spark, sf_dir), views.listings(spark, sf_dir), mappings)


FACT_COLUMNS = ["price_snapshot_id", "date_key", "snapshot_date", "retailer_id", "store_code", "retailer_product_id", "observation_id", "product_name", "listed_price", "current_price", "effective_unit_price", "comparison_unit"]
FACT = "obs latest listing fact"


@query(with_views(FACT, f"SELECT {', '.join(FACT_COLUMNS)} FROM fact"))
def price_snapshot_daily(spark, sf_dir):
    """Flagship: latest valid price of every listing, store and date, with unit prices."""
    return doubles(fact(spark, sf_dir).select(FACT_COLUMNS))


@query(with_views("obs latest", "SELECT observation_date, retailer_id, store_code, retailer_product_id, observation_id FROM latest"))
def latest_observation(spark, sf_dir):
    return gold.latest_observations(views.observations(spark, sf_dir)).select("observation_date", "retailer_id", "store_code", "retailer_product_id", "observation_id")


@query(with_views("obs", """SELECT CAST(sum(n) AS BIGINT) AS observations, count(*) AS grains, CAST(count(*) FILTER (n > 1) AS BIGINT) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS dropped_rows
FROM (SELECT count(*) AS n FROM obs GROUP BY observation_date, retailer_id, coalesce(store_code, 'unknown_store'), retailer_product_id)"""))
def selection_stats(spark, sf_dir):
    return gold.selection_stats(views.observations(spark, sf_dir))


@query(with_views("obs latest listing listing_x keyed mapped", """SELECT observation_id,
  CASE WHEN match_method = 'barcode_exact' THEN 'prod_' || left(sha256('barcode_exact|' || gtin), 24)
       WHEN match_method = 'attributes_exact' THEN 'prod_' || left(sha256('attributes_exact|' || akey), 24) END AS canonical_product_id
FROM (SELECT * REPLACE (CASE retailer_id WHEN 'view' THEN 'r0' WHEN 'click' THEN 'r1' ELSE 'r2' END AS retailer_id) FROM latest) o JOIN listing l USING (retailer_product_id)
LEFT JOIN mapped m ON m.retailer_product_id = o.retailer_product_id || '_' || right(o.retailer_id, 1)"""))
def snapshot_with_identity(spark, sf_dir):
    """The fact's canonical ids: an equi left join with approved mappings."""
    mapped = identity.map_products(views.listings_x(spark, sf_dir))
    mapped = mapped.withColumn("retailer_product_id", F.split_part("retailer_product_id", F.lit("_"), F.lit(1)))
    latest = gold.latest_observations(views.dealt_observations(spark, sf_dir)).join(views.listings(spark, sf_dir).select("retailer_product_id"), "retailer_product_id")
    at = F.when(F.col("retailer_id") == "view", "r0").when(F.col("retailer_id") == "click", "r1").otherwise("r2")
    approved = mapped.filter("review_status = 'matched'").select("retailer_id", "retailer_product_id", "canonical_product_id").dropDuplicates(["retailer_id", "retailer_product_id"])
    return latest.withColumn("retailer_id", at).join(approved, ["retailer_id", "retailer_product_id"], "left").select("observation_id", "canonical_product_id")


# --- Bronze ---------------------------------------------------------------

RAW = """raw AS (
  SELECT event_id AS source_line_number, event_type || '.jsonl' AS source_file, event_type AS retailer_id, k, user_id,
    CASE WHEN k % 6 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS day, event_id % 7 = 0 AS broken
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
), records AS (
  SELECT *, row_number() OVER (PARTITION BY source_file, payload ORDER BY source_line_number) AS occurrence FROM (
    SELECT *, '{' || CASE WHEN day IS NOT NULL THEN '"observed_at":"' || day || '",' ELSE '' END || '"source_product_id":"item' || user_id || '"' ||
      CASE WHEN k % 5 <> 0 THEN ',"source_url":"http://x/' || user_id || '"' ELSE '' END || ',"store_code":"s' || (k % 4) || '"}' AS payload
    FROM raw WHERE NOT broken)
), envelope AS (
  SELECT *, CASE WHEN k % 4 <> 1 THEN 'QUARANTINE' WHEN k % 5 = 0 OR day IS NULL THEN 'WARN' ELSE 'PASS' END AS quality_status,
    sha256('1|' || retailer_id || '|run_1|products|' || source_file || '|' || sha256(payload) || '|' || occurrence) AS bronze_record_key FROM records
)"""


def _envelope(spark, sf_dir):
    valid, invalid = bronze.split_valid(views.raw_lines(spark, sf_dir))
    return bronze.envelope(valid), invalid


@query("WITH " + RAW + " SELECT bronze_record_key, source_file, source_line_number, occurrence AS payload_occurrence_index, quality_status, day AS observed_at, concat_ws(',', CASE WHEN k % 5 = 0 THEN 'missing_source_url' END, CASE WHEN day IS NULL THEN 'missing_observed_at' END) AS warnings FROM envelope")
def bronze_envelope(spark, sf_dir):
    rows, _ = _envelope(spark, sf_dir)
    return rows.select("bronze_record_key", "source_file", "source_line_number", F.col("payload_occurrence_index").cast("bigint").alias("payload_occurrence_index"), "quality_status", "observed_at", F.array_join("quality_warnings", ",").alias("warnings"))


@query("WITH " + RAW + " SELECT source_file, source_line_number, 'invalid_json' AS reason FROM raw WHERE broken UNION ALL SELECT source_file, source_line_number, 'store_code_mismatch' FROM envelope WHERE quality_status = 'QUARANTINE'")
def bronze_quarantine(spark, sf_dir):
    rows, invalid = _envelope(spark, sf_dir)
    held = bronze.quarantined(rows).select("source_file", "source_line_number", F.array_join("quarantine_reasons", ",").alias("reason"))
    return invalid.select("source_file", "source_line_number", F.lit("invalid_json").alias("reason")).unionByName(held)


@query("WITH " + RAW + " SELECT source_file, CAST(max(occurrence) AS BIGINT) AS most, count(DISTINCT payload) AS payloads FROM records GROUP BY source_file")
def bronze_occurrence(spark, sf_dir):
    rows, _ = _envelope(spark, sf_dir)
    return rows.groupBy("source_file").agg(F.max("payload_occurrence_index").cast("bigint").alias("most"), F.count_distinct("payload_sha256").alias("payloads"))


@query("WITH " + RAW + """ SELECT 'run_1' AS run_id, metric, key, CAST(value AS BIGINT) AS value FROM (
  SELECT 'records_written' AS metric, 'all' AS key, count(*) AS value FROM envelope
  UNION ALL SELECT 'distinct_bronze_keys', 'all', count(DISTINCT bronze_record_key) FROM envelope
  UNION ALL SELECT 'duplicate_bronze_keys', 'all', count(*) - count(DISTINCT bronze_record_key) FROM envelope
  UNION ALL SELECT 'quarantine_records', 'all', count(*) FILTER (quality_status = 'QUARANTINE') FROM envelope
  UNION ALL SELECT 'quality_status', quality_status, count(*) FROM envelope GROUP BY 2
  UNION ALL SELECT 'warning', 'missing_source_url', count(*) FROM envelope WHERE k % 5 = 0
  UNION ALL SELECT 'warning', 'missing_observed_at', count(*) FROM envelope WHERE day IS NULL
  UNION ALL SELECT 'reason', 'store_code_mismatch', count(*) FROM envelope WHERE quality_status = 'QUARANTINE'
  UNION ALL SELECT 'file', source_file, count(*) FROM envelope GROUP BY 2
  UNION ALL SELECT 'invalid_json_records', 'all', count(*) FROM raw WHERE broken)""")
def bronze_metrics(spark, sf_dir):
    return bronze.run_metrics(*_envelope(spark, sf_dir))


# --- Silver ---------------------------------------------------------------

@query(with_views("listing", "SELECT retailer_product_id, parse AS package_parse_status, measurement_type, measurement_base_quantity, measurement_base_unit, unit_price_publishable, unit AS selling_unit_normalized FROM listing"))
def package_parse(spark, sf_dir):
    unit = F.when(F.col("package_parse_status") != "none", F.col("selling_unit_normalized"))
    return views.listings(spark, sf_dir).select("retailer_product_id", "package_parse_status", "measurement_type", "measurement_base_quantity", "measurement_base_unit", "unit_price_publishable", unit.alias("selling_unit_normalized"))


@query("SELECT p_partkey, ['each','pack','multi_pack','box','bottle','roll'][p_partkey % 6 + 1] AS unit FROM part")
def selling_unit_norm(spark, sf_dir):
    return views.read(spark, sf_dir, "part").select("p_partkey", selling_unit(views.pick(views.SELLING, F.col("p_partkey"))).alias("unit"))


@query(with_views("listing listing_x", "SELECT retailer_product_id, gtin FROM listing_x"))
def gtin_valid(spark, sf_dir):
    return views.listings_x(spark, sf_dir).select("retailer_product_id", numbers.valid_gtin(F.col("barcode")).alias("gtin"))


@query(with_views("listing", "SELECT parse AS package_parse_status, measurement_type, unit_price_publishable, count(*) AS listings FROM listing GROUP BY ALL"))
def parse_distribution(spark, sf_dir):
    return views.listings(spark, sf_dir).groupBy("package_parse_status", "measurement_type", "unit_price_publishable").agg(F.count("*").alias("listings"))


def silver_bronze(spark, sf_dir):
    """Bronze rows with product payloads: events joined with parts, as a crawler would land them."""
    e = views.observations(spark, sf_dir)
    p = views.listings(spark, sf_dir).select(F.col("retailer_product_id").alias("pid"), "product_name", "brand", "category_raw", "selling_unit_raw")
    rows = e.join(p, e["retailer_product_id"] == p["pid"])
    payload = F.struct(
        F.col("pid").alias("item_no"), "product_name", F.col("product_name").alias("product_name_raw"), F.col("brand").alias("brand_raw"), F.col("category_raw").alias("source_category_name"),
        F.col("selling_unit_raw").alias("unit_raw"), "current_price", "listed_price", "promo_price", (F.col("k") - 40).alias("stock_quantity"), "is_price_discount", "has_promo_mechanic",
        F.struct(F.col("pid").alias("sku")).alias("raw_product"),
    )
    status = F.when(F.col("data_quality_status") == "quarantined", "QUARANTINE").when(F.col("data_quality_status") == "warning", "WARN").otherwise("PASS")
    return rows.select(
        F.to_variant_object(payload).alias("raw_payload"), "retailer_id", F.col("source_run_id").alias("run_id"), F.col("source_bronze_record_key").alias("bronze_record_key"), "source_file", "source_line_number",
        "observed_at", "store_code", "region", F.lit("products").alias("source_dataset"), status.alias("quality_status"), F.lit(None).cast("string").alias("ingested_at"),
    )


SILVER_KEY = "sha256(o.retailer_id || '|' || retailer_product_id || '|' || retailer_product_id || '|' || coalesce(CASE WHEN p_partkey % 7 <> 0 THEN ['Cái','Gói','Lốc','Hộp','Chai','Cuộn'][p_partkey % 6 + 1] END, ''))"


@query(with_views("obs listing", f"""SELECT listing_key AS retailer_product_id, retailer_id, product_name, brand, category_raw, parse AS package_parse_status, last_seen_at FROM (
  SELECT {SILVER_KEY} AS listing_key, o.retailer_id, product_name, brand, category_raw, parse, observed_at AS last_seen_at,
    row_number() OVER (PARTITION BY {SILVER_KEY} ORDER BY source_file DESC, source_line_number DESC) AS place
  FROM obs o JOIN listing l USING (retailer_product_id) WHERE coalesce(data_quality_status, '') <> 'quarantined' AND current_price IS NOT NULL) WHERE place = 1"""))
def silver_products(spark, sf_dir):
    rows = silver.latest_products(silver.products(silver.select_datasets(silver_bronze(spark, sf_dir)), views.NORMALIZED_AT))
    return rows.select("retailer_product_id", "retailer_id", "product_name", "brand", "category_raw", "package_parse_status", "last_seen_at")


@query(with_views("obs listing", f"""SELECT sha256(listing_key || '|' || coalesce(store_code, 'None') || '|' || observed_at || '|' || source_bronze_record_key) AS observation_id, listing_key AS retailer_product_id, observation_date, current_price,
  CAST(CASE WHEN listed_price > 0 THEN greatest(CAST(listed_price AS DECIMAL(28, 12)) - CAST(current_price AS DECIMAL(28, 12)), 0) END AS DOUBLE) AS discount_amount,
  CAST(CASE WHEN listed_price > 0 THEN round(CAST(CAST(greatest(CAST(listed_price AS DECIMAL(28, 12)) - CAST(current_price AS DECIMAL(28, 12)), 0) AS DOUBLE) / listed_price * 100 AS DECIMAL(28, 12)), 4) END AS DOUBLE) AS discount_percent,
  CASE WHEN k > 40 THEN 'in_stock' ELSE 'out_of_stock' END AS availability_status, is_price_discount OR has_promo_mechanic AS is_on_promotion,
  CASE WHEN data_quality_status = 'warning' OR parse IN ('selling_unit_fallback', 'parse_failed') THEN 'warning' ELSE 'valid' END AS data_quality_status
FROM (SELECT *, {SILVER_KEY} AS listing_key FROM obs o JOIN listing l USING (retailer_product_id)) WHERE coalesce(data_quality_status, '') <> 'quarantined' AND current_price IS NOT NULL"""))
def silver_observations(spark, sf_dir):
    rows = silver.observations(silver_bronze(spark, sf_dir), views.NORMALIZED_AT)
    return doubles(rows.select("observation_id", "retailer_product_id", "observation_date", "current_price", "discount_amount", "discount_percent", "availability_status", "is_on_promotion", "data_quality_status"))


@query(with_views("obs listing", """SELECT CASE WHEN data_quality_status = 'quarantined' THEN 'quarantine' WHEN current_price IS NULL THEN 'missing_current_price' ELSE 'kept' END AS skip_reason, count(*) AS records
FROM obs JOIN listing USING (retailer_product_id) GROUP BY 1"""))
def silver_skip_counts(spark, sf_dir):
    return silver.skip_counts(silver_bronze(spark, sf_dir))


@query("SELECT doc_id, replace(strip_accents(lower(text)), 'đ', 'd') AS folded FROM documents")
def accent_fold(spark, sf_dir):
    return views.read(spark, sf_dir, "documents").select("doc_id", text.strip_marks(F.lower("text")).alias("folded"))


@query("""SELECT doc_id, md5(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'))) AS identity_md5,
  md5(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS category_md5 FROM documents""")
def text_normalize(spark, sf_dir):
    return views.read(spark, sf_dir, "documents").select("doc_id", F.md5(text.identity_text(F.col("text"))).alias("identity_md5"), F.md5(text.category_text(F.col("text"))).alias("category_md5"))


@query("""SELECT s_suppkey, 'ret_' || left(sha256(s_name), 24) AS retailer_key, 'store_' || left(sha256(s_name || '|' || n_name), 24) AS store_key,
  sha256(s_name || '|None||') AS listing_key, sha256(s_name || '|' || n_name || '|None|k') AS observation_key, 'prod_' || left(sha256('mapping|' || s_name), 24) AS mapping_key
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def surrogate_keys(spark, sf_dir):
    rows = views.read(spark, sf_dir, "supplier").join(F.broadcast(views.read(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    s, n, none = F.col("s_name"), F.col("n_name"), F.lit(None).cast("string")
    return rows.select("s_suppkey", keys.surrogate("ret", s).alias("retailer_key"), keys.surrogate("store", s, n).alias("store_key"), keys.listing_key(s, none, none, none).alias("listing_key"), keys.observation_key(s, n, none, F.lit("k")).alias("observation_key"), keys.identity_key(F.lit("mapping"), s).alias("mapping_key"))


# --- Identity, taxonomy, entities -----------------------------------------

IDENTITY = "listing listing_x keyed mapped"


@query(with_views(IDENTITY, """SELECT retailer_product_id, retailer_id, match_method, CASE WHEN match_method = 'none' THEN 'unmatched' ELSE 'matched' END AS review_status,
  CASE match_method WHEN 'barcode_exact' THEN 'high' WHEN 'none' THEN 'none' ELSE 'medium' END AS match_confidence,
  CASE match_method WHEN 'barcode_exact' THEN 'prod_' || left(sha256('barcode_exact|' || gtin), 24) WHEN 'attributes_exact' THEN 'prod_' || left(sha256('attributes_exact|' || akey), 24) END AS canonical_product_id FROM mapped"""))
def identity_mapping(spark, sf_dir):
    return identity.map_products(views.listings_x(spark, sf_dir)).select("retailer_product_id", "retailer_id", "match_method", "review_status", "match_confidence", "canonical_product_id")


#: Reviewed rules for the given part types: ordinal, retailer, kind, value, category.
RULES = [(1, "r0", "exact_leaf", "Economy", "food_dry"), (2, "r0", "path_prefix", "ECONOMY", "beverage"), (3, "r1", "path_prefix", "promo", "dairy"), (4, "r2", "exact_leaf", "nothing", "dairy"), (5, "r3", "exact_leaf", " Small ", "household")]


def _mapped_categories(spark, sf_dir):
    rules = F.broadcast(spark.createDataFrame(RULES, "ordinal int, retailer_id string, match_type string, value string, canonical_category_id string"))
    return taxonomy.map_categories(views.listings(spark, sf_dir), rules)


CATEGORY_SQL = """cats AS (
  SELECT retailer_id, lower(category_raw) AS category_normalized, CASE WHEN p_partkey % 4 <> 0 THEN category_raw || ' > ' || brand ELSE category_raw END AS category_path,
    arg_min(category_raw, p_partkey) AS category_raw, arg_min(p_partkey % 4 <> 0, p_partkey) AS listed FROM listing GROUP BY 1, 2, 3
), hit AS (
  SELECT *, CASE WHEN retailer_id = 'r0' AND category_normalized = 'economy' THEN 'food_dry' WHEN retailer_id = 'r1' AND listed AND category_normalized = 'promo' THEN 'dairy'
    WHEN retailer_id = 'r3' AND category_normalized = 'small' THEN 'household' END AS canonical_category_id,
    CASE WHEN retailer_id = 'r0' AND category_normalized = 'economy' THEN 'curated_exact_leaf_v1' WHEN retailer_id = 'r1' AND listed AND category_normalized = 'promo' THEN 'curated_path_prefix_v1'
    WHEN retailer_id = 'r3' AND category_normalized = 'small' THEN 'curated_exact_leaf_v1' ELSE 'unmapped' END AS mapping_method FROM cats
)"""


@query(with_views("listing", "").rstrip() + ",\n" + CATEGORY_SQL + " SELECT 'catmap_' || left(sha256(retailer_id || '|' || category_normalized || '|' || category_path), 24) AS category_mapping_id, retailer_id, category_normalized, category_path, canonical_category_id, mapping_method FROM hit")
def category_taxonomy(spark, sf_dir):
    return _mapped_categories(spark, sf_dir).select("category_mapping_id", "retailer_id", "category_normalized", "category_path", "canonical_category_id", "mapping_method")


@query(with_views("listing", "").rstrip() + ",\n" + CATEGORY_SQL + " SELECT CASE WHEN canonical_category_id IS NULL THEN 'unmapped' ELSE 'mapped' END AS mapping_status, mapping_method, count(*) AS categories FROM hit GROUP BY ALL")
def taxonomy_coverage(spark, sf_dir):
    return taxonomy.coverage(_mapped_categories(spark, sf_dir))


def _entity_rows(spark, sf_dir):
    o = views.observations(spark, sf_dir)
    lines = o.select(
        F.col("source_bronze_record_key").alias("bronze_record_key"), "retailer_id", "store_code", "region", F.col("source_run_id").alias("run_id"), "source_file", "source_line_number",
        F.when(F.col("k") % 2 == 0, F.concat(F.lit(" Aisle  "), (F.col("k") % 6).cast("string"))).alias("category_raw"),
        F.when(F.col("k") % 4 == 1, F.concat(F.lit("offer "), (F.col("k") % 3).cast("string"))).alias("offer_text_raw"),
    )
    return entities.joined(lines, o.filter("current_price is not null and coalesce(data_quality_status, '') <> 'quarantined'"), views.listings(spark, sf_dir))


ENTITY_SQL = """rows_ AS (
  SELECT b.* REPLACE (coalesce(b.store_code, 'unknown_store') AS store_code), CASE WHEN b.k % 2 = 0 THEN ' Aisle  ' || (b.k % 6) END AS raw_category,
    CASE WHEN b.k % 4 = 1 THEN 'offer ' || (b.k % 3) END AS offer_text_raw, l.product_name, l.category_raw AS product_category,
    b.current_price IS NOT NULL AND coalesce(b.data_quality_status, '') <> 'quarantined' AS seen
  FROM obs b LEFT JOIN listing l ON l.retailer_product_id = b.retailer_product_id AND b.current_price IS NOT NULL AND coalesce(b.data_quality_status, '') <> 'quarantined'
), offer_ AS (
  SELECT *, CASE WHEN is_price_discount THEN 'price_discount' WHEN has_promo_mechanic THEN 'promo_mechanic_unparsed' ELSE 'promotion_flag_only' END AS promotion_type FROM rows_
  WHERE seen AND is_on_promotion AND product_name IS NOT NULL
), num AS (SELECT *, concat_ws('|', retailer_id, store_code, retailer_product_id, observation_date, promotion_type,
    regexp_replace(regexp_replace(coalesce(CAST(CAST(listed_price AS DECIMAL(28, 6)) AS VARCHAR), ''), '(\\.\\d*?)0+$', '\\1'), '\\.$', ''),
    regexp_replace(regexp_replace(coalesce(CAST(CAST(promo_price AS DECIMAL(28, 6)) AS VARCHAR), ''), '(\\.\\d*?)0+$', '\\1'), '\\.$', ''),
    regexp_replace(regexp_replace(coalesce(CAST(CAST(current_price AS DECIMAL(28, 6)) AS VARCHAR), ''), '(\\.\\d*?)0+$', '\\1'), '\\.$', ''), coalesce(offer_text_raw, '')) AS parts FROM offer_
), keyed_ AS (SELECT *, 'promo_' || left(sha256(parts), 24) AS promotion_id FROM num
), last_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY promotion_id ORDER BY source_file DESC, source_line_number DESC) AS place FROM keyed_) WHERE place = 1)"""
ENTITIES = with_views("obs listing", "").rstrip() + ",\n" + ENTITY_SQL


@query(ENTITIES + """ SELECT 'retstore_' || left(sha256(retailer_id || '|' || store_code), 24) AS retailer_store_id, retailer_id, store_code, region
FROM (SELECT *, row_number() OVER (PARTITION BY retailer_id, store_code ORDER BY source_file DESC, source_line_number DESC) AS place FROM rows_) WHERE place = 1""")
def stores(spark, sf_dir):
    return entities.stores(_entity_rows(spark, sf_dir)).drop("bronze_record_key")


@query(ENTITIES + """ SELECT DISTINCT 'catmap_' || left(sha256(retailer_id || '|' || c), 24) AS category_mapping_id, retailer_id, c AS category_normalized
FROM (SELECT retailer_id, CASE WHEN raw_category IS NOT NULL THEN 'aisle ' || (k % 6) ELSE lower(product_category) END AS c FROM rows_) WHERE c IS NOT NULL""")
def categories(spark, sf_dir):
    return entities.categories(_entity_rows(spark, sf_dir)).select("category_mapping_id", "retailer_id", "category_normalized")


@query(ENTITIES + " SELECT promotion_id, retailer_id, store_code, promotion_type, offer_text_raw IS NOT NULL AS offer_text_available, observation_date, listed_price, promo_price, current_price FROM last_")
def promotions(spark, sf_dir):
    return entities.promotions(_entity_rows(spark, sf_dir)).select("promotion_id", "retailer_id", "store_code", "promotion_type", "offer_text_available", "observation_date", "listed_price", "promo_price", "current_price")


@query(ENTITIES + " SELECT 'promoitem_' || left(sha256(promotion_id || '|' || retailer_product_id), 24) AS promotion_item_id, promotion_id, retailer_product_id, observation_id FROM last_")
def promotion_items(spark, sf_dir):
    return entities.promotion_items(_entity_rows(spark, sf_dir)).select("promotion_item_id", "promotion_id", "retailer_product_id", "observation_id")


# --- Gold dimensions ------------------------------------------------------

@query(with_views("obs listing", "SELECT 'ret_' || left(sha256(retailer_id), 24) AS retailer_key, retailer_id, retailer_id AS retailer_name, CASE WHEN retailer_id LIKE 'r_' THEN 'run_1' END AS source_run_id FROM (SELECT retailer_id FROM obs UNION SELECT retailer_id FROM listing)"))
def dim_retailer(spark, sf_dir):
    return gold.dim_retailer(views.listings(spark, sf_dir), views.observations(spark, sf_dir)).drop("is_active")


@query(with_views("obs", """SELECT 'store_' || left(sha256(retailer_id || '|' || store_code), 24) AS store_key, retailer_id, store_code, arg_max(store_group_code, (observed_at, observation_id)) AS store_group_code, arg_max(region, (observed_at, observation_id)) AS region
FROM (SELECT * REPLACE (coalesce(store_code, 'unknown_store') AS store_code) FROM obs) GROUP BY retailer_id, store_code"""))
def dim_store(spark, sf_dir):
    return gold.dim_store(views.observations(spark, sf_dir)).select("store_key", "retailer_id", "store_code", "store_group_code", "region")


@query("""SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, strftime(o_orderdate, '%Y-%m-%d') AS calendar_date, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day, CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week, isodow(o_orderdate) >= 6 AS is_weekend FROM orders""")
def dim_date(spark, sf_dir):
    return gold.dim_date(views.read(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("observation_date")))


CANONICAL = "CASE match_method WHEN 'barcode_exact' THEN 'prod_' || left(sha256('barcode_exact|' || gtin), 24) WHEN 'attributes_exact' THEN 'prod_' || left(sha256('attributes_exact|' || akey), 24) END"


@query(with_views(IDENTITY, f"SELECT 'retprod_' || left(sha256(retailer_id || '|' || retailer_product_id), 24) AS retailer_product_key, retailer_product_id, {CANONICAL} AS canonical_product_id, retailer_id, product_name FROM mapped"))
def dim_retailer_product(spark, sf_dir):
    rows = views.listings_x(spark, sf_dir)
    return gold.dim_retailer_product(rows, identity.map_products(rows)).select("retailer_product_key", "retailer_product_id", "canonical_product_id", "retailer_id", "product_name")


@query(with_views(IDENTITY, f"""SELECT 'prod_' || left(sha256(c), 24) AS product_key, c AS canonical_product_id, product_name AS canonical_name, brand, measurement_type FROM (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY barcode IS NULL, product_name, retailer_id, retailer_product_id) AS place FROM (SELECT *, {CANONICAL} AS c FROM mapped) WHERE c IS NOT NULL) WHERE place = 1"""))
def dim_product(spark, sf_dir):
    rows = views.listings_x(spark, sf_dir)
    return gold.dim_product(rows, identity.map_products(rows)).select("product_key", "canonical_product_id", "canonical_name", "brand", "measurement_type")


@query(ENTITIES + " SELECT 'promo_' || left(sha256(promotion_id), 24) AS promotion_key, promotion_id, promotion_type, observation_date FROM last_")
def dim_promotion(spark, sf_dir):
    return gold.dim_promotion(entities.promotions(_entity_rows(spark, sf_dir))).select("promotion_key", "promotion_id", "promotion_type", "observation_date")


@query(ENTITIES + """ SELECT 'promofact_' || left(sha256('promoitem_' || left(sha256(promotion_id || '|' || retailer_product_id), 24)), 24) AS promotion_item_fact_id, CAST(replace(observation_date, '-', '') AS INTEGER) AS date_key,
  'promo_' || left(sha256(promotion_id), 24) AS promotion_key, 'store_' || left(sha256(retailer_id || '|' || store_code), 24) AS store_key, promotion_type, current_price FROM last_""")
def fact_promotion_item(spark, sf_dir):
    rows = _entity_rows(spark, sf_dir)
    return gold.fact_promotion_item(entities.promotion_items(rows), entities.promotions(rows)).select("promotion_item_fact_id", "date_key", "promotion_key", "store_key", "promotion_type", "current_price")


# --- Quality and reconciliation -------------------------------------------

ISSUES = FACT
ISSUE_SQL = """issues AS (
  SELECT price_snapshot_id, unnest(list_filter([
    CASE WHEN current_price IS NULL THEN 'missing_current_price' END, CASE WHEN current_price <= 0 THEN 'non_positive_current_price' END,
    CASE WHEN unit_price_publishable AND effective_unit_price IS NULL THEN 'invalid_unit_price_formula' END,
    CASE WHEN NOT unit_price_publishable THEN 'unit_price_not_publishable' END, CASE WHEN listed_price IS NULL THEN 'missing_listed_price' END,
    CASE WHEN data_quality_status = 'warning' THEN 'upstream_quality_warning' END], lambda x: x IS NOT NULL)) AS rule_id FROM fact
)"""
ISSUES_WITH = with_views(FACT, "").rstrip() + ",\n" + ISSUE_SQL
BLOCK = "CASE WHEN rule_id IN ('missing_current_price', 'non_positive_current_price', 'invalid_unit_price_formula') THEN 'BLOCK_PUBLISH' ELSE 'WARN' END"


@query(ISSUES_WITH + f" SELECT price_snapshot_id, rule_id, {BLOCK} AS severity FROM issues")
def gold_rule_issues(spark, sf_dir):
    return quality.snapshot_issues(fact(spark, sf_dir)).select("price_snapshot_id", "rule_id", "severity")


@query(ISSUES_WITH + f" SELECT rule_id, {BLOCK} AS severity, count(*) AS n FROM issues GROUP BY ALL")
def issue_summary(spark, sf_dir):
    return quality.issue_summary(quality.snapshot_issues(fact(spark, sf_dir)))


@query(ISSUES_WITH + f" SELECT count(*) FILTER ({BLOCK} = 'BLOCK_PUBLISH') AS block_publish_issues, count(*) FILTER ({BLOCK} = 'WARN') AS warn_issues, CASE WHEN count(*) FILTER ({BLOCK} = 'BLOCK_PUBLISH') = 0 THEN 'passed' ELSE 'failed' END AS status FROM issues")
def issue_verdict(spark, sf_dir):
    return quality.verdict(quality.snapshot_issues(fact(spark, sf_dir)))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_grain(spark, sf_dir):
    return quality.duplicate_grain(views.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT 'supplier' AS entity, count(*) AS n_rows, count(DISTINCT s_name) AS n_keys, CAST(0 AS BIGINT) AS n_empty FROM supplier")
def key_check(spark, sf_dir):
    return quality.key_check(views.read(spark, sf_dir, "supplier"), "s_name", "supplier")


@query("SELECT retailer_product_id, count(*) AS n FROM (SELECT 'p' || user_id * 20 AS retailer_product_id FROM events) WHERE retailer_product_id NOT IN (SELECT 'p' || p_partkey FROM part) GROUP BY 1")
def fk_orphans(spark, sf_dir):
    e = views.read(spark, sf_dir, "events").select(F.concat(F.lit("p"), (F.col("user_id") * 20).cast("string")).alias("retailer_product_id"))
    return quality.orphans(e, views.listings(spark, sf_dir), "retailer_product_id").groupBy("retailer_product_id").agg(F.count("*").alias("n"))


@query(with_views(FACT, "SELECT count(*) AS n_rows, count(DISTINCT price_snapshot_id) AS n_ids, CAST(0 AS BIGINT) AS repeated_grains, count(*) FILTER (current_price IS NULL) AS null_current_price, count(*) FILTER (listed_price IS NULL) AS null_listed_price FROM fact"))
def history_check(spark, sf_dir):
    return quality.history_check(fact(spark, sf_dir), "price_snapshot_id", quality.SNAPSHOT_GRAIN, ["current_price", "listed_price"])


@query("SELECT 'o_orderstatus' AS \"column\", 'allowed_values' AS rule, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('O', 'F') UNION ALL SELECT 'o_orderkey', 'type', 1 UNION ALL SELECT 'o_note', 'missing_column', 1")
def contract_issues(spark, sf_dir):
    return quality.contract_issues(views.read(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"], {"o_orderstatus": ["O", "F"]}, {"o_orderkey": "string", "o_note": "string"})


def _metrics(spark, sf_dir):
    o = views.observations(spark, sf_dir)
    n = lambda df, layer, metric: df.groupBy(F.col("source_run_id").alias("run_id")).agg(F.count("*").alias("value")).select("run_id", F.lit(layer).alias("layer"), F.lit(metric).alias("metric"), "value")
    kept = o.filter("coalesce(data_quality_status, '') <> 'quarantined'")
    return (
        n(o.filter("k <> 3"), "bronze", "records")
        .unionByName(n(o.filter("k = 98 and observation_date > '2024-01-20'"), "bronze", "duplicate_keys"))
        .unionByName(n(kept, "silver", "observations"))
        .unionByName(n(kept.filter("k <> 97"), "gold", "read"))
        .unionByName(n(kept.filter("observation_date <> '2024-01-02'"), "gold", "snapshots"))
    )


FLOW_SQL = """m AS (
  SELECT source_run_id AS run_id, count(*) FILTER (k <> 3) AS b, count(*) FILTER (k = 98 AND observation_date > '2024-01-20') AS d,
    count(*) FILTER (coalesce(data_quality_status, '') <> 'quarantined') AS s, count(*) FILTER (coalesce(data_quality_status, '') <> 'quarantined' AND k <> 97) AS g,
    count(*) FILTER (coalesce(data_quality_status, '') <> 'quarantined' AND observation_date <> '2024-01-02') AS p FROM obs GROUP BY 1
), flow AS (SELECT run_id, unnest(list_filter([CASE WHEN d > 0 THEN 'duplicate_bronze_keys' END, CASE WHEN s > b THEN 'silver_exceeds_bronze' END, CASE WHEN g <> s THEN 'gold_read_differs' END,
    CASE WHEN p > s THEN 'gold_exceeds_silver' END, CASE WHEN b = 0 OR s = 0 OR p = 0 THEN 'empty_layer' END], lambda x: x IS NOT NULL)) AS rule_id FROM m)"""
FLOW = with_views("obs", "").rstrip() + ",\n" + FLOW_SQL


@query(FLOW + " SELECT run_id, rule_id FROM flow")
def layer_reconcile(spark, sf_dir):
    return quality.layer_flow(_metrics(spark, sf_dir))


@query(FLOW + """, w AS (SELECT run_id, max(CASE WHEN rule_id = 'gold_read_differs' THEN 1 ELSE 2 END) AS worst FROM flow GROUP BY 1)
SELECT run_id, CASE coalesce(worst, 0) WHEN 2 THEN 'failed' WHEN 1 THEN 'passed_with_warnings' ELSE 'passed' END AS status, coalesce(worst, 0) < 2 AS publish_allowed, coalesce(worst, 0) = 2 AS alert_required FROM m LEFT JOIN w USING (run_id)""")
def run_decision(spark, sf_dir):
    issues = quality.layer_flow(_metrics(spark, sf_dir)).withColumn("severity", F.when(F.col("rule_id") == "gold_read_differs", "WARN").otherwise("BLOCK_RUN"))
    return quality.run_decisions(views.observations(spark, sf_dir).select(F.col("source_run_id").alias("run_id")).distinct(), issues)


@query(with_views("obs", "SELECT DISTINCT r.run_id, e.retailer_id FROM (SELECT DISTINCT source_run_id AS run_id FROM obs) r CROSS JOIN (SELECT DISTINCT retailer_id FROM obs) e WHERE (r.run_id, e.retailer_id) NOT IN (SELECT (source_run_id, retailer_id) FROM obs WHERE k = 5)"))
def missing_retailers(spark, sf_dir):
    o = views.observations(spark, sf_dir).select(F.col("source_run_id").alias("run_id"), "retailer_id", "k")
    retailers = o.agg(F.collect_set("retailer_id").alias("all")).select(F.explode("all").alias("retailer_id"))
    requested = o.select("run_id").distinct().join(F.broadcast(retailers))
    return quality.missing_retailers(requested, o.filter("k = 5").select("run_id", "retailer_id").distinct())


LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
LINES = """e AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, min(l_quantity) AS l_quantity, min(l_extendedprice) AS l_extendedprice, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL),
a AS (SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity, CASE WHEN l_partkey % 11 = 0 THEN l_extendedprice + 1 ELSE l_extendedprice + 0.00001 END AS l_extendedprice) FROM e WHERE l_orderkey % 13 <> 0)"""


def _line_versions(spark, sf_dir):
    e = views.read(spark, sf_dir, "lineitem").groupBy(LINE_KEYS).agg(*[F.min(c).alias(c) for c in ("l_quantity", "l_extendedprice", "l_returnflag")])
    a = e.filter("l_orderkey % 13 <> 0").withColumn("l_quantity", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")))
    return e, a.withColumn("l_extendedprice", F.col("l_extendedprice") + F.when(F.col("l_partkey") % 11 == 0, 1.0).otherwise(0.00001))


@query("WITH " + LINES + " SELECT l_orderkey, l_linenumber, l_partkey, 'missing' AS side FROM e WHERE l_orderkey % 13 = 0")
def key_set_diff(spark, sf_dir):
    return reconcile.key_sets(*_line_versions(spark, sf_dir), LINE_KEYS).select("l_orderkey", "l_linenumber", "l_partkey", "side")


@query("WITH " + LINES + """ SELECT 'l_quantity' AS field, count(*) FILTER (l_orderkey % 7 = 0) AS mismatches FROM a UNION ALL SELECT 'l_extendedprice', count(*) FILTER (l_partkey % 11 = 0) FROM a UNION ALL SELECT 'l_returnflag', 0""")
def field_mismatch(spark, sf_dir):
    return reconcile.field_mismatches(*_line_versions(spark, sf_dir), LINE_KEYS, ["l_quantity", "l_extendedprice", "l_returnflag"])


@query("WITH " + LINES + """ SELECT (SELECT count(*) FROM e WHERE l_orderkey % 13 = 0) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows,
  (SELECT count(*) FILTER (l_orderkey % 7 = 0) + count(*) FILTER (l_partkey % 11 = 0) FROM a) AS field_mismatches, CAST(0 AS BIGINT) AS expected_repeats, CAST(0 AS BIGINT) AS actual_repeats, false AS replacement_ready""")
def replacement_ready(spark, sf_dir):
    return reconcile.replacement_ready(*_line_versions(spark, sf_dir), LINE_KEYS, ["l_quantity", "l_extendedprice", "l_returnflag"])


PARITY_FIELDS = ["product_name", "price", "container", "size"]


@query("""
SELECT 'missing_keys' AS finding, NULL AS field, count(*) AS rows FROM part WHERE p_partkey % 17 = 0 UNION ALL SELECT 'extra_keys', NULL, count(*) FROM part WHERE p_partkey % 19 = 0
UNION ALL SELECT 'repeated_rows', 'expected', 0 UNION ALL SELECT 'repeated_rows', 'actual', count(*) FROM part WHERE p_partkey % 17 <> 0 AND p_partkey % 23 = 0
UNION ALL SELECT 'field_mismatch', 'product_name', count(*) FROM part WHERE p_partkey % 17 <> 0 AND p_partkey % 11 = 0 UNION ALL SELECT 'field_mismatch', 'price', count(*) FROM part WHERE p_partkey % 17 <> 0 AND p_partkey % 7 = 0
UNION ALL SELECT 'missing_column', 'container', 1 UNION ALL SELECT 'missing_column', 'size', 1""")
def silver_parity(spark, sf_dir):
    """Two versions of a table: rows missing, added and repeated, values changed within and beyond the
    tolerance, values that became null, and a column that only one side has, on either side."""
    parts = views.read(spark, sf_dir, "part")
    key, price = F.col("p_partkey"), F.col("p_size") + F.lit(0.5)
    expected = parts.select("p_partkey", F.col("p_name").alias("product_name"), price.alias("price"), F.col("p_brand").alias("container"))
    name = F.when(key % 22 == 0, F.lit(None)).when(key % 11 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    cost = F.when(key % 14 == 0, F.lit(None)).when(key % 7 == 0, price + 0.01).otherwise(price + 0.00001)
    kept = parts.filter(key % 17 != 0).select("p_partkey", name.alias("product_name"), cost.alias("price"), F.col("p_size").alias("size"))
    added = parts.filter(key % 19 == 0).select((-key - 1).alias("p_partkey"), F.lit("x").alias("product_name"), F.lit(1.0).alias("price"), F.lit(1).alias("size"))
    return reconcile.parity(expected, kept.unionByName(kept.filter(key % 23 == 0)).unionByName(added), ["p_partkey"], PARITY_FIELDS)


# --- Serving --------------------------------------------------------------

def _served(spark, sf_dir):
    """The fact with brands standing for canonical products, so several retailers share one."""
    return fact(spark, sf_dir).withColumn("canonical_product_id", F.when(F.col("brand") != "Brand#3", F.col("brand")))


SERVED = with_views(FACT, "").rstrip() + ",\nserved AS (SELECT *, CASE WHEN brand <> 'Brand#3' THEN brand END AS canonical_product_id FROM fact)"


@query(SERVED + " SELECT canonical_product_id, snapshot_date, retailer_id, min(current_price) AS min_price, max(current_price) AS max_price, count(*) AS listings FROM served WHERE canonical_product_id IS NOT NULL GROUP BY 1, 2, 3")
def price_across_retailers(spark, sf_dir):
    return serving.price_across_retailers(_served(spark, sf_dir))


@query(with_views(FACT, """SELECT retailer_id, snapshot_date, count(*) AS n, max(pct) AS max_percent, min(pct) AS min_percent FROM (
  SELECT *, CAST(round(CAST(CAST(CAST(listed_price AS DECIMAL(28, 12)) - CAST(current_price AS DECIMAL(28, 12)) AS DOUBLE) / listed_price * 100 AS DECIMAL(28, 12)), 4) AS DOUBLE) AS pct FROM fact WHERE listed_price > current_price) GROUP BY 1, 2"""))
def discounts(spark, sf_dir):
    amount, percent = silver.discount(F.col("current_price"), F.col("listed_price"))
    return doubles(serving.discounts(fact(spark, sf_dir).withColumns({"discount_amount": amount, "discount_percent": percent})))


@query(SERVED + """ SELECT a.canonical_product_id, a.snapshot_date, a.retailer_id AS a_retailer_id, b.retailer_id AS b_retailer_id, count(*) AS pairs
FROM served a JOIN served b ON a.canonical_product_id = b.canonical_product_id AND a.measurement_type = b.measurement_type AND a.comparison_unit = b.comparison_unit AND a.snapshot_date = b.snapshot_date AND a.retailer_id < b.retailer_id GROUP BY 1, 2, 3, 4""")
def comparable_pairs(spark, sf_dir):
    return serving.comparable_pairs(_served(spark, sf_dir)).groupBy("canonical_product_id", "snapshot_date", "a_retailer_id", "b_retailer_id").agg(F.sum("pairs").alias("pairs"))


CLASS_SQL = ", served_ AS (SELECT * FROM served WHERE canonical_product_id IS NOT NULL AND comparison_unit IS NOT NULL AND effective_unit_price IS NOT NULL)"


@query(SERVED + CLASS_SQL + """, firsts AS (SELECT *, row_number() OVER (PARTITION BY canonical_product_id, measurement_type, comparison_unit, snapshot_date ORDER BY price, retailer_id) AS place FROM (
  SELECT canonical_product_id, measurement_type, comparison_unit, snapshot_date, retailer_id, min(effective_unit_price) AS price FROM served_ GROUP BY 1, 2, 3, 4, 5))
SELECT s.canonical_product_id, s.snapshot_date, s.retailer_id, count(*) AS listings, f.retailer_id AS other_retailer_id, f.price AS other_price, CAST(count(*) FILTER (f.price < s.effective_unit_price) AS BIGINT) AS dearer
FROM served_ s JOIN firsts g ON g.canonical_product_id = s.canonical_product_id AND g.measurement_type = s.measurement_type AND g.comparison_unit = s.comparison_unit AND g.snapshot_date = s.snapshot_date AND g.place = 1
JOIN firsts f ON f.canonical_product_id = s.canonical_product_id AND f.measurement_type = s.measurement_type AND f.comparison_unit = s.comparison_unit AND f.snapshot_date = s.snapshot_date AND f.place = CASE WHEN g.retailer_id = s.retailer_id THEN 2 ELSE 1 END
GROUP BY 1, 2, 3, 5, 6""")
def best_comparable(spark, sf_dir):
    """Each listing against the cheapest comparable offer of another retailer, counted by offer."""
    found = serving.best_comparable(_served(spark, sf_dir))
    dearer = F.count_if(F.col("other_effective_unit_price") < F.col("effective_unit_price")).alias("dearer")
    return doubles(found.groupBy("canonical_product_id", "snapshot_date", "retailer_id", "other_retailer_id", F.col("other_effective_unit_price").alias("other_price")).agg(F.count("*").alias("listings"), dearer))


@query(with_views("listing listing_x keyed mapped", """, n AS (SELECT CASE WHEN match_method = 'barcode_exact' THEN 'prod_' || left(sha256('barcode_exact|' || gtin), 24) ELSE 'prod_' || left(sha256('attributes_exact|' || akey), 24) END AS canonical_product_id,
  retailer_id, count(*) AS listings FROM mapped WHERE match_method <> 'none' GROUP BY ALL) SELECT a.canonical_product_id, a.retailer_id AS a_retailer_id, b.retailer_id AS b_retailer_id, CAST(a.listings * b.listings AS BIGINT) AS pairs FROM n a JOIN n b USING (canonical_product_id) WHERE a.retailer_id < b.retailer_id""").replace("\n, n AS", ",\nn AS"))
def comparable_mapped(spark, sf_dir):
    """Comparable listings by the canonical ids that the identity mapping gives."""
    mapped = identity.map_products(views.listings_x(spark, sf_dir)).filter("review_status = 'matched'")
    rows = mapped.select("canonical_product_id", "retailer_id", "retailer_product_id", F.lit("x").alias("measurement_type"), F.lit("each").alias("comparison_unit"), F.lit("2024-01-01").alias("snapshot_date"), F.lit(1.0).alias("effective_unit_price"))
    return serving.comparable_pairs(rows).select("canonical_product_id", "a_retailer_id", "b_retailer_id", "pairs")


@query(with_views(FACT, """SELECT snapshot_date, measurement_type, comparison_unit, retailer_id, store_code, retailer_product_id, effective_unit_price FROM (
  SELECT *, row_number() OVER (PARTITION BY snapshot_date, measurement_type, comparison_unit ORDER BY effective_unit_price, retailer_id, store_code, retailer_product_id) AS place FROM fact WHERE effective_unit_price IS NOT NULL) WHERE place = 1"""))
def best_offer(spark, sf_dir):
    return doubles(serving.best_offers(fact(spark, sf_dir)).select("snapshot_date", "measurement_type", "comparison_unit", "retailer_id", "store_code", "retailer_product_id", "effective_unit_price"))


@query(with_views(FACT, "SELECT price_snapshot_id, source_bronze_record_key, retailer_id || '.jsonl' AS source_file, CAST(observation_id AS BIGINT) AS source_line_number FROM fact"))
def lineage_trace(spark, sf_dir):
    o = views.observations(spark, sf_dir).select(F.col("source_bronze_record_key").alias("bronze_record_key"), "source_file", "source_line_number")
    return serving.lineage(fact(spark, sf_dir), o)
