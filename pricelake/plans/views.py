"""The given tables seen as observations, listings and raw payloads.

``SQL`` holds the same views as common table expressions for a SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from pricelake.functions.package import PACKAGE_COLUMNS, with_package
from pricelake.operators.silver import availability

UNITS = ["kg", "g", "ml", "l", " x 20cm", ""]
SELLING = ["Cái", "Gói", "Lốc", "Hộp", "Chai", "Cuộn"]
NORMALIZED_AT = "2026-01-01T00:00:00+00:00"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Rows of a part that one task works on; a compact file is one or two splits, however many rows it has.
ROWS_A_TASK = 20_000


def dealt(rows: DataFrame, n: int, key: str, each: int = ROWS_A_TASK) -> DataFrame:
    """``n`` rows, dealt by a key to tasks of about ``each`` rows, however many rows there are; to all cores
    where these have a twentieth of that at least."""
    tasks = max(-(-n // each), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n * 20 // each)))
    return rows.repartition(tasks, key) if tasks > 1 else rows


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts, dealt to tasks by their number, for work that costs much more than reading them."""
    rows = read(spark, sf_dir, "part")
    return dealt(rows, rows.count(), "p_partkey")


def dealt_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations, dealt by listing: their grains, the join with listings and checks of grains
    need no other shuffle, and sort and count a bounded number of rows in a task."""
    return dealt(observations(spark, sf_dir), read(spark, sf_dir, "events").count(), "retailer_product_id", 200_000)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    rows = read(spark, sf_dir, "events").withColumn("k", k)
    c = F.col
    cut, mechanic = c("k") % 3 == 0, c("k") % 7 == 0
    return rows.select(
        c("event_id").cast("string").alias("observation_id"),
        c("event_type").alias("retailer_id"),
        F.concat(F.lit("p"), c("user_id").cast("string")).alias("retailer_product_id"),
        F.when(c("k") % 4 != 0, F.concat(F.lit("s"), (c("k") % 4).cast("string"))).alias("store_code"),
        F.concat(F.lit("g"), (c("k") % 2).cast("string")).alias("store_group_code"),
        F.concat(F.lit("area"), (c("k") % 3).cast("string")).alias("region"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("observed_at"),
        F.date_format("ts", "yyyy-MM-dd").alias("observation_date"),
        F.when(c("k") % 5 != 4, c("value") + (c("k") % 5) * 0.5).alias("listed_price"),
        F.when(cut, c("value")).alias("promo_price"),
        F.when(c("k") % 23 != 0, c("value")).alias("current_price"),
        F.lit("VND").alias("currency"),
        F.lit(None).cast("decimal(28,12)").alias("discount_amount"),
        F.lit(None).cast("decimal(28,4)").alias("discount_percent"),
        availability(c("k") - 40).alias("availability_status"),
        cut.alias("is_price_discount"),
        mechanic.alias("has_promo_mechanic"),
        (cut | mechanic | (c("k") % 11 == 0)).alias("is_on_promotion"),
        F.when(c("k") % 10 == 0, "quarantined").when(c("k") % 10 == 1, "warning").when(c("k") % 10 != 2, "valid").alias("data_quality_status"),
        F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd")).alias("source_run_id"),
        F.concat(F.lit("b"), c("event_id").cast("string")).alias("source_bronze_record_key"),
        F.concat(c("event_type"), F.lit(".jsonl")).alias("source_file"),
        c("event_id").alias("source_line_number"),
        F.lit(NORMALIZED_AT).alias("normalized_at"),
        "k",
    )


def pick(values: list[str], index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int") + 1)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    name = F.concat("p_name", F.lit(" "), F.col("p_size").cast("string"), pick(UNITS, key))
    unit = F.when(key % 7 != 0, pick(SELLING, key))
    rows = with_package(parts(spark, sf_dir).withColumn("product_name", name), name, F.lit(None).cast("string"), unit)
    return rows.select(
        F.concat(F.lit("p"), key.cast("string")).alias("retailer_product_id"),
        F.concat(F.lit("r"), (key % 5).cast("string")).alias("retailer_id"),
        "product_name",
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category_raw"),
        F.when(key % 4 != 0, F.array("p_type", "p_brand")).alias("category_path_raw"),
        F.lit("run_1").alias("source_run_id"),
        F.lit("part.jsonl").alias("source_file"),
        key.alias("source_line_number"),
        *PACKAGE_COLUMNS,
    )


def listings_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of the same parts at several retailers; some with barcodes, a few of them wrong."""
    key = F.col("p_partkey")
    base = listings(spark, sf_dir).drop("retailer_id").withColumn("p_partkey", F.expr("cast(substring(retailer_product_id, 2) as bigint)"))
    at = base.withColumn("r", F.explode(F.sequence(F.lit(0), (key % 3).cast("int"))))
    stem = F.lpad(key.cast("string"), 12, "0")
    sums = F.aggregate(F.transform(F.split(stem, ""), lambda d, i: d.try_cast("int") * F.when(i % 2 == 1, 3).otherwise(1)), F.lit(0), lambda a, x: a + x)
    check = (10 - sums % 10) % 10
    barcode = F.when(key % 3 != 1, F.concat(stem, ((check + F.when(key % 15 == 0, 1).otherwise(0)) % 10).cast("string")))
    return at.withColumn("barcode", F.when(F.col("r") != 2, barcode)).select(
        F.concat("retailer_product_id", F.lit("_"), F.col("r").cast("string")).alias("retailer_product_id"),
        F.concat(F.lit("r"), F.col("r").cast("string")).alias("retailer_id"),
        F.when(F.col("r") == 1, F.upper("product_name")).otherwise(F.col("product_name")).alias("product_name"),
        *["brand", "category_raw", "barcode", "measurement_type", "measurement_base_quantity", "measurement_base_unit", "selling_unit_count"],
        *["package_total_base_quantity", "source_run_id", "source_file", "source_line_number"],
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON lines of crawl files made of the events: every seventh is broken, some repeat."""
    e = read(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    payload = F.to_json(
        F.struct(
            F.concat(F.lit("item"), F.col("user_id").cast("string")).alias("source_product_id"),
            F.when(F.col("k") % 5 != 0, F.concat(F.lit("http://x/"), F.col("user_id").cast("string"))).alias("source_url"),
            F.when(F.col("k") % 6 != 0, F.date_format("ts", "yyyy-MM-dd")).alias("observed_at"),
            F.concat(F.lit("s"), (F.col("k") % 4).cast("string")).alias("store_code"),
        )
    )
    line = F.when(F.col("event_id") % 7 == 0, F.substring(payload, 1, 20)).otherwise(payload)
    return e.select(
        line.alias("line"),
        F.concat("event_type", F.lit(".jsonl")).alias("source_file"),
        F.col("event_id").alias("source_line_number"),
        F.lit("products").alias("source_dataset"),
        F.col("event_type").alias("retailer_id"),
        F.lit("run_1").alias("run_id"),
        F.lit("s1").alias("run_store_code"),
    )


SQL = {
    "obs": """obs AS (
  SELECT CAST(event_id AS VARCHAR) AS observation_id, event_type AS retailer_id, 'p' || user_id AS retailer_product_id,
    CASE WHEN k % 4 <> 0 THEN 's' || (k % 4) END AS store_code, 'g' || (k % 2) AS store_group_code, 'area' || (k % 3) AS region,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS observed_at, strftime(ts, '%Y-%m-%d') AS observation_date,
    CASE WHEN k % 5 <> 4 THEN value + (k % 5) * CAST(0.5 AS DOUBLE) END AS listed_price,
    CASE WHEN k % 3 = 0 THEN value END AS promo_price, CASE WHEN k % 23 <> 0 THEN value END AS current_price, 'VND' AS currency,
    CASE WHEN k > 40 THEN 'in_stock' ELSE 'out_of_stock' END AS availability_status,
    k % 3 = 0 AS is_price_discount, k % 7 = 0 AS has_promo_mechanic, (k % 3 = 0 OR k % 7 = 0 OR k % 11 = 0) AS is_on_promotion,
    CASE WHEN k % 10 = 0 THEN 'quarantined' WHEN k % 10 = 1 THEN 'warning' WHEN k % 10 <> 2 THEN 'valid' END AS data_quality_status,
    'run_' || strftime(ts, '%Y%m%d') AS source_run_id, 'b' || event_id AS source_bronze_record_key,
    event_type || '.jsonl' AS source_file, event_id AS source_line_number, k
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)""",
    "latest": """latest AS (
  SELECT * REPLACE (coalesce(store_code, 'unknown_store') AS store_code) FROM (
    SELECT *, row_number() OVER (PARTITION BY observation_date, retailer_id, coalesce(store_code, 'unknown_store'), retailer_product_id
      ORDER BY observed_at DESC, observation_id DESC) AS place FROM obs)
  WHERE place = 1 AND (data_quality_status IS NULL OR data_quality_status <> 'quarantined')
)""",
    "listing": """listing AS (
  SELECT *, CASE WHEN parse = 'parsed_measurement' THEN CASE WHEN u IN (0, 1) THEN 'mass' ELSE 'volume' END
      WHEN parse = 'parsed_area' THEN 'area' WHEN parse = 'selling_unit_fallback' THEN 'count' ELSE 'unknown' END AS measurement_type,
    CASE WHEN parse = 'parsed_measurement' THEN CAST(p_size AS DOUBLE) * CASE WHEN u IN (0, 3) THEN 1000 ELSE 1 END
      WHEN parse = 'parsed_area' THEN CAST(p_size AS DOUBLE) * 20 WHEN parse = 'selling_unit_fallback' THEN CAST(1 AS DOUBLE) END AS measurement_base_quantity,
    CASE WHEN parse = 'parsed_measurement' THEN CASE WHEN u IN (0, 1) THEN 'g' ELSE 'ml' END
      WHEN parse = 'parsed_area' THEN 'cm2' WHEN parse = 'selling_unit_fallback' THEN 'each' END AS measurement_base_unit,
    CASE WHEN parse <> 'parse_failed' THEN CAST(1 AS DOUBLE) END AS selling_unit_count,
    parse IN ('parsed_measurement', 'parsed_area') OR (parse = 'selling_unit_fallback' AND unit IN ('each', 'roll')) AS unit_price_publishable
  FROM (
    SELECT *, CASE WHEN u < 4 THEN 'parsed_measurement' WHEN u = 4 AND p_size >= 10 THEN 'parsed_area'
        WHEN unit IS NOT NULL THEN 'selling_unit_fallback' ELSE 'parse_failed' END AS parse
    FROM (SELECT 'p' || p_partkey AS retailer_product_id, 'r' || (p_partkey % 5) AS retailer_id, p_partkey, p_size, CAST(p_partkey % 6 AS INTEGER) AS u,
        p_name || ' ' || p_size || ['kg', 'g', 'ml', 'l', ' x 20cm', ''][p_partkey % 6 + 1] AS product_name, p_brand AS brand, p_type AS category_raw,
        CASE WHEN p_partkey % 7 <> 0 THEN ['each', 'pack', 'multi_pack', 'box', 'bottle', 'roll'][p_partkey % 6 + 1] END AS unit
      FROM part))
)""",
    "fact": """fact AS (
  SELECT sha256(observation_date || '|' || o.retailer_id || '|' || store_code || '|' || retailer_product_id) AS price_snapshot_id,
    CAST(replace(observation_date, '-', '') AS INTEGER) AS date_key, observation_date AS snapshot_date,
    o.retailer_id, store_code, retailer_product_id, observation_id, observed_at, product_name, brand, listed_price, current_price, availability_status,
    unit_price_publishable, measurement_type, measurement_base_quantity AS package_total_base_quantity, data_quality_status, source_run_id, source_bronze_record_key,
    CASE WHEN unit_price_publishable AND current_price > 0 AND measurement_base_quantity > 0
      THEN CAST(round(CAST(current_price / measurement_base_quantity AS DECIMAL(28, 12)), 6) AS DOUBLE) END AS effective_unit_price,
    CASE WHEN unit_price_publishable AND current_price > 0 AND measurement_base_quantity > 0 THEN measurement_base_unit END AS comparison_unit
  FROM latest o JOIN listing l USING (retailer_product_id)
)""",
    "listing_x": """listing_x AS (
  SELECT l.retailer_product_id || '_' || r AS retailer_product_id, 'r' || r AS retailer_id,
    CASE WHEN r = 1 THEN upper(product_name) ELSE product_name END AS product_name, brand, category_raw, measurement_type, measurement_base_quantity,
    measurement_base_unit, selling_unit_count, p_partkey, r,
    CASE WHEN p_partkey % 3 <> 1 AND r <> 2 THEN stem || ((chk + CASE WHEN p_partkey % 15 = 0 THEN 1 ELSE 0 END) % 10) END AS barcode,
    CASE WHEN p_partkey % 3 <> 1 AND r <> 2 AND p_partkey % 15 <> 0 THEN stem || chk END AS gtin
  FROM (SELECT *, unnest(range(0, p_partkey % 3 + 1)) AS r, lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS stem,
      (10 - list_sum(list_transform(range(1, 13), lambda i: CAST(lpad(CAST(p_partkey AS VARCHAR), 12, '0')[i] AS INTEGER) * CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END)) % 10) % 10 AS chk
    FROM listing) l
)""",
    "mapped": """mapped AS (
  SELECT x.*, CASE WHEN x.gtin IN (SELECT gtin FROM keyed WHERE gtin IS NOT NULL GROUP BY gtin HAVING count(DISTINCT retailer_id) > 1) THEN 'barcode_exact'
      WHEN x.akey IN (SELECT akey FROM keyed GROUP BY akey HAVING count(DISTINCT retailer_id) > 1) THEN 'attributes_exact' ELSE 'none' END AS match_method
  FROM keyed x
)""",
    "keyed": """keyed AS (
  SELECT *, concat_ws('|', trim(regexp_replace(lower(brand), '[^a-z0-9]+', ' ', 'g')), trim(regexp_replace(lower(product_name), '[^a-z0-9]+', ' ', 'g')), measurement_type,
    coalesce(CAST(CAST(measurement_base_quantity AS BIGINT) AS VARCHAR), ''), coalesce(measurement_base_unit, ''), coalesce(CAST(CAST(selling_unit_count AS BIGINT) AS VARCHAR), '')) AS akey
  FROM listing_x
)""",
}


def with_views(names: str, body: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names.split()) + "\n" + body
