"""Category mapping by reviewed rules; the first rule in order wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import keys
from pricelake.functions.text import taxonomy_text
from pricelake.operators.dedupe import dedupe


def check_rules(rules: DataFrame, declared: DataFrame) -> DataFrame:
    """Rules that name an undeclared category; must be empty."""
    return rules.join(declared, "canonical_category_id", "left_anti")


def candidates(products: DataFrame) -> DataFrame:
    """Distinct (retailer, name, path), the first product of each; a missing path is the name itself."""
    named = products.filter(F.trim("category_raw") != "").withColumn("category_normalized", taxonomy_text(F.col("category_raw")))
    clean = F.filter("category_path_raw", lambda x: F.trim(x) != "")
    named = named.withColumn("path", F.coalesce(clean, F.array("category_raw")))
    return dedupe(named, ["retailer_id", "category_normalized", "path"], [F.col("source_file"), F.col("source_line_number")])


def map_categories(products: DataFrame, rules: DataFrame) -> DataFrame:
    """rules: ordinal, retailer_id, match_type, value, canonical_category_id; a small reviewed list."""
    rows = candidates(products).withColumn("head", taxonomy_text(F.try_element_at("category_path_raw", F.lit(1))))
    rule = rules.select("ordinal", F.col("retailer_id").alias("rule_retailer"), "match_type", taxonomy_text(F.col("value")).alias("rule_value"), "canonical_category_id")
    hit = (F.col("retailer_id") == F.col("rule_retailer")) & (
        ((F.col("match_type") == "exact_leaf") & (F.col("category_normalized") == F.col("rule_value")))
        | ((F.col("match_type") == "path_prefix") & F.col("category_path_raw").isNotNull() & (F.col("head") == F.col("rule_value")))
    )
    first = F.min_by(F.struct("canonical_category_id", "match_type"), "ordinal")
    found = rows.join(rule, hit, "left").groupBy("retailer_id", "category_normalized", "path", "category_raw").agg(first.alias("rule"))
    method = F.when(F.col("rule.match_type") == "exact_leaf", "curated_exact_leaf_v1").when(F.col("rule.match_type") == "path_prefix", "curated_path_prefix_v1").otherwise("unmapped")
    path = F.array_join("path", " > ")
    return found.select(
        keys.surrogate("catmap", F.col("retailer_id"), F.col("category_normalized"), path).alias("category_mapping_id"),
        *["retailer_id", "category_raw", "category_normalized"],
        path.alias("category_path"),
        F.col("rule.canonical_category_id").alias("canonical_category_id"),
        F.when(F.col("rule.canonical_category_id").isNotNull(), "mapped").otherwise("unmapped").alias("mapping_status"),
        method.alias("mapping_method"),
    )


def coverage(mapped: DataFrame) -> DataFrame:
    return mapped.groupBy("mapping_status", "mapping_method").agg(F.count("*").alias("categories"))


CONFIG = "canonical_categories array<struct<canonical_category_id:string,canonical_category_name:string>>, mappings array<struct<retailer_id:string,match_type:string,value:string,canonical_category_id:string>>"


def read_config(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(declared categories, rules in their order) of a reviewed configuration, one JSON document."""
    config = spark.read.schema(CONFIG).option("multiLine", "true").json(path)
    return config.select(F.inline("canonical_categories")), config.select(F.posexplode("mappings").alias("ordinal", "m")).select("ordinal", "m.*")


def enabled_categories(categories: DataFrame) -> DataFrame:
    """Those that are switched on; a category without the switch is off."""
    return categories.filter(F.coalesce(F.col("enabled"), F.lit(False)))
