"""Row rules, key and reference checks, layer flow and publish decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.numbers import exact

TOLERANCE = 1e-4
#: Rules that stop publication; the others warn.
BLOCKING = ("missing_current_price", "non_positive_current_price", "date_key_mismatch", "missing_lineage", "invalid_unit_price_formula", "duplicate_snapshot_grain")
LAYER_METRICS = ["bronze.records", "bronze.duplicate_keys", "silver.observations", "gold.read", "gold.snapshots"]
SNAPSHOT_GRAIN = ["snapshot_date", "retailer_id", "store_code", "retailer_product_id"]


def row_rules() -> Column:
    """The ids of all rules that a snapshot row breaks."""
    c = F.col
    price, quantity, unit_price = c("current_price"), c("package_total_base_quantity"), c("effective_unit_price")
    missing = lambda x: F.coalesce(x, F.lit("")) == ""
    publishable = F.coalesce(c("unit_price_publishable"), F.lit(False))
    off = F.coalesce((quantity <= 0) | quantity.isNull() | unit_price.isNull() | (F.abs(exact(price) / exact(quantity) - exact(unit_price)) > TOLERANCE), F.lit(True))
    leaked = unit_price.isNotNull() | c("comparison_unit").isNotNull()
    rules = {
        "missing_current_price": price.isNull(),
        "non_positive_current_price": price <= 0,
        "date_key_mismatch": ~c("date_key").eqNullSafe(F.regexp_replace("snapshot_date", "-", "").cast("int")),
        "missing_lineage": missing(c("source_run_id")) | missing(c("observation_id")) | missing(c("source_bronze_record_key")),
        "invalid_unit_price_formula": F.when(publishable, off).otherwise(leaked),
        "unit_price_not_publishable": ~publishable & ~leaked,
        "missing_listed_price": c("listed_price").isNull(),
        "unknown_availability": c("availability_status") == "unknown",
        "upstream_quality_warning": c("silver_data_quality_status") == "warning",
    }
    return F.array_compact(F.array(*[F.when(broken, F.lit(rule)) for rule, broken in rules.items()]))


def severity(rule: Column) -> Column:
    return F.when(rule.isin(*BLOCKING), "BLOCK_PUBLISH").otherwise("WARN")


def snapshot_issues(snapshots: DataFrame) -> DataFrame:
    """One row per broken rule and row; a repeated grain is one issue."""
    broken = snapshots.select("price_snapshot_id", "retailer_product_id", F.explode(row_rules()).alias("rule_id"))
    return broken.unionByName(duplicate_grain(snapshots, SNAPSHOT_GRAIN).select(F.lit(None).cast("string").alias("price_snapshot_id"), "retailer_product_id", F.lit("duplicate_snapshot_grain").alias("rule_id"))).withColumn("severity", severity(F.col("rule_id")))


def duplicate_grain(df: DataFrame, grain: list[str]) -> DataFrame:
    return df.groupBy(*grain).agg(F.count("*").alias("n")).filter("n > 1")


def issue_summary(issues: DataFrame) -> DataFrame:
    return issues.groupBy("rule_id", "severity").agg(F.count("*").alias("n"))


def verdict(issues: DataFrame) -> DataFrame:
    """Totals and passed or failed; one row, also without issues."""
    return issues.agg(
        F.count_if(F.col("severity") == "BLOCK_PUBLISH").alias("block_publish_issues"),
        F.count_if(F.col("severity") == "WARN").alias("warn_issues"),
    ).withColumn("status", F.when(F.col("block_publish_issues") == 0, "passed").otherwise("failed"))


def sample_issues(issues: DataFrame, n: int = 50) -> DataFrame:
    """A report of the first issues in a fixed order."""
    return issues.orderBy("rule_id", "price_snapshot_id", "retailer_product_id").limit(n)


def key_check(df: DataFrame, key: str, entity: str) -> DataFrame:
    """Rows, distinct keys and empty keys of an entity."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.count_if(F.coalesce(F.col(key).cast("string"), F.lit("")) == "").alias("n_empty")).select(F.lit(entity).alias("entity"), "*")


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key the dimension lacks."""
    return fact.join(dimension.select(key), key, "left_anti")


def entity_issues(promotions: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """rule, severity and rows: items without their promotion or product, and price discounts without a price."""
    counted = lambda rows, rule: rows.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule_id"), F.lit("BLOCK_PUBLISH").alias("severity"), "n")
    unpriced = promotions.filter((F.col("promotion_type") == "price_discount") & F.col("current_price").isNull())
    rows = counted(orphans(items, promotions, "promotion_id"), "promotion_item_missing_promotion")
    rows = rows.unionByName(counted(orphans(items, products, "retailer_product_id"), "promotion_item_missing_product"))
    return rows.unionByName(counted(unpriced, "price_discount_missing_current_price")).filter("n > 0")


def history_check(history: DataFrame, key: str, grain: list[str], required: list[str]) -> DataFrame:
    """One row: rows, distinct ids, repeated grains, and nulls in required columns."""
    grains = F.count_distinct(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in grain]))
    return history.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(key).alias("n_ids"),
        (F.count("*") - grains).alias("repeated_grains"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required],
    )


def contract_issues(df: DataFrame, required: list[str], allowed: dict[str, list[str]], types: dict[str, str]) -> DataFrame:
    """column, rule and number of rows that break it; from a declared contract."""
    kinds = dict(df.dtypes)
    checks = [(c, "required", F.col(c).isNull()) for c in required if c in kinds]
    checks += [(c, "allowed_values", F.col(c).isNotNull() & ~F.col(c).isin(*values)) for c, values in allowed.items() if c in kinds]
    found = df.agg(*[F.count_if(bad).alias(f"{c}|{rule}") for c, rule, bad in checks])
    rows = found.unpivot([], found.columns, "check", "n").filter("n > 0").select(F.split_part("check", F.lit("|"), F.lit(1)).alias("column"), F.split_part("check", F.lit("|"), F.lit(2)).alias("rule"), "n")
    wrong = [(c, "missing_column" if c not in kinds else "type", 1) for c in dict.fromkeys([*required, *types]) if c not in kinds or (c in types and kinds[c] != types[c])]
    return rows.unionByName(df.sparkSession.createDataFrame(wrong, "column string, rule string, n long")) if wrong else rows


def layer_flow(metrics: DataFrame) -> DataFrame:
    """metrics: run_id, layer, metric, value. Rules between layers, for all runs at once."""
    named = metrics.withColumn("name", F.concat_ws(".", "layer", "metric"))
    wide = named.groupBy("run_id").pivot("name", LAYER_METRICS).agg(F.sum("value"))
    v = lambda name: F.coalesce(F.col(f"`{name}`"), F.lit(0))
    rules = {
        "duplicate_bronze_keys": v("bronze.duplicate_keys") > 0,
        "silver_exceeds_bronze": v("silver.observations") > v("bronze.records"),
        "gold_read_differs": v("gold.read") != v("silver.observations"),
        "gold_exceeds_silver": v("gold.snapshots") > v("silver.observations"),
        "empty_layer": (v("bronze.records") == 0) | (v("silver.observations") == 0) | (v("gold.snapshots") == 0),
    }
    return wide.select("run_id", F.explode(F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in rules.items()]))).alias("rule_id"))


def run_decisions(runs: DataFrame, issues: DataFrame, strict: bool = False) -> DataFrame:
    """Per run: status, publish and alert flags; strict mode lets a warning block."""
    rank = F.when(F.col("severity").isin("BLOCK_RUN", "BLOCK_PUBLISH"), 2).otherwise(2 if strict else 1)
    worst = issues.groupBy("run_id").agg(F.max(rank).alias("worst"))
    worst_or_none = F.coalesce("worst", F.lit(0))
    return runs.join(worst, "run_id", "left").select(
        "run_id",
        F.when(worst_or_none == 2, "failed").when(worst_or_none == 1, "passed_with_warnings").otherwise("passed").alias("status"),
        (worst_or_none < 2).alias("publish_allowed"),
        (worst_or_none == 2).alias("alert_required"),
    )


def missing_retailers(requested: DataFrame, completed: DataFrame) -> DataFrame:
    return requested.join(completed, ["run_id", "retailer_id"], "left_anti")
