"""Questions that the lakehouse answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def price_across_retailers(fact: DataFrame) -> DataFrame:
    """Lowest and highest price of each canonical product at each retailer and date."""
    return fact.filter("canonical_product_id is not null").groupBy("canonical_product_id", "snapshot_date", "retailer_id").agg(
        F.min("current_price").alias("min_price"), F.max("current_price").alias("max_price"), F.count("*").alias("listings")
    )


def discounts(fact: DataFrame) -> DataFrame:
    """Real discounts by retailer and date."""
    cut = fact.filter(F.col("discount_amount") > 0)
    return cut.groupBy("retailer_id", "snapshot_date").agg(F.count("*").alias("n"), F.max("discount_percent").alias("max_percent"), F.min("discount_percent").alias("min_percent"))


CLASS = ["canonical_product_id", "measurement_type", "comparison_unit", "snapshot_date"]


def comparable_classes(fact: DataFrame) -> DataFrame:
    """One row for each canonical product, measurement, unit, date and retailer: its listings and unit prices."""
    rows = fact.filter("canonical_product_id is not null and measurement_type is not null and comparison_unit is not null")
    return rows.groupBy(*CLASS, "retailer_id").agg(F.count("*").alias("listings"), F.min("effective_unit_price").alias("min_unit_price"), F.max("effective_unit_price").alias("max_unit_price"))


def comparable_pairs(fact: DataFrame) -> DataFrame:
    """Pairs of retailers whose listings of a class are comparable, with the number of pairs of
    listings. Only class rows are joined, one for each retailer, never listings with listings."""
    classes = comparable_classes(fact)
    side = lambda x: classes.select(*CLASS, *[F.col(c).alias(f"{x}_{c}") for c in ("retailer_id", "listings", "min_unit_price", "max_unit_price")])
    met = side("a").join(side("b"), CLASS).filter("a_retailer_id < b_retailer_id")
    return met.withColumn("pairs", F.col("a_listings") * F.col("b_listings"))


def best_comparable(fact: DataFrame) -> DataFrame:
    """Every listing that has a comparable one at another retailer, with the cheapest such offer.

    Of each class only the two cheapest retailers matter: the second one answers for listings of
    the first. They are found by aggregation, and one row for each class is joined back, so the
    output has a row for each listing at most."""
    rows = fact.filter("canonical_product_id is not null and measurement_type is not null and comparison_unit is not null and effective_unit_price is not null")
    offer = F.struct("effective_unit_price", "retailer_id", "store_code", "retailer_product_id")
    best = rows.groupBy(*CLASS, "retailer_id").agg(F.min(offer).alias("offer"))
    cheapest = best.groupBy(*CLASS).agg(F.min("offer").alias("first"))
    second = best.join(cheapest, CLASS).filter("retailer_id <> first.retailer_id").groupBy(*CLASS).agg(F.min("offer").alias("second"))
    answers = cheapest.join(second, CLASS)
    other = F.when(F.col("retailer_id") == F.col("first.retailer_id"), F.col("second")).otherwise(F.col("first"))
    met = rows.join(answers, CLASS).withColumn("other", other)
    return met.select(*CLASS, "retailer_id", "store_code", "retailer_product_id", "effective_unit_price", *[F.col(f"other.{c}").alias(f"other_{c}") for c in ("retailer_id", "store_code", "retailer_product_id", "effective_unit_price")])


def best_offers(fact: DataFrame) -> DataFrame:
    """The cheapest listing per unit of each date, measurement and unit."""
    order = Window.partitionBy("snapshot_date", "measurement_type", "comparison_unit").orderBy("effective_unit_price", "retailer_id", "store_code", "retailer_product_id")
    return fact.filter("effective_unit_price is not null").withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place")


def lineage(fact: DataFrame, bronze: DataFrame) -> DataFrame:
    """Source file and line of every fact row."""
    source = bronze.select(F.col("bronze_record_key").alias("source_bronze_record_key"), "source_file", "source_line_number")
    return fact.join(source, "source_bronze_record_key").select("price_snapshot_id", "source_bronze_record_key", "source_file", "source_line_number")
