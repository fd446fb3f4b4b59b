import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from pricelake.operators import entities, gold, landing, walk
from pricelake.plans import landing_queries, views


def test_a_price_of_zero_is_part_of_an_offer(spark):
    schema = "retailer_id string, store_code string, retailer_product_id string, observation_date string, listed_price double, promo_price double, current_price double, offer_text_raw string, product_name string, is_on_promotion boolean, is_price_discount boolean, has_promo_mechanic boolean"
    rows = [("r", "s", "p", "2024-01-01", listed, None, current, None, "n", True, True, False) for listed, current in ((0.0, 0.0), (None, 0.0), (1.5, -0.0), (None, None))]
    got = [r.promotion_id for r in entities.offers(spark.createDataFrame(rows, schema)).select("promotion_id").collect()]
    texts = ("0||0", "||0", "1.5||0", "||")
    assert got == ["promo_" + hashlib.sha256(f"r|s|p|2024-01-01|price_discount|{t}|".encode()).hexdigest()[:24] for t in texts]


@pytest.mark.parametrize("adapter", [landing.bhx_offers, landing.bhx_walk_offers, landing.winmart_offers])
def test_a_payload_is_taken_apart_once(spark, adapter):
    """Filters above an adapter's columns don't hold copies of the expressions behind these."""
    lines = ['{"Name":"first","name":"second","price":"1.000đ","url":"/u","gifts":[{"title":" g "},7,null,{"startTime":"t"}],"combos":"c","id":5,"productPrices":[{"price":1000}]}']
    rows = spark.createDataFrame([(x,) for x in lines], "line string").select(F.try_parse_json("line").alias("payload"))
    offers = adapter(rows)
    plan = offers._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"try_variant_get\(payload#\d+, \$, MapType", plan)) == 1
    got = offers.first().asDict()
    assert got.get("name", got.get("product_name_raw")) == "first"
    if adapter is landing.bhx_offers:
        assert got["promotion"] == 'c; g; 7; {"startTime": "t"}' and got["sale_price"] == 1000


def test_objects_of_one_shape_are_judged_once():
    walk._of_product.cache_clear()
    deep = json.loads('{"x":[' * 300 + '{"name":"n","price":1}' + "]}" * 300)
    assert len([n for n in walk.objects(deep, walk.looks_like_product) if walk.looks_like_product(n)]) == 1
    assert walk._of_product.cache_info().misses == 2


def test_parts_of_one_small_file_are_dealt_to_tasks(spark, tmp_path):
    rows = spark.range(5000).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), F.lit(7).alias("p_size"), F.lit(1.0).alias("p_retailprice"))
    rows.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    at = (spark, str(tmp_path))
    for made in (views.parts(*at), views.listings(*at), views.listings_x(*at), landing_queries.cards(*at), landing_queries.payloads(*at, id=F.col("p_partkey"))):
        assert made.rdd.getNumPartitions() > 1 and made.count() >= 5000


def test_observations_are_shuffled_once_into_bounded_tasks(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1704067200).alias("ts"), (F.col("id") % 50).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 3}').alias("props"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    assert views.dealt(rows, 1_000_000, "user_id", 200_000).rdd.getNumPartitions() == 5
    latest = gold.latest_observations(views.dealt_observations(spark, str(tmp_path)))
    assert len(re.findall(r"Exchange \w+", latest._jdf.queryExecution().executedPlan().toString())) == 1
    assert latest.count() == 50
