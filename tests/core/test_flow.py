import json

import pytest
from pyspark.sql import functions as F

from pricelake.operators import bronze, gold, landing, promo_cards, quality, silver, upsert, walk
from pricelake.sources import raw
from pricelake.sources.history import History

RUN = "store=winmart/date=2026-06-29/run_id=unit_test_run"


@pytest.fixture()
def run(tmp_path):
    folder = tmp_path / "raw" / RUN
    folder.mkdir(parents=True)
    meta = {"run_id": "unit_test_run", "store_id": "winmart", "store_name": "W", "config_api_summary": {"region": "r", "store_code": "1682", "store_group_code": "1998"}}
    (folder / "metadata.json").write_text(json.dumps(meta, indent=1))
    base = {"source_url": "http://x", "store_code": "1682", "crawl_timestamp": "2026-06-29T13:50:04+07:00"}
    rows = [
        json.dumps(base | {"source_product_id": "product-a", "product_name_raw": "Product A 3.1kg", "current_price": 135000, "listed_price": 207200, "package_size_raw": None, "raw_product": {"barcode": "8936136165974", "itemNo": "10274187"}}),
        "",
        json.dumps(base | {"source_product_id": "product-b", "store_code": "1535", "current_price": 10000}),
        "{broken",
        json.dumps({"note": 1}),
        json.dumps({"note": 1}),
        json.dumps({"source_product_id": "c", "crawled_at": "2026-06-29", "current_price": None}),
    ]
    (folder / "products.jsonl").write_text("\n".join(rows))
    (folder / "other.jsonl").write_text("{}")
    return str(tmp_path / "raw")


def records(spark, run):
    rows = raw.with_context(raw.lines(spark, run), raw.metadata(spark, run))
    return bronze.split_valid(rows)


def test_bronze(spark, run):
    valid, invalid = records(spark, run)
    got = {r.source_line_number: r for r in bronze.envelope(valid).collect()}
    assert sorted(got) == [1, 3, 5, 6, 7] and [r.source_line_number for r in invalid.collect()] == [4]
    assert got[1].quality_status == "WARN" and got[1].quality_warnings == ["package_size_null"] and got[1].run_id == "unit_test_run"
    assert got[3].quarantine_reasons == ["store_code_mismatch"]
    assert got[5].quarantine_reasons == ["missing_raw_payload_identity"] and (got[5].payload_occurrence_index, got[6].payload_occurrence_index) == (1, 2)
    assert got[7].observed_at == "2026-06-29" and "missing_observed_at" in got[7].quality_warnings
    assert len({r.bronze_record_key for r in got.values()}) == 5
    again = {r.source_line_number: r.bronze_record_key for r in bronze.envelope(valid).collect()}
    assert again == {k: r.bronze_record_key for k, r in got.items()}
    metrics = {(r.metric, r.key): r.value for r in bronze.run_metrics(bronze.envelope(valid), invalid).collect()}
    assert metrics["quarantine_records", "all"] == 3 and metrics["invalid_json_records", "all"] == 1 and metrics["duplicate_bronze_keys", "all"] == 0


def test_silver(spark, run):
    valid, _ = records(spark, run)
    b = bronze.envelope(valid).withColumnsRenamed({"payload": "raw_payload", "run_store_code": "store_code"}).withColumn("ingested_at", F.lit("x"))
    products, observations = silver.products(b, "now").collect(), silver.observations(b, "now").collect()
    assert [(p.measurement_base_quantity, p.barcode, p.barcode_source) for p in products] == [(3100.0, "8936136165974", "source_barcode")]
    assert len(observations) == 1 and observations[0].data_quality_status == "warning" and float(observations[0].discount_amount) == 72200
    assert {r.skip_reason: r.records for r in silver.skip_counts(b).collect()} == {"kept": 1, "quarantine": 3, "missing_current_price": 1}


def test_line_numbers_over_splits(spark, tmp_path):
    folder = tmp_path / "r" / "x"
    folder.mkdir(parents=True)
    (folder / "products.jsonl").write_text("\n".join("" if i % 10 == 9 else f'{{"i": {i}}}' for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4kb")
    try:
        got = raw.lines(spark, str(tmp_path / "r")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 3600 and all(json.loads(r.line)["i"] == r.source_line_number - 1 for r in got)


OBS = "observation_id string, retailer_product_id string, retailer_id string, store_code string, observed_at string, observation_date string, listed_price double, promo_price double, current_price double, discount_amount double, discount_percent double, availability_status string, is_on_promotion boolean, data_quality_status string, source_run_id string, source_bronze_record_key string, normalized_at string"
PROD = "retailer_product_id string, product_name string, brand string, category_raw string, unit_price_publishable boolean, package_total_base_quantity double, measurement_base_unit string, measurement_type string"


def fact(spark, observations):
    products = spark.createDataFrame([("p1", "A", "b", "c", True, 1500.0, "ml", "volume"), ("p2", "B", "b", "c", False, None, None, "unknown")], PROD)
    return gold.price_snapshot(spark.createDataFrame(observations, OBS), products)


def obs(i, product, at, price, status="valid", store="s"):
    return (i, product, "r", store, at, at[:10], None, None, price, None, None, "unknown", False, status, "run", "k" + i, None)


def test_gold(spark):
    rows = [obs("old", "p1", "2026-06-29T10:00", 45000.0), obs("new", "p1", "2026-06-29T12:00", 42000.0), obs("p2", "p2", "2026-06-29T12:00", 25000.0, "warning")]
    got = {r.observation_id: r for r in fact(spark, rows).collect()}
    assert set(got) == {"new", "p2"} and float(got["new"].effective_unit_price) == 28 and got["new"].comparison_unit == "ml" and got["p2"].effective_unit_price is None
    assert gold.selection_stats(spark.createDataFrame(rows, OBS)).first().duplicate_groups == 1
    assert quality.verdict(quality.snapshot_issues(fact(spark, rows))).first().status == "passed"


def test_newest_quarantined_and_null_status(spark):
    rows = [obs("a", "p1", "2026-01-01T10", 1.0), obs("b", "p1", "2026-01-01T11", 2.0, "quarantined"), obs("c", "p1", "2026-01-02T10", 3.0, None, ""), obs("d", "p9", "2026-01-02T10", 3.0)]
    got = fact(spark, rows).collect()
    assert [(r.observation_id, r.store_code) for r in got] == [("c", "unknown_store")]
    issues = {r.rule_id for r in quality.snapshot_issues(fact(spark, [obs("a", "p1", "2026-01-01T10", -1.0)])).collect()}
    assert {"non_positive_current_price", "invalid_unit_price_formula"} <= issues


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "h")
    make = lambda rows, extra="": spark.createDataFrame(rows, "id string, at int, v string, day string" + extra)
    upsert.upsert(path, make([("a", 2, "old", "d1"), ("b", 2, "keep", "d1"), ("c", 1, "c", "d2")]), ["id"], "at", "day")
    batch = make([("a", 3, "new", "d1", "x"), ("b", 1, "late", "d1", "x"), ("z", 1, "z", "d3", "x")], ", more string")
    for _ in range(2):
        upsert.upsert(path, batch, ["id"], "at", "day")
        got = {r.id: (r.v, r.more) for r in History(spark, path, "day").read().collect()}
        assert got == {"a": ("new", "x"), "b": ("keep", None), "c": ("c", None), "z": ("z", "x")}


def test_promo_cards(spark):
    text = "Mua 2 chai tặng 1 chai\nNuoc suoi Lavie\nMUA 2 CHAI TANG 1 chai\n12.000₫"
    row = spark.createDataFrame([(text, None)], "card string, anchor string").select(promo_cards.phrases(F.col("card")).alias("p"), promo_cards.product_name(F.col("anchor"), F.col("card")).alias("n"), promo_cards.mechanic(F.lit("Mua 3 hộp với giá 99.000")).alias("m")).first()
    assert row.p == ["Mua 2 chai tặng 1 chai"] and row.n == "Nuoc suoi Lavie" and row.m.bundle_price == 99000 and float(row.m.effective_unit_price) == 33000
    wide = spark.createDataFrame([("Mua 2 chai\nđược\ntặng 1 chai",)], "card string").select(promo_cards.phrases(F.col("card"))).first()[0]
    assert wide == ["Mua 2 chai được tặng 1 chai"]


def test_walk_and_pages(spark):
    deep = '{"a":' * 15 + '{"Title":"z","salePrice":"} ] \\\\\\" {"}' + "}" * 15
    rows = spark.createDataFrame([('{"a":[{"name":"x","price":1,"in":{"name":"y","id":2,"skuNo":"1"}},{"name":"no","id":3}]}',), (deep,), (None,), ("[]",)], "line string")
    assert {json.loads(r.product).get("name") or json.loads(r.product)["Title"] for r in walk.product_walk(rows).collect()} == {"x", "y", "z"}
    assert walk.product_walk(rows.limit(0)).count() == 0
    html = spark.createDataFrame([(1, '<a class="c" href="/p--s123?x">p</a><a href="/c-i.77">c</a><script id="__NEXT_DATA__" type="j">{"props":{"n":5}}</script>')], "page_id long, html string")
    got = {r.href: (r.item_no, r.category_id) for r in landing.page_links(html).collect()}
    assert got == {"/p--s123?x": ("123", None), "/c-i.77": (None, "77")}
    assert html.select(F.variant_get(landing.embedded_json(F.col("html")), "$.props.n", "int")).first()[0] == 5
