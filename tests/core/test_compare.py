import json
import time

from pyspark.sql import functions as F

from pricelake.operators import entities, identity, landing, reconcile, serving, walk

SIDE = "k string, x double, s string, b boolean"


def findings(spark, left, right, fields, keys=("k",), schemas=(SIDE, SIDE)):
    e, a = (spark.createDataFrame(rows, schema).repartition(3) for rows, schema in zip((left, right), schemas))
    found = reconcile.parity(e, a, list(keys), fields)
    return {(r.finding, r.field): r.rows for r in found.collect() if r.rows}, reconcile.parity_verdict(found).first()


def test_parity(spark):
    rows = [(f"k{i}", i / 7, f"s{i}", i % 2 == 0) for i in range(500)]
    assert findings(spark, rows, rows[::-1], ["x", "s", "b"])[0] == {}
    other = [(k, x + 5e-5, s, b) for k, x, s, b in rows]
    assert findings(spark, rows, other, ["x", "s", "b"]) == ({}, (True, True))
    other = [(k, None if i == 3 else x + (0.1 if i == 4 else 0), None if i == 5 else s, not b if i == 6 else b) for i, (k, x, s, b) in enumerate(rows)]
    got, verdict = findings(spark, rows, other[1:] + [("new", 1.0, "", True)], ["x", "s", "b"])
    assert got == {("missing_keys", None): 1, ("extra_keys", None): 1, ("field_mismatch", "x"): 2, ("field_mismatch", "s"): 1, ("field_mismatch", "b"): 1}
    assert tuple(verdict) == (False, True)


def test_parity_of_repeated_keys_nulls_and_missing_columns(spark):
    rows = [("a", 1.0, "x", True), ("a", 2.0, "y", True), ("b", None, None, None), (None, 1.0, "x", True)]
    assert findings(spark, rows, [*rows[1::-1], rows[2]], ["x", "s"])[0] == {("repeated_rows", "expected"): 1, ("repeated_rows", "actual"): 1}
    got, verdict = findings(spark, rows, [("a", 1.0), ("b", None)], ["x", "s"], schemas=(SIDE, "k string, x double"))
    assert got == {("repeated_rows", "expected"): 1, ("missing_column", "s"): 1}
    assert tuple(verdict) == (True, False)
    assert findings(spark, [], [], ["x"])[0] == {}


def test_comparable_offers_are_linear_in_listings(spark):
    row = lambda c, r, s, p, price: (c, "mass", "g", "d", r, s, p, price)
    rows = [row("c1", f"r{i % 3}", "s", f"p{i}", float(10 + i)) for i in range(300)] + [row(None, "r1", "s", "x", 1.0), row("c2", "r1", "s", "y", 1.0), row("c1", "r0", "s", "z", None)]
    fact = spark.createDataFrame(rows, "canonical_product_id string, measurement_type string, comparison_unit string, snapshot_date string, retailer_id string, store_code string, retailer_product_id string, effective_unit_price double")
    pairs = {(r.a_retailer_id, r.b_retailer_id): r.pairs for r in serving.comparable_pairs(fact).collect()}
    assert pairs == {("r0", "r1"): 101 * 100, ("r0", "r2"): 101 * 100, ("r1", "r2"): 100 * 100}
    best = serving.best_comparable(fact).collect()
    assert len(best) == 300
    assert {(r.retailer_id, r.other_retailer_product_id) for r in best} == {("r0", "p1"), ("r1", "p0"), ("r2", "p0")}


def test_rows_without_keys_meet_in_no_join(spark):
    columns = "retailer_product_id string, retailer_id string, barcode string, brand string, product_name string, measurement_type string, measurement_base_quantity double, measurement_base_unit string, selling_unit_count double"
    rows = [(f"p{i}", f"r{i % 2}", None, None, None, None, None, None, None) for i in range(40)]
    rows += [("q1", "r0", "8936136165974", "b", "n", "mass", 1.0, "g", 1.0), ("q2", "r1", "8936136165974", "c", "m", "mass", 1.0, "g", 1.0), ("q3", "r1", None, "B", "N", "mass", 1.0, "g", 1.0)]
    got = {r.retailer_product_id: r.match_method for r in identity.map_products(spark.createDataFrame(rows, columns)).collect()}
    assert len(got) == 43 and {k: v for k, v in got.items() if v != "none"} == {"q1": "barcode_exact", "q2": "barcode_exact", "q3": "attributes_exact"}

    bronze = spark.createDataFrame([(f"b{i}", None, "r") for i in range(5)] + [("k", "s", "r")], "bronze_record_key string, store_code string, retailer_id string")
    seen = spark.createDataFrame([("k", "o", "p", "d", 1.0, None, 1.0, "VND", False, False, True)], "source_bronze_record_key string, observation_id string, retailer_product_id string, observation_date string, listed_price double, promo_price double, current_price double, currency string, is_price_discount boolean, has_promo_mechanic boolean, is_on_promotion boolean")
    products = spark.createDataFrame([("p", "name", "cat")], "retailer_product_id string, product_name string, category_raw string")
    rows = {r.bronze_record_key: (r.product_name, r.store_code) for r in entities.joined(bronze, seen, products).collect()}
    assert rows == {**{f"b{i}": (None, "unknown_store") for i in range(5)}, "k": ("name", "s")}


def test_store_context_over_time(spark):
    contexts = spark.createDataFrame([("r", "2024-01-02 10:00:00", "a", "g", "x", None), ("r", "2024-01-02 18:00:00", "b", "g", "x", "B"), ("r", "2024-01-09 00:00:00", "c", "g", "x", "C"), ("r", "2025-01-01 00:00:00", "later", "g", "x", "C")], "retailer_id string, t string, store_code string, store_group_code string, address_context string, branch_name string")
    contexts = contexts.withColumn("valid_from", F.to_timestamp("t")).drop("t")
    times = ["2024-01-01 00:00:00", "2024-01-02 09:59:59", "2024-01-02 10:00:00", "2024-01-02 17:00:00", "2024-01-02 18:00:00", "2024-01-05 00:00:00", "2024-01-08 23:59:59", "2024-01-09 00:00:00", "2024-03-01 00:00:00"]
    rows = [(i, "r", t, "own") for i, t in enumerate(times)] + [(99, "other", times[4], "own"), (98, "r", None, "own"), (97, None, times[4], None)]
    records = spark.createDataFrame(rows, "id int, retailer_id string, t string, branch_name string").withColumn("observed_at", F.to_timestamp("t")).drop("t")
    got = {r.id: (r.store_code, r.branch_name) for r in landing.with_store_context(records, contexts).collect()}
    assert [got[i][0] for i in range(len(times))] == [None, None, "a", "a", "b", "b", "b", "c", "c"]
    assert got[2] == ("a", "own") and got[4] == ("b", "B") and got[99] == (None, "own") and got[98] == (None, "own") and got[97] == (None, None)
    assert landing.with_store_context(records.limit(0), contexts).count() == 0 and landing.with_store_context(records, contexts.limit(0)).count() == len(rows)


def test_walk_of_deep_payloads(spark):
    depth = 500
    deep = '{"a":[' * depth + '{"name":"x","price":1}' + "]}" * depth
    rows = spark.createDataFrame([(i, deep.replace('"x"', f'"x{i}"')) for i in range(50)] + [(99, '{"a":' * 200_000), (98, "[1"), (97, '{"name":"x0","price":1}')], "id int, line string")
    start = time.time()
    assert walk.product_walk(rows).count() == 50
    menu = '{"children":[' * depth + '{"url":"/u/","name":"leaf"}' + '],"name":"n","url":"same"}' * depth
    got = walk.menu_categories(spark.createDataFrame([(1, menu)], "page int, line string"), "page").collect()
    assert {(r.url, r["name"], r.parent_name) for r in got} == {("u", "leaf", "n"), ("same", "n", "n")}
    assert time.time() - start < 30


def test_walk_order_and_stops():
    value = json.loads('{"z":{"url":"u","name":"first"},"name":"top","children":[{"url":"u","name":"child"}],"a":{"url":"/u/","name":"last"}}')
    assert [n[1] for n in walk.menu_nodes(value)] == ["child", "first", "last"]
    nested = {"name": "o", "price": 1, "in": [{"title": "i", "salePrice": 2}], "more": {"x": {"Name": "n", "sku": 1}}}
    assert [n.get("name") or n.get("title") or n.get("Name") for n in walk.objects(nested) if walk.looks_like_product(n)] == ["o", "i", "n"]
    assert [n["name"] for n in walk.objects([nested], walk.looks_like_product)] == ["o"]
