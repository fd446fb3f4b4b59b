"""Queries over further fields of landed payloads, merge counts and configuration, and the same in SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from pricelake.operators import landing, promo_cards, quality, taxonomy
from pricelake.plans import views
from pricelake.plans.landing_queries import CARDS, PRODUCTS, _text, card_products, cards, payloads, pk, price
from pricelake.plans.queries import _entity_rows, query
from pricelake.sources.shared import Files, shared_folder
from pricelake.operators import entities


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'VN' WHEN 1 THEN p_brand ELSE '' END AS origin, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size * 1000 - 100 AS BIGINT) END AS member_price,
  CASE WHEN p_partkey % 2 = 0 THEN '2024-01-01' WHEN p_partkey % 5 = 0 THEN '10:00' ELSE '' END AS sale_start_at, CASE WHEN p_partkey % 2 = 0 THEN '2024-02-01' ELSE '' END AS sale_end_at, 'c' || (p_partkey % 4) AS category_id, p_type AS category_name FROM part""")
def landing_go_fields(spark, sf_dir):
    key = F.when(pk() % 3 == 0, "Xuất xứ").when(pk() % 3 == 1, "Nơi sản xuất tại").otherwise("khác")
    detail = F.array(F.struct(key.alias("name"), F.when(pk() % 3 == 0, " VN ").otherwise(F.col("p_brand")).alias("value")))
    even = lambda value: F.when(pk() % 2 == 0, value)
    rows = payloads(spark, sf_dir, name=F.col("p_name"), price=price(), promotion_price=price() + 1, image=F.lit("http://i"), id=pk(), detail=detail, member_price=even(price() - 100), category_id=_text("c", pk() % 4), category_name=F.col("p_type"),
                    member_price_start_date=even(F.lit("2024-01-01")), member_price_start_time=F.when(pk() % 5 == 0, "10:00"), member_price_end_date=even(F.lit(" 2024-02-01 ")))
    return landing.go_offers(rows).select(F.col("product_id").cast("bigint").alias("p_partkey"), "origin", "member_price", "sale_start_at", "sale_end_at", "category_id", "category_name")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_partkey || ':' || p_type || ':en:' || ';2:' || p_brand || '::s' END AS categories FROM part""")
def landing_mm_categories(spark, sf_dir):
    kinds = F.array(F.struct(pk().alias("id"), F.concat(F.lit(" "), F.col("p_type")).alias("name"), F.lit("en").alias("name_en"), F.lit(None).cast("string").alias("slug")), F.struct(F.lit(2).cast("long").alias("id"), F.col("p_brand").alias("name"), F.lit(None).cast("string").alias("name_en"), F.lit("s").alias("slug")))
    rows = payloads(spark, sf_dir, name=F.col("p_name"), slug=F.lit("s"), thumbnail_image=F.lit("http://i"), sale_price=price(), categories=F.when(pk() % 3 != 0, kinds), id=pk())
    shown = F.array_join(F.transform("categories", lambda x: F.concat_ws(":", x["id"], x["name"], x["name_en"], x["slug"])), ";")
    return landing.mm_offers(rows).select(F.col("product_id").cast("bigint").alias("p_partkey"), shown.alias("categories"))


@query("""SELECT p_name AS name, CAST(CASE p_partkey % 3 WHEN 0 THEN p_size * 1000 WHEN 1 THEN p_size * 900 ELSE p_size * 800 END AS DOUBLE) AS sale_price, CAST(CASE p_partkey % 3 WHEN 0 THEN p_size * 2000 WHEN 1 THEN p_size * 1000 END AS DOUBLE) AS original_price,
  'http://i/' || p_partkey || CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '/src' WHEN 2 THEN '/head' ELSE '/url' END AS image, CASE WHEN p_partkey % 2 = 0 THEN 'https://www.bachhoaxanh.com/p' || p_partkey ELSE 'http://x/p' || p_partkey END AS url, CASE WHEN p_partkey % 3 = 1 THEN '10%' WHEN p_partkey % 3 = 0 THEN '-5' ELSE '' END AS discount FROM part""")
def landing_bhx_walk(spark, sf_dir):
    """Products outside the category API: prices beside or inside entries, images as text, object or list."""
    size, text = F.col("p_size"), F.lit(None).cast("string")
    entry = lambda p, s, d: F.struct(p.cast("bigint").alias("price"), s.cast("bigint").alias("sysPrice"), d.alias("discountPercent"))
    prices = F.when(pk() % 3 == 1, F.array(entry(size * 850, text, text), entry(size * 900, size * 1000, F.lit("10%"))))
    link = _text("http://i/", pk())
    picture = F.when(pk() % 4 == 0, F.to_variant_object(F.array(link))).when(pk() % 4 == 1, F.to_variant_object(F.struct(F.concat(link, F.lit("/src")).alias("src"), F.lit("small").alias("small"))))
    picture = picture.when(pk() % 4 == 2, F.parse_json(F.concat(F.lit('"'), link, F.lit('/head"')))).otherwise(F.to_variant_object(F.array(F.struct(F.concat(link, F.lit("/url")).alias("url"), F.lit("l").alias("large")))))
    rows = views.parts(spark, sf_dir).select(F.to_variant_object(F.struct(
        F.col("p_name").alias("displayName"), prices.alias("productPrices"), F.when(pk() % 3 == 0, size * 1000).alias("finalPrice"), F.when(pk() % 3 == 2, _text(size * 800, "₫")).alias("discount_price"),
        F.when(pk() % 3 == 0, size * 2000).alias("marketPrice"), picture.alias("picture"), F.when(pk() % 2 == 0, _text("p", pk())).otherwise(_text("http://x/p", pk())).alias("slug"), F.when(pk() % 3 == 0, "-5").alias("discount"),
    )).alias("payload"))
    return landing.bhx_walk_offers(rows).select("name", F.col("sale_price").cast("double").alias("sale_price"), F.col("original_price").cast("double").alias("original_price"), "image", "url", "discount")


@query("""SELECT p_partkey AS product_id, CASE WHEN p_partkey % 2 = 0 THEN '{"crmProgramId": ' || p_partkey || ', "startTime": "t"}' ELSE p_type END AS promotion FROM part""")
def bhx_compact_promotions(spark, sf_dir):
    """Promotion objects without a text are described by their other fields."""
    gift = F.array(F.struct(F.when(pk() % 2 == 1, F.col("p_type")).alias("content"), F.lit("t").alias("startTime"), pk().alias("crmProgramId"), F.lit("").alias("dueTime"), F.lit(1).alias("other")))
    entry = F.array(F.struct(price().alias("price")))
    rows = payloads(spark, sf_dir, name=F.col("p_name"), productPrices=entry, gifts=gift, id=pk())
    return landing.bhx_offers(rows).select(F.col("product_id").cast("bigint").alias("product_id"), "promotion")


@query("""SELECT p_partkey, CAST(CASE WHEN p_partkey % 2 = 0 THEN p_size * 100 END AS DOUBLE) AS discount_amount, CAST(CASE WHEN p_partkey % 3 = 0 THEN 12.5 END AS DOUBLE) AS discount_percent, p_brand AS brand_raw, p_type AS category_raw, p_container AS package_size_raw, 'from' AS promotion_start_date
FROM (SELECT *, 'size ' || p_size AS p_container FROM part)""")
def landing_winmart_fields(spark, sf_dir):
    rows = payloads(spark, sf_dir, id=pk(), saveAmount=F.when(pk() % 2 == 0, F.col("p_size") * 100), DISCOUNTRATE=F.when(pk() % 3 == 0, F.lit(12.5)), manufacturer=F.col("p_brand"), cateName=F.concat(F.lit(" "), F.col("p_type")), volume=_text("size ", F.col("p_size")), startDate=F.lit("from"))
    done = landing.winmart_offers(rows)
    return done.select(F.col("source_product_id").cast("bigint").alias("p_partkey"), F.col("discount_amount").cast("double").alias("discount_amount"), F.col("discount_percent").cast("double").alias("discount_percent"), "brand_raw", "category_raw", "package_size_raw", "promotion_start_date")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'p' || p_partkey ELSE 's' || p_partkey END AS source_product_id, CASE WHEN p_partkey % 3 = 0 THEN 'http://p' ELSE 'http://u' END AS source_url, 'x' AS store_code, '{"crawled_at":"t","name":"' || p_name || '","original_price":' || p_size * 1000 || ',' || '"p_partkey":' || p_partkey || ',' || CASE WHEN p_partkey % 2 = 0 THEN '"product_id":"p' || p_partkey || '",' ELSE '"product_id":"",' END || CASE WHEN p_partkey % 3 = 0 THEN '"product_url":"http://p",' ELSE '"product_url":null,' END ||
  '"promotion":"","sale_price":' || p_size * 900 || ',"sku":"s' || p_partkey || '","store_site_code":"x","url":"http://u"}' AS raw_product FROM part""")
def raw_products(spark, sf_dir):
    """The offer as it came, kept beside the canonical columns."""
    rows = views.read(spark, sf_dir, "part").select(pk(), F.col("p_name").alias("name"), (F.col("p_size") * 900).alias("sale_price"), (F.col("p_size") * 1000).alias("original_price"), F.lit("").alias("promotion"), F.when(pk() % 2 == 0, _text("p", pk())).otherwise("").alias("product_id"),
                                                 _text("s", pk()).alias("sku"), F.lit("x").alias("store_site_code"), F.when(pk() % 3 == 0, "http://p").alias("product_url"), F.lit("http://u").alias("url"), F.lit("t").alias("crawled_at"))
    return landing.envelope(rows, "go").select("p_partkey", "source_product_id", "source_url", "store_code", F.to_json("raw_product").alias("raw_product"))


@query("WITH " + CARDS + ", " + PRODUCTS + """, m AS (SELECT CASE WHEN m = 2 THEN 'no_uom_hint' WHEN k % 3 = 2 THEN 'no_product_uoms' WHEN (k % 3 = 0 AND m IN (0, 3)) OR (k % 3 = 1 AND m = 1) THEN 'matched' ELSE 'unmatched' END AS status FROM promos JOIN products USING (item_no))
SELECT (SELECT count(*) FROM products) AS products_read, (SELECT count(*) FROM promos) AS promo_cards_read, (SELECT count(*) FROM promos WHERE item_no IS NULL) AS promo_cards_without_item_no, (SELECT count(*) FROM promos WHERE item_no IS NULL OR item_no NOT IN (SELECT item_no FROM products)) AS promo_cards_unmatched,
  (SELECT string_agg(status || ':' || n, ',' ORDER BY status) FROM (SELECT status, count(*) AS n FROM m GROUP BY 1)) AS uom_match_status_counts""")
def promo_merge_counts(spark, sf_dir):
    promos = promo_cards.promo_rows(cards(spark, sf_dir))
    attached = promo_cards.attach(card_products(spark, sf_dir), promos)
    statuses = attached.select(F.explode("uom_statuses").alias("uom_match_status"))
    row = promo_cards.merge_summary(attached, promos, statuses)
    shown = F.array_join(F.transform(F.map_entries("uom_match_status_counts"), lambda e: F.concat_ws(":", e["key"], e["value"])), ",")
    return row.select("products_read", "promo_cards_read", "promo_cards_without_item_no", "promo_cards_unmatched", shown.alias("uom_match_status_counts"))


@query("""SELECT p_type AS category, count(*) AS candidates, count(*) FILTER (p_partkey % 2 = 0) AS discounted, count(*) FILTER (p_partkey % 2 = 0 AND p_partkey % 3 = 0 AND p_brand <> 'Brand#1') AS written FROM part GROUP BY 1""")
def written_counts(spark, sf_dir):
    rows = views.read(spark, sf_dir, "part").select(pk(), "p_brand", F.col("p_type").alias("category"), price().alias("sale_price"), F.when(pk() % 2 == 0, price() + 1).otherwise(price()).alias("original_price"))
    return landing.landing_counts(rows, "category", rows.filter((pk() % 6 == 0) & (F.col("p_brand") != "Brand#1")))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN 'c' || p_partkey END AS category_code, CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS category_name, CASE WHEN p_partkey % 4 <> 0 THEN 's' END AS slug FROM part""")
def page_categories(spark, sf_dir):
    data = F.to_json(F.struct(F.struct(F.struct(F.struct(_text("c", pk()).alias("categoryCode"), F.col("p_type").alias("name")).alias("data"), F.lit("s").alias("slug")).alias("pageProps")).alias("props")))
    html = F.concat(F.lit("<html><script>var a={}</script>"), F.when(pk() % 4 != 0, F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script>"))).otherwise(""), F.lit("</html>"))
    found = landing.page_category(F.col("html"))
    return views.read(spark, sf_dir, "part").select("p_partkey", html.alias("html")).select("p_partkey", found.alias("c")).select("p_partkey", "c.category_code", "c.category_name", "c.slug")


@query("""WITH o AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) SELECT 'price_discount_missing_current_price' AS rule_id, 'BLOCK_PUBLISH' AS severity, 1 AS n""")
def entity_issues(spark, sf_dir):
    """One price discount lost its price; one item its promotion, and so on, as small changes of the real entities."""
    rows = _entity_rows(spark, sf_dir)
    promotions, items = entities.promotions(rows), entities.promotion_items(rows)
    first = promotions.filter("promotion_type = 'price_discount'").agg(F.min("promotion_id").alias("first"))
    broken = promotions.join(F.broadcast(first)).withColumn("current_price", F.when(F.col("promotion_id") != F.col("first"), F.coalesce("current_price", F.lit(1.0))))
    return quality.entity_issues(broken.filter("promotion_type = 'price_discount' or current_price is not null").unionByName(promotions.filter("promotion_type <> 'price_discount'").withColumn("first", F.lit(None).cast("string"))), items, items.select("retailer_product_id").distinct()).withColumn("n", F.col("n").cast("int"))


#: Categories and rules as a reviewed configuration has them, for the part types.
CONFIG = {
    "canonical_categories": [{"canonical_category_id": c, "canonical_category_name": c.upper()} for c in ("plain", "promo", "none")],
    "mappings": [{"retailer_id": f"r{r}", "match_type": "exact_leaf", "value": v, "canonical_category_id": c} for r, v, c in ((0, "ECONOMY", "plain"), (0, " economy ", "none"), (1, "Promo", "promo"), (2, "Small", "undeclared"))],
}


@query("""SELECT category_raw, retailer_id, CASE WHEN retailer_id = 'r0' AND lower(category_raw) = 'economy' THEN 'plain' WHEN retailer_id = 'r1' AND lower(category_raw) = 'promo' THEN 'promo' WHEN retailer_id = 'r2' AND lower(category_raw) = 'small' THEN 'undeclared' END AS canonical_category_id, CAST(1 AS BIGINT) AS undeclared_rules
FROM (SELECT DISTINCT p_type AS category_raw, 'r' || (p_partkey % 5) AS retailer_id FROM part)""")
def taxonomy_config(spark, sf_dir):
    """Rules read from a configuration file, checked against its categories, applied to the parts."""
    path = f"{shared_folder(spark, 'config')}.json"
    Files(spark).put(path, json.dumps(CONFIG))
    declared, rules = taxonomy.read_config(spark, path)
    wrong = taxonomy.check_rules(rules, declared).agg(F.count("*").alias("undeclared_rules"))
    mapped = taxonomy.map_categories(views.listings(spark, sf_dir), rules)
    return mapped.select("category_raw", "retailer_id", "canonical_category_id").distinct().join(F.broadcast(wrong))
