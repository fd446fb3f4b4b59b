"""Landing and promotion-card queries over payloads made of the given tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.functions import numbers
from pricelake.operators import landing, promo_cards, upsert, walk
from pricelake.operators.dedupe import dedupe, merge_fields
from pricelake.plans import views
from pricelake.plans.queries import doubles, query
from pricelake.sources import raw


def pk():
    return F.col("p_partkey")


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def payloads(spark, sf_dir, **fields):
    """The parts as payloads of one retailer."""
    rows = views.parts(spark, sf_dir)
    return rows.select(pk(), F.try_parse_json(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))).alias("payload"))


def as_lines(rows):
    """The payloads as the text of a line."""
    return rows.select(pk(), F.to_json("payload").alias("line"))


def price():
    """A part's whole price, the same in both engines."""
    return (F.col("p_size") * 1000).cast("bigint")


def listed_price():
    return F.when(pk() % 4 == 0, price()).when(pk() % 4 == 1, price() + 500).when(pk() % 4 == 2, price() * 2)


@query("""SELECT 'Ring ' || p_partkey AS name, 'https://go-vietnam.vn/products/a-i.' || p_partkey AS url, CAST(CASE WHEN p_partkey % 5 = 0 THEN p_size * 1000 - 100 ELSE p_size * 1000 END AS BIGINT) AS sale_price,
  CAST(CASE p_partkey % 4 WHEN 1 THEN p_size * 1000 + 500 WHEN 2 THEN p_size * 2000 END AS DOUBLE) AS original_price, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS brand
FROM part WHERE p_partkey % 9 <> 0 AND (p_partkey % 4 IN (1, 2) OR p_partkey % 5 = 0)""")
def landing_go(spark, sf_dir):
    detail = F.array(F.struct(F.lit("Xuất xứ").alias("name"), F.lit("VN").alias("value")), F.struct(F.when(pk() % 2 == 0, "Thương hiệu").otherwise("Khác").alias("name"), F.col("p_brand").alias("value")))
    rows = payloads(spark, sf_dir, name=_text(" Ring  ", pk()), price=_text(price(), " đ"), promotion_price=listed_price(), member_price=F.when(pk() % 5 == 0, price() - 100), image=F.when(pk() % 9 != 0, "http://i/x.jpg").otherwise("x.jpg"), alias=F.lit("a"), id=pk(), detail=detail)
    return landing.go_offers(rows).select("name", "url", "sale_price", F.col("original_price").cast("double").alias("original_price"), "brand")


@query("""SELECT p_name AS name, CAST(p_size * 1000 AS BIGINT) AS sale_price, CAST(CASE p_partkey % 4 WHEN 1 THEN p_size * 1000 + 500 WHEN 2 THEN p_size * 2000 END AS DOUBLE) AS original_price,
  p_type || ',' || p_brand AS labels, strftime(make_timestamp((1700000000 + p_partkey) * 1000000) + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS sale_start_at FROM part WHERE p_partkey % 6 <> 0""")
def landing_lotte(spark, sf_dir):
    vnd = F.struct(price().alias("special_price"), listed_price().alias("price"), (pk() + 1700000000).alias("special_from_date"))
    url = F.when(pk() % 6 != 0, "https://www.lottemart.vn/product/1").otherwise("https://other/product/1")
    rows = payloads(spark, sf_dir, name=F.col("p_name"), price=F.struct(vnd.alias("VND")), image_url=F.lit("https://i/x"), url=url, label=F.array(F.struct(F.col("p_type").alias("name")), F.struct(F.lit(" ").alias("name")), F.struct(F.col("p_brand").alias("name"))))
    return landing.lotte_offers(rows).select("name", "sale_price", F.col("original_price").cast("double").alias("original_price"), F.array_join("labels", ",").alias("labels"), "sale_start_at")


@query("""SELECT p_partkey AS product_id, CAST(CASE WHEN p_partkey % 3 = 0 THEN p_size * 1000 - 100 ELSE p_size * 1000 END AS BIGINT) AS sale_price,
  CAST(CASE WHEN p_partkey % 4 = 0 AND p_partkey % 3 = 0 THEN p_size * 1000 WHEN p_partkey % 4 = 1 THEN p_size * 1000 + 500 WHEN p_partkey % 4 = 2 THEN p_size * 2000 END AS DOUBLE) AS original_price,
  p_type || '; second' AS promotion, '2024-01-0' || (1 + p_partkey % 3) || 'T00:00:00+07:00' AS sale_start_at, '2024-02-01T10:00:00+07:00' AS sale_end_at FROM part""")
def landing_mm(spark, sf_dir):
    one = F.struct(F.lit("1").alias("id"), F.col("p_type").alias("name"), F.lit("2024-01-05 08:00:00").alias("start_date"), F.lit("2024-01-20").alias("end_date"))
    two = F.struct(F.lit("2").alias("id"), F.lit("second").alias("name"), _text("2024-01-0", 1 + pk() % 3).alias("start_date"), F.lit("2024-02-01 10:00:00").alias("end_date"))
    rows = payloads(spark, sf_dir, name=F.col("p_name"), slug=F.lit("s"), thumbnail_image=F.lit("http://i"), sale_price=price(), unit_price=listed_price(), mcard_price=F.when(pk() % 3 == 0, price() - 100), promotions=F.array(one, two), id=pk())
    return landing.mm_offers(rows).select(F.col("product_id").cast("bigint").alias("product_id"), "sale_price", F.col("original_price").cast("double").alias("original_price"), "promotion", "sale_start_at", "sale_end_at")


@query("""SELECT p_partkey AS product_id, CAST(CASE WHEN p_partkey % 4 IN (1, 2) THEN p_size * 1000 ELSE p_size * 900 END AS BIGINT) AS sale_price,
  CAST(CASE p_partkey % 4 WHEN 1 THEN p_size * 1000 + 500 WHEN 2 THEN p_size * 2000 END AS DOUBLE) AS original_price,
  concat_ws('; ', CASE WHEN p_partkey % 3 = 0 THEN p_type END, CASE WHEN p_partkey % 7 = 0 THEN 'text' END, CASE WHEN p_partkey % 5 = 0 THEN p_brand END, CASE WHEN p_partkey % 11 = 0 AND p_partkey % 4 IN (1, 2) THEN 'Khuyến mãi mua kèm' END, CASE WHEN p_partkey % 13 = 0 THEN p_name || ' gift' END) AS promotion,
  CASE WHEN p_partkey % 4 IN (1, 2) THEN 'category_sale' ELSE 'category_promotion' END AS promotion_type, CASE WHEN p_partkey % 4 = 2 THEN '50%' WHEN p_partkey % 4 = 1 THEN CAST(round_even(CAST(50000 AS DOUBLE) / (p_size * 1000 + 500), 0) AS INTEGER) || '%' ELSE '' END AS discount
FROM part WHERE p_partkey % 4 IN (1, 2) OR p_partkey % 3 = 0 OR p_partkey % 5 = 0 OR p_partkey % 7 = 0 OR p_partkey % 11 = 0 OR p_partkey % 13 = 0 OR p_partkey % 17 = 0 OR p_partkey % 19 = 0""")
def landing_bhx(spark, sf_dir):
    entry = lambda p, s, together: F.struct(p.alias("price"), s.alias("sysPrice"), together.alias("isBuyTogether"))
    prices = F.array(entry(_text(price(), "₫"), F.when(pk() % 4 != 0, listed_price()), pk() % 11 == 0), entry(_text((F.col("p_size") * 900).cast("bigint"), "₫"), F.lit(None).cast("bigint"), F.lit(False)))
    gift = F.when(pk() % 13 == 0, F.array(F.struct(F.lit(" ").alias("name"), _text(F.col("p_name"), "  gift").alias("title"))))
    rows = payloads(spark, sf_dir, productName=F.col("p_name"), productPrices=prices, promotionText=F.when(pk() % 3 == 0, F.col("p_type")), textPromotion=F.when(pk() % 7 == 0, " text "), label=F.when(pk() % 5 == 0, F.col("p_brand")), lstGift=gift, giftType=F.when(pk() % 17 == 0, 2).otherwise(0), lstCampaingInfo=F.when(pk() % 19 == 0, F.array(F.struct(F.lit("2024").alias("startTime")))), id=pk(), url=F.lit("a/b"), image=F.lit("http://i/x"))
    return landing.bhx_offers(rows).select(F.col("product_id").cast("bigint").alias("product_id"), "sale_price", F.col("original_price").cast("double").alias("original_price"), "promotion", "promotion_type", "discount")


@query("""SELECT p_partkey AS source_product_id, CAST(CASE WHEN p_partkey % 6 = 0 THEN p_size + 0.25 WHEN p_partkey % 3 = 0 THEN p_size * 1000 + 0.5 WHEN p_partkey % 3 = 1 THEN p_size * 1000 END AS DOUBLE) AS listed_price, CASE WHEN p_partkey % 3 <> 2 THEN CAST(p_size * 900 AS DOUBLE) END AS promo_price,
  CAST(CASE WHEN p_partkey % 3 = 2 THEN p_size * 1000 ELSE p_size * 900 END AS DOUBLE) AS current_price FROM part""")
def landing_winmart(spark, sf_dir):
    listed = F.when(pk() % 3 == 0, F.concat(F.regexp_replace((F.col("p_size") * 1000).cast("string"), r"000$", ".000"), F.lit(",5")))
    rows = payloads(spark, sf_dir, PRICE=price(), LISTEDprice=F.when(pk() % 6 != 0, listed), listprice=F.when(pk() % 6 == 0, F.col("p_size") + F.lit(0.25)), salePrice=F.when(pk() % 3 != 2, (F.col("p_size") * 900).cast("bigint")), ProductId=pk())
    return landing.winmart_offers(rows).select(F.col("source_product_id").cast("bigint").alias("source_product_id"), "listed_price", "promo_price", "current_price")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'online_default' ELSE 's' END AS store_code, p_partkey % 4 IN (1, 2) AS is_price_discount, p_partkey % 4 NOT IN (1, 2) AND p_partkey % 2 = 1 AS has_promo_mechanic,
  CASE WHEN p_partkey % 4 IN (1, 2) THEN CAST(p_size * 1000 AS DOUBLE) END AS promo_price FROM part""")
def landing_generic(spark, sf_dir):
    rows = views.read(spark, sf_dir, "part").select(pk(), price().alias("sale_price"), listed_price().alias("original_price"), F.when(pk() % 2 == 1, " gift ").otherwise(" ").alias("promotion"), F.when(pk() % 3 != 0, "s").otherwise("").alias("store_code"))
    return landing.envelope(rows, "go").select("p_partkey", "store_code", "is_price_discount", "has_promo_mechanic", F.col("promo_price").cast("double").alias("promo_price"))


@query("""SELECT p_partkey % 3 AS category_code, count(*) AS n, count(*) FILTER (p_partkey % 4 IN (1, 2)) AS discounted, CAST(max(CASE WHEN p_partkey % 4 IN (1, 2) THEN round(CAST(CASE p_partkey % 4 WHEN 1 THEN CAST(500 AS DOUBLE) / (p_size * 1000 + 500) ELSE CAST(0.5 AS DOUBLE) END * 100 AS DECIMAL(28, 12)), 2) END) AS DOUBLE) AS max_percent,
  any_value(CASE p_partkey % 3 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' END) AS category_name FROM part GROUP BY 1""")
def landing_enriched(spark, sf_dir):
    rows = views.read(spark, sf_dir, "part").select((pk() % 3).alias("category_code"), price().cast("double").alias("promo_price"), listed_price().cast("double").alias("listed_price"))
    names = spark.createDataFrame([(0, "zero"), (1, "one")], "category_code long, category_name string")
    done = landing.enriched(rows, names)
    return doubles(done.groupBy("category_code").agg(F.count("*").alias("n"), F.count_if("is_price_discount").alias("discounted"), F.max("discount_percent").alias("max_percent"), F.max("category_name").alias("category_name")))


@query("""WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events), c AS (
  SELECT * FROM (VALUES ('view', TIMESTAMP '2024-01-05 00:00:00', 's1', 'b1'), ('view', TIMESTAMP '2024-01-15 12:00:00', 's2', NULL), ('click', TIMESTAMP '2024-01-10 06:30:00', 's3', 'b3')) t(event_type, valid_from, store_code, branch))
SELECT event_type AS retailer_id, store_code, branch_name, availability_raw, count(*) AS n FROM (SELECT e.event_type, c.store_code, coalesce(c.branch, 'own') AS branch_name, CASE WHEN k % 3 <> 0 THEN 'quantity=' || (k % 3) END AS availability_raw,
  row_number() OVER (PARTITION BY event_id ORDER BY c.valid_from DESC NULLS LAST) AS place FROM e LEFT JOIN c ON c.event_type = e.event_type AND c.valid_from <= e.ts) WHERE place = 1 GROUP BY ALL""")
def landing_context(spark, sf_dir):
    """Stock, and the store context that held at each record's time; two contexts of one retailer over time."""
    rows = views.read(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    records = rows.select("event_id", F.col("event_type").alias("retailer_id"), F.col("ts").cast("timestamp").alias("observed_at"), F.lit("own").alias("branch_name"), F.when(F.col("k") % 3 != 0, (F.col("k") % 3).cast("string")).otherwise("").alias("quantity"))
    contexts = [("view", "2024-01-05 00:00:00", "s1", "b1"), ("view", "2024-01-15 12:00:00", "s2", None), ("click", "2024-01-10 06:30:00", "s3", "b3")]
    contexts = spark.createDataFrame(contexts, "retailer_id string, at string, store_code string, branch_name string").select("retailer_id", F.to_timestamp("at").alias("valid_from"), "store_code", F.lit("g").alias("store_group_code"), F.lit("x").alias("address_context"), "branch_name")
    done = landing.with_store_context(landing.with_stock(records), contexts)
    return done.groupBy("retailer_id", "store_code", "branch_name", "availability_raw").agg(F.count("*").alias("n"))


@query("""SELECT '{"id":' || p_partkey || ',"name":"' || p_name || '","price":' || p_size || '}' AS product FROM part
UNION SELECT '{"productName":"' || p_name || '","salePrice":' || p_size || '}' FROM part UNION SELECT '{"ProductSku":"s","Title":"' || p_brand || '","id":"1"}' FROM part""")
def json_product_walk(spark, sf_dir):
    product = F.struct(pk().alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("price"))
    category = F.struct(F.lit("c").alias("id"), F.col("p_type").alias("name"))
    deep = F.struct(F.col("p_name").alias("productName"), F.col("p_size").alias("salePrice"))
    for _ in range(20):
        deep = F.struct(deep.alias("a"))
    hinted = F.struct(F.lit("s").alias("ProductSku"), F.col("p_brand").alias("Title"), F.lit("1").alias("id"))
    rows = payloads(spark, sf_dir, data=F.struct(F.array(F.struct(F.array(product, product).alias("items")), F.struct(F.array(product).alias("items"))).alias("list"), category.alias("cat"), deep.alias("deep"), hinted.alias("hinted")))
    return walk.product_walk(as_lines(rows))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'a' END AS id, p_type AS name, 'menu/a' AS url, 'Top' AS parent_name FROM part
UNION ALL SELECT p_partkey, NULL, p_name, 'menu/b' || (p_partkey % 3), p_type FROM part UNION ALL SELECT p_partkey, NULL, 'Top', 'top', '' FROM part WHERE p_partkey % 5 <> 0
UNION ALL SELECT p_partkey, NULL, p_brand, 'deep', 'Top' FROM part""")
def menu_flatten(spark, sf_dir):
    """Menus of a category with a child under each name of the key, one repeated, one not a group."""
    none = F.lit(None).cast("string")
    node = lambda url, name, path=none, id=none: [id.alias("id"), url.alias("url"), name.alias("name"), path.alias("path")]
    leaf = F.array(F.struct(*node(_text("/menu/b", pk() % 3, "/"), F.col("p_name"), F.lit("GroupV2"))), F.struct(*node(F.lit("no"), F.lit("no"), F.lit("other"))))
    group = F.struct(*node(F.lit("menu/a"), F.col("p_type"), id=F.when(pk() % 2 == 0, "a")), leaf.alias("childrens"))
    early = F.struct(*node(F.lit("deep"), F.lit("first")), F.when(F.lit(False), leaf).alias("childrens"))
    late = F.struct(F.struct(F.array(F.struct(F.lit("/deep").alias("url"), _text(" ", F.col("p_brand"), " ").alias("name"))).alias("x")).alias("y"))
    rows = payloads(spark, sf_dir, url=F.lit("top"), name=F.lit("Top"), path=F.when(pk() % 5 != 0, "").otherwise("page"), children=F.array(group, early), more=late)
    return walk.menu_categories(as_lines(rows), "p_partkey")


@query("""SELECT '{"id":' || p_partkey || ',"name":"' || p_name || '","price":' || p_size || '}' AS product FROM part UNION SELECT '{"a":[{"name":"z' || p_partkey % 7 || '","price":1}],"sku":"s","title":"t"}' FROM part""")
def outermost_products(spark, sf_dir):
    """Objects 500 levels deep, and products inside products, of which the outer one counts."""
    inner = F.concat(F.lit('{"price":'), F.col("p_size").cast("string"), F.lit(',"name":"'), F.col("p_name"), F.lit('","id":'), pk().cast("string"), F.lit("}"))
    outer = F.concat(F.lit('{"title":"t","a":[{"price":1,"name":"z'), (pk() % 7).cast("string"), F.lit('"}],"sku":"s"}'))
    deep = F.concat(F.repeat(F.lit('{"x":['), 250), inner, F.lit(","), outer, F.repeat(F.lit("]}"), 250))
    return walk.product_walk(views.parts(spark, sf_dir).select(deep.alias("line")), outermost=True)


@query("""SELECT p_partkey, NULL AS id, CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE 'b' END AS name, 'u' AS url, 'top' AS parent_name FROM part UNION ALL SELECT p_partkey, '7', 'top', 'top', '' FROM part""")
def menu_key_order(spark, sf_dir):
    """Of equal urls the last in the order of the keys counts, which isn't that of their names."""
    node = lambda name: f'{{"url":"/u/","name":"{name}"}}'
    fields = F.when(pk() % 2 == 0, f'"z":{node("b")},"m":[[{node("a")}]]').otherwise(f'"z":{node("a")},"m":[[{node("b")}]]')
    lines = F.concat(F.lit('{"path":"","children":[' + node("first") + '],"id":7,"url":"top","name":"  top ",'), fields, F.lit("}"))
    return walk.menu_categories(views.parts(spark, sf_dir).select("p_partkey", lines.alias("line")), "p_partkey")


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '-28%' ELSE '-' || CAST(round_even(CAST(p_size * 100 AS DOUBLE) / (p_size + 7), 0) AS INTEGER) || '%' END AS label FROM part""")
def discount_labels(spark, sf_dir):
    """Labels of list prices and cuts, ties half to even (715 of 1000)."""
    size = F.col("p_size").cast("bigint")
    sale, listed = F.when(size % 2 == 0, 715).otherwise(F.lit(7)), F.when(size % 2 == 0, 1000).otherwise(size + 7)
    return views.read(spark, sf_dir, "part").select("p_partkey", numbers.discount_label(sale, listed).alias("label"))


@query("""SELECT DISTINCT page_id, href, nullif(regexp_extract(href, '--s(\\d+)(?:[/?#]|$)', 1), '') AS item_no, nullif(regexp_extract(href, '-i\\.(\\d+)', 1), '') AS category_id
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS href FROM pages)""")
def page_links(spark, sf_dir):
    return landing.page_links(views.read(spark, sf_dir, "pages"))


KEYED = "SELECT *, coalesce(CASE WHEN p_partkey % 3 = 0 THEN 'b' || (p_partkey % 50) END, 'id' || (p_partkey % 70)) AS key FROM part"


def _keyed(spark, sf_dir):
    barcode = F.when(pk() % 3 == 0, _text("b", pk() % 50))
    return views.read(spark, sf_dir, "part").withColumn("key", F.coalesce(barcode, _text("id", pk() % 70)))


@query(f"SELECT key, arg_max(p_partkey, p_partkey) AS p_partkey, arg_max(p_name, p_partkey) AS p_name FROM ({KEYED}) GROUP BY key")
def last_wins(spark, sf_dir):
    return dedupe(_keyed(spark, sf_dir), ["key"], [pk()], keep="last").select("key", "p_partkey", "p_name")


@query(f"SELECT key, arg_min(p_partkey, p_partkey) AS p_partkey, arg_min(p_name, p_partkey) AS p_name FROM ({KEYED}) GROUP BY key")
def first_wins(spark, sf_dir):
    return dedupe(_keyed(spark, sf_dir), ["key"], [pk()]).select("key", "p_partkey", "p_name")


@query(f"""SELECT key, arg_min(p_name, p_partkey) FILTER (p_size % 2 = 0) AS p_name, arg_min(p_brand, p_partkey) FILTER (p_size % 3 = 0) AS p_brand,
  CASE WHEN count(DISTINCT p_type) > 1 THEN 'network_json+dom' ELSE any_value(p_type) END AS p_type FROM ({KEYED}) GROUP BY key""")
def field_merge(spark, sf_dir):
    rows = _keyed(spark, sf_dir).withColumn("p_name", F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise("")).withColumn("p_brand", F.when(F.col("p_size") % 3 == 0, F.col("p_brand")))
    return merge_fields(rows, "key", "p_partkey", ["p_name", "p_brand"], source="p_type")


@query("""SELECT o_orderkey, strftime(date_trunc('day', o_orderdate) + to_hours(CAST(o_orderkey % 24 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS sale_start_at,
  strftime(date_trunc('day', o_orderdate) + to_hours(CAST((o_orderkey % 24 + 5) % 24 AS BIGINT)) + CASE WHEN o_orderkey % 24 + 5 >= 24 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END, '%Y-%m-%d %H:%M:%S') AS sale_end_at FROM orders""")
def flash_slots(spark, sf_dir):
    hour = F.col("o_orderkey") % 24
    start, end = landing.slot_times(_text(hour, "h - ", (hour + 5) % 24, "h"), F.col("o_orderdate").cast("date"))
    text = lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    return views.read(spark, sf_dir, "orders").select("o_orderkey", text(start).alias("sale_start_at"), text(end).alias("sale_end_at"))


@query("""SELECT p_partkey, CAST(least(p_size * 1000, p_size * 700) AS BIGINT) AS sale, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size * 1000 AS DOUBLE) END AS original, CASE WHEN p_partkey % 2 = 0 THEN '-30%' ELSE '' END AS percent
FROM part""")
def card_prices(spark, sf_dir):
    card = F.concat(_text(F.col("p_size") * 700, "đ"), F.when(pk() % 2 == 0, _text(" ", F.col("p_size") * 1000, "₫ -30%")).otherwise(""))
    low, high, percent = landing.card_prices(card)
    return views.read(spark, sf_dir, "part").select("p_partkey", low.alias("sale"), high.cast("double").alias("original"), percent.alias("percent"))


# --- Promotion cards ------------------------------------------------------

def cards(spark, sf_dir):
    n = (2 + pk() % 4).cast("string")
    line = F.element_at(
        F.array(_text("Mua ", n, " chai được tặng 1 ly"), _text("MUA ", n, " hộp với giá 99.000"), _text("mua ", n, " tính tiền 1"), _text("Mua ", n, " gói\nđược tặng 2 gói"), F.lit("Giá tốt mỗi ngày"), _text("mua ", n, " giá tốt")),
        (pk() % 6).cast("int") + 1,
    )
    return views.parts(spark, sf_dir).select(
        pk().alias("card_id"), F.when(pk() % 7 != 0, _text("item", pk() % 300)).alias("item_no"), F.concat(F.lit("x\n"), F.col("p_name"), F.lit(" lon\n"), line).alias("card_text"), _text("http://p/", pk() % 11).alias("url")
    )


CARDS = """cards AS (SELECT p_partkey AS card_id, CASE WHEN p_partkey % 7 <> 0 THEN 'item' || (p_partkey % 300) END AS item_no, 'http://p/' || (p_partkey % 11) AS url, p_partkey % 6 AS m, 2 + p_partkey % 4 AS n, p_name,
  CASE p_partkey % 6 WHEN 0 THEN 'Mua ' || (2 + p_partkey % 4) || ' chai được tặng 1 ly' WHEN 1 THEN 'MUA ' || (2 + p_partkey % 4) || ' hộp với giá 99.000' WHEN 2 THEN 'mua ' || (2 + p_partkey % 4) || ' tính tiền 1'
    WHEN 3 THEN 'Mua ' || (2 + p_partkey % 4) || ' gói được tặng 2 gói' END AS phrase FROM part),
ph AS (SELECT *, phrase AS promo_mechanic_text FROM cards WHERE m < 3 UNION ALL SELECT *, p_name || ' lon ' || phrase FROM cards WHERE m = 3 UNION ALL SELECT *, phrase FROM cards WHERE m = 3 UNION ALL SELECT *, 'x ' || p_name || ' lon ' || 'Mua ' || n || ' gói' FROM cards WHERE false),
promos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_no, promo_mechanic_text, url ORDER BY card_id) AS place FROM ph) WHERE place = 1)"""


@query("WITH " + CARDS + " SELECT card_id, promo_mechanic_text FROM ph")
def promo_phrases(spark, sf_dir):
    return cards(spark, sf_dir).select("card_id", F.explode(promo_cards.phrases(F.col("card_text"))).alias("promo_mechanic_text"))


@query("WITH " + CARDS + """ SELECT card_id, promo_mechanic_text, CASE m WHEN 1 THEN 'bundle_price' WHEN 2 THEN 'buy_x_pay_y' ELSE 'buy_x_get_y' END AS promo_mechanic_type, CASE WHEN m <> 1 THEN CAST(n AS DOUBLE) END AS buy_quantity,
  CAST(CASE m WHEN 0 THEN 1 WHEN 3 THEN 2 END AS DOUBLE) AS gift_quantity, CASE m WHEN 0 THEN 'ly' WHEN 3 THEN 'goi' END AS gift_uom, CASE WHEN m = 1 THEN CAST(99000 AS DOUBLE) END AS bundle_price, CASE WHEN m = 1 THEN CAST(round(CAST(99000 / CAST(n AS DOUBLE) AS DECIMAL(28, 12)), 2) AS DOUBLE) END AS effective_unit_price,
  CASE WHEN item_no IS NULL THEN 'low' ELSE 'high' END AS match_confidence FROM promos""")
def promo_mechanics(spark, sf_dir):
    return doubles(promo_cards.promo_rows(cards(spark, sf_dir)).select("card_id", "promo_mechanic_text", "promo.promo_mechanic_type", *[F.col(f"promo.{c}").cast("double").alias(c) for c in ("buy_quantity", "gift_quantity", "bundle_price")], "promo.gift_uom", "promo.effective_unit_price", "match_confidence"))


def card_products(spark, sf_dir):
    s = views.read(spark, sf_dir, "supplier").select(F.explode(F.array("s_suppkey", F.col("s_suppkey") + 500)).alias("k")).distinct()
    return s.select(_text("item", F.col("k")).alias("item_no"), F.when(F.col("k") % 3 == 0, F.array(F.lit("Chai"), F.lit("Gói "))).when(F.col("k") % 3 == 1, F.array(F.lit("Hộp"))).otherwise(F.array().cast("array<string>")).alias("uoms"), (F.col("k") * 1.0).alias("listed_price"), F.when(F.col("k") % 2 == 0, F.col("k") * 0.5).alias("promo_price"))


PRODUCTS = """products AS (SELECT DISTINCT 'item' || k AS item_no, k FROM (SELECT unnest([s_suppkey, s_suppkey + 500]) AS k FROM supplier))"""


@query("WITH " + CARDS + ", " + PRODUCTS + " SELECT p.item_no, count(c.card_id) AS promo_card_match_count, k > 0 AND k % 2 = 0 AS is_price_discount, (k > 0 AND k % 2 = 0) OR count(c.card_id) > 0 AS is_on_promotion FROM products p LEFT JOIN promos c USING (item_no) GROUP BY p.item_no, k")
def promo_attach(spark, sf_dir):
    return promo_cards.attach(card_products(spark, sf_dir), promo_cards.promo_rows(cards(spark, sf_dir))).select("item_no", "promo_card_match_count", "is_price_discount", "is_on_promotion")


@query("WITH " + CARDS + ", " + PRODUCTS + """ SELECT status, count(*) AS n FROM (SELECT CASE WHEN m = 2 THEN 'no_uom_hint' WHEN k % 3 = 2 THEN 'no_product_uoms' WHEN (k % 3 = 0 AND m IN (0, 3)) OR (k % 3 = 1 AND m = 1) THEN 'matched' ELSE 'unmatched' END AS status
  FROM products p JOIN promos c USING (item_no)) GROUP BY 1""")
def uom_match(spark, sf_dir):
    rows = promo_cards.attach(card_products(spark, sf_dir), promo_cards.promo_rows(cards(spark, sf_dir)))
    return rows.select(F.explode("uom_statuses").alias("status")).groupBy("status").agg(F.count("*").alias("n"))


@query("WITH " + CARDS + ", " + PRODUCTS + " SELECT card_id, promo_mechanic_text FROM promos WHERE item_no IS NULL OR item_no NOT IN (SELECT item_no FROM products)")
def promo_unmatched(spark, sf_dir):
    return promo_cards.unmatched(promo_cards.promo_rows(cards(spark, sf_dir)), card_products(spark, sf_dir)).select("card_id", "promo_mechanic_text")


@query("WITH " + CARDS + ", " + PRODUCTS + ", a AS (SELECT k, count(c.card_id) AS n FROM products p LEFT JOIN promos c USING (item_no) GROUP BY p.item_no, k) SELECT count(*) AS products_read, count(*) FILTER (k > 0 AND k % 2 = 0) AS products_with_price_discount, count(*) FILTER (n > 0) AS products_with_promo_cards, count(*) FILTER ((k > 0 AND k % 2 = 0) OR n > 0) AS products_on_promotion, CAST(sum(n) AS BIGINT) AS promo_card_matches FROM a")
def promo_summary(spark, sf_dir):
    return promo_cards.merge_summary(promo_cards.attach(card_products(spark, sf_dir), promo_cards.promo_rows(cards(spark, sf_dir))))


@query("WITH " + CARDS + ", " + PRODUCTS + ", mi AS (SELECT item_no, min(card_id) AS card_id FROM cards WHERE item_no IS NOT NULL AND item_no NOT IN (SELECT item_no FROM products) GROUP BY 1) SELECT item_no, card_id, CASE WHEN item_no IN (SELECT 'item' || p_partkey FROM part WHERE p_size % 2 = 0) THEN 'existing_payload' END AS hydration FROM mi")
def promo_hydration(spark, sf_dir):
    missing = promo_cards.without_product(cards(spark, sf_dir), card_products(spark, sf_dir))
    landed = views.read(spark, sf_dir, "part").filter("p_size % 2 = 0").select(_text("item", pk()).alias("item_no"), F.col("p_name").alias("product"), _text("run/", pk()).alias("path"))
    return missing.select("item_no", "card_id").join(promo_cards.hydrated(missing, landed).select("item_no", "hydration"), "item_no", "left")


# --- Runs -----------------------------------------------------------------

def _runs(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("retailer_id"), F.date_format("ts", "yyyy-MM-dd").alias("run_date"), F.date_format("ts", "yyyyMMdd_HH").alias("run_id")).distinct()


RUNS = "runs AS (SELECT DISTINCT event_type AS retailer_id, strftime(ts, '%Y-%m-%d') AS run_date, strftime(ts, '%Y%m%d_%H') AS run_id FROM events)"


@query("WITH " + RUNS + " SELECT retailer_id, max(run_date) AS run_date, max(run_id) AS run_id FROM runs GROUP BY 1")
def run_latest(spark, sf_dir):
    return raw.latest_runs(_runs(spark, sf_dir))


@query("WITH " + RUNS + " SELECT retailer_id, run_date, run_id FROM runs WHERE run_date > '2024-01-15' OR run_id LIKE '%_03'")
def run_incremental(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    ledger = runs.filter("run_date <= '2024-01-15'").withColumn("status", F.when(F.col("run_id").endswith("_03"), "failed").otherwise("success")).withColumn("output_format", F.lit("parquet"))
    return raw.runs_to_process(runs, ledger.drop("run_date"), "parquet")


@query("WITH " + RUNS + " SELECT retailer_id, run_date, run_id FROM runs WHERE run_id = '20240105_10' AND retailer_id <> 'view'")
def run_exact(spark, sf_dir):
    runs = _runs(spark, sf_dir).withColumn("status", F.when(F.col("retailer_id") == "view", "failed").otherwise("success"))
    return raw.exact_runs(runs, "20240105_10", "2024-01-05").drop("status")


def _batches(spark, sf_dir):
    rows = views.observations(spark, sf_dir).select(F.concat_ws("|", "retailer_id", "store_code", "retailer_product_id").alias("id"), F.col("observation_date").alias("day"), F.struct("observed_at", "observation_id").alias("at"), "current_price", "k")
    pick = lambda f: rows.filter(f).groupBy("id", "day").agg(F.max("at").alias("at"), F.max_by("current_price", "at").alias("current_price"))
    return pick("k % 2 = 0"), pick("k % 2 = 1 and day >= '2024-01-20'")


@query("""WITH o AS (SELECT *, concat_ws('|', event_type, CASE WHEN k % 4 <> 0 THEN 's' || (k % 4) END, 'p' || user_id) AS id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS tm, CAST(event_id AS VARCHAR) AS oid
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)),
t AS (SELECT DISTINCT day FROM o WHERE k % 2 = 1 AND day >= '2024-01-20')
SELECT id, day, tm AS observed_at, CASE WHEN k % 23 <> 0 THEN value END AS current_price FROM (SELECT *, row_number() OVER (PARTITION BY id, day ORDER BY tm DESC, oid DESC) AS place FROM o WHERE day IN (SELECT day FROM t)) WHERE place = 1""")
def upsert_history(spark, sf_dir):
    """Two batches: the touched days after the second, newest row of a key first."""
    old, new = _batches(spark, sf_dir)
    return upsert.merged(old, new, ["id"], "at", "day").select("id", "day", F.col("at.observed_at").alias("observed_at"), "current_price")
