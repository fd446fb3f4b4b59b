"""Reports, exports and readers over the given tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.operators import gold, landing, promo_cards, quality, reconcile, taxonomy
from pricelake.plans import views
from pricelake.plans.landing_queries import CARDS, PRODUCTS, _text, card_products, cards, pk, price
from pricelake.plans.queries import BLOCK, ISSUES_WITH, LINE_KEYS, LINES, _line_versions, fact, query
from pricelake.sources import raw
from pricelake.sources.shared import shared_folder


@query("WITH " + CARDS + ", " + PRODUCTS + """ SELECT item_no, listed_price, origin FROM (SELECT item_no, CAST(k AS DOUBLE) AS listed_price, NULL AS origin FROM products
UNION ALL SELECT DISTINCT item_no, NULL, 'existing_payload' FROM cards WHERE item_no NOT IN (SELECT item_no FROM products) AND item_no IN (SELECT 'item' || p_partkey FROM part WHERE p_size % 2 = 0))""")
def hydrated_products(spark, sf_dir):
    """The products, and those of cards that only a landed payload has; one row for each item."""
    products = card_products(spark, sf_dir).select("item_no", "listed_price")
    landed = views.read(spark, sf_dir, "part").filter("p_size % 2 = 0").select(_text("item", pk()).alias("item_no"), F.col("p_name").alias("product"), _text("run/", pk()).alias("path"))
    found = promo_cards.hydrated(promo_cards.without_product(cards(spark, sf_dir), products), landed).select("item_no", F.col("hydration").alias("origin"))
    extra = found.unionByName(products.limit(3).select("item_no", F.lit("too late").alias("origin")))
    return promo_cards.with_hydrated(products, extra).select("item_no", "listed_price", "origin")


@query("WITH " + LINES + """ SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS field, place FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_linenumber) AS place FROM a WHERE l_orderkey % 7 = 0) WHERE place <= 10
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_extendedprice', place FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_linenumber) AS place FROM a WHERE l_partkey % 11 = 0) WHERE place <= 10""")
def mismatch_samples(spark, sf_dir):
    """A report: the first ten differing rows of each field."""
    found = reconcile.mismatch_samples(*_line_versions(spark, sf_dir), LINE_KEYS, ["l_quantity", "l_extendedprice", "l_returnflag"])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "field", F.col("place").cast("long").alias("place"))


@query(ISSUES_WITH + f" SELECT price_snapshot_id, rule_id, {BLOCK} AS severity FROM issues ORDER BY rule_id, price_snapshot_id LIMIT 50")
def issue_samples(spark, sf_dir):
    """A report: the first fifty issues."""
    return quality.sample_issues(quality.snapshot_issues(fact(spark, sf_dir))).select("price_snapshot_id", "rule_id", "severity")


@query("SELECT p_partkey FROM part WHERE p_size > 0 AND p_partkey % 3 <> 0 AND p_partkey % 5 NOT IN (1, 2) AND p_partkey % 7 <> 0")
def valid_offers(spark, sf_dir):
    """Offers with a positive price, a web image and a product page of an allowed host."""
    url = F.when(pk() % 5 == 1, _text("https://www.bachhoaxanh.com/a/b/c", pk())).when(pk() % 5 == 2, _text("https://example.com/a/b", pk())).when(pk() % 5 == 3, _text("https://WWW.bachhoaxanh.com/a/b", pk(), "?x=1")).otherwise(_text("http://bachhoaxanh.com/a//b", pk(), "/"))
    rows = views.read(spark, sf_dir, "part").select("p_partkey", F.when(pk() % 3 == 0, 0).otherwise(price()).alias("sale_price"), F.when(pk() % 7 != 0, "https://i/x").otherwise("data:x").alias("image"), url.alias("url"))
    return landing.valid_offers(rows).select("p_partkey")


@query("""SELECT count(*) AS n, CAST(0 AS BIGINT) AS out_of_order, CAST(min(o_orderkey) AS BIGINT) AS first_key, CAST(max(o_orderkey) AS BIGINT) AS last_key FROM orders""")
def exported_lines(spark, sf_dir):
    """An export in a global order, read back: rows that follow a greater key, in a file or between files."""
    path = shared_folder(spark, "export")
    raw.export_lines(views.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), path, ["o_orderkey"])
    lines = raw.lines(spark, path, pattern="*.json").select("source_file", "source_line_number", F.get_json_object("line", "$.o_orderkey").cast("long").alias("key"))
    inside = lines.withColumn("before", F.lag("key").over(Window.partitionBy("source_file").orderBy("source_line_number")))
    files = inside.groupBy("source_file").agg(F.count("*").alias("n"), F.count_if(F.col("before") > F.col("key")).alias("bad"), F.min("key").alias("low"), F.max("key").alias("high"))
    numbered = files.agg(F.sort_array(F.collect_list(F.struct("source_file", "n", "bad", "low", "high"))).alias("files"))  # one row for each file
    between = F.aggregate("files", F.struct(F.lit(0).cast("long").alias("bad"), F.lit(-1).cast("long").alias("high")), lambda s, f: F.struct((s["bad"] + F.when(f["low"] < s["high"], 1).otherwise(0)).alias("bad"), f["high"].alias("high")), lambda s: s["bad"])
    total = lambda name: F.aggregate("files", F.lit(0).cast("long"), lambda s, f: s + f[name])
    return numbered.select(total("n").alias("n"), (total("bad") + between).alias("out_of_order"), F.array_min(F.transform("files", lambda f: f["low"])).alias("first_key"), F.array_max(F.transform("files", lambda f: f["high"])).alias("last_key"))


@query("""SELECT p_partkey, p_name, CAST(2 AS BIGINT) AS readers, CAST(NULL AS VARCHAR) AS not_there FROM part""")
def silver_readers(spark, sf_dir):
    """JSON lines and Parquet of one table by one schema, which has a column that neither has."""
    path, schema = shared_folder(spark, "silver"), "p_partkey long, p_name string, not_there string"
    parts = views.read(spark, sf_dir, "part").select("p_partkey", "p_name")
    parts.write.json(f"{path}/a.jsonl")
    parts.write.parquet(f"{path}/b")
    both = raw.read_silver(spark, f"{path}/a.jsonl", schema).unionByName(raw.read_silver(spark, f"{path}/b", schema))
    return both.groupBy("p_partkey", "p_name", "not_there").agg(F.count("*").alias("readers"))


@query("""SELECT 'part' AS name, count(*) AS n_rows, count(DISTINCT p_partkey) AS n_keys, 'publishable' AS status FROM part UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey), 'key is repeated or null' FROM lineitem
UNION ALL SELECT 'nothing', 0, 0, 'nothing to publish'""")
def publish_status(spark, sf_dir):
    """Whether a table has rows and a unique key."""
    part, line = views.read(spark, sf_dir, "part"), views.read(spark, sf_dir, "lineitem")
    cases = {"part": (part, "p_partkey"), "lineitem": (line, "l_orderkey"), "nothing": (part.filter("p_partkey < 0"), "p_partkey")}
    rows = [gold.publish_status(df, key).select(F.lit(name).alias("name"), "n_rows", "n_keys", "status") for name, (df, key) in cases.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("SELECT p_type AS category, count(*) AS n FROM part WHERE p_partkey % 4 = 0 GROUP BY 1")
def enabled_categories(spark, sf_dir):
    """Categories that the configuration switches on; a missing switch is off."""
    rows = views.read(spark, sf_dir, "part").select(F.col("p_type").alias("category"), F.when(pk() % 4 == 0, True).when(pk() % 4 == 1, False).alias("enabled"))
    return taxonomy.enabled_categories(rows).groupBy("category").agg(F.count("*").alias("n"))
