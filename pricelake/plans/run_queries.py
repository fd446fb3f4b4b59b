"""Queries over runs that are written from the given tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators import dimensions, upsert
from pricelake.plans import views
from pricelake.plans.landing_queries import _batches
from pricelake.plans.queries import query
from pricelake.sources import ledger, raw
from pricelake.sources.history import History
from pricelake.sources.shared import shared_folder

#: Runs that are written from the parts: retailer, date, id.
FIRST, SECOND, RERUN = ("2024-01-01", "a"), ("2024-01-02", "b"), ("2024-01-01", "b")
PRODUCTS, OBSERVATIONS = "retailer_products", "product_observations"


def _write_runs(spark, sf_dir, root, log, later):
    """The first runs of three retailers or the later ones: one lacks the brand, one its observations."""
    parts = views.read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand"), (F.col("p_partkey") % 5).alias("r"))

    def write(r, run, rows, observed=True):
        rows = rows.filter(F.col("r") == r).drop("r")
        run = (f"r{r}", *run)
        ledger.materialise(rows, root, log, run, PRODUCTS)
        if observed:
            ledger.materialise(rows.select("p_partkey"), root, log, run, OBSERVATIONS)
        else:
            ledger.failed(spark, log, run, OBSERVATIONS)

    if not later:
        for r in (0, 1, 2):
            write(r, FIRST, parts)
        return
    write(0, SECOND, parts.filter("p_partkey % 3 = 0").withColumn("product_name", F.upper("product_name")).drop("brand"))
    write(1, SECOND, parts.filter("p_partkey % 3 = 0").withColumn("product_name", F.lit("unseen")), observed=False)
    write(2, RERUN, parts.filter("p_partkey % 2 = 0").withColumn("product_name", F.concat("product_name", F.lit(" c"))))
    write(3, SECOND, parts.filter("p_partkey < 0"))


RUN_ROWS = """runs AS (
  SELECT p_partkey, 'r' || (p_partkey % 5) AS retailer_id, '2024-01-01' AS run_date, 'a' AS run_id, p_name AS product_name, p_brand AS brand FROM part WHERE p_partkey % 5 < 3
  UNION ALL SELECT p_partkey, 'r0', '2024-01-02', 'b', upper(p_name), NULL FROM part WHERE p_partkey % 5 = 0 AND p_partkey % 3 = 0
  UNION ALL SELECT p_partkey, 'r2', '2024-01-01', 'b', p_name || ' c', p_brand FROM part WHERE p_partkey % 5 = 2 AND p_partkey % 2 = 0
)"""


@query("WITH " + RUN_ROWS + """ SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY run_date DESC, run_id DESC) AS place FROM runs) WHERE place = 1""")
def dim_all_runs(spark, sf_dir):
    """Products of all available runs of all retailers, folded in twice: the first runs, then the later ones."""
    root, log, path = (shared_folder(spark, n) for n in ("silver", "ledger", "dimension"))
    for later in (False, True):
        _write_runs(spark, sf_dir, root, log, later)
        dimensions.update_dimension(spark, path, ledger.read_ledger(spark, log), root, PRODUCTS, ["p_partkey"], [PRODUCTS, OBSERVATIONS])
    return dimensions.read_dimension(spark, path)


@query("WITH " + RUN_ROWS + """ SELECT retailer_id, count(*) AS products FROM runs WHERE run_date = '2024-01-01' AND run_id = 'a' GROUP BY 1""")
def same_run_products(spark, sf_dir):
    """The products of one run at every retailer that has it."""
    root, log = (shared_folder(spark, n) for n in ("silver", "ledger"))
    for later in (False, True):
        _write_runs(spark, sf_dir, root, log, later)
    runs = dimensions.same_run(dimensions.available_runs(ledger.read_ledger(spark, log), [PRODUCTS, OBSERVATIONS]), *FIRST)
    return dimensions.read_runs(spark, runs, root, PRODUCTS).groupBy("retailer_id").agg(F.count("*").alias("products"))


@query("""SELECT 'r1' AS retailer_id, '2024-01-02' AS run_date, 'b' AS run_id, 'product_observations' AS dataset, 'failed' AS reason UNION ALL SELECT 'r3', '2024-01-02', 'b', d, 'no_rows' FROM (VALUES ('retailer_products'), ('product_observations')) t(d)
UNION ALL SELECT 'r4', '2024-01-02', 'b', 'retailer_products', 'no_record' FROM (SELECT DISTINCT p_partkey % 5 AS r FROM part) WHERE r = 4""")
def run_ledger(spark, sf_dir):
    """Runs that should be there and aren't done, by the records that the writers left."""
    root, log = (shared_folder(spark, n) for n in ("silver", "ledger"))
    _write_runs(spark, sf_dir, root, log, True)
    done = ledger.read_ledger(spark, log)
    missing = views.read(spark, sf_dir, "part").filter("p_partkey % 5 = 4").select(F.concat(F.lit("r"), (F.col("p_partkey") % 5).cast("string")).alias("retailer_id")).distinct()
    missing = missing.select("retailer_id", F.lit(SECOND[0]).alias("run_date"), F.lit(SECOND[1]).alias("run_id"), F.lit(PRODUCTS).alias("dataset"))
    return ledger.open_runs(done.select(*missing.columns).unionByName(missing), done)


@query("""SELECT 'r0' AS retailer_id, '2024-01-01' AS run_date, 'a' AS run_id, 'retailer_products' AS dataset, count(*) AS recorded, count(*) FILTER (p_partkey % 7 <> 0) AS counted, 'manifest_count_mismatch' AS rule_id FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT 'r2', '2024-01-01', 'a', 'product_observations', 0, count(*), 'manifest_count_mismatch' FROM part WHERE p_partkey % 5 = 2""")
def manifest_counts(spark, sf_dir):
    """Recorded counts against the tables: one table lost rows after its record, one record was replaced."""
    root, log = (shared_folder(spark, n) for n in ("silver", "ledger"))
    _write_runs(spark, sf_dir, root, log, False)
    path = f"{root}/store=r0/date={FIRST[0]}/run_id={FIRST[1]}/{PRODUCTS}"
    spark.read.parquet(path).filter("p_partkey % 7 <> 0").write.parquet(f"{path}-less")
    ledger.failed(spark, log, ("r2", *FIRST), OBSERVATIONS)
    done = ledger.read_ledger(spark, log)
    counts = []
    for retailer in ("r0", "r1", "r2"):
        for dataset in (PRODUCTS, OBSERVATIONS):
            at = f"{root}/store={retailer}/date={FIRST[0]}/run_id={FIRST[1]}/{dataset}"
            rows = spark.read.parquet(f"{path}-less" if at == path else at)
            counts.append(rows.agg(F.count("*").alias("n")).select(*(F.lit(v).alias(c) for c, v in zip([*ledger.RUN, "dataset"], (retailer, *FIRST, dataset))), "n"))
    every = counts[0]
    for c in counts[1:]:
        every = every.unionByName(c)
    return ledger.count_issues(every, done)


@query("""SELECT event_type AS retailer_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE CAST(strftime(ts, '%d') AS INTEGER) % 3 <> 0 AND CAST(strftime(ts, '%d') AS INTEGER) % 4 <> 0 GROUP BY ALL""")
def publish_gate(spark, sf_dir):
    """Rows of runs that passed; every third day's run failed, every fourth has no decision."""
    rows = views.observations(spark, sf_dir)
    day = F.substring("observation_date", 9, 2).cast("int")
    decisions = rows.select(F.col("source_run_id").alias("run_id"), day.alias("d")).distinct().filter("d % 4 <> 0").select("run_id", (F.col("d") % 3 != 0).alias("publish_allowed"))
    kept = ledger.publishable(rows.withColumn("run_id", F.col("source_run_id")), decisions)
    return kept.groupBy("retailer_id", F.col("observation_date").alias("day")).agg(F.count("*").alias("n"))


@query("""WITH o AS (SELECT *, concat_ws('|', event_type, CASE WHEN k % 4 <> 0 THEN 's' || (k % 4) END, 'p' || user_id) AS id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS tm, CAST(event_id AS VARCHAR) AS oid
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))
SELECT id, day, tm AS observed_at, CASE WHEN k % 23 <> 0 THEN value END AS current_price, CAST(2 AS BIGINT) AS version FROM (SELECT *, row_number() OVER (PARTITION BY id, day ORDER BY tm DESC, oid DESC) AS place FROM o WHERE k % 2 = 0 OR day >= '2024-01-20') WHERE place = 1""")
def history_versions(spark, sf_dir):
    """The whole table after two commits, the second to some days only, and what a failed third one left."""
    path = shared_folder(spark, "history")
    old, new = _batches(spark, sf_dir)
    for batch in (old, new):
        version = upsert.upsert(path, batch, ["id"], "at", "day")
    broken = new.withColumn("current_price", F.when(F.col("day") < "2024-01-21", F.col("current_price")).otherwise(F.raise_error(F.lit("the writer fails"))))
    table = History(spark, path, "day")
    try:
        table.commit(broken)
    except Exception as failure:
        if "the writer fails" not in str(failure):
            raise
    table.collect()
    return table.read().select("id", "day", F.col("at.observed_at").alias("observed_at"), "current_price", F.lit(version).cast("long").alias("version"))


@query("""SELECT event_type AS retailer_id, sha256(string_agg(event_id || ',' || event_type || CAST(chr(10) AS VARCHAR), '' ORDER BY event_id)) AS sha256, CAST(sum(length(event_id || ',' || event_type) + 1) AS BIGINT) AS bytes FROM events GROUP BY 1""")
def file_digests(spark, sf_dir):
    """Digests of one file for each retailer with a line for each event."""
    root = shared_folder(spark, "lines")
    rows = views.read(spark, sf_dir, "events").select("event_id", "event_type", F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value"))
    rows.repartition("event_type").sortWithinPartitions("event_type", "event_id").select("event_type", "value").write.partitionBy("event_type").text(root)
    return raw.file_digests(spark, root, "*.txt").select(raw.path_part(F.col("path"), "event_type").alias("retailer_id"), "sha256", "bytes")


@query("""SELECT event_type AS retailer_id, CAST(sum(n * id) AS BIGINT) AS weighted, count(*) AS n, CAST(max(n) AS BIGINT) AS last FROM (SELECT event_type, event_id % 1000 AS id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n, event_id FROM events) WHERE event_id % 10 <> 0 GROUP BY 1""")
def line_numbers(spark, sf_dir):
    """Numbers of lines over the splits of one file for each retailer, in which every tenth id's line is blank."""
    root = shared_folder(spark, "raw")
    value = F.when(F.col("event_id") % 10 != 0, F.col("event_id").cast("string")).otherwise(" ")
    rows = views.read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("store"), value.alias("value"))
    rows.repartition("store").sortWithinPartitions("store", "event_id").select("store", "value").write.option("compression", "none").partitionBy("store").text(f"{root}-text")
    lines = raw.lines(spark, f"{root}-text", pattern="*.txt")
    return lines.groupBy(F.col("path_retailer").alias("retailer_id")).agg(F.sum(F.col("source_line_number") * (F.col("line").cast("long") % 1000)).alias("weighted"), F.count("*").alias("n"), F.max("source_line_number").alias("last"))
