"""Tables over all runs that there are, not only those of the last call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.sources.history import History
from pricelake.sources.ledger import RUN
from pricelake.sources.shared import small_side

#: What says which row of a key is newer.
AGE = ["run_date", "run_id"]


def available_runs(ledger: DataFrame, datasets: list[str]) -> DataFrame:
    """Runs of any retailer in which each of the datasets was written, with a map from dataset to path."""
    done = ledger.filter(F.col("status").eqNullSafe("success") & F.col("dataset").isin(*datasets))
    runs = done.groupBy(*RUN).agg(F.map_from_entries(F.collect_set(F.struct("dataset", "path"))).alias("paths"))
    return runs.filter(F.size("paths") == len(datasets))


def same_run(runs: DataFrame, run_date: str, run_id: str) -> DataFrame:
    """The runs of one date and id at every retailer that has one, rerun or not."""
    return runs.filter((F.col("run_date") == run_date) & (F.col("run_id") == run_id))


def read_runs(spark: SparkSession, runs: DataFrame, root: str, dataset: str) -> DataFrame | None:
    """The rows of a dataset in all those runs as one table; a column that a run lacks is null in its
    rows. The driver sees one path for each run. None without runs."""
    paths = [r[0] for r in runs.select(F.col("paths")[dataset]).collect()]
    if not paths:
        return None
    rows = spark.read.option("mergeSchema", "true").option("basePath", root).parquet(*paths)
    rows = rows.withColumn("_path", F.col("_metadata.file_path"))
    part = lambda name: F.url_decode(F.regexp_extract("_path", rf"/{name}=([^/]+)/", 1))
    own = [c for c in rows.columns if c not in ("store", "date", "run_id", "_path", *RUN)]
    return rows.select(part("store").alias("retailer_id"), part("date").alias("run_date"), part("run_id").alias("run_id"), *own)


def newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key, from its last run by date and id; combined before the shuffle. Equal
    rows of a run's key are one, of unequal ones the greatest stays."""
    rest = [c for c in rows.columns if c not in keys]
    order = [*[F.col(c) for c in AGE], *[F.col(c).cast("string") for c in sorted(rest) if c not in AGE]]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row")).select(*keys, "row.*")


def folded(dimension: DataFrame | None, rows: DataFrame, keys: list[str]) -> DataFrame:
    """A dimension with further runs' rows: as if all runs had been read at once, in any order."""
    return newest(rows if dimension is None else dimension.unionByName(rows, allowMissingColumns=True), keys)


#: Parts of a dimension's history, by hash of the key; only those that new rows touch are rewritten.
BUCKETS = 64


def update_dimension(spark: SparkSession, path: str, ledger: DataFrame, root: str, dataset: str, keys: list[str], needs: list[str] | None = None) -> int:
    """Folds the runs that the dimension at ``path`` hasn't seen into it, in one commit; how many.

    The list of folded runs is committed with the rows, so a run counts once or not at all."""
    table = History(spark, path, "_bucket")
    done = [tuple(r) for r in table.state()["note"]]
    runs = available_runs(ledger, needs or [dataset])
    if done:
        runs = runs.join(small_side(spark.createDataFrame(done, ", ".join(f"{c} string" for c in RUN))), RUN, "left_anti")
    names = [tuple(r) for r in runs.select(*RUN).collect()]
    rows = read_runs(spark, runs, root, dataset)
    if rows is None:
        return 0
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)))
    touched = [r[0] for r in rows.select("_bucket").distinct().collect()]
    table.commit(folded(table.read(touched), rows, [*keys, "_bucket"]), sorted({*done, *names}))
    return len(names)


def read_dimension(spark: SparkSession, path: str) -> DataFrame | None:
    found = History(spark, path, "_bucket").read()
    return None if found is None else found.drop("_bucket")
