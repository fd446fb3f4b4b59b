"""The ledger of runs: what each run wrote, one record for each, put in one step."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricelake.sources.shared import Files

RECORD = "retailer_id string, run_date string, run_id string, dataset string, rows long, status string, output_format string, path string"
RUN = ["retailer_id", "run_date", "run_id"]


def materialise(rows: DataFrame, root: str, ledger: str, run: tuple[str, str, str], dataset: str) -> int:
    """One run's rows as Parquet below store=, date= and run_id= folders, counted while they are
    written; then its record. A run that failed before its record is as if it had not been."""
    counted = Observation()
    retailer, date, name = run
    path = f"{root}/store={retailer}/date={date}/run_id={name}/{dataset}"
    rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    n = counted.get["rows"]
    record = dict(zip(RUN, run)) | {"dataset": dataset, "rows": n, "status": "success", "output_format": "parquet", "path": path}
    Files(rows.sparkSession).put(f"{ledger}/{retailer}/{date}/{name}/{dataset}.json", json.dumps(record))
    return n


def failed(spark: SparkSession, ledger: str, run: tuple[str, str, str], dataset: str) -> None:
    """The record of a run that wrote nothing."""
    retailer, date, name = run
    record = dict(zip(RUN, run)) | {"dataset": dataset, "rows": 0, "status": "failed"}
    Files(spark).put(f"{ledger}/{retailer}/{date}/{name}/{dataset}.json", json.dumps(record))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All records as a table; none where no run has left one yet."""
    if not Files(spark).names(ledger):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(ledger)


def open_runs(expected: DataFrame, ledger: DataFrame) -> DataFrame:
    """Expected runs and datasets that aren't done, and why: no record, failed, or no rows."""
    key = [*RUN, "dataset"]
    seen = expected.select(*key).join(ledger.select(*key, "rows", "status"), key, "left")
    why = F.when(F.col("status").isNull(), "no_record").when(F.col("status") != "success", "failed").when(F.col("rows") == 0, "no_rows")
    return seen.withColumn("reason", why).filter("reason IS NOT NULL").select(*key, "reason")


def count_issues(counts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Runs and datasets whose record and table disagree; counts: retailer_id, run_date, run_id, dataset, n."""
    key = [*RUN, "dataset"]
    both = ledger.filter("status = 'success'").select(*key, F.col("rows").alias("recorded")).join(counts.select(*key, F.col("n").alias("counted")), key, "full")
    both = both.withColumns({"recorded": F.coalesce("recorded", F.lit(0)), "counted": F.coalesce("counted", F.lit(0))})
    return both.filter("recorded <> counted").withColumn("rule_id", F.lit("manifest_count_mismatch"))


def publishable(rows: DataFrame, decisions: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Rows of the runs that may be published; runs without a decision may not."""
    return rows.join(decisions.filter("publish_allowed").select(*(key or ["run_id"])).distinct(), key or ["run_id"], "left_semi")
