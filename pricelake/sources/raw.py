"""Raw crawl runs: files, lines, run context, run selection and the run ledger."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.functions.text import first_non_empty
from pricelake.sources.shared import settings, small_side, staged

#: Input files that every run may have; promotion files match a pattern.
KNOWN_FILES = ("products.jsonl", "products_discounted.jsonl", "promo_cards.jsonl", "promo_hydrated_products.jsonl", "products_enriched.jsonl", "unmatched_promo_cards.jsonl")
PROMOTION_FILES = r"_promotions_.*\.jsonl$"


def path_part(path: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(path, rf"/{name}=([^/]+)/", 1), F.lit(""))


def _texts(spark: SparkSession, roots: str | list[str], pattern: str) -> DataFrame:
    """value, path, _start (of the split) and _id (ascending in a split) of every line below the roots."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("lineSep", "\n")
    return reader.text(roots).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))


def _splits(texts: DataFrame) -> DataFrame:
    """Of every split: path, _start, the id of its first line, and how many lines the splits before it have."""
    splits = texts.groupBy("path", "_start").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("path", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))


def lines(spark: SparkSession, root: str | list[str], names: list[str] | None = None, pattern: str | None = None) -> DataFrame:
    """Lines of all input files below one root or several, with file name, dataset and 1-based line
    number: of the known files, of those with the given names, or of all that match a pattern.

    Blank lines count and are then dropped. The lines of every split are counted first; a line's
    number is the count of the splits before its own and its place inside it, so no file is
    gathered in one task. Only a row for each split is ordered by file. Both passes read the
    same splits: the numbers of lines inside a split follow Spark's own row ids.
    """
    rows = _texts(spark, root, pattern or "*.jsonl")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    rows = rows.withColumn("source_file", name)
    if names:
        rows = rows.filter(F.col("source_file").isin(*names))
    elif not pattern:
        rows = rows.filter(F.col("source_file").isin(*KNOWN_FILES) | F.col("source_file").rlike(PROMOTION_FILES))
    splits = small_side(staged(_splits(rows), "splits"))
    number = F.col("_before") + F.col("_id") - F.col("_first") + 1
    line = F.regexp_replace("value", r"\r$", "")
    return rows.join(splits, ["path", "_start"]).withColumn("source_line_number", number).filter(F.trim(line) != "").select(
        line.alias("line"),
        "path",
        "source_file",
        F.regexp_replace("source_file", r"\.[^.]+$", "").alias("source_dataset"),
        "source_line_number",
        path_part(F.col("path"), "store").alias("path_retailer"),
        path_part(F.col("path"), "date").alias("path_date"),
        path_part(F.col("path"), "run_id").alias("path_run"),
    )


METADATA_SCHEMA = "run_id string, store_id string, store_name string, run_date string, config_api_summary struct<region:string,store_code:string,store_group_code:string>"


def metadata(spark: SparkSession, root: str) -> DataFrame:
    """One row per run's metadata.json."""
    rows = spark.read.schema(METADATA_SCHEMA).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "metadata.json").json(root)
    return rows.select(F.regexp_replace("_metadata.file_path", r"/[^/]+$", "").alias("run_dir"), "*")


def with_context(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """Run context on every line; metadata outranks the path."""
    keyed = rows.withColumn("run_dir", F.regexp_replace("path", r"/[^/]+$", "")).join(small_side(meta), "run_dir", "left")
    return keyed.select(
        *rows.columns,
        "run_dir",
        first_non_empty(F.col("run_id"), F.col("path_run")).alias("run_id"),
        first_non_empty(F.col("store_id"), F.col("path_retailer")).alias("retailer_id"),
        first_non_empty(F.col("run_date"), F.col("path_date")).alias("run_date"),
        F.col("config_api_summary.store_code").alias("run_store_code"),
        F.col("config_api_summary.region").alias("region"),
    )


def blocked_runs(context: DataFrame, strict: bool = False, expected: DataFrame | None = None) -> DataFrame:
    """Runs without a run id, retailer or date, with the first missing part, and of the expected ones
    (run_dir) those without any input line; strict mode raises on use."""
    reason = F.when(F.col("run_id").isNull(), "missing_run_id").when(F.col("retailer_id").isNull(), "missing_retailer_id").when(F.col("run_date").isNull(), "missing_run_date")
    blocked = context.select("run_dir", reason.alias("reason")).filter("reason is not null").distinct()
    if expected is not None:
        without = expected.select("run_dir").distinct().join(context.select("run_dir").distinct(), "run_dir", "left_anti")
        blocked = blocked.unionByName(without.withColumn("reason", F.lit("missing_input")))
    return blocked.withColumn("reason", F.raise_error(F.concat(F.lit("BLOCK_RUN "), F.col("reason")))) if strict else blocked


#: For digests: a file is one split, and at most 64 small ones share a task.
WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(1 << 46), "spark.sql.files.openCostInBytes": str(1 << 40)}


def file_digests(spark: SparkSession, roots: str | list[str], glob: str = "*.jsonl") -> DataFrame:
    """path, bytes and SHA-256 of every file's content.

    A file is read by one task as a stream of pieces that end at line feeds, and the digest is
    carried from piece to piece: no row, batch or task holds a file."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("lineSep", "\n").text(roots)
    pieces = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), F.col("value").cast("binary").alias("value"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, read, state = None, 0, 0, sha256()
        done = lambda: pa.RecordBatch.from_pylist([{"path": name, "bytes": size, "sha256": state.hexdigest()}])
        for batch in batches:
            for path, length, value in zip(batch["path"], batch["bytes"], batch["value"]):
                if (path := path.as_py()) != name:
                    if name is not None:
                        yield done()
                    name, size, read, state = path, length.as_py(), 0, sha256()
                value = value.as_py()
                state.update(value)
                read += len(value)
                if read < size:  # the last line may end without a line feed
                    state.update(b"\n")
                    read += 1
        if name is not None:
            yield done()

    with settings(spark, WHOLE_FILES):
        found = staged(pieces.mapInArrow(digest, "path string, bytes long, sha256 string"), "digests")
    names = spark.createDataFrame([(f,) for f in files.inputFiles()], "path string")  # the driver's own list of files
    plain = lambda path: F.regexp_replace(path, "^file:/+", "/")  # noqa: E731 - a local path is written in two ways
    empty = names.join(found.select(F.col("path").alias("read")), plain(F.col("path")) == plain(F.col("read")), "left_anti").select("path", F.lit(0).cast("long").alias("bytes"), F.lit(sha256().hexdigest()).alias("sha256"))
    return found.unionByName(empty)


def read_silver(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet or JSON lines by suffix, always with a schema."""
    reader = spark.read.schema(schema)
    return reader.json(path) if path.rstrip("/").endswith((".jsonl", ".json")) else reader.parquet(path)


def export_lines(df: DataFrame, path: str, order: list[str]) -> None:
    """JSON lines in a global order: for exports only."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def latest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of each retailer by (date, run id)."""
    newest = F.max(F.struct("run_date", "run_id")).alias("m")
    return runs.groupBy("retailer_id").agg(newest).select("retailer_id", "m.run_date", "m.run_id")


def exact_runs(runs: DataFrame, run_id: str, run_date: str | None = None) -> DataFrame:
    """Successful runs of that id, and date if given."""
    chosen = runs.filter((F.col("run_id") == run_id) & (F.col("status") == "success"))
    return chosen.filter(F.col("run_date") == run_date) if run_date else chosen


def runs_to_process(candidates: DataFrame, ledger: DataFrame, output_format: str, force: bool = False) -> DataFrame:
    """Candidates that the ledger doesn't list as done in that format."""
    if force:
        return candidates
    done = ledger.filter((F.col("status") == "success") & (F.col("output_format") == output_format))
    return candidates.join(done, ["retailer_id", "run_id"], "left_anti")
