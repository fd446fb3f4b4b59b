"""Bronze: an auditable envelope around every raw JSON record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.functions import keys
from pricelake.functions.text import first_non_empty

IDENTITY_FIELDS = ("source_product_id", "item_no", "product_url", "match_key", "source_url", "product_name_raw")


def text_at(payload: Column, field: str) -> Column:
    return F.try_variant_get(payload, f"$.{field}", "string")


def split_valid(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid with ``payload`` VARIANT of objects, invalid with the raw text); blank lines go to neither."""
    parsed = lines.filter(F.length(F.trim("line")) > 0).withColumn("payload", F.try_parse_json("line"))
    good = F.coalesce(F.schema_of_variant("payload").startswith("OBJECT"), F.lit(False))
    return parsed.filter(good), parsed.filter(~good).drop("payload")


def canonical(payload: Column) -> Column:
    """Key-sorted compact JSON; whole floats are written as integers."""
    return F.to_json(payload)


def with_occurrence(df: DataFrame) -> DataFrame:
    """payload_sha256 and the occurrence number of an identical payload within its file."""
    order = Window.partitionBy("source_file", "payload_sha256").orderBy("source_line_number")
    return df.withColumn("payload_sha256", F.sha2(canonical(F.col("payload")), 256)).withColumn("payload_occurrence_index", F.row_number().over(order))


def _truthy(payload: Column, field: str) -> Column:
    text = text_at(payload, field)
    return F.coalesce(~text.isin("", "0", "false"), F.lit(False))


def quality(payload: Column, run_store: Column) -> dict[str, Column]:
    """quality_warnings, quarantine_reasons and quality_status; quarantine outranks a warning."""
    store = first_non_empty(text_at(payload, "store_code"))
    holds = lambda f: F.coalesce(~F.to_json(F.variant_get(payload, f"$.{f}", "variant")).isin("null", "{}", "[]", '""', "0", "false"), F.lit(False))
    identified = holds("raw_product") | holds("raw_card")
    for field in IDENTITY_FIELDS:
        identified = identified | _truthy(payload, field)
    null_size = F.coalesce(F.is_variant_null(F.variant_get(payload, "$.package_size_raw", "variant")), F.lit(False))
    warnings = F.array_compact(
        F.array(
            F.when(~_truthy(payload, "source_url"), "missing_source_url"),
            F.when(~_truthy(payload, "crawl_timestamp") & ~_truthy(payload, "observed_at"), "missing_observed_at"),
            F.when(null_size, "package_size_null"),
        )
    )
    reasons = F.array_compact(
        F.array(
            F.when((F.nullif(run_store, F.lit("")) != store), "store_code_mismatch"),
            F.when(~identified, "missing_raw_payload_identity"),
        )
    )
    status = F.when(F.size(reasons) > 0, "QUARANTINE").when(F.size(warnings) > 0, "WARN").otherwise("PASS")
    return {"quality_warnings": warnings, "quarantine_reasons": reasons, "quality_status": status}


def envelope(valid: DataFrame) -> DataFrame:
    """valid: payload, source_file, source_line_number, source_dataset, retailer_id, run_id, run_store_code, ..."""
    p = F.col("payload")
    observed = first_non_empty(text_at(p, "crawl_timestamp"), text_at(p, "observed_at"), text_at(p, "crawled_at"))
    keyed = with_occurrence(valid)
    return keyed.withColumns({"observed_at": observed, **quality(p, F.col("run_store_code"))}).withColumn(
        "bronze_record_key",
        keys.bronze_key(*[F.col(c) for c in ("retailer_id", "run_id", "source_dataset", "source_file", "payload_sha256", "payload_occurrence_index")]),
    )


def quarantined(records: DataFrame) -> DataFrame:
    """The copy of quarantined rows; they stay in the records as well."""
    return records.filter(F.size("quarantine_reasons") > 0)


def run_metrics(records: DataFrame, invalid: DataFrame) -> DataFrame:
    """Long-format counts by run: status, warnings, reasons, keys, files.

    One pass over each side: a record is exploded into what it counts for, its key included, and
    that is summed inside a task before it is shuffled. The groups of keys then say how many
    records there are, how many keys, and how many records repeat one."""
    c = F.col
    n = lambda metric, key, value=F.lit(1): F.struct(F.lit(metric).alias("metric"), key.alias("key"), value.cast("long").alias("value"))
    every = F.lit("all")
    held = F.when(c("quality_status") == "QUARANTINE", 1).otherwise(0)
    counts = F.concat(
        F.array(n("bronze_key", c("bronze_record_key")), n("quarantine_records", every, held), n("quality_status", c("quality_status")), n("file", c("source_file"))),
        F.transform("quality_warnings", lambda w: n("warning", w)),
        F.transform("quarantine_reasons", lambda r: n("reason", r)),
    )
    rows = records.select("run_id", F.explode(counts).alias("n")).unionByName(invalid.select("run_id", n("invalid_json_records", every).alias("n")))
    summed = lambda df: df.groupBy("run_id", "n.metric", "n.key").agg(F.sum("n.value").alias("value"))
    of_key = F.array(n("records_written", every, c("value")), n("distinct_bronze_keys", every), n("duplicate_bronze_keys", every, c("value") - 1))
    own = F.array(F.struct("metric", "key", "value"))
    return summed(summed(rows).select("run_id", F.explode(F.when(c("metric") == "bronze_key", of_key).otherwise(own)).alias("n")))
