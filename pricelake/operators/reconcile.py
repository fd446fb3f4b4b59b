"""Comparison of two versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.sources.shared import staged

TOLERANCE = 1e-4


def key_sets(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of one side only: missing in, or extra in, the actual table."""
    e, a = expected.select(*keys).distinct(), actual.select(*keys).distinct()
    missing = e.join(a, keys, "left_anti").withColumn("side", F.lit("missing"))
    return missing.unionByName(a.join(e, keys, "left_anti").withColumn("side", F.lit("extra")))


def differs(e: Column, a: Column, numeric: bool) -> Column:
    """Numbers within a tolerance are equal; null against a value is a difference."""
    unequal = F.abs(e.cast("double") - a.cast("double")) > TOLERANCE if numeric else e.cast("string") != a.cast("string")
    return (e.isNull() != a.isNull()) | F.coalesce(unequal, F.lit(False))


def _pairs(expected: DataFrame, actual: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    side = lambda df, x: df.select(*keys, *[F.col(f).alias(f"{x}_{f}") for f in fields])
    return side(expected, "e").join(side(actual, "a"), keys)


def _numeric(df: DataFrame, field: str) -> bool:
    return dict(df.dtypes)[field].split("(")[0] in ("double", "float", "decimal", "tinyint", "smallint", "int", "bigint")


def field_mismatches(expected: DataFrame, actual: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """field and number of differing rows, for all fields in one pass."""
    both = _pairs(expected, actual, keys, fields)
    counts = both.agg(*[F.count_if(differs(F.col(f"e_{f}"), F.col(f"a_{f}"), _numeric(expected, f))).alias(f) for f in fields])
    return counts.unpivot([], fields, "field", "mismatches")


def mismatch_samples(expected: DataFrame, actual: DataFrame, keys: list[str], fields: list[str], n: int = 10) -> DataFrame:
    """The first differing rows of each field in key order: a report."""
    both = _pairs(expected, actual, keys, fields)
    parts = F.array(*[F.when(differs(F.col(f"e_{f}"), F.col(f"a_{f}"), _numeric(expected, f)), F.struct(F.lit(f).alias("field"), F.col(f"e_{f}").cast("string").alias("expected"), F.col(f"a_{f}").cast("string").alias("actual"))) for f in fields])
    rows = both.select(*keys, F.explode(F.array_compact(parts)).alias("m")).select(*keys, "m.*")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("field").orderBy(*keys))).filter(F.col("place") <= n)


def replacement_ready(expected: DataFrame, actual: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row: do the key sets and all fields agree, and are keys unique on both sides?"""
    sides = key_sets(expected, actual, keys).agg(F.count_if(F.col("side") == "missing").alias("missing_rows"), F.count_if(F.col("side") == "extra").alias("extra_rows"))
    wrong = field_mismatches(expected, actual, keys, fields).agg(F.sum("mismatches").alias("field_mismatches"))
    repeats = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))
    row = sides.join(F.broadcast(wrong)).join(F.broadcast(repeats(expected, "expected_repeats"))).join(F.broadcast(repeats(actual, "actual_repeats")))
    clean = (F.col("missing_rows") + F.col("extra_rows") + F.col("field_mismatches") + F.col("expected_repeats") + F.col("actual_repeats")) == 0
    return row.withColumn("replacement_ready", clean)


BUCKETS = 4096


def _prints(df: DataFrame, keys: list[str], fields: list[str], kinds: dict[str, bool]) -> DataFrame:
    """keys, fields in a common form, a fingerprint of the row, and the bucket of its key."""
    form = lambda f: (F.col(f).cast("double") if kinds[f] else F.col(f).cast("string")).alias(f)
    rows = df.select(*[F.col(k).cast("string").alias(k) for k in keys], *[form(f) for f in fields])
    # Nulls hash as if they weren't there, so each value comes with whether it is null.
    parts = [x for c in (*keys, *fields) for x in (F.col(c).isNull(), F.col(c))]
    return rows.withColumns({"_print": F.xxhash64(*parts), "_bucket": F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))})


def _bucket_sums(prints: DataFrame) -> DataFrame:
    """Rows, and the sum of fingerprints, of every bucket: equal rows in any order give equal sums."""
    return prints.groupBy("_bucket").agg(F.count("*").alias("n"), F.sum(F.col("_print").cast("decimal(38,0)")).alias("total"))


def parity(expected: DataFrame, actual: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Findings of a comparison: finding, field, rows.

    Row fingerprints are summed by bucket of the key on both sides, and only rows of buckets
    that differ are compared by key, so the cost of tables that agree is one pass over each. Rows
    of one key are compared in the order of their fingerprints, the first with the first; keys
    with more rows than one are a finding, and rows without a key are left out. A field that
    one side lacks is the finding missing_column, with 1 row, and isn't compared. Numbers within
    1e-4 are equal, null equals only null.
    """
    shared = [f for f in fields if f in expected.columns and f in actual.columns]
    logical = lambda f: "boolean" in (dict(expected.dtypes)[f], dict(actual.dtypes)[f])
    kinds = {f: not logical(f) and (_numeric(expected, f) or _numeric(actual, f)) for f in shared}
    has_key = F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull()
    e, a = (_prints(side.filter(has_key), keys, shared, kinds) for side in (expected, actual))
    both = _bucket_sums(e).withColumnsRenamed({"n": "n_e", "total": "total_e"}).join(_bucket_sums(a), "_bucket", "full")
    differing = staged(both.filter(~(F.col("n").eqNullSafe(F.col("n_e")) & F.col("total").eqNullSafe(F.col("total_e")))).select("_bucket"), "parity-buckets")

    order = Window.partitionBy(*keys).orderBy("_print")
    left, right = (side.join(F.broadcast(differing), "_bucket", "left_semi").withColumn("_place", F.row_number().over(order)) for side in (e, a))  # at most BUCKETS rows
    names = lambda side, x: side.select(*keys, "_place", F.lit(True).alias(f"{x}_here"), *[F.col(f).alias(f"{x}_{f}") for f in shared])
    met = names(left, "e").join(names(right, "a"), [*keys, "_place"], "full")
    here = lambda x: F.col(f"{x}_here").isNotNull()
    first = F.col("_place") == 1
    counts = {"missing_keys|": first & ~here("a"), "extra_keys|": first & ~here("e"), "repeated_rows|expected": ~first & here("e"), "repeated_rows|actual": ~first & here("a")}
    counts |= {f"field_mismatch|{f}": here("e") & here("a") & differs(F.col(f"e_{f}"), F.col(f"a_{f}"), kinds[f]) for f in shared}
    found = met.agg(*[F.count_if(c).alias(n) for n, c in counts.items()]).unpivot([], list(counts), "name", "rows")
    same = staged(both.join(F.broadcast(differing), "_bucket", "left_anti").select("_bucket"), "parity-same")
    repeated = e.join(F.broadcast(same), "_bucket", "left_semi").groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("more"))
    found = found.join(F.broadcast(repeated)).withColumn("rows", F.col("rows") + F.when(F.col("name").startswith("repeated_rows"), F.col("more")).otherwise(0))
    rows = found.select(F.split_part("name", F.lit("|"), F.lit(1)).alias("finding"), F.nullif(F.split_part("name", F.lit("|"), F.lit(2)), F.lit("")).alias("field"), "rows")
    lacking = [("missing_column", f, 1) for f in fields if f not in shared]
    return rows.unionByName(expected.sparkSession.createDataFrame(lacking, "finding string, field string, rows long")) if lacking else rows


def parity_verdict(findings: DataFrame) -> DataFrame:
    """One row: passed (no key, row or value differs, and the actual table repeats no key) and
    complete (no column is missing either)."""
    breaks = (F.col("finding") != "missing_column") & ~((F.col("finding") == "repeated_rows") & (F.col("field") == "expected")) & (F.col("rows") > 0)
    return findings.agg((F.count_if(breaks) == 0).alias("passed"), (F.count_if(F.col("finding") == "missing_column") == 0).alias("complete"))
