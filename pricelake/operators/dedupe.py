"""First-wins and last-wins de-duplication with an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dedupe(df: DataFrame, keys: list[str], order: list[Column], keep: str = "first") -> DataFrame:
    """One row per key: the first or the last in ``order``, which must decide every tie."""
    if keep == "last":
        order = [F.desc_nulls_last(o) if isinstance(o, str) else o.desc_nulls_last() for o in order]
    else:
        order = [F.asc_nulls_last(o) if isinstance(o, str) else o.asc_nulls_last() for o in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def merge_fields(df: DataFrame, key: str, order: str, fields: list[str], source: str | None = None) -> DataFrame:
    """One row per key; each field is the first non-empty value in order. ``source``: a field
    that becomes ``network_json+dom`` where the merged rows disagree on it."""
    filled = lambda f: F.col(f).isNotNull() & (F.col(f).cast("string") != "")
    chosen = [F.min_by(F.when(filled(f), F.col(f)), F.when(filled(f), F.col(order))).alias(f) for f in fields]
    if source:
        chosen.append(F.when(F.count_distinct(source) > 1, "network_json+dom").otherwise(F.max(source)).alias(source))
    return df.groupBy(key).agg(*chosen)
