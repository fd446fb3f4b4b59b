"""Labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0)).cast("int")


def labelled(labels: DataFrame, name: str) -> DataFrame:
    """doc_id and label (0 or 1), one row for each doc_id; of repeated rows the larger label counts."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1))
    return known.groupBy("doc_id").agg(F.max(F.col(name).cast("int")).alias("label"))
