"""A training corpus from ``documents``: five stages, each one operator of the library.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.
Stages whose rows Python makes set the session's Arrow batches to a few MB, for the write.
A null or empty text passes the stages as their operators define; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import bpe, jaccard, mixing, pii, quality
from pricelake.llm.common import free_name, keep_batches_small, small_side, stage
from pricelake.llm.labels import fold


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; learned from the labels of its fold.

    All stay where the labels fit no network (fewer than eight, or of one kind only).
    """
    keep_batches_small(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold(F.col("doc_id"), 4) != 2)
    vectors, network = quality.fit(docs, labels)
    if not network.fitted:
        return docs
    name = free_name(docs, "quality_score")
    return quality.score(docs, vectors, network, name).filter(F.col(name) >= quality.THRESHOLD).drop(name)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents that with the smallest doc_id stays, in one row.

    Near duplicates are sets of five-word shingles with a similarity of 0.8 or more. Rows
    equal in doc_id and text are one document, a null doc_id included. In a group whose ids
    repeat or are all null, the smallest id comes first, a null last, then the least hash of
    the text. Documents without words are linked with nothing and stay.
    """
    rows = jaccard.jaccard_components(docs, width=5, percent=80).groupBy("doc_id", "text_key", "root").agg(F.count("*").alias("times"))
    rows = stage(rows, "pipeline-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "times")).alias("first")
    kept = rows.filter("root IS NOT NULL").groupBy("root").agg(first).select("first.doc_id", "first.text_key", "first.times")
    kept = stage(kept.unionByName(rows.filter("root IS NULL").select("doc_id", "text_key", "times")), "pipeline-kept")

    def those(keep: DataFrame) -> DataFrame:
        keep = small_side(keep.select("doc_id", "text_key"))
        return docs.join(keep, docs["doc_id"].eqNullSafe(keep["doc_id"]) & (F.xxhash64(docs["text"]) == keep["text_key"]), "left_semi")

    return those(kept.filter("times = 1")).unionByName(those(kept.filter("times > 1")).dropDuplicates(["doc_id", "text"]))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows the text."""
    keep_batches_small(spark)
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time the mix draws a document, shard by shard."""
    return mixing.drawn(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row's encoding and its decoding."""
    keep_batches_small(spark)
    return bpe.round_trip(docs, bpe.vocabulary_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: SQL can't express the classifier, the semi-Markov spans, the splitting tree or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{k}")
    return docs
