"""Importance resampling of documents towards a target distribution.

Documents and target texts are bags of hashed features: the runs of 1 to ``width`` words.
A bucket's gain is the logarithm of its smoothed share in the target over that in the
documents; a document weighs the mean gain of its features, and Gumbel noise that depends
on its doc_id and a seed turns the greatest sums of both into a draw without replacement.

A batch's texts are joined with a separator, which is no sign of a word. One pass of a
regular expression finds all words; their offsets are searched among the documents', and a
run whose first and last word lie in different documents is masked before the counts by
bucket and by document.

Defined cases: a null or empty text has no features, weight 0, and isn't drawn where any
words are asked for; a null doc_id counts as the empty text in the noise and comes last
among equal scores; rows that repeat a doc_id take part one by one; an empty table gives an
empty result, an empty target smoothed shares alone; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, islice
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import batch_of, small_side, stage, utf8

#: Digits, small letters and every sign beyond ASCII, in UTF-8.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\0"
#: So many words are held at once.
CHUNK = 1 << 17

COUNTS = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
WEIGHTS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def features(texts: list[bytes], width: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words in the run, document, bucket) of all features, chunk by chunk; documents by their place in ``texts``."""
    ends = np.cumsum([len(t) + len(SEPARATOR) for t in texts])
    found = WORD.finditer(SEPARATOR.join(texts).lower())
    words: list[bytes] = []
    docs = np.empty(0, np.int64)
    while chunk := [(m.start(), m[0]) for m in islice(found, CHUNK)]:
        known = len(words)
        words += [w for _, w in chunk]
        docs = np.concatenate([docs, np.searchsorted(ends, np.fromiter((at for at, _ in chunk), np.int64, len(chunk)), side="right")])
        codes = [crc32(w) for w in words]
        for k in range(1, width + 1):
            if k > 1:
                codes = [crc32(b" " + w, c) for w, c in zip(words[k - 1 :], codes)]
            first = max(0, known - k + 1)
            inside = docs[first : len(codes)] == docs[first + k - 1 : len(codes) + k - 1]
            yield k, docs[first : len(codes)][inside], np.array(codes[first:], np.int64)[inside] % buckets
        keep = min(len(words), width - 1)
        words, docs = words[len(words) - keep :], docs[len(docs) - keep :]


def bucket_counts(texts: DataFrame, width: int, buckets: int) -> DataFrame:
    """bucket and n, over all rows of ``text``; a task sends one row for each bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, codes in features(utf8(batch["text"]), width, buckets):
                total += np.bincount(codes, minlength=buckets)
        seen = np.flatnonzero(total)
        yield batch_of(COUNTS, seen, total[seen])

    return texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, width: int, buckets: int) -> np.ndarray:
    """1000 times the logarithm of the smoothed ratio of shares, floored, for every bucket.

    The driver gets one number for each bucket and table, a parameter of the method."""
    sides = []
    for side in (docs, target):
        counts = np.zeros(buckets)
        for bucket, n in stage(bucket_counts(side, width, buckets), "importance-counts").collect():
            counts[bucket] = n
        sides.append((counts.tolist(), float(counts.sum())))
    (mine, all_mine), (theirs, all_theirs) = sides
    return np.array([floor(1000 * log((t + 1) * (all_mine + buckets) / ((s + 1) * (all_theirs + buckets)))) for s, t in zip(mine, theirs)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, width: int) -> DataFrame:
    """Per row: doc_id, text_key, n_words, n_features and weight, the floored mean gain of its features."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            n_words, n_features, sums = np.zeros((3, n), np.int64)
            for k, docs_of, codes in features(utf8(batch["text"]), width, len(gain)):
                counted = np.bincount(docs_of, minlength=n)
                n_features += counted
                n_words += counted if k == 1 else 0
                sums += np.bincount(docs_of, weights=gain[codes], minlength=n).astype(np.int64)
            yield batch_of(WEIGHTS, batch["doc_id"], batch["text_key"], n_words, n_features, sums // np.maximum(1, n_features))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(weigh, "doc_id long, text_key long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times a Gumbel variate, floored, from the first 32 bits of a digest of seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with rank 1, 2, 3, ... in the given order: sorted by ranges, numbered inside each
    sorted partition, and shifted by the sizes of the partitions before it."""
    at = stage(rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "importance-ranked")
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = sorted(map(tuple, at.groupBy(part.alias("part")).count().collect()))
    before = [0, *accumulate(n for _, n in sizes)]
    shifts = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part long, before long")
    return at.withColumn("part", part).join(F.broadcast(shifts), "part").withColumn("rank", F.col("before") + inside + 1).drop("part", "before", "at")


def importance_ranks(docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """Per row: doc_id, text_key, n_words, n_features, weight, score and rank; rank is null for rows not drawn."""
    rows = weighted(docs, gains(docs, target, width, buckets), width).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = stage(rows, "importance-rows")
    enough = F.col("n_words") >= least_words
    draws = percent * rows.filter(enough).count() // 100
    drawn = ranked(rows.filter(enough), [F.desc("score"), F.asc_nulls_last("doc_id")]).withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    return drawn.unionByName(rows.filter(~enough).withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The drawn documents with their columns; rows equal in doc_id and text are drawn together."""
    keys = stage(importance_ranks(docs, target, **parameters).filter("rank IS NOT NULL").select("doc_id", "text_key").distinct(), "importance-drawn")
    keys = small_side(keys)
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["doc_id"]) & (F.xxhash64(docs["text"]) == keys["text_key"]), "left_semi")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return importance_ranks(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


#: crc32 of a word in SQL: the table of the reflected polynomial by its rule, then byte by byte.
ORACLE_OP13 = r"""
WITH RECURSIVE bits AS (SELECT i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8
), texts AS (SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (SELECT side, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
), counted AS (SELECT side, doc_id, word, count(*) AS n FROM words GROUP BY ALL
), bytes AS (SELECT word, [CAST('0x' || hex(encode(word))[2 * i - 1:2 * i] AS BIGINT) FOR i IN range(1, octet_length(encode(word)) + 1)] AS b FROM (SELECT DISTINCT word FROM counted)
), coded AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, steps[xor(c & 255, x) + 1]))) % 10000 AS bucket FROM bytes, crc
), sides AS (SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM counted JOIN coded USING (word) GROUP BY bucket
), totals AS (SELECT CAST(sum(s) AS DOUBLE) AS all_s, CAST(sum(t) AS DOUBLE) AS all_t FROM sides
), gains AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000) / ((coalesce(s, 0) + 1) * (all_t + 10000)))) AS BIGINT) AS gain FROM sides, totals
), sums AS (SELECT doc_id, sum(n) AS n, sum(n * gain) AS gain FROM counted JOIN coded USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id
), scored AS (SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce((gain - ((gain % n) + n) % n) // n, 0) AS BIGINT) AS weight,
    CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS noise FROM documents LEFT JOIN sums USING (doc_id)
), placed AS (SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS competitors FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * competitors // 100 THEN place END AS rank FROM placed
"""
