"""Exact deduplication by an exchange of Golomb-coded fingerprints.

A source is a block of up to ``BLOCK`` rows of one task. It sorts the fingerprints of its
texts and sends every owner, which has a range of them, one list: the distinct ones as gaps
in Golomb's code. An owner decodes its lists and returns a bitmap for each: which of the
fingerprints stand in another list as well. With its bitmaps and its own repeats a source
knows its suspects; all other rows are the only ones of their text. Fingerprints are cut to
the bits that the counted rows need, so a few rows are suspects in vain. The suspects' texts
are then compared as bytes: they are the keys of an aggregation, which combines the copies
inside a task before it shuffles.

Texts are equal when they are identical after every run of white space (space, U+0009 to
U+000D) became one space. Of equal texts the row with the smallest doc_id stays.

Defined cases: a null text counts as empty; a null doc_id is larger than any other; of rows
equal in doc_id and text one stays; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import log, log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import batch_of, free_name, shuffle_width, stage

#: Rows of a source, and the bits by which fingerprints exceed the logarithm of all rows.
BLOCK, SPARE_BITS = 1 << 16, 10
#: About so many fingerprints go to one owner.
OWNER_PRINTS = 1 << 22
#: Up to so many bitmaps of so many bytes in all, or so many ids, are sent to every executor.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 16_000_000
#: A group with more than this share of the rows is joined by broadcast; there are fewer than so many.
HOT_GROUPS = 10_000

LISTS = pa.schema([("block", pa.int64()), ("owner", pa.int32()), ("n", pa.int32()), ("shift", pa.int32()), ("prints", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("digests", pa.binary()), ("places", pa.binary())])
MARKS = pa.schema([("block", pa.int64()), ("owner", pa.int32()), ("marks", pa.binary())])
ROWS = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("row", pa.int64()), ("suspect", pa.bool_())])


def normalised(text: Column) -> Column:
    """Every run of white space is one space; null is empty. Single spaces aren't replaced anew."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def golomb_shift(n: int, span: int) -> int:
    """Bits of the remainders for n values spread over ``span``: the best power of two as Golomb's divisor."""
    return max(0, int(log2(max(1.0, log(2) * span / max(1, n)))))


def golomb_encode(values: np.ndarray, low: int, shift: int) -> bytes:
    """Ascending distinct values from ``low`` on: quotients of their gaps in unary, then all remainders."""
    gaps = np.diff(values, prepend=np.uint64(low))
    gaps[1:] -= np.uint64(1)
    ends = np.cumsum((gaps >> np.uint64(shift)) + np.uint64(1)).astype(np.int64)
    unary = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    rest = (gaps[:, None] >> np.arange(shift, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(unary).tobytes() + np.packbits(rest.astype(np.uint8).ravel()).tobytes()


def golomb_decode(data: bytes, n: int, low: int, shift: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    ends = np.flatnonzero(bits)[:n] + 1
    quotients = np.diff(ends, prepend=0).astype(np.uint64) - np.uint64(1)
    start = (int(ends[-1]) + 7) // 8 * 8 if n else 0
    rest = bits[start : start + n * shift].reshape(n, shift).astype(np.uint64)
    gaps = (quotients << np.uint64(shift)) + (rest << np.arange(shift, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    gaps[1:] += np.uint64(1)
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(low)


def fingerprints(digests: bytes, bits: int) -> np.ndarray:
    """The leading bits of digests of 32 bytes each."""
    return np.frombuffer(digests, ">u8").reshape(-1, 4)[:, 0].astype(np.uint64) >> np.uint64(64 - bits)


def _low(owner: int, owners: int, bits: int) -> int:
    """The least fingerprint of an owner."""
    return -(-(owner << bits) // owners)


def _lists(rows: DataFrame, bits: int, owners: int) -> DataFrame:
    """Per source and owner: the coded list, and what stays with the source, in the order of fingerprints."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        digests: list[bytes] = []
        blocks = 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal ids, digests, blocks
            doc_ids, data = pa.concat_arrays(ids), b"".join(digests)
            name = TaskContext.get().partitionId() << 16 | blocks
            ids, digests, blocks = [], [], blocks + 1
            prints = fingerprints(data, bits)
            order = np.argsort(prints, kind="stable")
            prints, doc_ids, wide = prints[order], doc_ids.take(pa.array(order)), np.frombuffer(data, "V32")[order]
            ends = np.searchsorted(prints, np.array([_low(o + 1, owners, bits) for o in range(owners)], np.uint64))
            out, start = [], 0
            for owner, end in enumerate(ends.tolist()):
                if end > start:
                    own = np.unique(prints[start:end])
                    shift = golomb_shift(len(own), (1 << bits) // owners)
                    coded = golomb_encode(own, _low(owner, owners, bits), shift)
                    out.append((name, owner, len(own), shift, coded, doc_ids[start:end].to_pylist(), wide[start:end].tobytes(), order[start:end].astype(np.int32).tobytes()))
                start = end
            yield batch_of(LISTS, *zip(*out))

        held = 0
        for batch in batches:
            at = 0
            while at < len(batch):
                part = batch.slice(at, BLOCK - held)
                at, held = at + len(part), held + len(part)
                ids.append(part["doc_id"])
                digests.append(b"".join(part["digest"].to_pylist()))
                if held == BLOCK:
                    yield from block()
                    held = 0
        if held:
            yield from block()

    return rows.mapInArrow(send, "block long, owner int, n int, shift int, prints binary, doc_ids array<long>, digests binary, places binary")


def _marks(sent: DataFrame, bits: int, owners: int) -> DataFrame:
    """The owners' answers: a bit for each fingerprint of a list that another list holds too."""

    def answer(lists: pa.Table) -> pa.Table:
        owner, sizes = lists["owner"][0].as_py(), lists["n"].to_numpy()
        low = _low(owner, owners, bits)
        values = np.concatenate([golomb_decode(d, n, low, s) for d, n, s in zip(lists["prints"].to_pylist(), sizes.tolist(), lists["shift"].to_pylist())])
        order = np.argsort(values, kind="stable")
        same = values[order][1:] == values[order][:-1]
        twice = np.zeros(len(values), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        marks = [np.packbits(x).tobytes() for x in np.split(twice, np.cumsum(sizes)[:-1])]
        return pa.table([lists["block"].combine_chunks(), lists["owner"].combine_chunks(), pa.array(marks, pa.binary())], schema=MARKS)

    return sent.groupBy("owner").applyInArrow(answer, "block long, owner int, marks binary")


def _marked(lists: DataFrame, bits: int) -> DataFrame:
    """Rows of the lists, each with what its bitmap says."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                digests, places = batch["digests"][k].as_py(), np.frombuffer(batch["places"][k].as_py(), np.int32)
                _, which, counts = np.unique(fingerprints(digests, bits), return_inverse=True, return_counts=True)
                elsewhere = np.unpackbits(np.frombuffer(batch["marks"][k].as_py(), np.uint8), count=len(counts)).astype(bool)
                wide = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(places), [None, pa.py_buffer(digests)])
                yield batch_of(ROWS, batch["doc_ids"][k].values, wide.cast(pa.binary()), (batch["block"][k].as_py() << 20) + places.astype(np.int64), (elsewhere | (counts > 1))[which])

    return lists.select("block", "doc_ids", "digests", "places", "marks").mapInArrow(unpack, "doc_id long, digest binary, row long, suspect boolean")


def _small(rows: DataFrame, size: Column) -> DataFrame:
    """``rows``, for broadcast if their counted number and size are small."""
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(rows) if n <= BROADCAST_ROWS and total <= BROADCAST_BYTES else rows


def _answers(rows: DataFrame, key: list[str], total: int) -> DataFrame:
    """doc_id, digest, keep_id, group_size and kept; rows with equal ``key`` are a group.

    Groups are joined back to their rows: the few that hold a large share of all rows by
    broadcast, the others, each small, by a shuffle."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    groups = stage(rows.groupBy(*key).agg(F.count("*").alias("group_size"), first).select(*key, "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")), "exact-groups")
    is_hot = F.col("group_size") * HOT_GROUPS > total
    hot = F.broadcast(groups.filter(is_hot))
    met = rows.join(hot, key).unionByName(rows.join(hot.select(*key), key, "left_anti").join(groups.filter(~is_hot), key))
    return met.select("doc_id", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"))


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Per row: doc_id, digest, keep_id, group_size, kept. ``digest`` gives 64 hex digits of a
    normalised text; texts are equal by their bytes, whatever it gives."""
    n = docs.count()
    bits = min(62, SPARE_BITS + max(1, n).bit_length())
    owners = max(shuffle_width(docs.sparkSession), n // OWNER_PRINTS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"))
    texts = texts.withColumn("digest", F.unhex(digest(F.col("norm"))))
    lists = stage(_lists(texts.select("doc_id", "digest"), bits, owners), "exact-lists")
    marks = stage(_marks(lists.select("owner", "block", "n", "shift", "prints"), bits, owners), "exact-marks")
    rows = stage(_marked(lists.join(_small(marks, F.octet_length("marks") + 24), ["block", "owner"]), bits), "exact-rows")
    suspects = rows.filter("suspect").drop("suspect")

    named = _small(suspects.filter("doc_id IS NOT NULL").select("doc_id").distinct(), F.lit(8))
    seen = texts.filter("doc_id IS NOT NULL").join(named, "doc_id", "left_semi").unionByName(texts.filter("doc_id IS NULL"))
    compared = seen.groupBy("digest", "norm").agg(F.count("*").alias("n")).groupBy("digest").agg(F.count("*").alias("n_texts"))
    clashing = stage(compared.filter("n_texts > 1").select("digest"), "exact-clashing")

    alone = rows.filter("NOT suspect").select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    if clashing.isEmpty():
        return alone.unionByName(_answers(suspects, ["digest"], n))
    # Different bytes under one digest: their rows are grouped by the texts themselves.
    clash = _small(clashing, F.lit(32))
    apart = stage(seen.join(clash, "digest", "left_semi").withColumn("row", F.monotonically_increasing_id()), "exact-apart")
    apart = _answers(apart, ["digest", "norm"], n)
    return alone.join(clash, "digest", "left_anti").unionByName(_answers(suspects.join(clash, "digest", "left_anti"), ["digest"], n)).unionByName(apart)


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without all but the first row of each group of equal texts, with its columns."""
    key = free_name(docs, "text_digest")
    kept = stage(exact_groups(docs).filter("kept").select(F.col("doc_id").alias("keep_id"), F.col("digest").alias("keep_digest"), "group_size"), "exact-kept")
    keyed = docs.withColumn(key, F.unhex(sha256(normalised(F.col("text")))))

    def those(keep: DataFrame) -> DataFrame:
        keep = _small(keep.select("keep_id", "keep_digest"), F.lit(40))
        return keyed.join(keep, keyed["doc_id"].eqNullSafe(keep["keep_id"]) & (keyed[key] == keep["keep_digest"]), "left_semi")

    return those(kept.filter("group_size = 1")).unionByName(those(kept.filter("group_size > 1")).dropDuplicates(["doc_id", key])).drop(key)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE_OP12 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW same AS (PARTITION BY norm)
"""
