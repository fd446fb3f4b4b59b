"""Substring deduplication by difference-cover anchors.

A window is ``length`` consecutive words. Positions of a document are anchors where they
are, modulo a period v, in a difference cover: for any two positions i and j some k < v
puts both i + k and j + k in the cover. With anchor windows of length - v + 1 words, two
equal windows therefore hold a pair of equal anchors at the same offset, and only about
sqrt(v) of v positions are hashed and shuffled. Anchors that several documents share are
then extended: the full windows around them are hashed, and a window is a repeat where the
least document with its words is smaller than its own. Windows and texts are told apart by
two hashes of 64 bits each.

Equal texts are one class beforehand: only the smallest document of a class takes part,
and in the others every window repeats. Windows are judged on the input.

Defined cases: a null or empty text has no words; a text of fewer words than a window
loses nothing; rows that repeat a doc_id, a null one too, are judged alike where their
texts are the same and each by its own words where they differ; a null doc_id is larger
than any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import ascii_words, batch_of, mix64, stage, utf8, window_hashes, word_hashes

PERIOD = 31
#: Up to so many rows, of so many numbers in all, are sent to every executor; beyond, texts are shuffled.
BROADCAST_ROWS, BROADCAST_NUMBERS = 1_000_000, 4_000_000
#: A text all of whose words go.
ALL = -1

#: What names a text: its document, and a hash, as a doc_id may come with several texts.
ROW = ["doc", "text_key"]

CLASS = pa.schema([("doc", pa.int64()), ("text_key", pa.int64()), ("class_key", pa.int64()), ("class_check", pa.int64()), ("n_words", pa.int64())])
ANCHOR = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("text_key", pa.int64()), ("pos", pa.int32())])
RUNS = pa.schema([("doc", pa.int64()), ("text_key", pa.int64()), ("runs", pa.list_(pa.int32()))])
WINDOW = pa.schema([("window", pa.int64()), ("check", pa.int64()), ("doc", pa.int64()), ("text_key", pa.int64()), ("pos", pa.int32())])
KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
NULL_DOC = (1 << 63) - 1


@lru_cache
def difference_cover(period: int) -> tuple[int, ...]:
    """A small set of residues whose differences are all residues: a search for one as small
    as counting allows, else 0..r-1 with the multiples of r, where r * r >= period."""
    size = 1
    while size * (size - 1) + 1 < period:
        size += 1

    def grow(chosen: tuple[int, ...], covered: frozenset[int]) -> tuple[int, ...] | None:
        if len(chosen) == size:
            return chosen if len(covered) == period else None
        for x in range(chosen[-1] + 1, period):
            new = {(x - c) % period for c in chosen} | {(c - x) % period for c in chosen}
            if size * (size - 1) + 1 == period and (new & covered or len(new) < 2 * len(chosen)):
                continue
            if found := grow((*chosen, x), covered | new):
                return found
        return None

    if found := grow((0,), frozenset({0})) if period <= 64 else None:
        return found
    r = int(np.ceil(np.sqrt(period)))
    return tuple(sorted({*range(r), *(k * r % period for k in range(r + 1))}))


def anchor_positions(n: int, width: int, period: int) -> np.ndarray:
    at = np.arange(max(0, n - width + 1))
    return at[np.isin(at % period, difference_cover(period))]


def merged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The union of the intervals [start, end), as start, end, start, end, ..."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return np.column_stack([starts[new], np.append(ends[:-1][new[1:]], ends[-1])]).ravel()


def inside(runs: np.ndarray, n: int) -> np.ndarray:
    """The numbers from 0 to n - 1 that lie in the runs."""
    runs = np.clip(runs, 0, n).reshape(-1, 2)
    return np.concatenate([np.empty(0, np.int64), *(np.arange(a, b) for a, b in runs)])


def window_key(words: np.ndarray, width: int) -> np.ndarray:
    return window_hashes(words, width)


def window_check(words: np.ndarray, width: int) -> np.ndarray:
    """A second hash of every window, of other numbers for its words: both make 128 bits."""
    return window_hashes(mix64(words ^ np.uint64(0xA0761D6478BD642F)), width)


def _columns(schema: pa.Schema, columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    return batch_of(schema, *(np.concatenate(c).astype(f.type.to_pandas_dtype()) for c, f in zip(columns, schema)))


def _classes(docs: DataFrame) -> DataFrame:
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [word_hashes(t) for t in utf8(batch["text"])]
            keys = [[xxhash.xxh3_64_intdigest(w.tobytes(), seed) - (1 << 63) for w in words] for seed in (0, 1)]
            yield batch_of(CLASS, batch["doc"], batch["text_key"], *keys, [len(w) for w in words])

    return docs.mapInArrow(digest, "doc long, text_key long, class_key long, class_check long, n_words long")


def _anchors(docs: DataFrame, length: int, period: int) -> DataFrame:
    width = length - period + 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for doc, key, text in zip(batch["doc"].to_pylist(), batch["text_key"].to_pylist(), utf8(batch["text"])):
                words = word_hashes(text)
                if len(words) >= length:
                    at = anchor_positions(len(words), width, period)
                    for column, values in zip(columns, (window_hashes(words, width)[at].view(np.int64), np.full(len(at), doc), np.full(len(at), key), at)):
                        column.append(values)
            if columns[0]:
                yield _columns(ANCHOR, columns)

    return docs.mapInArrow(find, "anchor long, doc long, text_key long, pos int")


def _windows(docs: DataFrame, length: int) -> DataFrame:
    """Hashes of the whole windows that start in ``runs``; docs: doc, text_key, text, runs."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for doc, key, text, runs in zip(batch["doc"].to_pylist(), batch["text_key"].to_pylist(), utf8(batch["text"]), batch["runs"]):
                words = word_hashes(text)
                at = inside(np.array(runs.as_py(), np.int64), max(0, len(words) - length + 1))
                if len(at):
                    for column, values in zip(columns, (window_key(words, length)[at].view(np.int64), window_check(words, length)[at].view(np.int64), np.full(len(at), doc), np.full(len(at), key), at)):
                        column.append(values)
            if columns[0]:
                yield _columns(WINDOW, columns)

    return docs.select(*ROW, "text", "runs").mapInArrow(extend, "window long, check long, doc long, text_key long, pos int")


def _runs(positions: DataFrame, before: int, after: int) -> DataFrame:
    """doc, text_key and runs: the union of [pos - before, pos + after) over the text's positions."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [np.array(p.as_py(), np.int64) for p in batch["positions"]]
            yield batch_of(RUNS, batch["doc"], batch["text_key"], [merged(np.maximum(0, p - before), p + after) for p in at])

    found = positions.groupBy(*ROW).agg(F.collect_set("pos").alias("positions"))
    return found.mapInArrow(merge, "doc long, text_key long, runs array<int>")


def _with(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """docs joined with rows on ROW; rows go to all executors only if their counted size is small."""
    numbers = F.sum(F.size("runs")) if "runs" in rows.columns else F.lit(0)
    n, total = rows.agg(F.count("*"), F.coalesce(numbers, F.lit(0))).first()
    few = n <= BROADCAST_ROWS and total <= BROADCAST_NUMBERS
    return docs.join(F.broadcast(rows) if few else rows, ROW, how)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(NULL_DOC)).alias("doc"), F.xxhash64("text").alias("text_key"), "text")


def find_repeats(docs: DataFrame, length: int = 50, period: int = PERIOD) -> DataFrame:
    """doc (doc_id, a null one as the largest), text_key and runs of words to remove; ALL for a copy of
    a smaller document's text. Texts that keep every word have no row."""
    texts = _texts(docs)
    classes = stage(_classes(texts).filter(F.col("n_words") >= length), "substring-classes")
    least = classes.groupBy("class_key", "class_check", "n_words").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least <> most").drop("most")
    copies = stage(classes.join(stage(least, "substring-least"), ["class_key", "class_check", "n_words"]).filter("doc > least").select(*ROW).distinct(), "substring-copies")
    texts = _with(texts, copies, "left_anti")

    anchors = _anchors(texts, length, period)
    shared = anchors.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low <> high").select("anchor")
    met = anchors.join(stage(shared, "substring-shared"), "anchor").select(*ROW, "pos")
    around = stage(_runs(met, length - (length - period + 1), 1), "substring-around")

    windows = _windows(_with(texts, around, "inner"), length)
    first = windows.groupBy("window", "check").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low <> high").drop("high")
    repeats = windows.join(stage(first, "substring-first"), ["window", "check"]).filter("doc > low").select(*ROW, "pos")
    everything = copies.select(*ROW, F.array(F.lit(ALL)).alias("runs"))
    return stage(_runs(repeats, 0, length).unionByName(everything), "substring-repeats")


def remove_repeats(docs: DataFrame, length: int = 50, period: int = PERIOD) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed and kept, its remaining words joined by one space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch["text"], batch["runs"]):
                words, gone = ascii_words(text.as_py()), runs.as_py()
                if gone == [ALL]:
                    kept = []
                elif gone:
                    lost = np.zeros(len(words), bool)
                    lost[inside(np.array(gone, np.int64), len(words))] = True
                    kept = [w for w, x in zip(words, lost.tolist()) if not x]
                else:
                    kept = words
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
            yield batch_of(KEPT, batch["doc_id"], *(zip(*out) if out else ([], [], [])))

    marked = _with(_texts(docs), find_repeats(docs, length, period), "left")
    return marked.select("doc_id", "text", "runs").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_OP8 = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t WHERE len(w) >= 50)
), f AS (SELECT h, min(doc_id) AS first_doc FROM h GROUP BY h
), g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM h JOIN f USING (h) WHERE doc_id > first_doc
), words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM t
), kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM t LEFT JOIN kept USING (doc_id)
"""
