"""Quality by random-indexing word vectors and a small network.

Random indexing: every context item has a fixed sparse vector of +1 and -1; the vector of
a word is the sum of its neighbours' vectors over the whole corpus, summed per task and
then per item. Items are hash buckets of words and of their shapes. Distinct words of the
corpus are counted first, and there are as many word buckets, up to WORD_BUCKETS: the table
goes to all executors, so it needs a bound (13 MB). A document is the mean of
its items' vectors, with the share of words that repeat the one before. A two-layer numpy
network, fitted on a bounded sample of labelled rows, gives a logit, and a temperature
chosen on a part of that sample turns it into a probability.

Defined cases: a null or empty text has a zero vector and the score that this gets; texts
are read whole; equal texts get equal scores; without labels of both kinds the score is
the smoothed share of label 1; an empty table gives an empty result; labels, lang, source
and doc_id are never inputs; other columns stay as they are, but for one that has the score's name.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pricelake.llm.common import batch_of, distinct, mix64, pieces, release, releasing, small_batches, utf8, word_bounds, word_hashes
from pricelake.llm.labels import fold, labelled

#: Word buckets at most and at least; in between, the power of two that holds all distinct words.
WORD_BUCKETS, LEAST_BUCKETS = 1 << 16, 1 << 12
SHAPE_BUCKETS, DIMENSIONS, NONZERO, REACH = 1 << 9, 48, 6, 2
#: Labelled rows that the network is fitted on, at most: those whose ids hash lowest.
SAMPLE = 12_000
HIDDEN, EPOCHS, SEED = 24, 60, 17
THRESHOLD = 0.7
CHUNK = 32_768

_UPPER, _DIGIT, _SIGN = 1, 2, 4


@cache
def sign_kinds() -> np.ndarray:
    """Of each code point: is it an upper-case letter, a digit, or neither letter, mark, number nor blank?"""
    kinds = np.zeros(sys.maxunicode + 1, np.uint8)
    for k in range(len(kinds)):
        group = unicodedata.category(chr(k))
        kinds[k] = _UPPER if group in ("Lu", "Lt") else _DIGIT if group == "Nd" else _SIGN if group[0] in "PSC" and group not in ("Cn", "Co", "Cs") else 0
    return kinds


def folded_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words in lower case."""
    return np.concatenate([word_hashes(p.lower() if p.isascii() else p.decode("utf-8", "replace").lower().encode()) for p in pieces(text)])


def document_items(text: bytes, word_buckets: int = WORD_BUCKETS) -> np.ndarray:
    """A code for each word: its bucket, and the bucket of its shape, piece by piece of the text."""
    return np.concatenate([_items(piece, word_buckets) for piece in pieces(text)])


def _items(text: bytes, word_buckets: int) -> np.ndarray:
    """Codes of a piece of a text.

    A shape is: no, first or most letters upper case; digits or not; how many signs that are
    neither letters nor digits, up to four; which they are if they are at most three, or else
    the last one.
    """
    points = np.frombuffer(text, np.uint8) if text.isascii() else np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts, ends = word_bounds(np.minimum(points, 255).astype(np.uint8))
    if not len(starts):
        return np.empty(0, np.int32)
    kinds = sign_kinds()[points]

    def within(values: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(points) + 1, values.dtype)
        np.cumsum(values, out=sums[1:])
        return sums[ends] - sums[starts]

    marks = kinds == _SIGN
    upper, others = within((kinds == _UPPER).astype(np.int32)), within(marks.astype(np.int32))
    named = np.zeros(len(points), np.uint64)
    named[marks] = mix64(points[marks].astype(np.uint64) + np.uint64(1))
    last = points[ends - 1]
    which = np.where(others <= 3, within(named), np.where(marks[ends - 1], last, 0).astype(np.uint64))
    case = np.where(2 * upper > ends - starts - others, 2, np.minimum(upper, 1))
    key = (case * 2 + (within((kinds == _DIGIT).astype(np.int32)) > 0)) * 5 + np.minimum(others, 4)
    shapes = mix64(which * np.uint64(32) + key.astype(np.uint64)) % np.uint64(SHAPE_BUCKETS)
    return (folded_hashes(text) % np.uint64(word_buckets) * np.uint64(SHAPE_BUCKETS) + shapes).astype(np.int32)


def split_items(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word buckets, shape buckets), in the narrow type that sorts fastest."""
    return (codes // SHAPE_BUCKETS).astype(np.uint16), (codes % SHAPE_BUCKETS).astype(np.uint16)


def index_vectors(word_buckets: int = WORD_BUCKETS, seed: int = SEED) -> np.ndarray:
    """The fixed sparse vectors of all items: words, then shapes."""
    rng = np.random.default_rng(seed)
    out = np.zeros((word_buckets + SHAPE_BUCKETS, DIMENSIONS), np.int8)
    for start in range(0, len(out), LEAST_BUCKETS):
        part = out[start : start + LEAST_BUCKETS]
        places = np.argsort(rng.random(part.shape, np.float32), axis=1)[:, :NONZERO]
        np.put_along_axis(part, places, rng.choice(np.array([-1, 1], np.int8), places.shape), axis=1)
    return out


class ContextSums:
    """Sums of neighbours' index vectors by item."""

    def __init__(self, word_buckets: int = WORD_BUCKETS):
        index = index_vectors(word_buckets)
        self.word_buckets, self.words, self.shapes = word_buckets, index[:word_buckets], index[word_buckets:]
        self.sums = np.zeros(index.shape, np.int64)
        self.counts = np.zeros(len(index), np.int64)

    def add(self, codes: np.ndarray) -> None:
        """Codes of consecutive words; neighbours are up to REACH words away."""
        for start in range(0, len(codes), CHUNK):
            low = max(0, start - REACH)
            buckets, shapes = split_items(codes[low : start + CHUNK + REACH])
            own = slice(start - low, start - low + min(CHUNK, len(codes) - start))
            vectors = self.words[buckets] + self.shapes[shapes]
            around = np.zeros_like(vectors)  # at most 2 * 2 * REACH either way
            for d in range(1, min(REACH, len(buckets) - 1) + 1):
                around[d:] += vectors[:-d]
                around[:-d] += vectors[d:]
            around = around[own]
            for ids, base in ((buckets[own], 0), (shapes[own], self.word_buckets)):
                order = np.argsort(ids, kind="stable")
                ranked = ids[order]
                first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
                kinds = ranked[first].astype(np.int64) + base
                self.sums[kinds] += np.add.reduceat(around[order], first, axis=0, dtype=np.int32)
                self.counts[kinds] += np.diff(np.append(first, len(ranked)))


SUMS = pa.schema([("item", pa.int32()), ("vector", pa.list_(pa.int64()))])
#: One in so many of all possible hashes is counted.
COUNTED = 64


def bucket_count(docs: DataFrame) -> int:
    """The power of two that holds the corpus's distinct words, within the bounds.

    All words whose hash lies in one of COUNTED equal ranges are counted exactly.
    """

    @releasing
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate([np.empty(0, np.uint64), *(h[h < 2**64 // COUNTED] for h in map(folded_hashes, utf8(batch["text"])))])
            yield pa.RecordBatch.from_arrays([pa.array(distinct(found).view(np.int64))], names=["word"])

    with small_batches(docs.sparkSession):
        n = COUNTED * docs.select("text").mapInArrow(words, "word long").distinct().count()
    return min(WORD_BUCKETS, max(LEAST_BUCKETS, 1 << max(0, n - 1).bit_length()))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all items, from all documents; unseen items have zero vectors."""
    buckets = bucket_count(docs)

    @releasing
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, waiting, held = ContextSums(buckets), [], 0
        gap = np.zeros(REACH, np.int32)  # texts are neighbours of nothing but this filler
        for batch in batches:
            for text in utf8(batch["text"]):
                waiting += [document_items(text, buckets), gap]
                held += len(waiting[-2])
                if held >= CHUNK:
                    sums.add(np.concatenate(waiting))
                    waiting, held = [], 0
        if waiting:
            sums.add(np.concatenate(waiting))
        seen = np.flatnonzero(sums.counts)
        for some in np.array_split(seen, len(seen) // CHUNK + 1):
            vectors = pa.ListArray.from_arrays(np.arange(0, DIMENSIONS * len(some) + 1, DIMENSIONS, dtype=np.int32), sums.sums[some].ravel())
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), vectors], schema=SUMS)

    parts = docs.select("text").mapInArrow(add, "item int, vector array<long>")
    total = parts.groupBy("item").agg(*[F.sum(F.col("vector")[d]).cast("float").alias(f"v{d}") for d in range(DIMENSIONS)])
    table = np.zeros((buckets + SHAPE_BUCKETS, DIMENSIONS), np.float32)
    with small_batches(docs.sparkSession):
        rows = total.toArrow()  # at most a row for each bucket
    items = rows["item"].to_numpy()
    for d in range(DIMENSIONS):
        table[items, d] = rows[f"v{d}"].to_numpy()
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(norm > 0, norm, np.float32(1))


class Pool:
    """A document's features: mean vectors of words and of shapes, their spread, repetition, length."""

    WIDTH = 3 * DIMENSIONS + 3

    def __init__(self, vectors: np.ndarray):
        self.words, shapes = vectors[:-SHAPE_BUCKETS], vectors[-SHAPE_BUCKETS:].astype(np.float64)
        self.shapes = np.hstack([shapes, shapes**2])

    def features(self, text: bytes) -> np.ndarray:
        out, codes = np.zeros(self.WIDTH), document_items(text, len(self.words))
        if n := len(codes):
            buckets, shapes = split_items(codes)
            out[:DIMENSIONS] = self.words[buckets].mean(axis=0)
            moments = np.bincount(shapes, minlength=SHAPE_BUCKETS) @ self.shapes / n
            out[DIMENSIONS : 2 * DIMENSIONS] = moments[:DIMENSIONS]
            out[2 * DIMENSIONS : 3 * DIMENSIONS] = np.sqrt(np.maximum(moments[DIMENSIONS:] - moments[:DIMENSIONS] ** 2, 0))
            out[-3] = (codes[1:] == codes[:-1]).mean() if n > 1 else 0.0
            out[-2] = len(distinct(codes)) / math.sqrt(n)
            out[-1] = math.log1p(n)
        return out


@dataclass
class Network:
    """Standardised features, one hidden layer, a logit, a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    #: False if the labels did not suffice: all scores are then their smoothed share.
    fitted: bool = True

    def logits(self, x: np.ndarray) -> np.ndarray:
        # row by row: in one large product, equal rows can differ in the last digit
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.array([np.tanh(row @ self.w1 + self.b1) @ self.w2 + self.b2 for row in z])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
    """Adam on three quarters of the rows; the temperature of least log loss on the rest."""
    rng = np.random.default_rng(seed)
    prior = (y.sum() + 1) / (len(y) + 2)
    width = x.shape[1]
    if len(y) < 8 or y.min(initial=1) == y.max(initial=0):
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(prior / (1 - prior))), fitted=False)
    order = rng.permutation(len(y))
    held, fit = order[: len(y) // 4], order[len(y) // 4 :]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
    w = [rng.normal(0, 1 / math.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN), np.array([np.log(prior / (1 - prior))])]
    first, second, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    z = np.clip((x - mean) / scale, -8, 8)
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // 128)):
            step += 1
            h = np.tanh(z[rows] @ w[0] + w[1])
            d = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3][0], -60, 60))) - y[rows]) / len(rows)
            dh = np.outer(d, w[2]) * (1 - h * h)
            for i, g in enumerate((z[rows].T @ dh + 1e-3 * w[0], dh.sum(axis=0), h.T @ d + 1e-3 * w[2], np.array([d.sum()]))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                w[i] = w[i] - 0.01 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, w[0], w[1], w[2], float(w[3][0]))
    logits, truth = net.logits(x[held]), y[held]

    def loss(t: float) -> float:
        s = np.clip(logits / t, -40, 40)
        return float(np.mean(np.log1p(np.exp(-s)) * truth + np.log1p(np.exp(s)) * (1 - truth)))

    net.temperature = min((float(t) for t in np.geomspace(0.25, 8, 41)), key=loss)
    return net


FEATURES = pa.schema([("label", pa.int32()), ("features", pa.list_(pa.float64()))])
SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents, and the network from at most ``sample`` of the labels given."""
    vectors = word_vectors(docs)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)
    chosen = labelled(labels, "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")

    @releasing
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = Pool(sent.value)
        for batch in batches:
            yield batch_of(FEATURES, batch["label"], [pool.features(t) for t in utf8(batch["text"])])

    with small_batches(docs.sparkSession):
        found = rows.mapInArrow(features, "label int, features array<double>").toPandas()
    x = np.stack(found["features"].to_list()) if len(found) else np.zeros((0, Pool.WIDTH))
    order = np.lexsort([*x.T[-3:], found["label"].to_numpy()]) if len(found) else []
    network = fit_network(x[order], found["label"].to_numpy(float)[order])
    del rows, found, x
    release()  # the driver lives on too
    return vectors, network


def score(docs: DataFrame, vectors: np.ndarray, network: Network, name: str = "quality_score") -> DataFrame:
    """docs with a column ``name``, in place of one already called so; all others stay."""
    docs = docs.drop(name)
    sent = docs.sparkSession.sparkContext.broadcast((vectors, network))

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, net = sent.value
        pool = Pool(table)
        for batch in batches:
            x = np.array([pool.features(t) for t in utf8(batch["text"])]).reshape(-1, Pool.WIDTH)
            yield batch.append_column(name, pa.array(net.scores(x), pa.float64()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def with_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all rows by a model of the labelled rows outside the held-out fold."""
    return score(docs, *fit(docs, labels.filter(fold(F.col("doc_id"), 4) != 2)))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = with_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
