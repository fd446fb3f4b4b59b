"""Toxicity by class-conditional Kneser-Ney models over the signs of words.

Two models, of toxic and of ordinary labelled documents, have counts of their own for runs
of five signs inside a word; below, both share one chain of continuation counts, taken
over both classes, so rare and inflected expressions are smoothed alike and the classes
differ only where their own counts speak. A word's evidence is the difference of its two
log-likelihoods; documents are compared by that difference, normalised by length, over the
whole text, over each line, and for the strongest words, which are also counted. A logistic function of these
gives the score; it is fitted on a fold of the labelled rows (one row in five), by models
whose counts leave that fold out. Scores come from models that count all labelled rows.

Counts are summed by Spark and stay in staged tables under the full 64-bit hash of a run. What the models say is looked up
once for every run of the corpus, by joins with these tables. The runs found in the most
parts of the corpus go to the executors; the values of any others are joined to the
documents that hold them, so nothing is shared between runs and nothing has a fixed size.

Defined cases: a null or empty text has no evidence and gets the score of none; texts are
read whole; equal texts get equal scores; without labels of both kinds the score is the
smoothed share of label 1; an empty table gives an empty result; labels, lang, source and
doc_id are never inputs; other columns stay as they are, but for one that has the score's name.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import neg
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import batch_of, mix64, small_batches, small_side, stage, text_of
from pricelake.llm.labels import fold, labelled

ORDER = 5
DISCOUNT = 0.75
#: Signs that the lowest model spreads its rest over.
ALPHABET = 1 << 12
#: Labelled rows on which the logistic function is fitted, by counts without them, at most.
CALIBRATION_SAMPLE = 20_000
CALIBRATION_FOLDS = 5
BROADCAST_LABELS = 1_000_000
THRESHOLD = 0.7
KNOWN_WORDS = 400_000
#: Signs whose runs are cut at a time, if no single word has more, and runs a task remembers as sent.
SIGNS_AT_ONCE, KNOWN_RUNS = 200_000, 2_000_000
#: Runs whose values go to every executor, at most; the values of rarer ones are joined to documents.
SENT_RUNS = 2_000_000
START, END = "\x02", "\x03"
_STEP = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[str]:
    return text_of(text).lower().split()


def portions(words: list[str]) -> Iterator[list[str]]:
    """The words in order, in lists of about SIGNS_AT_ONCE signs at most."""
    part, held = [], 0
    for w in words:
        if part and held + len(w) > SIGNS_AT_ONCE:
            yield part
            part, held = [], 0
        part.append(w)
        held += len(w) + ORDER
    if part:
        yield part


def runs(words: list[str]) -> tuple[np.ndarray, dict[int, np.ndarray], np.ndarray]:
    """(word index, {k: hash of the k signs that end at each position}, positions).

    A word stands between ORDER - 1 start signs and an end sign; positions are those of its
    own signs and of the end sign.
    """
    pad = START * (ORDER - 1)
    joined = "".join([pad + w + END for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + ORDER
    word = np.repeat(np.arange(len(words)), lengths)
    offset = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.flatnonzero(offset >= ORDER - 1)
    hashes: dict[int, np.ndarray] = {}
    total, power = np.zeros(len(codes), np.uint64), 1
    for k in range(1, ORDER + 1):
        shifted = np.zeros_like(codes)
        shifted[k - 1 :] = codes[: len(codes) - k + 1]
        total = total + (shifted + np.uint64(1)) * np.uint64(power)
        power = power * _STEP % (1 << 64)
        hashes[k] = mix64(total + np.uint64(k))
    return word[at], hashes, at


COUNTS = pa.schema([("toxic", pa.int64()), ("ordinary", pa.int64()), *((f"g{k}", pa.int64()) for k in range(1, ORDER + 1)), *((f"h{k}", pa.int64()) for k in range(1, ORDER))])


def _counts(rows: DataFrame) -> DataFrame:
    """Counts by run of ORDER signs, with the hashes of its endings g_k and of their histories h_(k-1)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_label: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(batch["text"], batch["label"].to_pylist()):
                by_label[label].update(words_of(text.as_py()))
            for words in portions(list(by_label[0].keys() | by_label[1].keys())):
                word, h, at = runs(words)
                columns = [np.array([by_label[label][w] for w in words], np.int64)[word] for label in (1, 0)]
                kinds, first, of = np.unique(h[ORDER][at], return_index=True, return_inverse=True)
                columns = [np.bincount(of, weights=c, minlength=len(kinds)).astype(np.int64) for c in columns]
                columns += [h[k][at][first].view(np.int64) for k in range(1, ORDER + 1)]
                columns += [h[k][at - 1][first].view(np.int64) for k in range(1, ORDER)]
                yield batch_of(COUNTS, *columns)

    return rows.select("text", "label").mapInArrow(count, ", ".join(f"{f.name} long" for f in COUNTS))


KINDS = pa.schema([*((f"g{k}", pa.int64()) for k in range(1, ORDER + 1)), *((f"h{k}", pa.int64()) for k in range(1, ORDER))])


def _kinds(docs: DataFrame) -> DataFrame:
    """All runs of ORDER signs in the texts, with g_k and h_k as in _counts; n: parts of the corpus that hold one."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[str] = set()
        sent = np.empty(0, np.uint64)
        for batch in batches:
            new: set[str] = set()
            for text in batch["text"]:
                new.update(words_of(text.as_py()))
            words = list(new - met)
            if len(met) > KNOWN_WORDS:
                met.clear()
            met |= new
            for part in portions(words):
                _, h, at = runs(part)
                kinds, first = np.unique(h[ORDER][at], return_index=True)
                fresh = ~np.isin(kinds, sent, assume_unique=True)
                first = first[fresh]
                sent = np.concatenate([sent, kinds[fresh]]) if len(sent) < KNOWN_RUNS else kinds
                columns = [h[k][at][first].view(np.int64) for k in range(1, ORDER + 1)] + [h[k][at - 1][first].view(np.int64) for k in range(1, ORDER)]
                yield batch_of(KINDS, *columns)

    found = docs.select("text").mapInArrow(find, ", ".join(f"{f.name} long" for f in KINDS))
    return found.groupBy(f"g{ORDER}").agg(F.count("*").alias("n"), *(F.first(f.name).alias(f.name) for f in KINDS if f.name != f"g{ORDER}"))


def _runs(counts: DataFrame) -> DataFrame:
    """The classes' counts of every run of ORDER signs."""
    keep = [f.name for f in COUNTS if f.name[0] in "gh" and f.name != f"g{ORDER}"]
    return stage(counts.groupBy(f"g{ORDER}").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"), *(F.first(c).alias(c) for c in keep)), "toxicity-runs")


class TwoModels:
    """Staged counts by full hash: of the classes' own runs, and the shared continuation counts.

    Continuation counts of k signs are the kinds of runs of k + 1 that end in them.
    """

    def __init__(self, top: DataFrame):
        self.runs = top
        self.histories = stage(top.groupBy(f"h{ORDER - 1}").agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o"), F.count_if(F.col("toxic") > 0).alias("tk"), F.count_if(F.col("ordinary") > 0).alias("ok")), "toxicity-histories")
        self.endings: dict[int, DataFrame] = {}
        self.totals: dict[int, DataFrame] = {}
        for k in range(ORDER - 1, 0, -1):
            above = self.endings.get(k + 1, top)
            keep = [c for c in above.columns if c[0] in "gh" and int(c[1:]) < k]
            self.endings[k] = stage(above.groupBy(f"g{k}").agg(F.count("*").alias(f"n{k}"), *(F.first(c).alias(c) for c in keep)), f"toxicity-endings-{k}")
            if k > 1:
                self.totals[k] = stage(self.endings[k].groupBy(f"h{k - 1}").agg(F.sum(f"n{k}").alias(f"total{k}"), F.count("*").alias(f"types{k}")), f"toxicity-totals-{k}")

    def values(self, docs: DataFrame) -> DataFrame:
        """run, n and value, log P(last sign | toxic) - log P(it | ordinary), for the texts' runs; one without a row is 0."""
        found = _kinds(docs).join(small_side(self.histories), f"h{ORDER - 1}")
        found = found.join(small_side(self.runs.select(f"g{ORDER}", "toxic", "ordinary")), f"g{ORDER}", "left")
        for k in range(1, ORDER):
            found = found.join(small_side(self.endings[k].select(f"g{k}", f"n{k}")), f"g{k}", "left")
            if k > 1:
                found = found.join(small_side(self.totals[k]), f"h{k - 1}", "left")
        total, kinds = self.endings[1].agg(F.coalesce(F.sum("n1"), F.lit(0)), F.count("*")).first()
        above = lambda count: F.greatest(F.coalesce(F.col(count), F.lit(0)) - F.lit(DISCOUNT), F.lit(0.0))
        p = above("n1") / F.lit(float(max(total, 1))) + F.lit(DISCOUNT * kinds / max(total, 1) / ALPHABET)
        columns = ["toxic", "ordinary", "t", "o", "tk", "ok", *(f"{c}{k}" for k in range(2, ORDER) for c in ("n", "total", "types"))]
        found = found.select(F.col(f"g{ORDER}").alias("run"), "n", *columns, p.alias("p"))
        for k in range(2, ORDER):
            smoothed = (above(f"n{k}") + F.lit(DISCOUNT) * F.col(f"types{k}") * F.col("p")) / F.col(f"total{k}")
            found = found.withColumn("p", F.coalesce(smoothed, F.col("p")))
        logs = [F.log(F.when(F.col(t) > 0, (above(own) + F.lit(DISCOUNT) * F.col(kinds) * F.col("p")) / F.col(t)).otherwise(F.col("p"))) for own, t, kinds in (("toxic", "t", "tk"), ("ordinary", "o", "ok"))]
        return stage(found.select("run", "n", (logs[0] - logs[1]).alias("value")), "toxicity-values")

    def differences(self, words: list[str]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of a few words."""
        rows = self.values(self.runs.sparkSession.createDataFrame([(w,) for w in words], "text string"))
        return RunValues.of(rows).by_word(words)


def count_models(rows: DataFrame, more_than: TwoModels | None = None) -> TwoModels:
    """rows: text and label, counted besides what ``more_than`` counts."""
    counts = _counts(rows)
    return TwoModels(_runs(counts.unionByName(more_than.runs) if more_than else counts))


@dataclass
class RunValues:
    """Values of runs, by ascending hash; runs that are not among them have the value 0."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame) -> RunValues:
        table = rows.select("run", "value").toArrow()
        return cls.sorted(table["run"].to_numpy(), table["value"].to_numpy())

    @classmethod
    def sorted(cls, keys: np.ndarray, values: np.ndarray) -> RunValues:
        keys = np.asarray(keys, np.int64).view(np.uint64)
        order = np.argsort(keys)
        return cls(keys[order], np.asarray(values, np.float64)[order])

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, found) of each hash."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return at, self.keys[at] == hashes

    def by_word(self, words: list[str]) -> np.ndarray:
        sums = [np.empty(0)]
        for part in portions(words):
            word, h, at = runs(part)
            place, found = self.places(h[ORDER][at])
            weights = np.where(found, self.values[place], 0.0) if len(self.keys) else np.zeros(len(at))
            sums.append(np.bincount(word, weights=weights, minlength=len(part)))
        return np.concatenate(sums)

    def lacking(self, words: list[str]) -> np.ndarray:
        """Distinct runs of the words that are not among these."""
        kinds = np.unique(np.concatenate([np.empty(0, np.uint64), *(h[ORDER][at] for _, h, at in map(runs, portions(words)))]))
        return kinds[~self.places(kinds)[1]]


class Evidence:
    """A document's features, with the differences of the words met so far."""

    SIZE = 9
    #: Words with at least so much evidence are counted.
    STRONG = (1.0, 2.5)

    def __init__(self, sent: RunValues):
        self.sent, self.known = sent, {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        new = [w for w in words if w not in self.known]
        for part in portions(new):
            self.known.update(zip(part, self.sent.by_word(part).tolist()))

    def features(self, text: str | None, rare: RunValues | None = None) -> list[float]:
        """rare: values of the text's runs that were not sent."""
        lines = [line.lower().split() for line in text_of(text).split("\n")]
        words = {w for line in lines for w in line}
        self.learn(words)
        known = self.known
        if rare and words:
            listed = list(words)
            known = {w: known[w] + more for w, more in zip(listed, rare.by_word(listed).tolist())}
        by_line = [[known[w] for w in line] for line in lines if line]
        every = sorted((d for line in by_line for d in line), reverse=True)
        if not every:
            return [0.0] * self.SIZE
        signs = sum(len(w) + 1 for line in lines for w in line)
        best_line = max(sum(line) / len(line) for line in by_line)
        strong = [math.log1p(bisect_left(every, -least, key=neg)) for least in self.STRONG]
        excess = sum(max(d - self.STRONG[0], 0.0) for d in every[: 1 + int(math.expm1(strong[0]) + 0.5)]) / math.sqrt(len(every))
        return [sum(every) / signs, best_line, *(every[:3] + [every[-1]] * 3)[:3], len(every) ** -0.5, *strong, excess]


RARE = pa.schema([("_text", pa.int64()), ("run", pa.int64())])


def _with_rare(docs: DataFrame, rare: DataFrame, sent: RunValues) -> DataFrame:
    """docs with ``_rare``, the values of their runs that are in ``rare``; by text, so equal texts get equal lists."""
    keyed = docs.withColumn("_text", F.xxhash64("text"))  # names are free: the caller has seen to it
    held = docs.sparkSession.sparkContext.broadcast(sent)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch["_text"].to_pylist(), batch["text"]):
                if words := list(set(words_of(text.as_py()))):
                    kinds = held.value.lacking(words)
                    yield batch_of(RARE, np.full(len(kinds), key), kinds.view(np.int64))

    wanted = keyed.select("_text", "text").mapInArrow(find, "_text long, run long").distinct()
    lists = wanted.join(rare.select("run", "value"), "run").groupBy("_text").agg(F.sort_array(F.collect_list(F.struct("run", "value"))).alias("_rare"))
    return keyed.join(stage(lists, "toxicity-rare"), "_text", "left").drop("_text")


def with_features(docs: DataFrame, models: TwoModels, name: str, kind: T.DataType, finish: Callable[[np.ndarray], pa.Array]) -> DataFrame:
    """docs with a column ``name``, what ``finish`` makes of their features; all columns stay."""
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])
    values = models.values(docs)
    most = values.orderBy(F.desc("n"), "run").limit(SENT_RUNS)
    few = values.count() <= SENT_RUNS
    frequent = values if few else stage(most, "toxicity-frequent")
    table = RunValues.of(frequent)
    sent = docs.sparkSession.sparkContext.broadcast(table)
    rows = docs if few else _with_rare(docs, values.join(frequent.select("run"), "run", "left_anti"), table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(sent.value)
        for batch in batches:
            rare = [None] * len(batch)
            if not few:
                rare = [r and RunValues.sorted([x["run"] for x in r], [x["value"] for x in r]) for r in batch["_rare"].to_pylist()]
                batch = batch.drop_columns(["_rare"])
            x = np.array([evidence.features(t.as_py(), r) for t, r in zip(batch["text"], rare)]).reshape(-1, Evidence.SIZE)
            yield batch.append_column(name, finish(x))

    return rows.mapInArrow(run, schema)


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 400) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(mean, scale, weights, bias) of least log loss by Newton steps with a slight penalty."""
    width = x.shape[1]
    prior = (y.sum() + 1) / (len(y) + 2)
    if len(y) < 8 or y.min(initial=1) == y.max(initial=0):
        return np.zeros(width), np.ones(width), np.zeros(width), float(np.log(prior / (1 - prior)))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    penalty = np.diag([1e-2] * width + [1e-6]) * len(x) / 100
    for _ in range(min(steps, 60)):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty @ w
        hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + penalty
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w[:-1], float(w[-1])


@dataclass
class Scorer:
    models: TwoModels
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    """The logistic function from a fold of the labelled rows, by counts of the others; then counts of all."""
    labels = stage(labelled(labels, "toxic"), "toxicity-labels")
    calibrates = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION_FOLDS)) == 0
    texts = docs.select("doc_id", "text")
    models = count_models(texts.join(small_side(labels.filter(~calibrates), BROADCAST_LABELS), "doc_id"))
    chosen = labels.filter(calibrates).orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_SAMPLE)
    rows = stage(texts.join(F.broadcast(chosen), "doc_id").select("text", "label"), "toxicity-calibration")
    with small_batches(docs.sparkSession):
        found = with_features(rows, models, "features", T.ArrayType(T.DoubleType()), lambda x: pa.array(list(x), pa.list_(pa.float64()))).select("label", "features").toPandas()
    x = np.stack(found["features"].to_list()) if len(found) else np.zeros((0, Evidence.SIZE))
    every = count_models(texts.join(small_side(labels.filter(calibrates), BROADCAST_LABELS), "doc_id"), models)
    return Scorer(every, *fit_logistic(x, found["label"].to_numpy(float)))


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """docs with a column ``toxicity_score``; all columns stay."""
    mean, scale, weights, bias = scorer.mean, scorer.scale, scorer.weights, scorer.bias

    def finish(x: np.ndarray) -> pa.Array:
        return pa.array(1 / (1 + np.exp(-np.clip(((x - mean) / scale * weights).sum(axis=1) + bias, -500, 500))), pa.float64())

    return with_features(docs, scorer.models, "toxicity_score", T.DoubleType(), finish)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold(F.col("doc_id"), 3) != 1)
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
