"""Approximate nearest neighbours by learned partitions.

Fit, on a bounded sample: the sample's neighbour graph is cut into parts of equal size by
moving vertices towards their neighbours' parts under a capacity; a small two-layer
network then learns a vector's part, with its neighbours' parts as soft labels; and the
number of parts to probe is the least that finds the wanted share of the sample's own
nearest neighbours.

Parts grow with the rows, one for each block of them, between bounds: finer ones would cost
more copies of a query, more than the sample can teach would be guessed. Index: every row
goes to its most probable part; a part is split into blocks of bounded size, so a part that
holds a third of the rows is no single task. Search: a query visits all blocks of its most
probable parts, and of further ones until the visited parts, whose rows are counted, hold as
many candidates as it wants; a part that many queries visit gets them in blocks. What it finds is ranked by the inner product in double precision on the
original vectors.

Defined cases: vectors that are null, zero, empty, or hold a null or non-finite component,
and rows with a null id, take no part; vectors of another length than the commonest in the
sample are a part of their own for each length, in which their like search whole; repeated rows (same id and vector) count once; a query
never meets its own id; fewer candidates than k give fewer rows; an empty table gives an
empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.llm.common import batch_of, shuffle_width, small_side, stage
from pricelake.llm.topk import usable

#: Rows for each part that the partition is learned on, those whose ids hash lowest, and least and most parts.
PART_SAMPLE = 64
LEAST_PARTS, MOST_PARTS = 16, 256
#: Rows of the sample at least.
SAMPLE = 4096
NEIGHBOURS = 10
#: Share of the sample's nearest neighbours that the probed parts must hold.
WANTED_RECALL = 0.96
CALIBRATION_QUERIES = 512
BLOCK, LEAST_BLOCK, QUERY_BLOCK = 4096, 256, 2048
SEED = 11


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k nearest other rows by inner product."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for start in range(0, len(x), 512):
        near = x[start : start + 512] @ x.T
        near[np.arange(len(near)), start + np.arange(len(near))] = -np.inf
        out[start : start + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(graph: np.ndarray, x: np.ndarray, parts: int, seed: int = SEED, rounds: int = 15) -> np.ndarray:
    """A part for each vertex: equal sizes, few cut edges.

    Starts from nearest seeds under the capacity; then, round by round, vertices choose in
    order of how strongly they prefer their neighbours' commonest part, if it has room.
    """
    n = len(x)
    capacity = math.ceil(n / parts)
    rng = np.random.default_rng(seed)
    affinity = x @ x[rng.permutation(n)[:parts]].T
    edges = np.column_stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    part = np.zeros(n, np.int64)
    for turn in range(rounds + 1):
        if turn:
            cells = np.concatenate([edges[:, 0] * parts + part[edges[:, 1]], edges[:, 1] * parts + part[edges[:, 0]]])
            affinity = np.bincount(cells, minlength=n * parts).reshape(n, parts).astype(float)
            affinity[np.arange(n), part] += 0.5  # a slight wish to stay
        choices = np.argsort(-affinity, axis=1, kind="stable")
        top = np.sort(affinity, axis=1)
        margin = top[:, -1] - (top[:, -2] if top.shape[1] > 1 else 0)
        room = [capacity] * affinity.shape[1]
        before, part = part, np.zeros(n, np.int64)
        for v in np.argsort(-margin, kind="stable"):
            part[v] = next(p for p in choices[v] if room[p])
            room[part[v]] -= 1
        if turn and (part == before).mean() > 0.995:
            break
    return part


@dataclass
class Router:
    """A two-layer network from vectors to probabilities of parts, and the parts to probe."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.probabilities(x), axis=1, kind="stable")


def train_router(x: np.ndarray, labels: np.ndarray, hidden: int = 64, steps: int = 300, rate: float = 0.02, seed: int = SEED) -> Router:
    """Full-batch Adam on the cross entropy with soft labels."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], labels.shape[1]
    weights = [rng.normal(0, 1 / math.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / math.sqrt(hidden), (hidden, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        h = np.tanh(x @ weights[0] + weights[1])
        z = h @ weights[2] + weights[3]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        dz = (e / e.sum(axis=1, keepdims=True) - labels) / len(x)
        dh = dz @ weights[2].T * (1 - h * h)
        for i, g in enumerate((x.T @ dh + 1e-4 * weights[0], dh.sum(axis=0), h.T @ dz + 1e-4 * weights[2], dz.sum(axis=0))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*weights, probes=parts)


def part_count(rows: int) -> int:
    """A power of two: no part is meant to be smaller than a block, within the bounds."""
    return min(MOST_PARTS, max(LEAST_PARTS, 1 << (rows // BLOCK).bit_length()))


def fit(sample: np.ndarray, k: int, parts: int = LEAST_PARTS) -> Router:
    """Partition, classifier and number of probes from the sample's rows."""
    scale = np.linalg.norm(sample, axis=1).mean()
    x = np.unique(sample, axis=0) / scale
    parts = max(1, min(parts, len(x)))
    graph = neighbour_graph(x, NEIGHBOURS)
    part = balanced_parts(graph, x, parts)
    labels = np.eye(parts)[part]
    labels += sum(labels[graph[:, j]] for j in range(graph.shape[1]))
    router = train_router(x, labels / labels.sum(axis=1, keepdims=True))
    router.w1 = router.w1 / scale
    # the sample, as if it were the table: which parts hold a row's nearest, by rank of the part
    asked = np.random.default_rng(SEED).permutation(len(x))[:CALIBRATION_QUERIES]
    nearest = neighbour_graph(x, k)[asked]
    if nearest.shape[1]:
        ranked = router.ranked(x * scale)
        home = ranked[:, 0]
        place = np.argsort(ranked[asked], axis=1)
        needed = np.take_along_axis(place, home[nearest], axis=1)
        router.probes = 1 + next(p for p in range(parts) if (needed <= p).mean() >= WANTED_RECALL)
    return router


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of components."""
    total = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        total += queries[:, d] * vectors[:, d]
    return total


def block_nearest(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query row, candidate row, score): each query's k best in the block, ties to smaller ids."""
    found = []
    for start in range(0, len(queries), 256):
        near = queries[start : start + 256] @ vectors.T
        near[query_ids[start : start + 256, None] == ids[None, :]] = -np.inf
        least = np.partition(near, -k, axis=1)[:, [-k]] if len(ids) > k else np.full((len(near), 1), -np.inf)
        q, c = np.nonzero((near >= least - 1e-9 * (1 + np.abs(near).max(initial=0, where=np.isfinite(near)))) & (near > -np.inf))
        score = exact_scores(queries[start + q], vectors[c])
        order = np.lexsort([ids[c], -score, q])
        q, c, score = q[order], c[order], score[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        found.append((start + q[keep], c[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, parts: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score; both sides: vec_id long and v, an array of doubles."""
    spark = vectors.sparkSession
    rows = stage(vectors.filter("vec_id is not null").select("vec_id", "v").distinct(), "ann-vectors")
    total = rows.count()
    parts = parts or part_count(total)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(SAMPLE, PART_SAMPLE * parts)).toPandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = int(sample["v"].map(len).mode()[0])
    router = spark.sparkContext.broadcast(fit(np.stack([v for v in sample["v"] if len(v) == width]), k, parts))
    routed = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.float64())), ("parts", pa.list_(pa.int32()))])

    def placed(side: DataFrame, keep: int, sizes: np.ndarray | None = None, wanted: int = 0) -> DataFrame:
        """Rows of the common length with their ``keep`` most probable parts, and with as many more as it
        takes until those of ``sizes`` hold ``wanted`` rows; others with the part of their length."""

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    ranked = router.value.ranked(np.array(batch["v"].to_pylist(), np.float64)).astype(np.int32)
                    probes = np.full(len(ranked), keep)
                    if sizes is not None:
                        probes = np.maximum(probes, 1 + (np.cumsum(sizes[ranked], axis=1) < wanted).sum(axis=1))
                    yield batch_of(routed, batch["vec_id"], batch["v"], [r[:n] for r, n in zip(ranked, probes)])

        common = side.filter(F.size("v") == width).mapInArrow(run, "vec_id long, v array<double>, parts array<int>")
        return common.select("vec_id", "v", F.explode("parts").alias("part")).unionByName(side.filter(F.size("v") != width).withColumn("part", -F.size("v")))

    index = stage(placed(rows, 1), "ann-index")
    counted = dict(map(tuple, index.filter("part >= 0").groupBy("part").count().collect()))  # one row for each part
    sizes = np.array([counted.get(p, 0) for p in range(router.value.w2.shape[1])])
    same_id = rows.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    asked = placed(queries.filter("vec_id is not null").select("vec_id", "v").distinct(), router.value.probes, sizes, k + same_id)
    asked = stage(asked, "ann-queries")
    spread = min(shuffle_width(spark), total // LEAST_BLOCK)
    size = F.count("*")
    blocks = index.groupBy("part").agg(F.greatest(F.lit(1), F.ceil(size / BLOCK), F.round(F.lit(spread) * size / total)).cast("int").alias("blocks"))
    down = asked.groupBy("part").agg(F.ceil(size / QUERY_BLOCK).cast("int").alias("down"))
    blocks = small_side(stage(blocks.join(down, "part"), "ann-blocks"))
    cells = (
        index.join(blocks, "part")
        .select("part", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("j"), F.lit(False).alias("asks"), "vec_id", "v")
        .unionByName(asked.join(blocks, "part").select("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("vec_id"), "down").cast("int").alias("j"), F.lit(True).alias("asks"), "vec_id", "v"))
    )

    def search(cell: pd.DataFrame) -> pd.DataFrame:
        asks, ids, v = cell["asks"].to_numpy(), cell["vec_id"].to_numpy(), np.stack(cell["v"].to_numpy()) if len(cell) else None
        if not asks.any() or asks.all():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        q, c, score = block_nearest(ids[~asks], v[~asks], ids[asks], v[asks], k)
        return pd.DataFrame({"query_id": ids[asks][q], "vec_id": ids[~asks][c], "score": score})

    found = cells.groupBy("part", "block", "j").applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0))
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)
