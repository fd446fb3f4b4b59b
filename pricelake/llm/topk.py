"""Exact top-k inner products by no-random-access aggregation over sorted lists.

The vectors of a block are read as one sorted list per dimension, best entries for the
query first. After reading all lists to a depth, a vector's upper bound takes the list's
frontier for every component not yet read, its lower bound the list's worst entry. A query
leaves the block when no vector outside its k best lower bounds, read or unread, can have
an upper bound that qualifies; vectors that can't qualify are dropped; at last the bounds
of those left meet in their final scores. Bounds of many queries are computed at once: for
a list read to depth t, the bound that a query with a positive weight uses is the larger
of the component and the frontier, so both bounds are matrix products.

Candidates lie in blocks of bounded size, those alike in their largest component together. A
block is known by its greatest and least value in each dimension, which bound a query's
scores there. A query first visits the blocks with the best bounds, and with the k-th score
found there it skips every other block whose bound is lower. Queries that visit a block
meet it in cells of bounded size. A cell returns its k best; a window over (query, at most
k per visited block) makes the result.

Defined cases: vectors that are null, or hold a null or non-finite component, take no part;
repeated rows (same id and components) count once; rows of one id with different
vectors are candidates of their own and ask together; a query never meets rows of its own id; rows with a
null id take no part; scores must fit a long; vectors of different lengths never meet; fewer than k candidates
give fewer rows; an empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.llm.common import shuffle_width, small_side, stage

#: Rows of a cell's candidate block and of its query block, on average.
CANDIDATE_BLOCK, QUERY_BLOCK = 4096, 2048
LEAST_BLOCK = 256
QUERIES_AT_ONCE = 256
#: Blocks that a query visits before it skips any, and block summaries that are compared at once.
FIRST_VISITS, SUMMARIES = 2, 1024
#: Depths to which lists are read, as parts of their length.
DEPTHS = (1 / 16, 1 / 4, 1 / 2, 1.0)


def usable(vector: Column) -> Column:
    """Not null, not empty, and all components finite."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & ok, F.lit(False))


def exact_type(candidates: np.ndarray, queries: np.ndarray) -> type:
    """A matrix type in which all products and their sums are exact whole numbers."""
    top = float(np.abs(candidates).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, candidates.shape[1])
    return np.float32 if top < 2**24 else np.float64 if top < 2**53 else np.int64


class SortedLists:
    """One list per dimension, and the block as it is known after reading to a depth."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.ordered = vectors, np.sort(vectors, axis=0)

    def known(self, depth: int) -> tuple[np.ndarray, ...]:
        """Components that give the upper and the lower bound: for positive weights, whose lists
        are read from the largest entry on, then for negative ones."""
        v, n = self.vectors, len(self.vectors)
        high, low = self.ordered[n - depth], self.ordered[depth - 1]  # frontiers, read from either end
        best, worst = self.ordered[-1], self.ordered[0]
        return np.maximum(v, high), np.where(v >= high, v, worst), np.minimum(v, low), np.where(v <= low, v, best)


def block_top_k(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, read: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of each query's k best in the block, ties to smaller ids.
    ``read`` gets the depth to which the lists were read for each query row."""
    order = np.lexsort([ids])
    ids, kind = ids[order], exact_type(vectors, queries)
    lists = SortedLists(vectors[order].astype(kind))
    n = len(ids)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    waiting = np.arange(len(queries))
    columns = np.arange(n)  # candidates that some waiting query may still want
    for part in DEPTHS:
        depth = min(n, max(1, math.ceil(part * n)))
        pos_up, pos_low, neg_up, neg_low = (m[columns] for m in lists.known(depth))
        undone, wanted = [], np.zeros(len(columns), bool)
        for start in range(0, len(waiting), QUERIES_AT_ONCE):
            rows = waiting[start : start + QUERIES_AT_ONCE]
            q = queries[rows].astype(kind)
            plus, minus = np.maximum(q, 0), np.minimum(q, 0)
            lower = plus @ pos_low.T + minus @ neg_low.T
            own = query_ids[rows][:, None] == ids[columns][None, :]
            if read is not None:
                read.update(dict.fromkeys(rows.tolist(), depth))
            if depth == n:  # everything is read: bounds are scores
                found.append(_best(rows, columns, lower, own, k))
                continue
            upper = plus @ pos_up.T + minus @ neg_up.T
            floor = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
            lower[own] = floor
            if lower.shape[1] > k:
                least = np.partition(lower, lower.shape[1] - k, axis=1)[:, -k]
                may = (upper >= least[:, None]) & ~own
            else:
                may = ~own
            done = may.sum(axis=1) <= k
            if done.any():  # none outside can qualify: the rest of these few components gives the scores
                for row, m in zip(rows[done], may[done]):
                    at = columns[m]
                    score = lists.vectors[at] @ queries[row].astype(kind)
                    found.append(_best(np.array([row]), at, score[None, :], np.zeros((1, len(at)), bool), k))
            undone.append(rows[~done])
            wanted |= may[~done].any(axis=0)
        waiting = np.concatenate(undone) if undone else np.empty(0, np.int64)
        columns = columns[wanted] if depth < n else columns
        if not len(waiting):
            break
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    rows, at, score = (np.concatenate(x) for x in zip(*found))
    return rows, order[at], score.astype(np.int64)


def _best(rows: np.ndarray, columns: np.ndarray, score: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best columns of each row; columns come in the order of ids, so the sort's stability breaks ties."""
    score = np.where(own, np.iinfo(np.int64).min, score.astype(np.int64))
    if score.shape[1] > k:
        least = np.partition(score, score.shape[1] - k, axis=1)[:, -k]
        r, c = np.nonzero((score >= least[:, None]) & ~own)
    else:
        r, c = np.nonzero(~own)
    s = score[r, c]
    order = np.lexsort([c, -s, r])
    r, c, s = r[order], c[order], s[order]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    keep = place < k
    return rows[r[keep]], columns[c[keep]], s[keep]


def _empty(columns: str) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(dtype="int64") for c in columns.split()})


def in_blocks(candidates: DataFrame) -> DataFrame:
    """candidates with a block: ranges of the largest component's dimension, sign and size, which
    a hash cuts where many are equal. The rows of a range are one task's, of about CANDIDATE_BLOCK."""
    spark, n = candidates.sparkSession, candidates.count()
    across = max(1, math.ceil(n / CANDIDATE_BLOCK), min(shuffle_width(spark), n // LEAST_BLOCK))
    size = F.transform("v", F.abs)
    at = F.array_position(size, F.array_max(size))
    value = F.element_at("v", at.cast("int"))
    placed = candidates.repartitionByRange(across, F.size("v"), at, value, F.xxhash64("vec_id", "v"))
    return stage(placed.withColumn("block", F.spark_partition_id()), "topk-blocks")


def _summaries(blocks: DataFrame) -> DataFrame:
    """Of each block and length of vectors: the greatest and least value in every dimension."""

    def ends(rows: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(rows["v"].to_numpy())
        return pd.DataFrame({"block": [int(rows["block"].iloc[0])], "high": [v.max(axis=0)], "low": [v.min(axis=0)]})

    return stage(blocks.groupBy("block", F.size("v").alias("width")).applyInPandas(ends, "block int, high array<long>, low array<long>"), "topk-summaries")


def block_bounds(high: np.ndarray, low: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """The most that a query (row) can score in a block (column)."""
    kind = exact_type(np.concatenate([high, low]), queries)
    q = queries.astype(kind)
    return (np.maximum(q, 0) @ high.astype(kind).T + np.minimum(q, 0) @ low.astype(kind).T).astype(np.int64)


def _visits(queries: DataFrame, summaries: DataFrame, first: bool) -> DataFrame:
    """vec_id, v, block and bound. Of each query the FIRST_VISITS blocks with the best bounds in a part of
    the summaries; or else, queries having ``least``, all blocks whose bound reaches that."""
    columns = "vec_id long, v array<long>, block int, bound long"
    across, down = max(1, math.ceil(summaries.count() / SUMMARIES)), max(1, math.ceil(queries.count() / QUERY_BLOCK))
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    none = lambda kind: F.lit(None).cast(kind)
    least = none("long") if first else F.col("least")
    cells = summaries.select(F.pmod("block", F.lit(across)).alias("i"), every(down).alias("j"), none("long").alias("vec_id"), F.col("high").alias("v"), "low", "block", none("long").alias("least")).unionByName(
        queries.select(every(across).alias("i"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(down)).cast("int").alias("j"), "vec_id", "v", none("array<bigint>").alias("low"), none("int").alias("block"), least.alias("least"))
    )

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        out, length, asks = [], cell["v"].map(len).to_numpy(), cell["vec_id"].notna().to_numpy()
        for width in np.unique(length[asks]):
            q, b = cell[asks & (length == width)], cell[~asks & (length == width)]
            if not len(b):
                continue
            bound = block_bounds(np.stack(b["v"].to_numpy()), np.stack(b["low"].to_numpy()), np.stack(q["v"].to_numpy()))
            if first:
                best = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST_VISITS]
                r, c = np.repeat(np.arange(len(q)), best.shape[1]), best.ravel()
            else:
                wanted = q["least"].fillna(np.iinfo(np.int64).min).to_numpy(dtype=np.int64)
                r, c = np.nonzero(bound >= wanted[:, None])
            out.append(pd.DataFrame({"vec_id": q["vec_id"].to_numpy(dtype=np.int64)[r], "v": q["v"].to_numpy()[r], "block": b["block"].to_numpy(dtype=np.int32)[c], "bound": bound[r, c]}))
        return pd.concat(out) if out else _empty("vec_id v block bound").astype({"v": "object"})

    return cells.groupBy("i", "j").applyInPandas(compare, columns)


def _search(blocks: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each visit."""
    down = visits.groupBy("block").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("down"))
    down = small_side(stage(down, "topk-down"))
    cells = blocks.join(down, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("j"), F.lit(False).alias("asks"), "vec_id", "v").unionByName(
        visits.join(down, "block").select("block", F.pmod(F.xxhash64("vec_id", "v"), "down").cast("int").alias("j"), F.lit(True).alias("asks"), "vec_id", "v")
    )

    def search(cell: pd.DataFrame) -> pd.DataFrame:
        out = []
        length = cell["v"].map(len).to_numpy()
        for size in np.unique(length):
            part = cell[length == size]
            asks = part["asks"].to_numpy()
            ids, v = part["vec_id"].to_numpy(), np.stack(part["v"].to_numpy()).astype(np.int64)
            if asks.any() and not asks.all():
                q, c, score = block_top_k(ids[~asks], v[~asks], ids[asks], v[asks], k)
                out.append(pd.DataFrame({"query_id": ids[asks][q], "vec_id": ids[~asks][c], "score": score}))
        return pd.concat(out) if out else _empty("query_id vec_id score")

    return stage(cells.groupBy("block", "j").applyInPandas(search, "query_id long, vec_id long, score long"), "topk-found")


def _placed(found: DataFrame) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))


def all_visits(blocks: DataFrame, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The first visits' results, and the further visits that their k-th scores leave."""
    summaries = _summaries(blocks)
    best = Window.partitionBy("vec_id", "v").orderBy(F.desc("bound"), "block")
    first = _visits(queries, summaries, True).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= FIRST_VISITS).select("vec_id", "v", "block")
    first = stage(first, "topk-first")
    found = _search(blocks, first, k)
    least = _placed(found).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    rest = _visits(queries.join(least, "vec_id", "left"), summaries, False).join(first, ["vec_id", "v", "block"], "left_anti")
    return found, stage(rest, "topk-rest")


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score; both sides: vec_id long and v, an array of longs."""
    queries = stage(queries.filter("vec_id is not null").select("vec_id", "v").distinct(), "topk-queries")
    blocks = in_blocks(candidates.filter("vec_id is not null").select("vec_id", "v").distinct())
    found, rest = all_visits(blocks, queries, k)
    return _placed(found.unionByName(_search(blocks, rest, k))).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double")))
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


ORACLE_OP1 = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
