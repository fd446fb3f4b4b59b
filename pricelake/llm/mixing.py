"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree.

Every source is cut into blocks by a hash of the document. The words that a source owes
the mix are whole passes over its blocks plus a part of one more pass, so a source has an
exact number of block draws. A binary tree over the output shards splits the vector of
block draws: at each node the left half's share is one multivariate hypergeometric draw.
At a leaf a shard knows its exact quota of every source, and takes that many consecutive
draws of the source's permuted block sequence: shards are disjoint by construction.
What a shard draws is the mix: a draw outside all leaves is not taken. Inside a shard, rows
are ordered by a keyed hash.

Documents are drawn whole. Of each source one block is drawn in part, and there documents
are taken, in the order of a keyed hash, as long as they bring the source nearer to its target.

Only one row per source reaches the driver. Blocks are a fixed number per source, so a
source with most of the rows is spread over all of them.

Defined cases: a null text has size 0; a null source is a source of its own, ordered last;
a source without words has target 0; every row is a document of its own, also where
doc_ids repeat; rows that agree in doc_id and text are drawn from one block; documents of
size 0 are never drawn; an empty table gives an empty result; other columns, whatever their
names, only travel along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.llm.common import small_side, stage

#: Weights by a source's place in code-point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2.0
BLOCKS_PER_SOURCE = 4096
#: Up to so many blocks are sent to every executor; beyond, rows are shuffled to them.
BROADCAST_BLOCKS = 200_000
#: Shards: as many as give each about WORDS_PER_SHARD words, within these limits.
SHARDS, MOST_SHARDS, WORDS_PER_SHARD = 64, 8192, 50_000_000
SEED = 20240607

ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> list[float]:
    """Words owed by each source (given in order): ``share`` of all words by weight, where a
    source stops at ``limit`` times its size and the excess goes to the others by weight."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    target: list[float] = [0.0] * len(sizes)
    left, active = share * sum(sizes), list(range(len(sizes)))
    while active:
        total = sum(weight[i] for i in active)
        over = [i for i in active if left * weight[i] / total > limit * sizes[i]]
        if not over:
            for i in active:
                target[i] = left * weight[i] / total
            break
        for i in over:
            target[i] = float(limit * sizes[i])
        left -= sum(target[i] for i in over)
        gone = set(over)
        active = [i for i in active if i not in gone]
    return target


def split_quotas(draws: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Block draws by (shard, source): the leaves of the splitting tree.

    Shards get equal numbers of draws, but for rounding; given that, every assignment of
    draws to shards is equally likely.
    """
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(draws)), np.int64)
    stack = [(0, shards, np.asarray(draws, np.int64))]
    while stack:
        low, high, quota = stack.pop()
        if high - low == 1 or not quota.sum():
            out[low] = quota
            continue
        middle = (low + high) // 2
        taken = int(quota.sum()) * (middle - low) // (high - low)
        left = rng.multivariate_hypergeometric(quota, taken, method="marginals")
        stack += [(low, middle, left), (middle, high, quota - left)]
    return out


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver's. As an Arrow table they lie in the plan; a list of Python's is read by
    Python workers, which every executor would start, and keep for a minute, for nothing else."""
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return spark.createDataFrame(pa.table({name: pa.array(c, ARROW[kind]) for c, (name, kind) in zip(columns, fields)}), schema)


def _shards(words: int) -> int:
    """More shards for more words, so that each is of a size that one task can order."""
    return min(MOST_SHARDS, max(SHARDS, -(-words // WORDS_PER_SHARD)))


def mix(docs: DataFrame, shards: int | None = None, seed: int = SEED, texts: bool = False) -> DataFrame:
    """Per document row: doc_id, size, source, source_size, target, and draws: an array of
    (shard, pass, place), one for each time that a shard draws the document, whole.
    With ``texts``, also row: all columns of docs."""
    spark = docs.sparkSession
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))
    keyed = docs.select(
        *([F.struct(docs.columns).alias("row")] if texts else []),
        "doc_id",
        "source",
        key.alias("source_key"),
        word_count(F.col("text")).alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text")).alias("draw_key"),
    ).withColumn("block", F.pmod(F.shiftrightunsigned("draw_key", 20), F.lit(BLOCKS_PER_SOURCE)).cast("int"))
    # all of this follows from a row alone, so texts are not written here but read again below
    sized = stage(keyed.drop("row"), "mix-sized")
    blocks = stage(sized.groupBy("source_key", "block").agg(F.max("source").alias("source"), F.sum("size").alias("words")), "mix-blocks")
    per_source = blocks.groupBy("source_key").agg(F.max("source").alias("source"), F.sum("words").alias("size"), F.count("*").alias("blocks")).collect()
    per_source.sort(key=lambda r: (r.source is None, r.source or ""))

    targets = source_targets([r.size for r in per_source])
    owed = [round(t) for t in targets]
    passes = [o // r.size if r.size else 0 for o, r in zip(owed, per_source)]
    rest = [o - p * r.size for o, p, r in zip(owed, passes, per_source)]
    plan = local_rows(
        spark,
        [(r.source_key, r.size, t, p, left, r.blocks) for r, t, p, left in zip(per_source, targets, passes, rest)],
        "source_key string, source_size long, target double, passes int, rest long, n_blocks long",
    )

    # every pass is a permutation of the source's blocks; the last one stops when the rest is met
    order = Window.partitionBy("source_key", "pass").orderBy(F.xxhash64(F.lit(seed), "source_key", "pass", "block"), "block")
    drawn = (
        blocks.drop("source")
        .join(plan, "source_key")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes"))))
        .withColumn("place", F.row_number().over(order).cast("long") - 1)
        .withColumn("before", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("room", F.when(F.col("pass") == F.col("passes"), F.col("rest") - F.coalesce("before", F.lit(0))))
        .filter((F.col("pass") < F.col("passes")) | (F.col("room") > 0))
        .withColumn("draw", F.col("pass") * F.col("n_blocks") + F.col("place"))
        .select("source_key", "block", "words", "pass", "room", "draw")
    )
    drawn = stage(drawn, "mix-drawn")
    counts = {r.source_key: r.n for r in drawn.groupBy("source_key").agg(F.count("*").alias("n")).collect()}
    # the tree's leaves: each shard has its own stretch of every source's permuted sequence
    quota = split_quotas([counts.get(r.source_key, 0) for r in per_source], shards or _shards(sum(owed)), seed)
    ends = quota.cumsum(axis=0)
    leaves = local_rows(
        spark,
        [(r.source_key, int(s), int(e[s] - quota[s, k]), int(e[s])) for k, (r, e) in enumerate(zip(per_source, ends.T)) for s in np.flatnonzero(quota[:, k])],
        "source_key string, shard int, first long, past long",
    )
    stretches = leaves.withColumn("draw", F.explode(F.sequence("first", F.col("past") - 1))).select("source_key", "shard", "draw")
    per_block = (
        stretches.hint("merge").join(drawn, ["source_key", "draw"])
        .groupBy("source_key", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("block_draws"), F.max("room").alias("room"), F.max("words").alias("words"))
    )
    per_block = small_side(stage(per_block, "mix-per-block"), BROADCAST_BLOCKS)
    rows = (keyed if texts else sized).join(per_block, ["source_key", "block"], "left").join(small_side(plan.drop("rest", "n_blocks"), BROADCAST_BLOCKS), "source_key")
    cut = F.col("room") < F.col("words")  # of the blocks, one in each source is taken in part: documents while they bring it nearer to the rest
    inside = Window.partitionBy("source_key", "block").orderBy("draw_key", "doc_id", "size")
    partial = (
        rows.filter(cut)
        .withColumn("before", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("fits", 2 * F.col("before") + F.col("size") <= 2 * F.col("room"))
        .drop("before")
    )
    whole = rows.filter(F.coalesce(~cut, F.lit(True))).withColumn("fits", F.lit(True))
    own = F.filter(F.coalesce("block_draws", F.array().cast("array<struct<pass:int,shard:int>>")), lambda d: (F.col("fits") | (d["pass"] < F.col("passes"))) & (F.col("size") > 0))
    return whole.unionByName(partial).select(
        *(["row"] if texts else []),
        *["doc_id", "size", "source", "source_size", "target"],
        F.transform(own, lambda d: F.struct(d["shard"].alias("shard"), d["pass"].alias("pass"), F.xxhash64(F.lit(seed), d["pass"], "draw_key").alias("place"))).alias("draws"),
    )


def drawn(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mix: a row of docs for each draw, shard by shard, and in the order of place inside a shard."""
    rows = mix(docs, shards, seed, texts=True).select("row", F.explode("draws").alias("draw"))
    return rows.repartition(F.col("draw.shard")).sortWithinPartitions("draw.shard", "draw.place", "draw.pass").select("row.*")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda total, _: total + F.col("size"))
    by_shard = F.array_join(F.transform(F.array_sort("draws"), lambda d: d["shard"].cast("string")), ",")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), by_shard.alias("shards"))
