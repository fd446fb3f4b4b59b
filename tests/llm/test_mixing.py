import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import mixing


def test_targets_stop_at_the_limit():
    sizes = [10, 1000, 500, 0, 40]
    got = mixing.source_targets(sizes)
    assert sum(got) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * s + 1e-9 for t, s in zip(got, sizes))
    free = [i for i, (t, s) in enumerate(zip(got, sizes)) if t < 2 * s - 1e-9]
    weights = [5, 2, 1, 5, 2]
    assert len({round(got[i] / weights[i], 6) for i in free}) == 1


def test_tree_keeps_quotas_exactly():
    draws = [1000, 3, 0, 77]
    q = mixing.split_quotas(draws, 7)
    assert (q.sum(axis=0) == draws).all() and q.sum(axis=1).max() - q.sum(axis=1).min() <= 3
    mean = np.mean([mixing.split_quotas([40, 60], 4, seed=s)[0] for s in range(400)], axis=0)
    assert abs(mean[0] - 10) < 0.5


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, shard string")


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), rng.choice(["a", "a", "a", "b", "c", None]), "x") for i in range(600)]
    rows += [(900, None, "b", "x"), (901, "", "zero", "x"), (7, "one two", "a", "y"), (7, "one two", "a", "y")]
    docs = docs_of(spark, rows)
    got = mixing.mix(docs, shards=5).collect()
    assert len(got) == len(rows)
    taken, target, largest = Counter(), {}, Counter()
    for r in got:
        assert len(r.draws) <= 2 and all(0 <= d.shard < 5 for d in r.draws)
        taken[r.source] += len(r.draws) * r.size
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - t) <= largest[s] / 2 + 1 for s, t in target.items())
    again = mixing.mix(docs.repartition(7), shards=5).collect()
    key = lambda r: (r.doc_id, r.size, sorted(map(tuple, r.draws)))
    assert sorted(map(key, got)) == sorted(map(key, again))
    # a block pass goes to one shard only
    assert mixing.mix(docs.limit(0)).count() == 0


def test_drawn_rows(spark):
    rows = [(i, " ".join(["w"] * (3 + i % 7)), "abc"[i % 3], i) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, draw int").withColumnsRenamed({"draw": "drawn_words"}).withColumn("row", F.lit(1)).withColumn("shard", F.lit(2))
    got = mixing.drawn(docs, shards=4)
    assert got.columns == docs.columns
    words = {r.source: r.n for r in got.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    target = {r.source: r.target for r in mixing.mix(docs, shards=4).collect()}
    assert all(abs(words[s] - t) <= 6 for s, t in target.items())


def test_like_a_plain_loop(spark):
    """Shard by shard: the leaf's stretch of each source's permuted blocks, documents one by one."""
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 30)), rng.choice(["a", "b", None]), "x") for i in range(300)]
    docs, shards = docs_of(spark, rows), 6
    keyed = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(mixing.SEED), "doc_id", F.xxhash64("text")).alias("key")).collect()
    block = lambda r: (r.key % (1 << 64) >> 20) % mixing.BLOCKS_PER_SOURCE
    sources = sorted({r.source for r in keyed}, key=lambda s: (s is None, s or ""))
    sizes = [sum(r.size for r in keyed if r.source == s) for s in sources]
    targets = mixing.source_targets(sizes)
    sequences = []
    for s, size, target in zip(sources, sizes, targets):
        name = "null" if s is None else "s" + s
        blocks = {}
        for r in sorted((r for r in keyed if r.source == s), key=lambda r: (r.key, r.doc_id, r.size)):
            blocks.setdefault(block(r), []).append(r)
        hashes = {(x.p, x.b): x.h for x in spark.createDataFrame([(name, p, b) for p in range(3) for b in blocks], "s string, p int, b int").select("p", "b", F.xxhash64(F.lit(mixing.SEED), "s", "p", "b").alias("h")).collect()}
        sequence, left, p = [], round(target), 0
        while left > 0:
            for b in sorted(blocks, key=lambda b: (hashes[p, b], b)):
                if left <= 0:
                    break
                words = sum(r.size for r in blocks[b])
                chosen, room = blocks[b], left
                if words > left and round(target) - p * size < size:
                    chosen, before = [], 0
                    for r in blocks[b]:
                        if 2 * before + r.size <= 2 * room:
                            chosen.append(r)
                        before += r.size
                sequence.append(chosen)
                left -= words
            p += 1
        sequences.append(sequence)
    quota = mixing.split_quotas([len(q) for q in sequences], shards)
    want = Counter()
    for k, sequence in enumerate(sequences):
        place = 0
        for shard in range(shards):
            for chosen in sequence[place : place + quota[shard, k]]:
                for r in chosen:
                    if r.size:
                        want[r.doc_id, shard] += 1
            place += quota[shard, k]
    got = Counter()
    for r in mixing.mix(docs, shards).collect():
        assert (r.source_size, r.target) == (sizes[sources.index(r.source)], targets[sources.index(r.source)])
        for d in r.draws:
            got[r.doc_id, d.shard] += 1
    assert got == want


def test_the_mix_starts_no_python_worker(spark, monkeypatch):
    docs = spark.range(200).selectExpr("id AS doc_id", "repeat('w ', int(id % 9)) AS text", "'s' || id % 3 AS source", "'x' AS shard")
    monkeypatch.setattr(spark.sparkContext, "pythonExec", "/nowhere/python")
    assert mixing.drawn(docs).count() > 200 and mixing.drawn(docs.limit(0)).count() == 0
