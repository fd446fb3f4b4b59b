import math
import random

import numpy as np
import pytest

from pricelake.llm import ann, topk


def brute(ids, vectors, asked, k, product):
    out = {}
    for q in asked:
        scores = sorted((-product(vectors[q], vectors[c]), ids[c]) for c in range(len(ids)) if ids[c] != ids[q])
        out[ids[q]] = [(i, -s) for s, i in scores[:k]]
    return out


@pytest.mark.parametrize("seed,spread", [(1, 3), (2, 60), (3, 5000), (4, 2**29)])
def test_block_top_k(seed, spread):
    rng = np.random.default_rng(seed)
    v = rng.integers(-spread, spread + 1, (300, 8))
    v[50:90] = v[5] // 2
    ids = rng.permutation(1000)[:300]
    q, c, s = topk.block_top_k(ids, v, ids[::3], v[::3], 5)
    want = brute(ids.tolist(), v.astype(object), range(0, 300, 3), 5, lambda a, b: int((a * b).sum()))
    got = {}
    for qi, ci, si in sorted(zip(q.tolist(), c.tolist(), s.tolist()), key=lambda x: (x[0], -x[2], ids[x[1]])):
        got.setdefault(int(ids[::3][qi]), []).append((int(ids[ci]), si))
    assert got == want


def test_early_stop_on_clear_leaders():
    rng = np.random.default_rng(0)
    v = rng.integers(-2, 3, (800, 4))
    v[:6] = 5000
    q, c, s = topk.block_top_k(np.arange(800), v, np.array([900]), np.full((1, 4), 10), 5)
    assert sorted(c.tolist()) == [0, 1, 2, 3, 4] and set(s.tolist()) == {200_000}


def test_reading_stops_and_blocks_are_skipped(spark, monkeypatch):
    rng = np.random.default_rng(8)
    v = rng.integers(-2, 3, (4000, 6))
    v[100:130] = rng.integers(4000, 6000, (30, 6))
    queries = rng.integers(1, 20, (80, 6))
    queries[40:] *= rng.choice([-1, 1], (40, 6))  # the leaders lead no more where signs are mixed
    read = {}
    q, c, s = topk.block_top_k(np.arange(4000), v, np.arange(80) + 10_000, queries, 5, read)
    assert len(read) == 80 and all(read[k] < 4000 for k in range(40)) and any(d == 4000 for d in read.values())
    assert all(sorted(s[q == k].tolist()) == sorted((v @ queries[k]).tolist())[-5:] for k in range(80))

    centres = rng.integers(-900, 901, (40, 12))
    v = np.repeat(centres, 50, axis=0) + rng.integers(-5, 6, (2000, 12))
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 50)
    monkeypatch.setattr(topk, "SUMMARIES", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, v array<bigint>")
    asked = rows.filter("vec_id % 50 = 0")
    blocks = topk.in_blocks(rows)
    n_blocks = blocks.select("block").distinct().count()
    _, rest = topk.all_visits(blocks, asked, 5)
    visited = 40 * topk.FIRST_VISITS + rest.count()
    assert n_blocks >= 40 and visited < 0.4 * 40 * n_blocks, (visited, 40 * n_blocks)
    got = {}
    for r in sorted(topk.top_k(rows, asked, 5).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute(list(range(2000)), v.astype(object), range(0, 2000, 50), 5, lambda a, b: int((a * b).sum()))


def rows_of(rng, n):
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(30)] + [(7, rows[7][1])]
    bad = [(5000, None), (5020, []), (5040, [math.nan] * 6), (5060, [math.inf, *[0.0] * 5]), (None, [0.5] * 6)]
    return rows, bad


def test_top_k_in_cells(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    rows, bad = rows_of(random.Random(2), 400)
    spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in sorted(topk.op1_topk(spark, str(tmp_path)).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    whole = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in rows}
    ids = list(whole)
    want = brute(ids, [whole[i] for i in ids], [k for k, i in enumerate(ids) if i % 50 == 0], 5, lambda a, b: sum(x * y for x, y in zip(a, b)))
    assert got == want


def test_balanced_parts_follow_clusters():
    rng = np.random.default_rng(1)
    centres = np.eye(8)[:4]
    x = np.repeat(centres, 60, axis=0) + rng.normal(0, 0.05, (240, 8))
    part = ann.balanced_parts(ann.neighbour_graph(x, 8), x, 4)
    assert np.bincount(part, minlength=4).max() <= 60
    assert sum(len(set(part[k * 60 : k * 60 + 60].tolist())) for k in range(4)) <= 6


def test_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(0, 1, (3000, 24))
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32).astype(np.float64)
    v[100:140] = v[99]
    vectors = spark.createDataFrame([(int(i), x.tolist()) for i, x in enumerate(v)], "vec_id long, v array<double>").repartition(4)
    got = {}
    for r in ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits = 0
    for q in range(0, 3000, 20):
        near = v @ v[q]
        near[q] = -9
        best = set(np.lexsort([np.arange(3000), -near])[:20].tolist())
        hits += len(best & {i for i, _ in got[q].values()})
        assert sorted(got[q]) == list(range(1, 21))
        assert all(abs(s - near[i]) < 1e-12 for i, s in got[q].values())
        assert [s for _, s in (got[q][k] for k in range(1, 21))] == sorted((s for _, s in got[q].values()), reverse=True)
    assert hits / (150 * 20) >= 0.9


def test_search_of_odd_rows(spark, tmp_path):
    rows, bad = rows_of(random.Random(4), 50)
    rows = rows + bad + [(60, [0.0] * 6), (80, [1.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = ann.op5_nearest(spark, str(tmp_path)).collect()
    assert {r.query_id for r in got} == {0, 20, 40, 60} and not {r.vec_id for r in got} & {5000, 5020, 5040, 5060}
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert ann.op5_nearest(spark, f"{tmp_path}/none").count() == topk.op1_topk(spark, f"{tmp_path}/none").count() == 0


def test_vectors_of_every_length_are_searched(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 8 if i % 10 else 3 + i % 20 // 10).tolist()) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = {}
    for r in ann.nearest(vectors, vectors.filter("vec_id % 10 = 0"), 5).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    for q, v in rows[::10]:
        like = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        assert [got[q][k] for k in range(1, 6)] == [i for _, i in like[:5]]


def test_parts_grow_and_clusters_need_few():
    assert [ann.part_count(n) for n in (0, 50_000, 200_000, 10**6, 10**10)] == [16, 16, 64, 256, 256]
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (64, 16))[rng.integers(0, 64, 4096)] + rng.normal(0, 0.05, (4096, 16))
    assert ann.fit(x, 20, 64).probes <= 64 / 3


@pytest.mark.parametrize("query_block", [2048, 7])
def test_parts_of_unequal_size_give_whole_results(spark, monkeypatch, query_block):
    monkeypatch.setattr(ann, "QUERY_BLOCK", query_block)
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.normal(5, 0.1, (560, 8)), rng.normal(0, 1, (40, 8))])[rng.permutation(600)]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(40, v[3].tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(3)
    got = {}
    for r in ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert len(got) == 30
    for q, found in got.items():
        assert sorted(k for k, _ in found) == list(range(1, 21)) and q not in {i for _, i in found}
