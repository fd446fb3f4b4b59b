import random
import re
from collections import Counter
from hashlib import sha256
from math import floor, log
from zlib import crc32

import pytest

from pricelake.llm import importance

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, target, width, buckets, percent, least, seed):
    def codes(text):
        w = words_of(text)
        return [crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, width + 1) for i in range(len(w) - k + 1)]

    s, t = (Counter(c for _, text in side for c in codes(text)) for side in (rows, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: floor(1000 * log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text in rows:
        mine = [gain(c) for c in codes(text)]
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(mine) // len(mine) if mine else 0
        out.append([i, len(mine), weight, weight + floor(-1000 * log(-log((h + 0.5) / 4294967296))), len(words_of(text)) >= least])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(out):
        out[k] = (*r[:4], None)
    for place, r in enumerate(fit[: percent * len(fit) // 100]):
        out[out.index((*r[:4], None))] = (*r[:4], place + 1)
    return sorted(out, key=str)


@pytest.mark.parametrize("width,chunk", [(1, 1 << 17), (2, 1 << 17), (3, 5), (1, 3)])
def test_like_brute_force(spark, monkeypatch, width, chunk):
    monkeypatch.setattr(importance, "CHUNK", chunk)
    rng = random.Random(width)
    word = lambda: rng.choice(["Alpha", "béta", "x9", "a-b", "日本", "É", "\0odd", "under_score", "end."])
    rows = [(i, " ".join(word() for _ in range(rng.randrange(30)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "..., !"), (None, "a b c " * 9), (None, "a b c " * 9), (3, "again " * 25), (203, "long " * 60_000)]
    target = [(i, " ".join(word() for _ in range(40))) for i in range(5)] + [(9, None)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, score string, rank int").repartition(3)
    goal = spark.createDataFrame(target, "item_id long, text string")
    got = importance.importance_ranks(docs, goal, width, 97, 30, 10, 5)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str) == brute(rows, target, width, 97, 30, 10, 5)


def test_drawn_documents_keep_their_columns(spark):
    rows = [(i, f"w{i % 7} " * 30, "x") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank string").repartition(4)
    goal = spark.createDataFrame([(1, "w3 w3 w4")], "item_id long, text string")
    ranks = {r.doc_id: r["rank"] for r in importance.importance_ranks(docs, goal).collect()}
    drawn = importance.resampled(docs, goal)
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} == {i for i, r in ranks.items() if r}
    assert sorted(r for r in ranks.values() if r) == list(range(1, 11))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    none = docs.limit(0)
    assert importance.importance_ranks(none, docs).count() == 0
    assert importance.importance_ranks(docs, none).count() == 1
