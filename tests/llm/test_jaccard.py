import random
import re

import pytest

from pricelake.llm import jaccard
from pricelake.llm.components import components


def brute(rows, width, percent):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 90))) for _ in range(40)]
    passage = " ".join(rng.choices(vocabulary, k=25))
    rows = []
    for i in range(n):
        words = rng.choice(texts).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            words += passage.split()
        rows.append((i, (" " if rng.random() < 0.8 else " \n").join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t "), (n + 3, "Word"), (n + 4, "word"), (n + 5, "É word x"), (n + 6, "é word x")]


@pytest.mark.parametrize("seed,percent,frequent", [(1, 85, 40), (2, 85, 5), (3, 60, 5)])
def test_like_brute_force(spark, monkeypatch, seed, percent, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT_SETS", frequent)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, set_id string, n int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, 4, percent).collect()}
    assert got == brute(rows, 4, percent)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(5, "a b c d e"), (5, "a b c d e"), (3, "A b c d e"), (None, "a b c d e")], "doc_id long, text string")
    assert {r.component_id for r in jaccard.jaccard_components(docs).collect()} == {3}
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0


def test_null_ids_bridge_others(spark):
    base = [f"w{i}" for i in range(60)]
    tail = base[:57] + ["x", "y", "z"]
    one, two, three = " ".join(base), " ".join(tail), " ".join(["v", "w", *tail[2:]])  # one and three alone are not alike enough
    docs = spark.createDataFrame([(9, one), (None, two), (4, three), (None, "quite another text of a few words"), (7, "a b c")], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.jaccard_components(docs, 4, 85).collect()}
    assert got == {(9, 57): 4, (None, 57): 4, (4, 57): 4, (None, 4): None, (7, 1): 7}


def test_reach_admits_linked_sets_alone():
    for percent in (60, 85):
        for n in range(1, 60):
            for m in range(n, 90):
                need = -(-percent * (n + m) // (100 + percent))
                for pos in range(n):
                    assert (n - pos >= need) == (m <= (100 + percent) * (n - pos) // percent - n)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(50, 40), (60, 60)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert len({got[i] for i in range(1, 31)}) == 1 and got[50] == got[40] and 60 not in got
