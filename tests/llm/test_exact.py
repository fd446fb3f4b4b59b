import random
import re
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import exact

DOCS = "doc_id long, text string, digest string, row string, n string"


@pytest.mark.parametrize("n,bits,owners", [(1, 12, 3), (5, 14, 3), (1000, 20, 4), (3000, 12, 1)])
def test_golomb_round_trip(n, bits, owners):
    rng = np.random.default_rng(n)
    for owner in range(owners):
        low, high = exact._low(owner, owners, bits), exact._low(owner + 1, owners, bits)
        values = np.unique(rng.integers(low, high, n).astype(np.uint64))
        shift = exact.golomb_shift(len(values), high - low)
        coded = exact.golomb_encode(values, low, shift)
        assert (exact.golomb_decode(coded, len(values), low, shift) == values).all()
        assert len(coded) * 8 <= len(values) * (np.log2((high - low) / len(values)) + 2.5) + 16


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = []
    for norm, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        out += [(-1 if i is None else i, -1 if ids[0] is None else ids[0], len(ids), k == 0, sha256(norm.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out)


def rows_of(seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "é"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t \r"]) for _ in range(rng.randrange(6)))) for i in range(400)]
    rows += [(1000 + i, "the same text\n") for i in range(200)] + [(2000 + i, f"only {i}") for i in range(200)]
    rows += [(None, "the same text "), (None, "mine"), (None, "mine"), (5, None), (6, ""), (7, None), (1000, "the same text\n"), (9000, "x" * 200_000), (9001, "x" * 200_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,few", [(1 << 16, True), (7, True), (50, False)])
def test_like_brute_force(spark, monkeypatch, block, few):
    monkeypatch.setattr(exact, "BLOCK", block)
    if not few:
        monkeypatch.setattr(exact, "BROADCAST_ROWS", -1)
    rows = rows_of(block)
    docs = spark.createDataFrame([(*r, "d", "r", "n") for r in rows], DOCS).repartition(5)
    got = [(-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in exact.exact_groups(docs).collect()]
    assert sorted(got) == brute(rows)


def test_equal_digests_of_different_texts_are_told_apart(spark):
    rows = [r for r in rows_of(1) if len(r[1] or "") < 1000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    weak = lambda norm: F.sha2(F.length(norm).cast("string"), 256)
    got = [(-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(docs, weak).collect()]
    assert sorted(got) == [r[:4] for r in brute(rows)]


def test_deduplicated_and_empty_table(spark):
    rows = rows_of(2)
    docs = spark.createDataFrame([(*r, "d", "r", "n") for r in rows], DOCS).repartition(3)
    kept = exact.deduplicated(docs)
    assert kept.columns == docs.columns
    want = sorted((r[0], r[4]) for r in brute(rows) if r[3])
    assert sorted((-1 if r.doc_id is None else r.doc_id, sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest()) for r in kept.collect()) == want
    assert exact.exact_groups(docs.limit(0)).count() == 0
