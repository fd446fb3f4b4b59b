import random
import re

import numpy as np
import pytest

from pricelake.llm import substring


@pytest.mark.parametrize("period", [7, 13, 20, 31, 57, 100])
def test_difference_cover(period):
    cover = substring.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert len(cover) <= 3 * period**0.5
    assert len(substring.difference_cover(31)) == 6


def test_runs():
    runs = substring.merged(np.array([5, 0, 7, 20]), np.array([8, 2, 9, 21]))
    assert runs.tolist() == [0, 2, 5, 9, 20, 21]
    assert substring.inside(runs, 8).tolist() == [0, 1, 5, 6, 7]


def brute(rows, length):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][k : k + length]), i)
    out = {}
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - length + 1) if first[tuple(w[k : k + length])] < i for j in range(length)}
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("seed,length,period,few", [(1, 50, 31, True), (2, 50, 31, True), (3, 12, 7, True), (4, 50, 13, True), (1, 50, 31, False)])
def test_like_brute_force(spark, monkeypatch, seed, length, period, few):
    if not few:
        monkeypatch.setattr(substring, "BROADCAST_ROWS", -1)
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(300)}"
    passages = [[word() for _ in range(n)] for n in (length - 1, length, length + 1, 3 * length)]
    texts = []
    for _ in range(120):
        parts = [[word() for _ in range(rng.randrange(0, 40))] for _ in range(3)]
        for p in parts[:2]:
            if rng.random() < 0.5:
                p += rng.choice(passages)
        texts.append(" ".join(sum(parts, [])))
    texts += [texts[0], texts[3].replace(" ", "\n"), "a " * (3 * length), "a " * (2 * length + 1), None, "", " \t", "é" * 10]
    ids = list(range(10, 10 + len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, pos int, runs string").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(docs, length, period).collect()}
    assert got == brute(rows, length)


def test_one_hash_alone_removes_nothing(spark, monkeypatch):
    """Windows whose first hashes are all equal are told apart by their second ones."""
    texts = [" ".join(f"{i}x{k}" for k in range(70)) for i in range(6)] + [" ".join(f"0x{k}" for k in range(70))]
    texts[5] += " " + " ".join(f"3x{k}" for k in range(10, 65))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(substring, "window_key", lambda words, width: np.zeros(max(0, len(words) - width + 1), np.uint64))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(docs).collect()}
    assert got == brute(rows, 50)


def test_repeated_rows_nulls_and_empty_table(spark):
    text = " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(4, text), (4, text), (None, text), (9, text)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in substring.remove_repeats(docs).collect())
    assert got == [(0, 60), (4, 0), (4, 0), (9, 60)]
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_texts_of_one_id_lose_only_their_own_words(spark):
    text = " ".join(map(str, range(60)))
    clean = {i: " ".join(f"{i}c{k}" for k in range(80)) for i in (None, 7)}
    part = {i: " ".join(f"{i}p{k}" for k in range(30)) for i in (None, 7)}
    rows = [(1, text), *((i, t) for i in (None, 7) for t in (text, clean[i], f"{part[i]} {text}"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.kept, r.n_words) for r in substring.remove_repeats(docs).collect()}
    assert got == {(1, text, 60), *((i, *kept) for i in (None, 7) for kept in (("", 60), (clean[i], 80), (part[i], 90)))}
