import random
import re
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from pricelake.llm import periodic

TEXTS = "doc_id long, text string, runs string, key string, start string"


def brute(words):
    """(start, length, period) of all runs."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            root, length = words[s : s + q], i - s + q
            if length >= max(24, 3 * q) and not any(q % d == 0 and root == root[:d] * (q // d) for d in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng, n, k):
    words = [f"w{rng.randrange(k)}" for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 10:
            a = rng.randrange(n)
            p = rng.randrange(1, max(2, (n - a) // 3 + 1))
            for i in range(a, min(n, a + p * rng.randrange(2, 9))):
                words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("seed", range(5))
def test_solve_like_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        words = some_words(rng, rng.randrange(400), rng.choice([1, 2, 3, 50]))
        numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
        got = periodic.solve(np.array([numbers[w] for w in words], np.int64), 1, len(words) // 3 + 1)
        assert sorted((s, e - s + q, q) for s, e, q in got) == sorted(brute(words))


def test_patterns_that_cancel_in_sums_of_powers_of_two():
    words = [bin(i).count("1") % 2 for i in range(1 << 13)]
    got = periodic.solve(np.array(words * 3, np.int64), 1, len(words) + 1)
    assert got == [(0, 2 * len(words), len(words))]


def test_a_very_long_repetition_stays_fast():
    assert periodic.solve(np.zeros(300_000, np.int64), 1, 100_001) == [(0, 299_999, 1)]


@pytest.mark.parametrize("base,long", [(1 << 14, 1 << 18), (8, 60), (16, 500), (8, 0)])
def test_tiles_give_the_same(spark, monkeypatch, base, long):
    monkeypatch.setattr(periodic, "BASE", base)
    monkeypatch.setattr(periodic, "LONG", long)
    rng = random.Random(base)
    rows = [(i, " ".join(some_words(rng, rng.randrange(900), rng.choice([1, 2, 3, 50]))), "x", "y", "z") for i in range(60)]
    rows += [(100, None, "", "", ""), (101, "", "", "", ""), (102, " \t\n", "", "", ""), (None, "é " * 80, "", "", ""), (None, "a b\n" * 30, "", "", ""), (7, "a " * 25, "", "", ""), (7, "a " * 25, "", "", "")]
    docs = spark.createDataFrame(rows, TEXTS).repartition(3)
    got = sorted((r.doc_id or -1, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in periodic.periodic_runs(docs).collect())
    want = []
    for i, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = brute(words)
        want.append((i or -1, tuple(runs), collapsed(words, runs)))
    assert got == sorted(want)


def test_tiles_cover_every_match(monkeypatch):
    monkeypatch.setattr(periodic, "BASE", 8)
    for n in (1, 24, 63, 64, 65, 500, 3000):
        found = list(periodic.tiles(n))
        for q in range(1, n // 3 + 1):
            mine = [(s, e) for s, e, low, high in found if low <= q < high]
            assert {i for s, e in mine for i in range(s, e - q)} == set(range(n - q))


def test_whole_query_and_empty_table(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(200)))) for i in range(150)] + [(900, None), (None, "a " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in periodic.op11_periodic(spark, str(tmp_path)).collect()}
    planted = 0
    for i, text in rows:
        words = (text or "").split()
        n, h = len(words), crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        runs = brute(words)
        r = got[i]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == sha256(collapsed(words, runs).encode()).hexdigest()
        if runs:
            from fractions import Fraction

            s, m, q = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, m, q, 1000 * m // q)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert planted > 5
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.periodic_runs(empty).count() == 0
