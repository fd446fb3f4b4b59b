import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import quality, toxicity
from pricelake.llm.labels import fold

SYLLABLES = ["an", "er", "the", "ou", "re", "ti", "os", "de", "la", "ie", "ment", "che"]


def corpus(spark, tmp_path, n=700):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices(SYLLABLES, k=rng.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(5, 80))]
        good, toxic = rng.random() < 0.7, rng.random() < 0.3
        if not good:
            words = [w + rng.choice(["***", "&&&"]) for w in words] if rng.random() < 0.5 else [w for w in words[:6] for _ in range(9)]
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["zogg", "wuxx"]) + rng.choice(SYLLABLES))
        docs.append((i, " ".join(words), "en"))
        labels.append((i, int(good), int(toxic)))
    docs += [(n, None, None), (n + 1, "", "x"), (n + 2, " \n", "x"), (5, docs[5][1], "en")]
    labels += [(n, None, None), (None, 1, 1), (3, labels[3][1], labels[3][2])]
    spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return docs, {i: (q, t) for i, q, t in labels if i is not None}


@pytest.mark.parametrize("query,column,folds,held", [(quality.op9_quality, 0, 4, 2), (toxicity.op10_toxicity, 1, 3, 1)])
def test_held_out(spark, tmp_path, query, column, folds, held):
    import zlib

    docs, labels = corpus(spark, tmp_path)
    rows = query(spark, str(tmp_path)).collect()
    assert len(rows) == len(docs)
    got = {r.doc_id: r for r in rows}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % folds == held) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    out = [i for i, r in got.items() if r.held_out and labels.get(i, (None, None))[column] is not None]
    right = [got[i].predicted == labels[i][column] for i in out]
    assert len(out) > 100 and np.mean(right) > 0.95
    assert got[700].score == got[701].score == got[702].score


@pytest.mark.parametrize("query", [quality.op9_quality, toxicity.op10_toxicity])
def test_no_labels_and_no_rows(spark, tmp_path, query):
    spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.score for r in query(spark, str(tmp_path)).collect()} == {0.5}
    spark.createDataFrame([], "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert query(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("module,name", [(quality, "quality_score"), (toxicity, "toxicity_score")])
def test_columns_that_clash(spark, module, name):
    docs = spark.createDataFrame([(i, f"some words {i} " * 4000, "old", 1) for i in range(12)], f"doc_id long, text string, {name} string, label int")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    fitted = module.fit(docs, labels)
    got = module.score(docs, *fitted) if module is quality else module.score(docs, fitted)
    assert got.columns == ["doc_id", "text", "label", name] and all(0 <= r[name] <= 1 and r.label == 1 for r in got.collect())


def test_fold(spark):
    import zlib

    got = spark.range(50).select("id", fold(F.col("id"), 3).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in got)


def test_context_sums_like_a_loop():
    rng = np.random.default_rng(1)
    codes = (rng.integers(0, 20, 500) * quality.SHAPE_BUCKETS + rng.integers(0, 5, 500)).astype(np.int32)
    items = np.column_stack([codes // quality.SHAPE_BUCKETS, quality.WORD_BUCKETS + codes % quality.SHAPE_BUCKETS])
    sums, index = quality.ContextSums(), quality.index_vectors()
    sums.add(codes)
    want = np.zeros_like(sums.sums)
    for i in range(len(items)):
        for d in (-2, -1, 1, 2):
            if 0 <= i + d < len(items):
                for x in items[i]:
                    want[x] += index[items[i + d]].sum(axis=0)
    assert np.allclose(sums.sums, want, atol=1e-3)
    old, quality.CHUNK = quality.CHUNK, 37
    try:
        parts = quality.ContextSums()
        parts.add(codes)
    finally:
        quality.CHUNK = old
    assert np.allclose(parts.sums, sums.sums, atol=1e-3) and (parts.counts == sums.counts).all()


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (4000, 3))
    p = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (rng.random(4000) < p).astype(float)
    s = quality.fit_network(x, y).scores(x)
    for low in (0.1, 0.3, 0.5, 0.7):
        part = (s >= low) & (s < low + 0.2)
        assert abs(s[part].mean() - y[part].mean()) < 0.06


def plain_models(rows):
    """Kneser-Ney over dictionaries."""
    n = toxicity.ORDER
    counts = [Counter(), Counter()]
    for text, label in rows:
        for w in toxicity.words_of(text):
            s = toxicity.START * (n - 1) + w + toxicity.END
            for i in range(n - 1, len(s)):
                counts[label][s[i - n + 1 : i + 1]] += 1
    kinds = set(counts[0]) | set(counts[1])
    shared = {}
    for k in range(n - 1, 0, -1):
        shared[k] = Counter(g[1:] for g in kinds)
        kinds = set(shared[k])
    d = toxicity.DISCOUNT

    def backoff(g):
        k = len(g)
        below = 1 / toxicity.ALPHABET if k == 1 else backoff(g[1:])
        total = sum(c for x, c in shared[k].items() if x[:-1] == g[:-1])
        types = sum(1 for x in shared[k] if x[:-1] == g[:-1])
        return (max(shared[k][g] - d, 0) + d * types * below) / total if total else below

    def difference(w):
        s, out = toxicity.START * (n - 1) + w + toxicity.END, 0.0
        for i in range(n - 1, len(s)):
            g, logs = s[i - n + 1 : i + 1], []
            for c in (1, 0):
                total = sum(v for x, v in counts[c].items() if x[:-1] == g[:-1])
                types = sum(1 for x in counts[c] if x[:-1] == g[:-1])
                p = backoff(g[1:])
                logs.append(math.log((max(counts[c][g] - d, 0) + d * types * p) / total if total else p))
            out += logs[0] - logs[1]
        return out

    return difference


def test_models_like_plain_kneser_ney(spark):
    rng = random.Random(4)
    rows = [(" ".join("".join(rng.choices("abé", k=rng.randrange(1, 7))) for _ in range(12)), int(rng.random() < 0.4)) for _ in range(40)]
    models = toxicity.count_models(spark.createDataFrame(rows, "text string, label int").repartition(3))
    plain = plain_models(rows)
    words = ["a", "ab", "éab", "abababab", "zz", "bé", "a" * 30]
    assert np.allclose(models.differences(words), [plain(w) for w in words], atol=1e-4)


def test_rare_runs_share_nothing(spark):
    """More distinct runs than 2**20 between a few toxic ones: each keeps its own counts."""
    rng = random.Random(12)
    word = lambda: "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(7))
    ordinary = [(" ".join(word() for _ in range(1000)), 0) for _ in range(250)]
    models = toxicity.count_models(spark.createDataFrame([*ordinary, ("zogg wuxx", 1)], "text string, label int").repartition(4))
    plain = toxicity.count_models(spark.createDataFrame([("zogg wuxx", 1)], "text string, label int"))
    assert models.runs.count() > 1 << 20
    own = {r.g5: (r.toxic, r.ordinary) for r in models.runs.join(plain.runs.select("g5"), "g5").collect()}
    assert len(own) == plain.runs.count() and all(toxic == 1 and plain_runs == 0 for toxic, plain_runs in own.values())
    totals = {r.h4: (r.t, r.o, r.tk, r.ok) for r in models.histories.join(plain.histories.select("h4"), "h4").collect()}
    start = {k for k, v in totals.items() if v[1]}
    assert len(start) == 1 and all(v[1] == v[3] == 0 for k, v in totals.items() if k not in start)


def test_scores_do_not_depend_on_what_is_sent(spark, tmp_path, monkeypatch):
    corpus(spark, tmp_path, 200)
    query = lambda: sorted((r.doc_id, r.score) for r in toxicity.op10_toxicity(spark, str(tmp_path)).collect())
    want = query()
    monkeypatch.setattr(toxicity, "SENT_RUNS", 40)
    got = query()
    assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([s for _, s in got], [s for _, s in want], atol=1e-6)


def test_all_labelled_rows_are_counted(spark):
    texts = [(i, "plain words here" if i % 2 else f"zogg{chr(97 + i % 26)}{chr(97 + i // 26)} here") for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in texts], "doc_id long, toxic int")
    models = toxicity.fit(docs, labels).models
    want = Counter()
    for i, text in texts:
        want[1 - i % 2] += sum(len(w) + 1 for w in toxicity.words_of(text))
    got = models.runs.agg(F.sum("toxic"), F.sum("ordinary")).first()
    assert tuple(got) == (want[1], want[0])
    whole = toxicity.count_models(docs.join(labels.withColumnRenamed("toxic", "label"), "doc_id"))
    assert np.allclose(models.differences(["zoggaa", "here", "x"]), whole.differences(["zoggaa", "here", "x"]))


def test_shapes_see_accents_and_signs():
    shape = lambda word: int(quality.document_items(word.encode())[0] % quality.SHAPE_BUCKETS)
    assert shape("Été") == shape("Eta") != shape("été") and shape("ÉTÉ") == shape("ABC")
    assert len({shape(w) for w in ("a", "«a", "a»", "a…", "a–b", "a1", "٣", "¿a?", "a....")}) == 8  # both digits without a sign are alike
    assert shape("٣") == shape("a1") and shape("日本") == shape("ab")
    lower, upper = (quality.document_items(w.encode(), 4096) // quality.SHAPE_BUCKETS for w in ("été ab", "ÉTÉ AB"))
    assert (lower == upper).all() and len(quality.document_items(("é " * 300_000).encode())) == 300_000
    assert len(quality.document_items(b"\xff\xfe a")) == 2 and len(quality.document_items(b" \n")) == 0


def test_buckets_grow_with_the_words(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(" ".join(f"w{rng.randrange(60_000)}" for _ in range(3000)),) for _ in range(100)] + [(None,), ("",)], "text string")
    assert quality.bucket_count(docs) == 1 << 16 and quality.bucket_count(docs.limit(1)) == quality.LEAST_BUCKETS == quality.bucket_count(docs.limit(0))


def test_runs_do_not_depend_on_the_portions(monkeypatch):
    words = [f"w{i}" * (1 + i % 7) for i in range(500)] + ["long" * 300, "é"]
    _, h, at = toxicity.runs(words)
    values = toxicity.RunValues.sorted(h[toxicity.ORDER][at][::3].view(np.int64), np.arange(len(at[::3])) / 7)
    whole, rest = values.by_word(words), values.lacking(words)
    monkeypatch.setattr(toxicity, "SIGNS_AT_ONCE", 100)
    assert [w for part in toxicity.portions(words) for w in part] == words
    assert max(sum(map(len, part)) for part in toxicity.portions(words) if len(part) > 1) <= 100
    assert np.array_equal(values.by_word(words), whole) and np.array_equal(values.lacking(words), rest)
    assert len(values.by_word([])) == 0 and len(values.lacking([])) == 0


def test_memory_of_long_words_follows_the_signs():
    import tracemalloc

    words = ["x" * 5000 + str(i) for i in range(4000)]  # 20 million signs
    values = toxicity.RunValues.sorted(np.arange(3), np.ones(3))
    tracemalloc.start()
    values.by_word(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
