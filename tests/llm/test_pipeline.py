import random

import pyarrow as pa
import pytest

import corpus_pipeline
from pricelake.llm import pii


def test_stages_on_a_small_table(spark, tmp_path):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices(["an", "er", "the", "ou", "re", "ti"], k=rng.randrange(1, 4)))
    docs, labels = [], []
    for i in range(300):
        words = [word() for _ in range(rng.randrange(12, 60))]
        bad = i % 5 == 0
        if bad:
            words = [w + "***" for w in words]
        docs.append((i, " ".join(words) + (" mail a.b@c.org" if i % 7 == 1 else ""), "en", rng.choice(["a", "b"]), 0))
        labels.append((i, int(not bad), 0))
    docs += [(1000 + i, docs[i][1], "en", "a", 0) for i in range(1, 60, 5)] + [(2000, None, None, None, None), (2001, "", "en", "b", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    d, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        before = d
        d = step(spark, d, str(tmp_path))
        assert k == 4 or d.columns == before.columns
        d.write.parquet(f"{tmp_path}/{k}")
        d = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(d.collect())
    good = {r.doc_id for r in kept[0] if r.doc_id < 2000}
    assert not any(i % 5 == 0 for i in good if i < 300) and len([i for i in good if i < 300]) > 225
    assert not any(1000 <= r.doc_id < 2000 for r in kept[1]) and len({r.doc_id for r in kept[1]}) == len(kept[1])
    assert not any(pii.base_spans(r.text or "") for r in kept[2]) and {r.doc_id for r in kept[2]} == {r.doc_id for r in kept[1]}
    sizes = {r.doc_id: len((r.text or "").split()) for r in kept[2]}
    assert abs(sum(len((r.text or "").split()) for r in kept[3]) - 1.5 * sum(sizes.values())) <= 2 * 60
    assert len(kept[4]) == len(kept[3]) and {r.n_tokens > 0 for r in kept[4]} <= {True, False}
    assert [c for c in d.columns] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_near_duplicates_with_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(80))
    near, other = text.replace("w40 ", "w4O "), "some other words that are here in one row alone"
    rows = [(5, text, 1), (5, text, 2), (3, near, 3), (None, near, 4), (8, other, 5), (None, "all by itself is this text without an id", 6), (6, "", 7), (6, None, 8), (None, "", 9), (5, other + " x", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key int")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.text_key for r in kept.collect()) == [3, 6, 7, 8, 9, 10]  # 5 is linked with 10, whose id is smaller
    assert corpus_pipeline.near_duplicate_stage(spark, docs.limit(0), "").count() == 0


@pytest.mark.parametrize("labels", [[], [(i, 0, 0) for i in range(40)], [(1, 1, 0)], [(1, 1, 0), (2, 0, 0), (3, 0, 0)]])
def test_quality_stage_keeps_all_without_a_network(spark, tmp_path, labels):
    docs = spark.createDataFrame([(i, f"clean words {i}") for i in range(40)] + [(40, None)], "doc_id long, text string")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.quality_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(41))


@pytest.mark.parametrize("step", [corpus_pipeline.quality_stage, corpus_pipeline.pii_stage, corpus_pipeline.bpe_stage])
def test_written_later_a_stage_still_works_in_small_batches(spark, tmp_path, step):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    docs = spark.range(2500).coalesce(1).selectExpr("id AS doc_id", "if(id % 5 = 0, 'bad *** bad', 'some good words') || id AS text")
    spark.range(400).selectExpr("id AS doc_id", "int(id % 5 > 0) AS quality", "0 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")

    def counted(batches):
        yield from (b.slice(0, 0).from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches)

    for name in names:
        spark.conf.unset(name)
    try:
        sizes = [r.n for r in step(spark, docs, str(tmp_path)).mapInArrow(counted, "n long").collect()]
    finally:
        for name in names:
            spark.conf.unset(name)
    assert sum(sizes) >= 1500 and max(sizes) <= 1000
