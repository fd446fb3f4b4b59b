import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from pricelake.operators import dimensions, upsert
from pricelake.sources import history, ledger, raw
from pricelake.sources.shared import Files

ROW = "id string, at int, v string, day string"


def rows_of(table):
    return {(r.id, r.day): r.v for r in table.read().collect()}


def test_a_failed_commit_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    make = lambda rows: spark.createDataFrame(rows, ROW)
    first = make([("a", 1, "x", "d1"), ("b", 1, "y", "d2"), ("n", 1, "z", None)])
    assert upsert.upsert(path, first, ["id"], "at", "day") == 1
    table = history.History(spark, path, "day")
    old = rows_of(table)
    assert old == {("a", "d1"): "x", ("b", "d2"): "y", ("n", None): "z"}

    broken = make([("a", 2, "new", "d1"), ("b", 2, "new", "d2")]).withColumn("v", F.when(F.col("id") == "a", F.col("v")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        table.commit(broken)
    assert rows_of(table) == old

    with monkeypatch.context() as m:
        m.setattr(Files, "put", lambda *_: (_ for _ in ()).throw(OSError("the pointer can't be written")))
        with pytest.raises(OSError):
            upsert.upsert(path, make([("a", 3, "new", "d1")]), ["id"], "at", "day")
    assert rows_of(table) == old and table.state()["version"] == 1

    assert upsert.upsert(path, make([("a", 3, "new", "d1"), ("c", 1, "c", "d1")]), ["id"], "at", "day") == 2
    assert rows_of(table) == {**old, ("a", "d1"): "new", ("c", "d1"): "c"}
    assert table.collect() == 1  # the third commit's partition; the failed write left a folder without any
    assert len(Files(spark).names(f"{path}/data")) == 2
    assert rows_of(table) == {**old, ("a", "d1"): "new", ("c", "d1"): "c"}
    before = table.state()["before"]
    assert all(part in Files(spark).names(f"{path}/data/commit={commit}") for part, commit in before.items())
    assert not [n for n in Files(spark).names(path) if n.endswith(".tmp")]


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    table = history.History(spark, path, "day")
    table.commit(spark.createDataFrame([("a", 1, "x", "d1")], ROW))
    states = iter([table.state(), {**table.state(), "version": 7}])
    monkeypatch.setattr(history.History, "state", lambda self: next(states))
    with pytest.raises(history.ConcurrentCommit):
        table.commit(spark.createDataFrame([("a", 2, "y", "d1")], ROW))


@pytest.mark.parametrize("value", ["007", "2024-01-01", "a=b/c", "", "é"])
def test_partition_values_keep_their_text(spark, tmp_path, value):
    path = str(tmp_path / "h")
    upsert.upsert(path, spark.createDataFrame([("a", 1, "x", value), ("b", 1, "y", "other")], ROW), ["id"], "at", "day")
    found = upsert.snapshot_of(spark, path, "day", value)
    assert [(r.id, r.day) for r in found.collect()] == [("a", value)]
    assert upsert.snapshot_of(spark, path, "day", "none such") is None


def test_output_kinds(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "x", "d1")], ROW)
    upsert.write_rows(rows, str(tmp_path / "p"), "parquet", ["id"], "at", "day")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
    upsert.write_rows(rows, str(tmp_path / "h"), "history", ["id"], "at", "day")
    assert history.History(spark, str(tmp_path / "h"), "day").read().count() == 1
    with pytest.raises(ValueError):
        upsert.write_rows(rows, str(tmp_path / "x"), "csv", ["id"], "at", "day")


def test_ledger(spark, tmp_path):
    root, log = str(tmp_path / "s"), str(tmp_path / "l")
    rows = spark.range(7).withColumn("x", F.lit("y"))
    assert ledger.materialise(rows, root, log, ("r1", "d", "a"), "products") == 7
    assert ledger.materialise(rows.limit(0), root, log, ("r2", "d", "a"), "products") == 0
    ledger.failed(spark, log, ("r3", "d", "a"), "products")
    done = ledger.read_ledger(spark, log)
    expected = spark.createDataFrame([(f"r{k}", "d", "a", "products") for k in (1, 2, 3, 4)], "retailer_id string, run_date string, run_id string, dataset string")
    assert {r.retailer_id: r.reason for r in ledger.open_runs(expected, done).collect()} == {"r2": "no_rows", "r3": "failed", "r4": "no_record"}
    counts = expected.select("*", F.when(F.col("retailer_id") == "r1", 6).otherwise(0).cast("long").alias("n"))
    assert [(r.retailer_id, r.recorded, r.counted) for r in ledger.count_issues(counts, done).collect()] == [("r1", 7, 6)]
    decisions = spark.createDataFrame([("a", True), ("b", False)], "run_id string, publish_allowed boolean")
    data = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "run_id string, v int")
    assert [r.v for r in ledger.publishable(data, decisions).collect()] == [1]


def test_dimension_over_runs(spark, tmp_path):
    root, log, path = str(tmp_path / "s"), str(tmp_path / "l"), str(tmp_path / "d")
    write = lambda run, rows, schema: ledger.materialise(spark.createDataFrame(rows, schema), root, log, run, "products")
    fold = lambda: dimensions.update_dimension(spark, path, ledger.read_ledger(spark, log), root, "products", ["id"])
    assert fold() == 0 and dimensions.read_dimension(spark, path) is None
    write(("r1", "2024-01-02", "a"), [(1, "new", "b"), (2, "two", "b")], "id int, name string, brand string")
    assert fold() == 1
    write(("r1", "2024-01-01", "z"), [(1, "late and old", "b"), (3, "three", "b")], "id int, name string, brand string")
    write(("r2", "2024-01-03", "a"), [(2, "without brand")], "id int, name string")
    assert fold() == 2 and fold() == 0
    got = {r.id: (r["name"], r.brand, r.run_date) for r in dimensions.read_dimension(spark, path).collect()}
    assert got == {1: ("new", "b", "2024-01-02"), 2: ("without brand", None, "2024-01-03"), 3: ("three", "b", "2024-01-01")}


@pytest.mark.parametrize("end", ["", "\n", "\r\n"])
def test_lines_of_a_file_of_many_splits(spark, tmp_path, end):
    folder = tmp_path / "raw" / "store=s"
    folder.mkdir(parents=True)
    rng = random.Random(1)
    body = ["" if rng.random() < 0.1 else " " if rng.random() < 0.1 else json.dumps({"i": i, "x": "y" * rng.randrange(300)}) for i in range(3000)]
    joined = ("\r\n" if end == "\r\n" else "\n").join(body) + end
    (folder / "products.jsonl").write_bytes(joined.encode())
    (folder / "promo_cards.jsonl").write_text('{"i": 0}\n')
    other = tmp_path / "other"
    other.mkdir()
    (other / "products.jsonl").write_text('\n{"i": 1}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7kb")
    try:
        got = raw.lines(spark, [str(tmp_path / "raw"), str(other)])
        plan = got._jdf.queryExecution().toString()
        got = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "row_number" not in plan
    assert len(got) == sum(bool(t.strip()) for t in body) + 2
    assert all(json.loads(r.line)["i"] == r.source_line_number - 1 for r in got)


def test_digests_of_files_in_one_split_each(spark, tmp_path):
    rng = random.Random(2)
    contents = {"empty": b"", "end": b"a\nb\n", "open": b"a\nb", "cr": b"a\r\nb\r\n", "feeds": b"\n\n\n", "bytes": bytes(rng.randrange(256) for _ in range(300_000)), "long": b"x" * 3_000_000 + b"\ny" * 400_000}
    for name, data in contents.items():
        (tmp_path / f"{name}.jsonl").write_bytes(data)
    with_small_splits = {"spark.sql.files.maxPartitionBytes": "64kb", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
    for k, v in with_small_splits.items():
        spark.conf.set(k, v)
    try:
        got = {r.path.rsplit("/", 1)[1].removesuffix(".jsonl"): (r.sha256, r.bytes) for r in raw.file_digests(spark, str(tmp_path)).collect()}
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64kb"
    finally:
        for k in with_small_splits:
            spark.conf.unset(k)
    assert got == {n: (hashlib.sha256(d).hexdigest(), len(d)) for n, d in contents.items()}


def test_blocked_runs(spark):
    context = spark.createDataFrame([("a", "1", "r", "d"), ("b", None, "r", "d")], "run_dir string, run_id string, retailer_id string, run_date string")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "run_dir string")
    assert {tuple(r) for r in raw.blocked_runs(context, expected=expected).collect()} == {("b", "missing_run_id"), ("c", "missing_input")}
    with pytest.raises(Exception, match="BLOCK_RUN"):
        raw.blocked_runs(context, strict=True).collect()
