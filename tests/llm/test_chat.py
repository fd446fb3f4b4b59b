import hashlib
import random


from pricelake.llm import chat


def test_round_trip_of_odd_texts(spark):
    rng = random.Random(2)
    signs = ["<", "|", "\\", "\n", "<|im_start|>", "<|im_end|>", "assistant", "é", "$1", " "]
    rows, want = [], {}
    for conv in range(60):
        turns = []
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["system", "user", "assistant", "to\nol", "", "a\\", "<|x"])
            text = rng.choice([None, "".join(rng.choices(signs, k=rng.randrange(0, 9)))])
            rows.append((conv, turn, role, text, "x", 7))
            turns.append((role, text or "", role == "assistant"))
        want[conv] = turns
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string, segments int").repartition(3)
    read = chat.parse_chats(chat.format_chats(df)).collect()
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in read} == want
    for r in read:
        assert "".join(s.text for s in r.segments) == r.formatted
        assert sum(s.loss for s in r.segments) == sum(t.loss for t in r.turns)


def test_machine(spark):
    orders = {1: "system user assistant", 2: "user assistant user assistant", 3: "user", 4: "assistant", 5: "user user assistant", 6: "user system assistant", 7: "user assistant system user assistant"}
    rows = [(c, k, role, "t") for c, o in orders.items() for k, role in enumerate(o.split())]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {r.conv_id for r in chat.format_chats(df).filter("valid").collect()} == {1, 2}
    assert chat.format_chats(df.limit(0)).count() == 0


def test_query_and_repeated_rows(spark, tmp_path):
    rows = [(5, 0, "user", "hi"), (5, 1, "assistant", "yo"), (5, 1, "assistant", "yo"), (None, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op6_chat_format(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[5].n_turns == 3 and got[5].loss_sha256 == sha("yoyo") and not got[5].valid
    assert got[-1].turns_sha256 == sha(f"user\n{chat.PROBE_TEXT}\nassistant\n{chat.PROBE_TEXT}\n") and got[-1].loss_chars == len(chat.PROBE_TEXT) and got[-1].valid
    assert got[None].n_turns == 1 and got[None].loss_chars == 0


def test_native_plan(spark, tmp_path):
    spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    plan = chat.op6_chat_format(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
