import hashlib
import random

import pytest
from tokenizers import Tokenizer

from pricelake.llm import bpe

PATH = bpe.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(text):
    return [i for run in bpe.encoder(PATH).encode(text) for i in run]


SAMPLES = ["", " ", "  a  b\n\n c", "It's we'll 'tis don't", "naïve café 東京 😀😀", "<|endoftext|>x<|endoftext|>", "a" * 5000, "ab" * 9000, " " * 3000, "  x\u0085y\x1cz\x1fq", "…" * 700, "123456789 1,000.5", "퟿", "x" * 70_000 + " y" * 40_000]


@pytest.mark.parametrize("text", SAMPLES)
def test_same_ids_as_library(library, text):
    assert ids_of(text) == library.encode(text, add_special_tokens=False).ids


def test_random_texts(library):
    rng = random.Random(5)
    signs = [*"abcde tion the    \n\t'.,!-0123", "é", "ß", "中", "😀", "́", "​", "'ll", "<|endoftext|>"]
    for _ in range(400):
        text = "".join(rng.choices(signs, k=rng.randrange(1, 120)))
        assert ids_of(text) == library.encode(text, add_special_tokens=False).ids


def test_long_text_without_blanks_stays_small():
    import tracemalloc

    code = bpe.encoder(PATH)
    line, n = "ein\nWort, und noch eins\t", 12_000
    for text in (line.replace(" ", "\n") * n, "ab" * 150_000, "\n" * 300_000):
        tracemalloc.start()
        runs = most = 0
        for run in code.runs(text):
            runs, most = runs + 1, max(most, len(run))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert runs > 1 and most <= bpe.PIECE_CHARS and peak < 40 * bpe.PIECE_CHARS + 6 * len(text)


def test_runs_carry_what_the_ids_stand_for():
    code = bpe.encoder(PATH)
    for text in SAMPLES:
        for ids, written, data in (x for run in code.runs(text) for x in run):
            assert written == ",".join(map(str, ids)) and data == b"".join(code.merges.token_bytes[i] for i in ids)


def test_windows_agree_with_one_merge():
    m, rng = bpe.merge_list(PATH), random.Random(7)
    assert 1 < m.lookahead < 4096
    for alphabet in ("ab", "aeiourstln", "acehinortst", "=-_*", "thein"):
        for _ in range(4):
            data = "".join(rng.choices(alphabet, k=3 * m.window)).encode()
            assert list(m.transduce(data)) == m.merge(data)


def test_lookahead_bounds_the_influence_of_what_follows():
    m, rng = bpe.merge_list(PATH), random.Random(11)

    def ends(data):
        at, out = 0, set()
        for t in m.merge(data):
            at += len(m.token_bytes[t])
            out.add(at)
        return out

    for _ in range(300):
        head = "".join(rng.choices("thesinaro", k=m.lookahead + 80)).encode()
        stable = len(head) - m.lookahead
        one, two = (ends(head + "".join(rng.choices("thesinaro", k=60)).encode()) for _ in range(2))
        assert {e for e in one if e <= stable} == {e for e in two if e <= stable}


def test_round_trip_and_nulls(spark):
    rows = [(1, None), (2, ""), (3, "Grüße 😀 <|endoftext|>"), (4, "Grüße 😀 <|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.round_trip(docs, PATH).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[1].n_tokens == got[2].n_tokens == 0 and got[1].ids_sha256 == got[2].decoded_sha256 == empty
    assert got[3].decoded_sha256 == hashlib.sha256(rows[2][1].encode()).hexdigest() and got[3].ids_sha256 == got[4].ids_sha256
    back = {r.doc_id: r.text for r in bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect()}
    assert back == {1: "", 2: "", 3: rows[2][1], 4: rows[3][1]}
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0


def test_decoder_holds_back_unfinished_characters(library):
    ids = ids_of("😀é")
    step = bpe.Decoder(bpe.merge_list(PATH))
    assert "".join(step.feed([i]) for i in ids) + step.feed((), True) == "😀é"
    broken = ids[:1]
    assert bpe.Decoder(bpe.merge_list(PATH)).feed(broken, True) == library.decode(broken, skip_special_tokens=False)
