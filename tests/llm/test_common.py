import random
import tracemalloc

import numpy as np
import pytest

from pricelake.llm import common, quality


def some_text(n):
    rng = random.Random(n)
    return " ".join(rng.choice(["alpha", "béta", "x", "\t\n", "Zz9,", "日本"]) for _ in range(n)).encode()


@pytest.mark.parametrize("n", [0, 1, 30, 3000])
def test_hashes_do_not_depend_on_the_pieces(monkeypatch, n):
    text = some_text(n)
    words = common.word_hashes(text)
    windows = [common.window_hashes(words, w) for w in (1, 5, 50)]
    items = quality.document_items(text)
    assert len(words) == len(common.ascii_words(text.decode()))
    monkeypatch.setattr(common, "AT_ONCE", 64)
    assert (common.word_hashes(text) == words).all()
    assert b"".join(common.pieces(text)) == text
    for w, before in zip((1, 5, 50), windows):
        assert np.array_equal(common.window_hashes(words, w), before)
    assert np.array_equal(quality.document_items(text), items)


def test_a_long_text_needs_little_memory_beside_its_hashes():
    text = b"alpha beta gamma " * 1_200_000  # 20 MB
    common.word_hashes(text[:300_000])
    tracemalloc.start()
    words = common.word_hashes(text)
    hashed = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    items = quality.document_items(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(words) == len(items) == 3_600_000
    assert hashed < 2.5 * words.nbytes + 20e6
    assert peak < 200e6
    assert len(common._powers) <= 4 * common.AT_ONCE
