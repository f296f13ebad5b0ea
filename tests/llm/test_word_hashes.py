"""Words that differ are told apart, whatever their bytes."""

import numpy as np
import pytest
from tests_llm_helpers import brute_windows

from tessera.llm.common import word_hashes
from tessera.llm.decontaminate import decontaminate
from tessera.llm.substring_dedup import remove_repeats


def twin(n):
    """Two words of n letters, the Thue-Morse order of a and b and its complement: they collide under every
    polynomial modulo a power of two."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_hashes_tell_words_apart():
    words = sorted({w for n in (1, 2, 7, 8, 9, 16, 31, 32, 63, 64, 65, 256, 512, 1024, 4096) for w in twin(n)}
                   | {"x" * k for k in range(1, 80)} | {f"w{i}" for i in range(5000)} | {"a" * k + "b" for k in range(70)})
    text = " ".join(words).encode()
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - [len(w) for w in words]
    h = word_hashes(np.frombuffer(text, np.uint8), start, end, 3)
    assert len(set(h.tolist())) == len(words)
    alone = [word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]), 3)[0] for w in words[::50]]
    assert alone == h[::50].tolist()


@pytest.mark.parametrize("n", [512, 4096])
def test_operators_tell_words_apart(spark, n):
    a, b = twin(n)
    row = [f"w{i}" for i in range(34)]
    docs = spark.createDataFrame([(1, " ".join([*row, a])), (2, " ".join([*row, b])), (3, f"x {a} y")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in remove_repeats(docs, n=35).collect()} == {1: 0, 2: 0, 3: 0}
    items = [(1, b)]
    got = {r.doc_id: r.n_hit for r in decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), n=10).collect()}
    assert got == {r.doc_id: len(brute_windows(r.text, items)[1]) for r in docs.collect()} == {1: 0, 2: 1, 3: 0}
