"""Packing: exact round trip, the level rule against a plain search, and edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import Row
from tests_llm_helpers import check_pieces
from tokenizers import Tokenizer

from tessera.llm import packing as P


def test_round_trip_of_the_table(spark, sf001, texts):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").repartition(3)
    assert check_pieces(P.pack_documents(docs).collect(), texts.items())


def test_edge_cases(spark):
    rows = [(1, None), (1, ""), (None, "null id"), (2, "twice"), (2, "twice"), (3, "long text, " * 60_000), (4, " \n\t "), (5, "<|endoftext|> x")]
    df = spark.createDataFrame([Row(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, start int")
    out = P.pack_documents(df)
    check_pieces(out.collect(), rows)
    assert P.pack_documents(df.where("false")).count() == 0


def test_encoder_equals_the_tokenizer(texts):
    enc, tok = P.BlankCachedEncoder(P.tokenizer_path(), keep=50), Tokenizer.from_file(P.tokenizer_path())
    rng = random.Random(1)
    letters = "aAéÉß'sStTdDlL 1²½\t\n\r\x0b.,!#<|>\x7f\x85\xa0\xad\x00\x1cÿÀİł́Σς "
    odd = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for t in [*odd, *texts.values(), "a <|startoftext|>b", "İI ΑΣ Σ", "don't 'S it'll"]:
        assert enc.encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_level_rule():
    """The chosen level changes the sum of squares least among all levels that fit."""
    rng = random.Random(2)
    p = P.Packer(size=16, max_open=10 ** 9)
    for i in range(400):
        s = rng.randint(1, 15)
        before = p.count.copy()
        options = {}
        for level in range(16 - s + 1):
            if level == 0 or before[level]:
                after = before.copy()
                after[level] -= level > 0
                after[level + s] += level + s < 16
                options[level] = int((after ** 2).sum())
        assert options[p.level_for(s)] == min(options.values())
        list(p.add(i, b"\0\0\0\0" * s))
        assert int((p.count ** 2).sum()) == min(options.values()) and p.open == p.count.sum()


@pytest.mark.parametrize("max_open", [3, 1000])
def test_nothing_is_padded(max_open):
    rng = random.Random(3)
    p, fill, sizes = P.Packer(size=64, max_open=max_open), {}, {}
    out = []
    for i in range(500):
        sizes[i] = rng.randint(1, 200)
        out += p.add(i, b"\0\0\0\0" * sizes[i])
        assert p.open <= max_open
    out += p.close()
    got = {}
    for doc, start, ids, total, seq, off in out:
        assert off == fill.get(seq, 0) and start == got.get(doc, 0) and total == sizes[doc]
        fill[seq] = off + len(ids) // 4
        got[doc] = start + len(ids) // 4
    assert got == sizes and all(f & (f - 1) == 0 for f in fill.values()) and sum(f < 64 for f in fill.values()) <= 6
