"""Plain versions shared by tests."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from tessera.llm.packing import tokenizer_path


def brute_windows(text, items, n=10):
    """The text's words and the numbers of those inside an occurrence of an item window."""
    find = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+").findall
    low = lambda t: find(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, windows = low(text), set()
    for _, t in items:
        w = low(t)
        windows |= {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1) if w else 0)}
    hit = set()
    for m in {len(w) for w in windows}:
        for k in range(len(words) - m + 1):
            if tuple(words[k:k + m]) in windows:
                hit |= set(range(k, k + m))
    return words, hit


def check_pieces(pieces, docs, size=2048, end=1):
    """Every id of every document in exactly one piece; sequences gapless, full or a power of two."""
    tok = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for d, t in docs:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, end], "<u4")
        want[d, ids.tobytes()] += 1
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for d in {k[0] for k in want}:
        texts = [k[1] for k in want if k[0] == d for _ in range(want[k])]
        covered = sum(p.length for p in by_doc[d])
        assert covered == sum(len(t) // 4 for t in texts)
        if len(texts) == 1:
            parts = sorted(by_doc[d], key=lambda p: p.start)
            assert b"".join(bytes(p.ids) for p in parts) == texts[0]
            assert all(p.doc_tokens == len(texts[0]) // 4 for p in parts)
            assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
    assert set(by_doc) == {k[0] for k in want}
    for seq in by_seq.values():
        seq.sort(key=lambda p: p.offset)
        total = 0
        for p in seq:
            assert p.offset == total
            total += p.length
        assert total <= size and total & (total - 1) == 0
    return {zlib.crc32(bytes(p.ids)) for p in pieces}
