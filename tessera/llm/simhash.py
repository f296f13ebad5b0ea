"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Fingerprints that differ in at most ``k`` bits
share at least ``8 - k`` of them: the guaranteed minimum of matches. Postings of single bytes
would list a 256th of the corpus each, so a posting here is a set of positions with their byte
values: the eight positions form ``k + 2`` blocks, and as at most ``k`` blocks can differ, two
whole blocks agree. Each pair of blocks gives one posting per distinct fingerprint.

* Short postings (at most ``hot`` fingerprints): members are compared, the shared positional bytes
  of a pair are tallied, pairs below the guaranteed minimum are dropped, the rest is verified by
  the bits of the exclusive or.
* Longer postings are refined instead of capped: members must agree in further positions up to the
  guaranteed minimum, so the posting splits by those bytes; what is left free is ``8 k`` bits. There,
  two members within ``k`` bits meet in a value at most ``ceil(k / 2)`` flips from each, so members are
  joined over these values, whose groups have a fixed maximal size.

Copies collapse first: the index holds each distinct fingerprint once, whatever its group's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .common import _q, map_texts
from .components import connected_components

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BLANKS = b" \t\n\r\x0b\x0c"


def _word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The blank-separated words of a text, in lists of about ``size`` bytes."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in _BLANKS:
            end += 1
        yield data[at:end].split()
        at = end


def fingerprint(data: bytes, shingle: int = 3) -> int:
    """SimHash of one UTF-8 text: A-Z lower-cased, ``shingle`` words each, repeats counted."""
    from xxhash import xxh64_intdigest
    ones, n, tail = np.zeros((8, 8), np.int64), 0, []
    for words in _word_blocks(data.lower()):
        words = tail + words
        k = len(words) - shingle + 1
        if k > 0:
            grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if shingle > 1 else words
            h = np.fromiter(map(xxh64_intdigest, grams, repeat(42)), np.uint64, k).view(np.uint8).reshape(k, 8)
            for j in range(8):
                ones[j] += np.bincount(h[:, j], minlength=256) @ _BITS
            n += k
        tail = words[max(0, k):]
    if not n:
        return xxh64_intdigest(b" ".join(tail), 42) if tail else 0
    return int.from_bytes(np.packbits((2 * ones > n).ravel(), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, fp)`` per row and the ``keep`` columns; ``fp`` is the fingerprint as a signed long. A null
    text has no words."""
    def start():
        def fn(texts):
            f = [fingerprint(t.encode(), shingle) if t else 0 for t in texts]
            return {"fp": np.array(f, np.uint64).view(np.int64).tolist()}
        return fn
    out = T.StructType([T.StructField("fp", T.LongType())])
    src = docs.select(_q(id_col).alias("id"), _q(text_col).alias("text"), *[_q(c) for c in keep])
    return map_texts(src, "text", ["id", *keep], out, start)


def _mask(positions) -> int:
    m = sum(0xFF << (8 * p) for p in positions)
    return m - 2**64 if m >= 2**63 else m


def _shared_bytes(x: Column) -> Column:
    """The number of positional bytes two fingerprints share, from their exclusive or."""
    same = [F.when(x.bitwiseAND(F.lit(_mask([p]))) == 0, 1).otherwise(0) for p in range(8)]
    return sum(same[1:], same[0])


def near_pairs(fps: DataFrame, k: int = 2, hot: int = 64) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of the distinct fingerprints ``fps.fp`` with at most ``k``
    differing bits (0 to 6)."""
    if not 0 <= k <= 6:
        raise ValueError("k must be from 0 to 6")
    parts = [list(map(int, p)) for p in np.array_split(np.arange(8), k + 2)]
    postings = [sorted(p + q) for p, q in combinations(parts, 2)]
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("set"), F.col("fp").bitwiseAND(F.lit(_mask(p))).alias("bytes"))
                               for i, p in enumerate(postings)]))
    post = fps.select("fp", rows.alias("p")).select("fp", "p.set", "p.bytes")
    lengths = post.groupBy("set", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    short = (post.join(lengths.where(F.col("n") <= hot), ["set", "bytes"])
             .groupBy("set", "bytes").agg(F.collect_list("fp").alias("fps")))
    x = F.col("a").bitwiseXOR(F.col("b"))
    found = (short.select("fps", F.explode("fps").alias("a")).select("a", F.explode("fps").alias("b"))
             .where("a < b").where(_shared_bytes(x) >= 8 - k).where(F.bit_count(x) <= k).select("a", "b"))
    return found.unionByName(_refined(post.join(lengths.where(F.col("n") > hot), ["set", "bytes"]), postings, k)).distinct()


def _refined(long: DataFrame, postings: list[list[int]], k: int) -> DataFrame:
    need = 8 - k
    finer = []
    for p in postings:
        rest = [q for q in range(8) if q not in p]
        finer.append([sorted(p + list(c)) for c in combinations(rest, max(0, need - len(p)))])
    sets = sorted({tuple(f) for fs in finer for f in fs})
    number = {s: i for i, s in enumerate(sets)}
    made = F.lit(None)
    for i, fs in enumerate(finer):
        made = F.when(F.col("set") == i, F.array(*[
            F.struct(F.lit(number[tuple(f)]).alias("set"), F.col("fp").bitwiseAND(F.lit(_mask(f))).alias("bytes"))
            for f in fs])).otherwise(made)
    fine = long.select("fp", F.explode(made).alias("p")).select("fp", "p.set", "p.bytes").distinct()
    # values at most ceil(k / 2) flips from the fingerprint, within the positions left free
    flips = F.lit(None)
    for s, i in number.items():
        bits = [b for b in range(64) if b // 8 not in s]
        ways = [sum(1 << b for b in c) for r in range((k + 1) // 2 + 1) for c in combinations(bits, r)]
        ways = [w - 2**64 if w >= 2**63 else w for w in ways]
        flips = F.when(F.col("set") == i, F.array(*map(F.lit, ways))).otherwise(flips)
    met = (fine.select("fp", "set", F.explode(flips).alias("flip"))
           .groupBy("set", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")).agg(F.collect_list("fp").alias("fps"))
           .where(F.size("fps") > 1))
    x = F.col("a").bitwiseXOR(F.col("b"))
    return (met.select("fps", F.explode("fps").alias("a")).select("a", F.explode("fps").alias("b"))
            .where("a < b").where(_shared_bytes(x) >= need).where(F.bit_count(x) <= k).select("a", "b"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 2, hot: int = 64) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 lowercase hex digits) and
    ``component_id`` (the smallest id whose fingerprint is reachable over links of at most
    ``max_bits`` bits).

    Null, empty and blank texts have fingerprint zero and link like any other; texts of fewer
    words than ``shingle`` are one shingle. Rows with a null id take part; a component of such
    rows only has a null ``component_id``. Repeated rows give repeated result rows. Texts of any
    length are read whole, in blocks. An empty table gives no rows; other columns are ignored.
    """
    checkpoint_dir(docs.sparkSession)
    each = fingerprints(docs, id_col, text_col, shingle).checkpoint()
    classes = each.groupBy("fp").agg(F.min("id").alias("low")).checkpoint()
    rooted = _rooted(classes, max_bits, hot)
    named = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "root").select(
        "fp", "component_id")
    return each.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rooted(classes: DataFrame, max_bits: int, hot: int) -> DataFrame:
    """``classes`` (a row per distinct ``fp``) with the ``root`` fingerprint of each one's component."""
    roots = connected_components(near_pairs(classes.select("fp"), max_bits, hot))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       max_bits: int = 2, hot: int = 64) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: the one with the smallest id
    (null ids last), on ties the one whose row hash is least; of fully equal rows one."""
    checkpoint_dir(docs.sparkSession)
    row, tail = "__row", ""
    while row + tail in docs.columns or "__id" + tail in docs.columns:
        tail += "_"
    row, ident = row + tail, "__id" + tail
    plain = [c for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    hashed = docs.withColumn(row, F.xxhash64(*[_q(c) for c in plain])).withColumn(ident, _q(id_col))
    each = fingerprints(hashed, id_col, text_col, shingle, (row,)).checkpoint()
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id", row)).alias("first")
    rooted = _rooted(each.groupBy("fp").agg(first).checkpoint(), max_bits, hot)
    chosen = rooted.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.id").alias("i"), F.col(f"first.{row}").alias("r")).checkpoint()
    kept = hashed.join(chosen, _q(ident).eqNullSafe(F.col("i")) & (_q(row) == F.col("r")), "left_semi")
    repeated = each.groupBy("id", row).count().where("count > 1")
    if repeated.join(chosen, F.col("id").eqNullSafe(F.col("i")) & (F.col(row) == F.col("r")), "left_semi").limit(1).count():
        kept = kept.dropDuplicates([ident, row])
    return kept.select(*[_q(c) for c in docs.columns])
