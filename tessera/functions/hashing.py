"""Deterministic hashing: arm assignment, sample order keys, seeded noise (SC9, SMP4, RB1).

All values are pure functions of (seed, row id): partition-independent, identical on
recomputation after an executor loss, and reproducible in SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import id_text

TWO_32 = 4294967296  # 2^32


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_piece(h: Column, i: int) -> Column:
    """The i-th 32-bit piece (0..3) of a hex md5 digest, as a non-negative bigint."""
    return F.conv(F.substr(h, F.lit(1 + 8 * i), F.lit(8)), 16, 10).cast("bigint")


def md5_mod(c: str | Column, n: int) -> Column:
    """SC9: ``int(md5(str(id)), 16) % n`` for the 128-bit digest, by Horner's rule over four
    32-bit pieces so every intermediate stays below ``n * 2^32`` (exact in 64-bit for n < 2^31).
    NULL ids hash as the text ``nan``."""
    if not 0 < n < 2 ** 31:
        raise ValueError("n must be in 1 .. 2^31-1")
    h = F.md5(id_text(_c(c)))
    r = md5_piece(h, 0) % n
    for i in (1, 2, 3):
        r = (r * F.lit(TWO_32) + md5_piece(h, i)) % n
    return r.cast("int")


def hash_key(seed: int | str, c: str | Column) -> Column:
    """Order key of a seeded shuffle: md5 of ``seed:id`` (hex text, totally ordered)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_text(_c(c))))


def uniform_open(seed: int | str, tag: str, c: str | Column) -> tuple[Column, Column]:
    """Two independent uniforms from one md5: u1 in (0, 1], u2 in [0, 1)."""
    h = F.md5(F.concat(F.lit(f"{seed}|{tag}|"), id_text(_c(c))))
    u1 = (md5_piece(h, 0) + F.lit(1)).cast("double") / F.lit(float(TWO_32 + 1))
    u2 = md5_piece(h, 1).cast("double") / F.lit(float(TWO_32))
    return u1, u2


def gaussian(seed: int | str, tag: str, c: str | Column) -> Column:
    """Standard normal deviate by Box-Muller from the row id (seeded, partition-independent)."""
    u1, u2 = uniform_open(seed, tag, c)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
