"""Replayable pseudo-random draws: every draw is a pure function of (seed, keys).

Nothing here depends on partitioning, task retries or row order. `digest` is MD5 based and can be
recomputed by any SQL engine, and so can the replicate weights that follow from it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulon.functions.numeric import col

DIGEST_BITS = 60


def _text(seed, keys) -> Column:
    return F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys])


def digest(seed: int | str, *keys: str | Column) -> Column:
    """A 60-bit non-negative integer from the first 15 hex digits of md5('seed|key|...')."""
    return F.conv(F.substring(F.md5(_text(seed, keys)), 1, 15), 16, 10).cast("bigint")


def uniform(seed: int | str, *keys: str | Column) -> Column:
    """A double in [0, 1) from the portable digest."""
    return digest(seed, *keys).cast("double") / F.lit(float(2 ** DIGEST_BITS))


#: Number of draws of a Poisson(1) replicate by its upper 32-bit bounds: a number at or above k bounds draws k or more.
POISSON_BOUNDS = tuple(b for b in (int(2 ** 32 * sum(math.exp(-1.0) / math.factorial(j) for j in range(k + 1))) for k in range(16)) if b < 2 ** 32 - 1)
_STEP, _SPREAD = 2654435769, 73244475


def draw_state(seed: int | str, *keys: str | Column) -> tuple[Column, Column]:
    """Two numbers of a row (32 and 28 bits of its portable digest) from which all its replicate weights follow."""
    d = digest(seed, *keys)
    return d.bitwiseAND(F.lit(2 ** 32 - 1)), F.shiftright(d, 32)


def poisson_weights(a: np.ndarray, b: np.ndarray, first: int, count: int) -> np.ndarray:
    """(rows x count) Poisson(1) weights of the replicates from `first` on: integer arithmetic on 32 bits, which
    `sql_poisson_weight` repeats."""
    replicate = np.arange(first, first + count, dtype=np.uint32)
    x = a.astype(np.uint32)[:, None] + replicate[None, :] * (2 * b + 1).astype(np.uint32)[:, None] + replicate * np.uint32(_STEP)
    for _ in range(2):
        x ^= x >> np.uint32(16)
        x *= np.uint32(_SPREAD)
    x ^= x >> np.uint32(16)
    out = np.zeros(x.shape, np.uint8)
    for bound in POISSON_BOUNDS:
        out += x >= np.uint32(bound)
    return out


def sql_poisson_weights(rows: str, digest: str, b: int, keep: str) -> str:
    """SQL of (keep, replicate, w) for the replicates 1..b of every row of `rows`."""
    out = (f"SELECT {keep}, replicate, ((d & 4294967295) + replicate * (2 * (d >> 32) + 1) + replicate * {_STEP}) & 4294967295 AS x "
           f"FROM (SELECT {keep}, {digest} AS d FROM {rows}), (SELECT unnest(range(1, {b + 1})) AS replicate)")
    for _ in range(2):
        out = f"SELECT {keep}, replicate, (xor(x, x >> 16) * {_SPREAD}) & 4294967295 AS x FROM ({out})"
    weight = " + ".join(f"(x >= {bound})::INT" for bound in POISSON_BOUNDS)
    return f"SELECT {keep}, replicate, {weight} AS w FROM (SELECT {keep}, replicate, xor(x, x >> 16) AS x FROM ({out}))"
