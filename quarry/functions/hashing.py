"""Seeded, deterministic pseudo-random numbers from stable keys.

Results must be reproducible and checkable by SQL, so randomness is a hash of the row's stable key and a seed: the
first 52 bits of the MD5 of ``seed:key:key...`` as text.  Any SQL engine evaluates it identically, and it has no linear
structure: consecutive keys or seeds give unrelated numbers.
"""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hashes lie in [0, RANGE).
RANGE = 1 << 52


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _digits(*keys, seed: int) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(_c(k).cast("string"), F.lit("")) for k in keys])
    return F.substring(F.md5(text), 1, 13)


def mix_hash(*keys, seed: int = 0) -> Column:
    """Integer hash in [0, 2**52) of the given keys and a seed; null keys count as empty text."""
    return F.conv(_digits(*keys, seed=seed), 16, 10).cast("long")


def uniform01(*keys, seed: int = 0) -> Column:
    """Pseudo-uniform double in [0, 1) from the keys and a seed."""
    return mix_hash(*keys, seed=seed) / F.lit(float(RANGE))


def uniform_below(limit: float, *keys, seed: int = 0) -> Column:
    """``uniform01(*keys, seed=seed) < limit`` without the number: hex digits of one length are ordered as what they stand for."""
    bound = math.ceil(min(max(limit, 0.0), 1.0) * RANGE)
    if bound in (0, RANGE):
        return F.lit(bound > 0)
    return _digits(*keys, seed=seed) < F.lit(f"{bound:013x}")


def mix_hash_sql(*keys: str, seed: int = 0) -> str:
    """The same hash as SQL text (for the oracle)."""
    text = " || ':' || ".join([f"'{seed}'", *(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)])
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


def uniform01_sql(*keys: str, seed: int = 0) -> str:
    return f"({mix_hash_sql(*keys, seed=seed)} / {float(RANGE)})"
