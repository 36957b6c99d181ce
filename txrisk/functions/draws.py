"""Reproducible uniform draws: a function of the row's key, never of its partition."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def congruential_draw(key: Column, factor: int, step: int, modulus: int) -> Column:
    """``(key * factor + step) mod modulus``, scaled to [0, 1).

    The key is reduced first, which leaves the result as it is and keeps the product inside a bigint
    for any key (as long as ``factor * modulus`` is).
    """
    reduced = F.pmod(key, F.lit(modulus))
    return F.pmod(reduced * F.lit(factor) + F.lit(step), F.lit(modulus)) / F.lit(float(modulus))


def key_draw(key: Column, seed: int) -> Column:
    """Draw for a key of any type: the upper 53 bits of its 64-bit hash, scaled to [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(2**53))
