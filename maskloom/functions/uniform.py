"""Deterministic pseudo-random columns.

Every random choice in the library is a function of (seed, stream, row key), so a re-run task, a
lost executor or another partitioning gives the same rows. The numbers are reproducible by anyone
who knows the seed: where secrecy matters the seed must be secret.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int, stream: str, *keys: Column | str) -> Column:
    """Double in [0, 1): the first 32 bits of md5(``seed|stream|key...``)."""
    parts = [F.lit(str(seed)), F.lit(stream)]
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    head = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def exponential(seed: int, stream: str, *keys: Column | str) -> Column:
    """Exp(1) variate."""
    return -F.log(F.lit(1.0) - uniform(seed, stream, *keys))


def laplace(scale: float, seed: int, stream: str, *keys: Column | str) -> Column:
    """Laplace(0, scale) as the difference of two exponentials."""
    first = exponential(seed, f"{stream}+", *keys)
    second = exponential(seed, f"{stream}-", *keys)
    return (first - second) * F.lit(float(scale))


def fine(seed: int, stream: str, *keys: Column | str) -> Column:
    """Double in [0, 1) with all of its 53 bits drawn, from the first 56 bits of the same md5."""
    parts = [F.lit(str(seed)), F.lit(stream)]
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    text = F.md5(F.concat_ws("|", *parts))
    high = F.conv(F.substring(text, 1, 8), 16, 10).cast("long")
    low = F.shiftright(F.conv(F.substring(text, 9, 6), 16, 10).cast("long"), 3)
    return (high * F.lit(1 << 21) + low).cast("double") / F.lit(float(1 << 53))


def discrete_laplace(scale: float, grid: float, seed: int, stream: str, *keys: Column | str) -> Column:
    """Two-sided geometric noise on the multiples of ``grid``: falls by e^(-grid / scale) from one to the next.

    The whole part of an exponential number is geometric, so no rounding of a sum of doubles shows through;
    draws of 53 bits reach 36 scales.
    """
    def steps(sign: str) -> Column:
        return F.floor(-F.log(F.lit(1.0) - fine(seed, f"{stream}{sign}", *keys)) * F.lit(scale / grid))

    return (steps("+") - steps("-")).cast("double") * F.lit(float(grid))
