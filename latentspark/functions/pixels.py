"""Column expressions on packed 32-bit pixels (lowest byte = red).

All are JVM built-ins (bit operations, ``greatest``/``least``); packing uses
OR, so no intermediate sum can overflow under ANSI arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def channel(px, i: int) -> Column:
    """Channel ``i`` (0 red, 1 green, 2 blue, 3 alpha)."""
    return F.shiftright(_c(px), 8 * i).bitwiseAND(F.lit(255))


def red(px) -> Column:
    return channel(px, 0)


def green(px) -> Column:
    return channel(px, 1)


def blue(px) -> Column:
    return channel(px, 2)


def alpha(px) -> Column:
    return channel(px, 3)


def rgba(r, g, b, a=255) -> Column:
    """Pack channels; alpha defaults to 255.  Result is a signed INT."""
    a = F.lit(a) if isinstance(a, int) else _c(a)
    return (_c(r).cast("int").bitwiseOR(F.shiftleft(_c(g).cast("int"), 8))
            .bitwiseOR(F.shiftleft(_c(b).cast("int"), 16)).bitwiseOR(F.shiftleft(a.cast("int"), 24)))


def max3(a, b, c) -> Column:
    """Three-way maximum (all three arguments considered, Q4)."""
    return F.greatest(_c(a), _c(b), _c(c))


def min3(a, b, c) -> Column:
    return F.least(_c(a), _c(b), _c(c))


def stretch(px) -> Column:
    """Map each channel to ``int(255·(c − min)/(max − min))``, alpha 255.

    A grey pixel (max = min) is returned unchanged, alpha included (Q5).
    """
    r, g, b = red(px), green(px), blue(px)
    hi, lo = max3(r, g, b), min3(r, g, b)
    diff = (hi - lo).cast("double")

    def s(c):
        return ((F.lit(255) * (c - lo)).cast("double") / diff).cast("int")

    return F.when(hi == lo, _c(px)).otherwise(rgba(s(r), s(g), s(b)))


def to_unit(px) -> Column:
    """Red, green, blue as doubles in [0, 1]."""
    return F.array(*[channel(px, i).cast("double") / F.lit(255.0) for i in range(3)])


def from_unit(v) -> Column:
    """Back from [0, 1] (truncating ×255), alpha 255."""
    return rgba(*[(_c(v).getItem(i) * F.lit(255.0)).cast("int") for i in range(3)])
