"""Column expressions over fixed-length ``ARRAY<DOUBLE>`` feature vectors.

Every function returns a Column and stays inside whole-stage codegen.  When
the rank is known on the driver the expressions are unrolled
(``f[0]*g[0] + f[1]*g[1] + ...``): a fixed summation order that DuckDB
reproduces bit for bit, and no lambda evaluation per element.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(f, g, k: int | None = None) -> Column:
    """V1 dot product.  Unrolled when ``k`` is given, else ``aggregate(zip_with)``."""
    f, g = _c(f), _c(g)
    if k is None:
        return F.aggregate(F.zip_with(f, g, lambda p, q: p * q), F.lit(0.0), lambda s, x: s + x)
    out = f.getItem(0) * g.getItem(0)
    for j in range(1, k):
        out = out + f.getItem(j) * g.getItem(j)
    return out


def sq_norm(f, k: int | None = None) -> Column:
    """A9 squared norm of one vector."""
    return dot(f, f, k)


def vec_sub(f, g) -> Column:
    """V3 elementwise difference."""
    return F.zip_with(_c(f), _c(g), lambda p, q: p - q)


def vec_mul(f, g) -> Column:
    """V3 elementwise product."""
    return F.zip_with(_c(f), _c(g), lambda p, q: p * q)


def vec_scale(f, c) -> Column:
    """V4 multiply every component by ``c`` (divide by a normaliser: ``1/N``)."""
    c = c if isinstance(c, Column) else F.lit(float(c))
    return F.transform(_c(f), lambda p: p * c)


def zeros(k: int) -> Column:
    """V8 zero vector of length ``k``."""
    return F.array_repeat(F.lit(0.0), k)


def unit_uniform(*keys) -> Column:
    """Uniform in (0, 1) from a 64-bit hash of ``keys``; independent of partitioning."""
    h = F.xxhash64(*keys)
    # 53 random bits → (0,1): (bits + 0.5) / 2^53
    bits = F.shiftright(h, 11).bitwiseAND(F.lit((1 << 53) - 1))
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def gaussian(id_col, j: int, seed: int, stddev: float = 1.0) -> Column:
    """V7 N(0, stddev²) by Box–Muller over two hashed uniforms of (id, j, seed)."""
    u1 = unit_uniform(_c(id_col), F.lit(j), F.lit(seed), F.lit(1))
    u2 = unit_uniform(_c(id_col), F.lit(j), F.lit(seed), F.lit(2))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2) * F.lit(float(stddev))


def gaussian_vector(id_col, k: int, seed: int, stddev: float = 1.0) -> Column:
    return F.array(*[gaussian(id_col, j, seed, stddev) for j in range(k)])
