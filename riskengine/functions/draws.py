"""Random draws as pure functions of (seed, row key): same value on every run and layout."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(*parts: Column | str | int) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def hash_int(*parts: Column | str | int, digits: int = 8) -> Column:
    """The first `digits` hex digits of the digest as BIGINT (up to 13 stay exact in a double)."""
    return F.conv(F.substring(_digest(*parts), 1, digits), 16, 10).cast("long")


def uniform(*parts: Column | str | int) -> Column:
    """Uniform in (0, 1), never at either end."""
    return (hash_int(*parts).cast("double") + 0.5) / float(2**32)


def normal(mean: float, std: float, *parts: Column | str | int) -> Column:
    """Normal draw by the Box-Muller transform of two uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(*parts, "u1")))
    return F.lit(mean) + F.lit(std) * radius * F.cos(F.lit(2.0 * math.pi) * uniform(*parts, "u2"))
