"""Small column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_order(*parts, seed: int | Column) -> Column:
    """Deterministic 60-bit pseudo-random key of ``concat(parts..., ':', seed)``.

    The first 15 hex digits of the MD5 digest, read as a non-negative BIGINT. Any
    SQL engine with ``md5`` reproduces it, which is what makes generated graphs
    and sampled seeds checkable against an independent engine.
    """
    tail = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    text = F.concat_ws(":", *[F.col(p) if isinstance(p, str) else p for p in parts], tail)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def ratio_or_zero(num: Column, den: Column) -> Column:
    """``num / den`` as DOUBLE, 0.0 when ``den`` is 0 (empty Jaccard union)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing whitespace of every kind (``trim`` only drops spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def round_to(c: Column | str, digits: int) -> Column:
    """``floor(x * 10^digits + 0.5) / 10^digits``: half-up rounding done in binary arithmetic.

    Unlike ``round`` (which rounds the decimal form of the double) this is the same
    IEEE computation in any engine, so values on a rounding tie agree exactly.
    """
    scale = float(10**digits)
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
