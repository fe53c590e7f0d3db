"""Vector columns: which rows hold a usable vector, and fixed random rotations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def usable(col: str) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    finite = F.forall(
        col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(finite & F.exists(col, lambda x: x != 0), F.lit(False))


def vectors(df: DataFrame, id_col: str, col: str) -> tuple[DataFrame, int]:
    """``(id, v)`` with one row per id, and the dimension.

    Rows without a usable vector or id are left out, and so are vectors of another
    length than the commonest. Of rows with the same id the least vector counts.
    """
    good = df.filter(usable(col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(col).alias("v")
    )
    common = (
        good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    )
    dim = common[0] if common else 0
    return good.filter(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v")), dim


def precision(df: DataFrame, col: str = "v") -> str:
    """NumPy type that holds the column's numbers without loss."""
    return "f4" if isinstance(df.schema[col].dataType.elementType, T.FloatType) else "f8"


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision scaled to length 1, also where squares would overflow."""
    x = rows.astype("f8")
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
