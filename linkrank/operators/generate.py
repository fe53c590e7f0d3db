"""Deterministic random directed graphs and edge samples, as Spark jobs.

A graph on ``n`` nodes has ``m = n(n-1)`` possible edges without self-loops.

* sparse (``e <= m/2``): draw ``(src, dst)`` from hashes of ``i = 0, 1, 2, ...`` and keep the
  first ``e`` distinct pairs, i.e. the ``e`` pairs whose first draw is earliest;
* dense (``e > m/2``): order all ``m`` pairs by a hash of their number and keep the first ``e``.

``dst`` is drawn among ``n - 1`` values and moved up by one from ``src`` on, so a self-loop
cannot occur. Both branches end in an exact "``e`` smallest keys" cut that never gathers
``e`` rows in one task: a sketch guesses the range that holds the cut, its keys are counted per
piece, whole pieces below the cut are kept, and only the piece holding it is ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkrank.functions.columns import hash_order
from linkrank.session import ensure_checkpoint_dir

# Default generator seed, bits of a hash key; value ranges per counting pass, quantiles of the
# sketch, rows that are ordered at the cut.
DEFAULT_SEED = 42
HASH_BITS = 60
_BUCKETS = 1 << 14
_GRID = 500
_ORDERED = 1_000_000


def smallest(
    df: DataFrame,
    key: str,
    n: int,
    lo: int,
    hi: int,
    tie: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` rows with the smallest ``(key, *tie)``; ``key`` is a BIGINT in ``[lo, hi]``.

    ``df`` is written once and then passed over three times as a rule: a quantile sketch guesses a narrow
    range that holds the cut, one exact count of that range in ``_BUCKETS`` pieces (and of all below it)
    finds the piece, and the last pass takes what is below the piece and orders the piece alone. A guess
    that misses, or a piece of more than ``_ORDERED`` rows, costs a further count; the result is exact.
    """
    if n <= 0:
        return df.limit(0)
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint()
    least, most = lo, hi
    guess = _around(df, key, n)
    if guess is None:
        return df
    lo, hi = max(lo, guess[0]), min(hi, guess[1])
    k = F.col(key)
    while True:
        width = max(1, -(-(hi - lo + 1) // _BUCKETS))
        # Integer division: the bounds must agree exactly with the filters.
        bucket = F.when(k < F.lit(lo), F.lit(-1)).otherwise(F.expr(f"(`{key}` - {int(lo)}) div {int(width)}"))
        counts = df.filter(k <= F.lit(hi)).groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("c")).collect()
        taken, at = 0, None
        for b, c in sorted((r["b"], r["c"]) for r in counts):
            if taken + c >= n:
                at = b
                break
            taken += c
        if at is None:  # the cut is above the range
            if hi >= most:
                return df
            lo, hi = hi + 1, most
            continue
        if at < 0:  # the cut is below the range
            lo, hi = least, lo - 1
            continue
        lo, hi = lo + at * width, min(hi, lo + (at + 1) * width - 1)
        if taken + c == n:
            return df.filter(k <= F.lit(hi))
        if c <= _ORDERED or lo == hi:
            inside = df.filter((k >= F.lit(lo)) & (k <= F.lit(hi))).orderBy(key, *tie)
            return df.filter(k < F.lit(lo)).unionByName(inside.limit(n - taken))


def _around(df: DataFrame, key: str, n: int) -> tuple[int, int] | None:
    """Two keys that the ``n``-th smallest very likely lies between, None if there are no more than ``n`` rows."""
    grid = ", ".join(str(i / _GRID) for i in range(_GRID + 1))
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"percentile_approx(`{key}`, array({grid}), {_GRID * 20})").alias("q")
    ).first()
    if row["n"] <= n:
        return None
    at = n * _GRID // row["n"]
    return row["q"][max(0, at - 1)], row["q"][min(_GRID, at + 2)]


def _draws(i: str, seed, n: int) -> list:
    """``src`` and ``dst`` of draw ``i``, from two independent hashes."""
    src = F.pmod(hash_order(i, F.lit("src"), seed=seed), F.lit(n))
    dst = F.pmod(hash_order(i, F.lit("dst"), seed=seed), F.lit(n - 1))
    return [src.alias("src"), (dst + F.when(dst >= src, 1).otherwise(0)).alias("dst")]


def _numbered(pairs: DataFrame, n: int, index: str, *keep: str) -> DataFrame:
    """Pair number ``k`` in ``[0, n(n-1))`` to ``(src, dst)``."""
    src = F.expr(f"`{index}` div {int(n - 1)}")
    dst = F.pmod(F.col(index), F.lit(n - 1))
    moved = (dst + F.when(dst >= src, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
    return pairs.select(*keep, src.alias("src"), moved.alias("dst"))


def _checked(n: int, e: int) -> tuple[int, int]:
    if n <= 0:
        raise ValueError(f"number of nodes must be positive, got {n}")
    if e < 0:
        raise ValueError(f"number of edges must not be negative, got {e}")
    if n >= 1 << HASH_BITS:
        raise ValueError(f"number of nodes must be below 2^{HASH_BITS}, got {n}")
    m = n * (n - 1)
    if min(e, m) > m // 2 and m >= 1 << HASH_BITS:
        raise ValueError("a dense graph of this size has more pairs than the generator numbers")
    return m, min(e, m)


def random_graph(
    spark: SparkSession, n: int, e: int, seed: int = DEFAULT_SEED
) -> tuple[DataFrame, DataFrame]:
    """``(nodes(id), edges(src, dst))``: ``min(e, n(n-1))`` distinct non-loop edges on ids ``0..n-1``.

    Isolated nodes are kept in ``nodes``.
    """
    m, e = _checked(n, e)
    nodes = spark.range(n).select(F.col("id"))
    if e == 0:
        return nodes, spark.range(0).select(F.col("id").alias("src"), F.col("id").alias("dst"))
    if e <= m // 2:
        count = e + e // 4 + 64
        while True:
            draws = spark.range(count).select(F.col("id").alias("i"), *_draws("id", seed, n))
            firsts = draws.groupBy("src", "dst").agg(F.min("i").alias("first"))
            if firsts.count() >= e:
                return nodes, smallest(firsts, "first", e, 0, count - 1).select("src", "dst")
            count *= 2
    pairs = spark.range(m).select(F.col("id").alias("k"), hash_order("id", seed=seed).alias("h"))
    return nodes, _numbered(smallest(pairs, "h", e, 0, (1 << HASH_BITS) - 1, tie=["k"]), n, "k")


def random_graphs(
    spark: SparkSession, count: int, n: int, e: int, first_seed: int = DEFAULT_SEED
) -> tuple[DataFrame, DataFrame]:
    """``count`` graphs as :func:`random_graph` makes them, keyed by ``graph_id`` 0..count-1, in one job.

    Graph ``i`` has seed ``first_seed + i``. The cut is a window per graph, so this is meant for
    many graphs of moderate size; make a large one with :func:`random_graph`.
    """
    m, e = _checked(n, e)
    graph = F.expr(f"id div {n}").alias("graph_id")
    nodes = spark.range(count * n).select(graph, F.pmod("id", F.lit(n)).alias("id"))
    seed = F.col("graph_id") + F.lit(first_seed)
    draws = m if e > m // 2 else 2 * e + 64
    while True:
        rows = spark.range(count * draws).select(
            F.expr(f"id div {draws}").alias("graph_id"), F.pmod("id", F.lit(draws)).alias("i")
        )
        if e > m // 2:
            pairs = _numbered(rows.withColumn("first", hash_order("i", seed=seed)), n, "i", "graph_id", "first", "i")
        else:
            pairs = rows.select("graph_id", "i", *_draws("i", seed, n))
            pairs = pairs.groupBy("graph_id", "src", "dst").agg(F.min("i").alias("i")).withColumn("first", F.col("i"))
        turn = F.row_number().over(Window.partitionBy("graph_id").orderBy("first", "i"))
        edges = pairs.withColumn("turn", turn).filter(F.col("turn") <= e).select("graph_id", "src", "dst")
        if e > m // 2 or edges.count() == count * e:
            return nodes, edges
        draws *= 2


def edge_sample(edges: DataFrame, e: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """``e`` distinct edges chosen by hash order of ``(src, dst)``: a deterministic random subset."""
    if e < 0:
        raise ValueError(f"sample size must not be negative, got {e}")
    distinct = edges.select("src", "dst").distinct()
    keyed = distinct.withColumn("_h", hash_order("src", "dst", seed=seed))
    return smallest(keyed, "_h", e, 0, (1 << HASH_BITS) - 1, tie=["src", "dst"]).select("src", "dst")
