"""Checks of a rank vector: non-negative, sums to 1, one rank for each node and for no other id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.operators.graph import dangling_nodes

# Fixed value: tolerance of the sum check.
SUM_TOLERANCE = 1e-4


def _fingerprint(prefix: str) -> list[Column]:
    """Sum and exclusive or of the ids' hashes: equal for equal bags of ids, whatever their order."""
    h = F.xxhash64("id")
    return [F.sum(h.cast("decimal(20,0)")).alias(f"{prefix}_sum"), F.bit_xor(h).alias(f"{prefix}_xor")]


def rank_report(
    ranks: DataFrame,
    nodes: DataFrame,
    keys: Sequence[str] = (),
    tolerance: float = SUM_TOLERANCE,
) -> DataFrame:
    """One row per graph with every check, computed in a single aggregation pass.

    ``(keys..., rank_count, node_count, negative_count, all_non_negative,
    sum_of_ranks, sum_valid, count_matches, ids_match, all_checks_passed)``. The sum test is
    strict: ``|sum - 1| < tolerance``. ``ids_match`` compares order-independent fingerprints of both
    bags of ids, so one id twice and another one absent fails although the counts agree.
    """
    keys = list(keys)
    r = ranks.groupBy(*keys) if keys else ranks
    checks = r.agg(
        F.count(F.lit(1)).alias("rank_count"),
        F.count_if(F.col("rank") < 0).alias("negative_count"),
        F.sum("rank").alias("sum_of_ranks"),
        *_fingerprint("_r"),
    )
    n = nodes.groupBy(*keys) if keys else nodes
    counts = n.agg(F.count(F.lit(1)).alias("node_count"), *_fingerprint("_n"))
    if not keys:
        # Two one-row aggregates; join them on a constant key.
        keys_join = ["_one"]
        checks, counts = checks.withColumn("_one", F.lit(1)), counts.withColumn("_one", F.lit(1))
    else:
        keys_join = keys
    joined = checks.join(counts, keys_join, "full")
    return joined.select(
        *keys,
        F.coalesce("rank_count", F.lit(0)).alias("rank_count"),
        F.coalesce("node_count", F.lit(0)).alias("node_count"),
        F.coalesce("negative_count", F.lit(0)).alias("negative_count"),
        (F.coalesce("negative_count", F.lit(0)) == 0).alias("all_non_negative"),
        F.col("sum_of_ranks"),
        (F.abs(F.col("sum_of_ranks") - 1.0) < tolerance).alias("sum_valid"),
        (F.coalesce("rank_count", F.lit(0)) == F.coalesce("node_count", F.lit(0))).alias("count_matches"),
        (F.col("_r_sum").eqNullSafe(F.col("_n_sum")) & F.col("_r_xor").eqNullSafe(F.col("_n_xor"))).alias("ids_match"),
    ).withColumn(
        "all_checks_passed",
        F.col("all_non_negative") & F.coalesce(F.col("sum_valid"), F.lit(False)) & F.col("count_matches") & F.col("ids_match"),
    )


def dangling_ranks(
    ranks: DataFrame, nodes: DataFrame, edges: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Ranks of nodes without out-edges (semi join of ranks with the dangling set)."""
    keys = list(keys)
    return ranks.join(dangling_nodes(nodes, edges, keys), [*keys, "id"], "left_semi")
