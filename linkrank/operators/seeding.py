"""Seed sets: teleport probabilities and membership checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def teleport(nodes: DataFrame, seeds: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Teleport probability per node: ``(keys..., id, teleport)``.

    ``1/|S|`` on the seeds that are nodes and 0 elsewhere; ``1/N`` for every node
    when a graph has no valid seed (or ``seeds`` is None).
    """
    k = list(keys)
    n = nodes.select(*k, "id")
    if seeds is None:
        flagged = n.withColumn("is_seed", F.lit(False))
    else:
        valid = (
            seeds.select(*k, "id")
            .distinct()
            .join(n, [*k, "id"], "left_semi")
            .withColumn("is_seed", F.lit(True))
        )
        flagged = n.join(valid, [*k, "id"], "left").withColumn(
            "is_seed", F.coalesce("is_seed", F.lit(False))
        )
    counts = (flagged.groupBy(*k) if k else flagged).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("is_seed").alias("_s")
    )
    on = k
    if not k:
        # One graph: a constant key instead of a cross join with the one-row counts.
        on = ["_one"]
        flagged, counts = flagged.withColumn("_one", F.lit(1)), counts.withColumn("_one", F.lit(1))
    # One row per graph.
    joined = flagged.join(F.broadcast(counts), on)
    t = F.when(F.col("_s") == 0, F.lit(1.0) / F.col("_n")).otherwise(
        F.when(F.col("is_seed"), F.lit(1.0) / F.col("_s")).otherwise(F.lit(0.0))
    )
    return joined.select(*k, "id", t.alias("teleport"))


def seed_check(candidates: DataFrame, nodes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Which candidate seeds are nodes: ``(keys..., id, known)``.

    The known ones come from a semi join, the unknown ones (which a personalized
    run ignores) from an anti join.
    """
    k = list(keys)
    c = candidates.select(*k, "id").distinct()
    n = nodes.select(*k, "id")
    known = c.join(n, [*k, "id"], "left_semi").withColumn("known", F.lit(True))
    unknown = c.join(n, [*k, "id"], "left_anti").withColumn("known", F.lit(False))
    return known.unionByName(unknown)


def all_known(candidates: DataFrame, nodes: DataFrame, keys: Sequence[str] = ()) -> bool:
    """Subset test: every candidate seed is a node."""
    k = list(keys)
    return candidates.select(*k, "id").join(nodes.select(*k, "id"), [*k, "id"], "left_anti").isEmpty()
