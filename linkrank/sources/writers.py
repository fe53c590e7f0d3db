"""Result sinks: rank summaries, full rank vectors and experiment reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.operators.compare import top_k
from linkrank.operators.rank import RankResult

# Fixed value: timings are written rounded to 4 decimal places.
TIME_DIGITS = 4


def rank_summary(result: RankResult, k: int = 10) -> DataFrame:
    """One row per graph: ``keys..., top_k array<struct<id, rank>>, iterations, total_time,
    converged, iteration_times, mean_iteration_time``.

    ``total_time`` is that of the whole run, setup included, and ``mean_iteration_time`` its share
    per iteration, NULL when no iteration ran. The lists are at most ``k`` and
    ``max_iter`` long, so gathering them into one row is bounded.
    """
    on = result.keys or ["_one"]

    def keyed(df: DataFrame) -> DataFrame:
        return df if result.keys else df.withColumn("_one", F.lit(1))

    best = keyed(top_k(result.ranks, k, result.keys)).groupBy(*on).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("position", "id", "rank"))),
            lambda s: F.struct(s["id"].alias("id"), s["rank"].alias("rank")),
        ).alias("top_k")
    )
    times = keyed(result.iterations).groupBy(*on).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("iteration", "seconds"))),
            lambda s: F.round(s["seconds"], TIME_DIGITS),
        ).alias("iteration_times")
    )
    total = F.lit(round(result.total_seconds, TIME_DIGITS))
    return (
        keyed(result.runs)
        .join(best, on, "left")
        .join(times, on, "left")
        .select(
            *result.keys,
            F.coalesce("top_k", F.array()).alias("top_k"),
            "iterations",
            total.alias("total_time"),
            "converged",
            F.coalesce("iteration_times", F.array()).alias("iteration_times"),
            F.round(total / F.when(F.col("iterations") > 0, F.col("iterations")), TIME_DIGITS).alias("mean_iteration_time"),
        )
    )


def write_rank_result(result: RankResult, path: str, k: int = 10, mode: str = "error") -> None:
    """``path/summary`` (one JSON row per graph) and ``path/ranks`` (the whole vectors, Parquet)."""
    rank_summary(result, k).write.mode(mode).json(f"{path}/summary")
    result.ranks.write.mode(mode).parquet(f"{path}/ranks")


def write_experiment(
    details: DataFrame, summary: DataFrame, seeds: DataFrame, path: str, mode: str = "error"
) -> None:
    """Experiment report: ``path/details`` (a JSON row per graph), ``path/summary``, ``path/seeds`` (a row per seed)."""
    details.write.mode(mode).json(f"{path}/details")
    summary.coalesce(1).write.mode(mode).json(f"{path}/summary")
    seeds.write.mode(mode).json(f"{path}/seeds")
