"""Standard against personalized ranking, for one graph or many graphs in one job.

Every graph is ranked twice in one loop over one edge table, then the two top-k lists
of each graph are compared by position and by Jaccard overlap.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkrank.functions.columns import hash_order
from linkrank.operators.compare import jaccard, mean_overlap, side_by_side, top_k
from linkrank.operators.generate import random_graphs
from linkrank.operators.rank import PERSONALIZED, STANDARD, RankResult, pagerank_both

# Defaults of the experiment.
SEEDS_PER_GRAPH = 5
TOP_K = 10
SAMPLE_SEED = 42


def sample_seeds(
    nodes: DataFrame, keys: Sequence[str] = (), k: int = SEEDS_PER_GRAPH, seed: int = SAMPLE_SEED
) -> DataFrame:
    """``min(k, N)`` node ids per graph, chosen by hash order of ``(id, seed)``: ``(keys..., id)``."""
    keys = list(keys)
    h = hash_order("id", seed=seed)
    if not keys:
        return nodes.select("id").orderBy(h, "id").limit(k)
    w = Window.partitionBy(*keys).orderBy(h, F.col("id"))
    return (
        nodes.select(*keys, "id")
        .withColumn("_r", F.row_number().over(w))
        .filter(F.col("_r") <= k)
        .select(*keys, "id")
    )


@dataclass
class Comparison:
    """``ranks``/``top``: per ``(keys..., mode)``; ``pairs``: lists side by side;
    ``overlap``: Jaccard per graph; ``summary``: mean overlap and graph count."""

    result: RankResult
    seeds: DataFrame
    ranks: DataFrame
    top: DataFrame
    pairs: DataFrame
    overlap: DataFrame
    summary: DataFrame


def compare_rankings(
    nodes: DataFrame,
    edges: DataFrame,
    keys: Sequence[str] = (),
    seeds: DataFrame | None = None,
    k: int = TOP_K,
    n_seeds: int = SEEDS_PER_GRAPH,
    seed: int = SAMPLE_SEED,
    scale_digits: int | None = None,
    **rank_options,
) -> Comparison:
    """Rank each graph with uniform and with seeded teleport, then compare the top-k lists.

    ``seeds(keys..., id)`` defaults to :func:`sample_seeds` over ``nodes``.
    ``scale_digits`` replaces a rank by ``rank * N`` rounded to so many decimals, which
    is comparable between engines at any graph size.
    """
    keys = list(keys)
    if seeds is None:
        seeds = sample_seeds(nodes, keys, n_seeds, seed)
    res = pagerank_both(edges, nodes, seeds.select(*keys, "id"), keys, **rank_options)
    ranks = res.ranks if scale_digits is None else scaled(res, scale_digits)
    top = top_k(ranks, k, res.keys)
    std = top.filter(F.col("mode") == STANDARD).drop("mode")
    ppr = top.filter(F.col("mode") == PERSONALIZED).drop("mode")
    overlap = jaccard(std, ppr, keys)
    return Comparison(
        result=res,
        seeds=seeds,
        ranks=ranks,
        top=top,
        pairs=side_by_side(std, ppr, keys),
        overlap=overlap,
        summary=mean_overlap(overlap),
    )


def scaled(result: RankResult, digits: int) -> DataFrame:
    """``(keys..., id, rank)`` with ``rank * N`` rounded to ``digits`` decimals: a mean rank is 1 at any size."""
    from linkrank.functions.columns import round_to

    if not result.keys:
        n = result.runs.first()["n_nodes"]
        return result.ranks.withColumn("rank", round_to(F.col("rank") * F.lit(float(n)), digits))
    sizes = result.runs.select(*result.keys, "n_nodes")
    return result.ranks.join(sizes, result.keys).select(
        *result.keys, "id", round_to(F.col("rank") * F.col("n_nodes").cast("double"), digits).alias("rank")
    )


def experiment_details(cmp: Comparison, keys: Sequence[str]) -> DataFrame:
    """One row per graph: ``keys..., std_top_k, ppr_top_k, overlap_score``.

    The top-k lists hold ``k`` entries. The seeds are a table of their own,
    ``cmp.seeds``, as their number is not bounded.
    """
    keys = list(keys)
    on = keys or ["_one"]

    def lists(mode: str, name: str) -> DataFrame:
        top = cmp.top.filter(F.col("mode") == mode)
        top = top if keys else top.withColumn("_one", F.lit(1))
        return top.groupBy(*on).agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("position", "id", "rank"))),
                lambda s: F.struct(s["id"].alias("id"), s["rank"].alias("rank")),
            ).alias(name)
        )

    overlap = cmp.overlap if keys else cmp.overlap.withColumn("_one", F.lit(1))
    out = lists(STANDARD, "std_top_k").join(lists(PERSONALIZED, "ppr_top_k"), on, "full").join(overlap, on, "full")
    return out.select(*keys, "std_top_k", "ppr_top_k", F.col("overlap").alias("overlap_score"))


def run_experiment(
    spark,
    num_graphs: int = 10,
    n: int = 1000,
    e: int = 5000,
    k: int = TOP_K,
    n_seeds: int = SEEDS_PER_GRAPH,
    first_seed: int = SAMPLE_SEED,
    **rank_options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Standard against personalized ranking on ``num_graphs`` generated graphs, in one batched loop.

    Returns ``(details, summary, seeds)``; write them with
    :func:`linkrank.sources.writers.write_experiment`.
    """
    if num_graphs <= 0:
        raise ValueError(f"num_graphs must be positive, got {num_graphs}")
    nodes, edges = random_graphs(spark, num_graphs, n, e, first_seed)
    cmp = compare_rankings(
        nodes, edges, keys=["graph_id"], k=k, n_seeds=n_seeds, seed=first_seed, **rank_options
    )
    return experiment_details(cmp, ["graph_id"]), cmp.summary, cmp.seeds
