"""Spark-native link analysis: random-surfer ranking of directed graphs held in DataFrames."""

from linkrank.operators.batch import compare_rankings, sample_seeds
from linkrank.operators.compare import jaccard, mean_overlap, side_by_side, top_k
from linkrank.operators.generate import edge_sample, random_graph
from linkrank.operators.graph import (
    adjacency,
    clean_edges,
    dangling_nodes,
    graph_summary,
    node_set,
    out_degree,
    weighted_edges,
)
from linkrank.operators.rank import RankResult, pagerank
from linkrank.operators.seeding import seed_check, teleport
from linkrank.operators.validate import dangling_ranks, rank_report

__all__ = [
    "RankResult",
    "adjacency",
    "clean_edges",
    "compare_rankings",
    "dangling_nodes",
    "dangling_ranks",
    "edge_sample",
    "graph_summary",
    "jaccard",
    "mean_overlap",
    "node_set",
    "out_degree",
    "pagerank",
    "random_graph",
    "rank_report",
    "sample_seeds",
    "seed_check",
    "side_by_side",
    "teleport",
    "top_k",
    "weighted_edges",
]
