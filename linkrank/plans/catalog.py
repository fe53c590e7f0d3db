"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the warehouse tables under ``sf_dir`` (``part``, ``lineitem``, ``orders``)
and runs over them whole; its rows depend on theirs. Column names and rounding
match :mod:`linkrank.plans.oracle`. Ranks are reported as ``rank * N``, rounded: a mean
rank is 1 at any scale, and ties within the rounding are broken by id.

Queries keep no state between calls: each derives its graph and ranks it anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.functions.columns import round_to
from linkrank.operators import batch as B
from linkrank.operators import compare as C
from linkrank.operators import generate as G
from linkrank.operators import graph as GR
from linkrank.operators import rank as R
from linkrank.operators import seeding as SE
from linkrank.operators import validate as V
from linkrank.plans import oracle as O
from linkrank.sources import edge_list as EL
from linkrank.sources import graph_json as GJ
from linkrank.sources import seeds as SD
from linkrank.sources import tables as TB
from linkrank.sources import writers as WR
from linkrank.session import Scratch


# ------------------------------------------------------------------ graphs
def _edges(spark, sf_dir) -> DataFrame:
    return TB.parts_graph(spark, sf_dir)[1]


def _rank(spark, sf_dir, personalized: bool = False, **kw) -> R.RankResult:
    nodes, edges = TB.parts_graph(spark, sf_dir)
    seeds = TB.seed_parts(spark, sf_dir) if personalized else None
    return R.pagerank(edges, nodes, seeds=seeds, **kw)


def _scaled(res: R.RankResult) -> DataFrame:
    return B.scaled(res, O.RANK_DIGITS)


def _compare(spark, sf_dir) -> B.Comparison:
    nodes, edges = TB.parts_graph(spark, sf_dir)
    return B.compare_rankings(
        nodes, edges, seeds=TB.seed_parts(spark, sf_dir), k=10, scale_digits=O.RANK_DIGITS
    )


def _compare_batch(spark, sf_dir) -> B.Comparison:
    nodes, edges = TB.batch_graphs(spark, sf_dir)
    return B.compare_rankings(
        nodes, edges, keys=["graph_id"], k=10, n_seeds=5, seed=O.SEED, scale_digits=O.RANK_DIGITS
    )


# ------------------------------------------------------------ G: shaping
def q_node_set(spark, sf_dir):
    return GR.node_set(_edges(spark, sf_dir))


def q_adjacency(spark, sf_dir):
    nodes, edges = TB.parts_graph(spark, sf_dir)
    return GR.adjacency(nodes, edges).select(
        "id", "part", "out_degree", F.array_join("out_neighbors", " ").alias("out_neighbors")
    )


def q_adjacency_split(spark, sf_dir):
    """Lists of at most 16: how the parts of every node are numbered and filled."""
    nodes, edges = TB.parts_graph(spark, sf_dir)
    lists = GR.adjacency(nodes, edges, max_list=16)
    return lists.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_parts"), F.max("part").cast("bigint").alias("last_part"),
        F.max(F.size("out_neighbors")).cast("bigint").alias("longest"),
        F.array_join(F.array_sort(F.flatten(F.collect_list("out_neighbors"))), " ").alias("out_neighbors"),
    )


def q_adjacency_exploded(spark, sf_dir):
    nodes, edges = TB.parts_graph(spark, sf_dir)
    return GR.explode_adjacency(GR.adjacency(nodes, edges))


def q_out_degree(spark, sf_dir):
    return GR.out_degree(*TB.parts_graph(spark, sf_dir))


def q_dangling_nodes(spark, sf_dir):
    return GR.dangling_nodes(*TB.parts_graph(spark, sf_dir))


def q_graph_summary(spark, sf_dir):
    return GR.graph_summary(*TB.parts_graph(spark, sf_dir))


def q_clean_edges(spark, sf_dir):
    return GR.clean_edges(_edges(spark, sf_dir))


def q_weighted_edges(spark, sf_dir):
    wedges = GR.weighted_edges(_edges(spark, sf_dir))
    return wedges.withColumn("weight", round_to("weight", O.WEIGHT_DIGITS))


def q_edge_sample(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    distinct = edges.select("src", "dst").distinct().count()
    return G.edge_sample(edges, distinct // 2, seed=O.SEED)


# ------------------------------------------------------- P / J / A steps
def q_initial_rank(spark, sf_dir):
    return _scaled(_rank(spark, sf_dir, max_iter=0))


def _contributions(spark, sf_dir) -> DataFrame:
    start = _rank(spark, sf_dir, max_iter=0)
    ones = start.ranks.withColumn("rank", F.col("rank") * F.lit(float(start.runs.first()["n_nodes"])))
    return R.contributions(ones, GR.weighted_edges(_edges(spark, sf_dir)))


def q_contributions(spark, sf_dir):
    sent = _contributions(spark, sf_dir)
    return sent.withColumn("contribution", round_to("contribution", O.SMALL_DIGITS))


def q_inflow(spark, sf_dir):
    flows = R.inflow(_contributions(spark, sf_dir))
    return flows.withColumn("inflow", round_to("inflow", O.RANK_DIGITS))


def q_rank_step(spark, sf_dir):
    return _scaled(_rank(spark, sf_dir, max_iter=1))


def q_l1_change(spark, sf_dir):
    log = _rank(spark, sf_dir, max_iter=1).iterations
    return log.select(round_to("l1_diff", O.SMALL_DIGITS).alias("l1_diff"))


def q_dangling_mass(spark, sf_dir):
    nodes, edges = TB.parts_graph(spark, sf_dir)
    dangling = V.dangling_ranks(_rank(spark, sf_dir, max_iter=1).ranks, nodes, edges)
    return dangling.agg(
        round_to(F.coalesce(F.sum("rank"), F.lit(0.0)), O.SMALL_DIGITS).alias("dangling_mass")
    )


# ------------------------------------------------------------ R / T / U
def q_pagerank(spark, sf_dir):
    return _scaled(_rank(spark, sf_dir))


def q_pagerank_fixed5(spark, sf_dir):
    return _scaled(_rank(spark, sf_dir, max_iter=5, epsilon=0.0))


def q_pagerank_width(spark, sf_dir):
    """Three partitions in the loop, or as many as its rows need, and the ranks in the order of their ids."""
    return _scaled(_rank(spark, sf_dir, num_partitions=3)).orderBy("id")


def q_pagerank_top10(spark, sf_dir):
    return C.top_k(_scaled(_rank(spark, sf_dir)), 10).select("id", "rank")


def q_pagerank_positions(spark, sf_dir):
    top = C.top_k(_scaled(_rank(spark, sf_dir)), 10)
    return top.select(F.col("position").cast("bigint").alias("position"), "id", "rank")


def q_iteration_log(spark, sf_dir):
    log = _rank(spark, sf_dir).iterations
    return log.select(
        "iteration",
        round_to("l1_diff", O.LOG_DIGITS).alias("l1_diff"),
        round_to("dangling_mass", O.LOG_DIGITS).alias("dangling_mass"),
    )


def q_rank_summary(spark, sf_dir):
    """The rank sink's row per graph, without its timings."""
    nodes, edges = TB.batch_graphs(spark, sf_dir)
    res = R.pagerank(edges, nodes, keys=["graph_id"])
    res.ranks = _scaled(res)
    rows = WR.rank_summary(res, 10)
    ids = F.array_join(F.transform("top_k", lambda x: x["id"].cast("string")), " ")
    return rows.select("graph_id", ids.alias("top_ids"), "iterations", "converged")


def q_teleport(spark, sf_dir):
    nodes, _ = TB.parts_graph(spark, sf_dir)
    return SE.teleport(nodes, TB.seed_parts(spark, sf_dir))


def q_seed_check(spark, sf_dir):
    return SE.seed_check(TB.seed_parts(spark, sf_dir), GR.node_set(_edges(spark, sf_dir)))


def q_pagerank_personalized(spark, sf_dir):
    return _scaled(_rank(spark, sf_dir, personalized=True))


def q_side_by_side(spark, sf_dir):
    return _compare(spark, sf_dir).pairs.select(
        F.col("position").cast("bigint").alias("position"),
        F.col("left_id").alias("std_id"),
        F.col("left_rank").alias("std_rank"),
        F.col("right_id").alias("ppr_id"),
        F.col("right_rank").alias("ppr_rank"),
    )


def q_topk_jaccard(spark, sf_dir):
    return _compare(spark, sf_dir).overlap


def q_validation(spark, sf_dir):
    nodes, _ = TB.parts_graph(spark, sf_dir)
    report = V.rank_report(_rank(spark, sf_dir).ranks, nodes)
    return report.withColumn("sum_of_ranks", round_to("sum_of_ranks", 6))


def q_dangling_ranks(spark, sf_dir):
    nodes, edges = TB.parts_graph(spark, sf_dir)
    return V.dangling_ranks(_scaled(_rank(spark, sf_dir)), nodes, edges)


def q_batch_ranks(spark, sf_dir):
    return _compare_batch(spark, sf_dir).ranks


def q_batch_many(spark, sf_dir):
    """Up to 150 graphs in one loop."""
    nodes, edges = TB.batch_graphs(spark, sf_dir, many=True)
    return _scaled(R.pagerank(edges, nodes, keys=["graph_id"]))


def q_batch_topk(spark, sf_dir):
    top = _compare_batch(spark, sf_dir).top
    return top.withColumn("position", F.col("position").cast("bigint"))


def q_batch_seeds(spark, sf_dir):
    nodes, _ = TB.batch_graphs(spark, sf_dir)
    return B.sample_seeds(nodes, ["graph_id"], 5, O.SEED)


def q_batch_overlap(spark, sf_dir):
    return _compare_batch(spark, sf_dir).overlap


def q_mean_overlap(spark, sf_dir):
    return _compare_batch(spark, sf_dir).summary


def q_experiment_details(spark, sf_dir):
    """The experiment report's row per graph, its lists as text."""
    rows = B.experiment_details(_compare_batch(spark, sf_dir), ["graph_id"])
    ids = lambda c: F.array_join(F.transform(c, lambda x: x["id"].cast("string")), " ").alias(c)
    return rows.select("graph_id", ids("std_top_k"), ids("ppr_top_k"), "overlap_score")


def q_pagerank_bipartite(spark, sf_dir):
    return _scaled(R.pagerank(TB.bipartite_graph(spark, sf_dir)))


def q_pagerank_hub_split(spark, sf_dir):
    """Three nodes hold half of all edges: they take the hub path at every scale (ten updates)."""
    return _scaled(R.pagerank(TB.flag_graph(spark, sf_dir), max_iter=10, epsilon=0.0))


# ---------------------------------------------------------- S1-S4 / K1
def _edge_lines(spark, sf_dir) -> DataFrame:
    li = TB.table(spark, sf_dir, "lineitem")
    o, p, s = (F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey"))
    n = F.col("l_linenumber")
    line = (
        F.when(n == 1, F.concat(o, F.lit(" "), p))
        .when(n == 2, F.concat(F.lit("  "), o, F.lit("\t"), p, F.lit("  ")))
        .when(n == 3, F.when(F.col("l_partkey") % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("# order "), o)))
        .when(n == 4, F.concat(F.lit("+"), o, F.lit("   -"), s))
        .when(n == 5, F.concat(o, F.lit(" "), p, F.lit(" "), s))
        .when(n == 6, F.concat(o, F.lit(","), p))
        .otherwise(F.concat(F.lit("x"), o, F.lit(" "), p))
    )
    return li.select(line.alias("value"))


def q_edge_list_parse(spark, sf_dir):
    edges, _ = EL.parse_edge_lines(_edge_lines(spark, sf_dir))
    return edges


def q_edge_list_rejects(spark, sf_dir):
    _, rejects = EL.parse_edge_lines(_edge_lines(spark, sf_dir))
    return rejects


def _graph_texts(spark, sf_dir) -> DataFrame:
    """A JSON text per order line: documents (``nodes`` first or not), nodes, and four kinds of bad rows."""
    li = TB.table(spark, sf_dir, "lineitem")
    o, p, s = (F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey"))
    n = F.col("l_linenumber")

    def text(pattern: str, *args) -> Column:
        return F.format_string(pattern, *args)

    value = (
        F.when(n == 1, text('{"nodes": [{"id": %s, "outNeighbors": [%s]}, {"id": %s, "outNeighbors": []}]}', o, p, p))
        .when(n == 2, text('{"meta": 1, "nodes": [{"id": %s, "outNeighbors": [%s, %s]}]}', o, p, s))
        .when(n == 3, text('{"foo": %s}', o))
        .when(n == 4, text('{"id": %s, "outNeighbors": [%s', o, p))
        .when(n == 5, text('{"id": "x%s", "outNeighbors": []}', o))
        .when(n == 6, text('{"id": %s, "outNeighbors": [%s, null]}', o, p))
        .otherwise(text('{"outNeighbors": [%s, %s], "id": %s}', p, s, o))
    )
    return li.select(value.alias("value"))


def q_graph_json_parse(spark, sf_dir):
    return GJ.parse_graph_json(_graph_texts(spark, sf_dir))[1]


def q_graph_json_nodes(spark, sf_dir):
    return GJ.parse_graph_json(_graph_texts(spark, sf_dir))[0]


def q_graph_json_rejects(spark, sf_dir):
    return GJ.parse_graph_json(_graph_texts(spark, sf_dir))[2]


def _seed_texts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Comma strings and lines; line numbers 5 to 7 bring bad entries."""
    li = TB.table(spark, sf_dir, "lineitem")
    n, part = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    last = (
        F.when(n == 5, F.concat(F.lit("+-"), part))
        .when(n == 6, F.concat(part, F.lit("99999999999999999999")))
        .otherwise(F.concat(F.lit(" +"), n.cast("string")))
    )
    strings = li.select(F.concat_ws(",", part, "l_suppkey", last).alias("value"))
    order = F.col("l_orderkey").cast("string")
    line = F.when(n == 2, F.lit("   ")).when(n == 7, F.concat(order, F.lit(" 1"))).otherwise(F.concat(F.lit("  "), order))
    return strings, li.select(line.alias("value"))


def q_seed_parse(spark, sf_dir):
    strings, lines = _seed_texts(spark, sf_dir)
    return SD.parse_seed_string(strings)[0].unionByName(SD.parse_seed_lines(lines)[0]).distinct()


def q_seed_rejects(spark, sf_dir):
    strings, lines = _seed_texts(spark, sf_dir)
    return SD.parse_seed_string(strings)[1].unionByName(SD.parse_seed_lines(lines)[1])


def q_graph_json_rows(spark, sf_dir):
    nodes, edges = TB.parts_graph(spark, sf_dir)
    return GJ.graph_json_rows(nodes, edges).select("id", F.col("part").cast("bigint").alias("part"), "json")


def q_graph_document(spark, sf_dir):
    """The graph written as one JSON document of ordered parts and read again in splits: edges with multiplicity."""
    nodes, edges = TB.parts_graph(spark, sf_dir)
    scratch = Scratch(spark)
    GJ.write_graph_document(nodes, edges, scratch.path("graph.json"))
    back, again = GJ.read_graph_document(spark, scratch.path("graph.json"))
    pairs = again.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("multiplicity"))
    alone = GR.dangling_nodes(back, again).select(F.col("id").alias("src"))
    empty = alone.select("src", F.lit(None).cast("bigint").alias("dst"), F.lit(0).cast("bigint").alias("multiplicity"))
    result = pairs.unionByName(empty).checkpoint()
    scratch.release()
    return result


def q_adjacency_runs(spark, sf_dir):
    """Run-length lists of at most 16 edges: sums over the parts of each node."""
    runs = GR.adjacency_runs(_edges(spark, sf_dir), max_list=16)
    filled = F.aggregate("runs", F.lit(0).cast("bigint"), lambda a, r: a + r["multiplicity"])
    return runs.select("id", "out_degree", filled.alias("filled"), F.inline("runs")).groupBy("id", "dst").agg(
        F.first("out_degree").alias("out_degree"), F.sum("multiplicity").alias("multiplicity"), F.max("filled").alias("most")
    ).select("id", "dst", "out_degree", "multiplicity", (F.col("most") <= 16).alias("bounded"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_")
}
