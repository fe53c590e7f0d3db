"""Graph shaping: node sets, degrees, adjacency lists, summaries.

A graph is a pair of DataFrames: ``nodes(keys..., id)`` and ``edges(keys...,
src, dst)``. ``keys`` are optional grouping columns that hold many graphs in one
table (one graph per distinct key value); every operator here works per graph.
Edges are a bag: parallel edges and self-loops are kept unless removed on purpose.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkrank.session import default_partitions


def _k(keys: Sequence[str] | None) -> list[str]:
    return list(keys or ())


def node_set(edges: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct union of edge endpoints: ``(keys..., id)``."""
    k = _k(keys)
    ends = edges.select(*k, F.col("src").alias("id")).unionByName(
        edges.select(*k, F.col("dst").alias("id"))
    )
    return ends.distinct()


def out_degree(
    nodes: DataFrame, edges: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """``(keys..., id, out_degree)``: out-edges per node counting multiplicity, 0 if none."""
    k = _k(keys)
    deg = edges.groupBy(*k, F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))
    return nodes.select(*k, "id").join(deg, [*k, "id"], "left").select(
        *k, "id", F.coalesce("out_degree", F.lit(0)).cast("bigint").alias("out_degree")
    )


def dangling_nodes(
    nodes: DataFrame, edges: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """Nodes without out-edges: ``nodes`` anti-joined with the distinct edge sources.

    Sources are made distinct first (map-side partial aggregation), so a source
    with a huge out-degree is one row, not a hot join key.
    """
    k = _k(keys)
    srcs = edges.select(*k, F.col("src").alias("id")).distinct()
    return nodes.select(*k, "id").join(srcs, [*k, "id"], "left_anti")


def graph_summary(
    nodes: DataFrame, edges: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """One row per graph: node count, edge count (with multiplicity), dangling count."""
    k = _k(keys)
    deg = out_degree(nodes, edges, k)
    grouped = deg.groupBy(*k) if k else deg
    return grouped.agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).cast("bigint").alias("n_edges"),
        F.count_if(F.col("out_degree") == 0).cast("bigint").alias("n_dangling"),
    )


def clean_edges(edges: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct edges without self-loops (the generator's edge rules)."""
    k = _k(keys)
    return edges.filter(F.col("src") != F.col("dst")).select(*k, "src", "dst").distinct()


# Column names of the salted joins and of the cut lists.
_SALT, _KEY = "_salt", "_source"


def frequent_keys(rows: DataFrame, key: Column, share: float) -> list[int]:
    """Values of the BIGINT ``key`` that more than ``share`` of the rows have, and perhaps some below.

    One pass with a mergeable frequent-items sketch of bounded size. Its error is at most
    3.5 / tracked of the rows, and it reports what is certainly above its error, so with
    ``tracked`` of 8 / share nothing above the share is missed. At most 2 / share keys come back.
    """
    most = min(100_000, math.ceil(2 / share))
    tracked = min(1_000_000, max(64, math.ceil(8 / share)))
    found = rows.select(key.alias(_KEY)).agg(F.expr(f"approx_top_k({_KEY}, {most}, {tracked})").alias("top"))
    counts = found.select(F.inline("top")).collect()  # bounded by ``most``
    return [r["item"] for r in counts if r["item"] is not None]


def join_by_source(
    many: DataFrame, sources: DataFrame, keys: Sequence[str] | None = None, seen: DataFrame | None = None
) -> DataFrame:
    """Join rows per edge with the one row per source ``sources(keys..., src, ...)``.

    Sources that hold more rows than a mean partition are found by :func:`frequent_keys` in one pass
    over ``seen`` (rows per edge that ``many`` is derived from; ``many`` itself by default). Their rows are
    dealt to as many salts as there are partitions and their one row is copied to each, so they
    never meet in one task. All other sources have the salt 0. ``many`` and ``sources`` are read once each.
    """
    k = _k(keys)
    width = default_partitions(many.sparkSession)
    key = F.xxhash64(*k, "src")
    hubs = frequent_keys(many if seen is None else seen, key, 1 / width)
    if not hubs:
        return many.join(sources, [*k, "src"])
    hub = key.isin(hubs)
    # Never null, so no filter on it goes down one side only: both sides may share a shuffle below.
    salt = F.when(hub, F.coalesce(F.pmod(F.xxhash64("dst"), F.lit(width)).cast("int"), F.lit(0))).otherwise(0)
    copies = F.when(hub, F.sequence(F.lit(0), F.lit(width - 1))).otherwise(F.array(F.lit(0)))
    dealt = many.withColumn(_SALT, salt)
    return dealt.join(sources.withColumn(_SALT, F.explode(copies)), [*k, "src", _SALT]).drop(_SALT)


def _pairs(edges: DataFrame, k: list[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct edges with multiplicity, and out-degrees summed from the same aggregation."""
    pairs = edges.groupBy(*k, "src", "dst").agg(F.count(F.lit(1)).alias("multiplicity"))
    return pairs, pairs.groupBy(*k, "src").agg(F.sum("multiplicity").alias("_deg"))


def weighted_edges(edges: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """``(keys..., src, dst, multiplicity, weight)`` with ``weight = multiplicity / out_degree``.

    Parallel edges collapse into one row, so later work scales with distinct edges.
    """
    k = _k(keys)
    pairs, deg = _pairs(edges, k)
    return join_by_source(pairs, deg, k, seen=edges).select(
        *k,
        "src",
        "dst",
        F.col("multiplicity").cast("bigint").alias("multiplicity"),
        (F.col("multiplicity") / F.col("_deg")).alias("weight"),
    )


def adjacency_runs(
    edges: DataFrame, keys: Sequence[str] | None = None, max_list: int = 1_000_000, seen: DataFrame | None = None
) -> DataFrame:
    """Run-length adjacency ``(keys..., id, part, out_degree, runs)``, ``runs`` an array of ``(dst, multiplicity)``.

    The out-edges of a node, sorted within hash cells of a fraction of ``max_list``, form one sequence
    that is cut every ``max_list`` edges: ``part`` 0, 1, .... Parallel edges are one run however many
    there are; a run that crosses a cut goes on in the next part. Only cumulated counts are
    computed: cell by cell in parallel, then over the (small) table of cells. Nodes without
    out-edges have no row.
    """
    k = _k(keys)
    pairs, deg = _pairs(edges, k)
    wide = join_by_source(pairs, deg, k, seen=edges if seen is None else seen)
    cells = F.when(F.col("_deg") <= max_list, 1).otherwise(F.ceil(F.col("_deg") / F.lit(max_list)) * 4)
    # Explicit: the layout by source would satisfy the window and keep a hub in one task.
    wide = wide.withColumn("_cell", F.pmod(F.xxhash64("dst"), cells)).repartition(*k, "src", "_cell")
    inside = Window.partitionBy(*k, "src", "_cell").orderBy("dst").rowsBetween(Window.unboundedPreceding, -1)
    wide = wide.withColumn("_at", F.coalesce(F.sum("multiplicity").over(inside), F.lit(0)))
    sizes = wide.groupBy(*k, "src", "_cell").agg(F.sum("multiplicity").alias("_n"))
    before = Window.partitionBy(*k, "src").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    placed = wide.join(sizes.drop("_n"), [*k, "src", "_cell"]).withColumn("_at", F.col("_at") + F.col("_before"))
    # The run holds the places [_at, _end); of each part it touches, it fills what lies in both. Parts are
    # told in two steps, so that no array grows beyond the root of their number.
    size = F.lit(int(max_list)).cast("bigint")
    placed = placed.withColumn("_end", F.col("_at") + F.col("multiplicity"))
    placed = placed.withColumn("_p0", F.expr(f"_at div {int(max_list)}")).withColumn("_p1", F.expr(f"(_end - 1) div {int(max_list)}"))
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("_p1") - F.col("_p0") + 1))).cast("bigint")
    placed = placed.withColumn("_step", step)
    placed = placed.withColumn("_from", F.explode(F.sequence("_p0", "_p1", "_step")))
    last = F.least(F.col("_p1"), F.col("_from") + F.col("_step") - 1)
    placed = placed.withColumn("part", F.explode(F.sequence(F.col("_from"), last)))
    filled = F.least("_end", (F.col("part") + 1) * size) - F.greatest("_at", F.col("part") * size)
    run = F.struct("dst", filled.alias("multiplicity"))
    return (
        placed.select(*k, F.col("src").alias("id"), F.col("part").cast("int").alias("part"), "_deg", run.alias("_run"))
        .groupBy(*k, "id", "part")
        .agg(F.first("_deg").alias("out_degree"), F.sort_array(F.collect_list("_run")).alias("runs"))
        .select(*k, "id", "part", "out_degree", "runs")
    )


def adjacency(
    nodes: DataFrame,
    edges: DataFrame,
    keys: Sequence[str] | None = None,
    max_list: int = 1_000_000,
) -> DataFrame:
    """Adjacency lists ``(keys..., id, part, out_degree, out_neighbors)``.

    Every node appears, with an empty list when it has no out-edges. Neighbor lists are sorted
    and keep parallel edges. A node with more than ``max_list`` out-edges has ``ceil(out_degree /
    max_list)`` rows, ``part`` 0, 1, ..., none longer than ``max_list``. The lists are the runs of
    :func:`adjacency_runs`, written out only here.
    """
    k = _k(keys)
    lists = adjacency_runs(edges, k, max_list)
    written = F.flatten(F.transform("runs", lambda r: F.array_repeat(r["dst"], r["multiplicity"].cast("int"))))
    return (
        nodes.select(*k, "id")
        .join(lists, [*k, "id"], "left")
        .select(
            *k,
            "id",
            F.coalesce("part", F.lit(0)).alias("part"),
            F.coalesce("out_degree", F.lit(0)).cast("bigint").alias("out_degree"),
            F.coalesce(written, F.array().cast("array<bigint>")).alias("out_neighbors"),
        )
    )


def explode_adjacency(adj: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Adjacency rows back to the edge bag ``(keys..., src, dst)``."""
    k = _k(keys)
    return adj.select(*k, F.col("id").alias("src"), F.explode("out_neighbors").alias("dst"))


def check_graph(
    nodes: DataFrame, edges: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """One row per problem kind found: duplicate node ids, unknown sources, unknown targets.

    Columns ``(problem, n)``; an empty result means the graph is consistent.
    """
    k = _k(keys)
    n = nodes.select(*k, "id")
    dups = n.groupBy(*k, "id").count().filter("count > 1")
    srcs = edges.select(*k, F.col("src").alias("id")).distinct().join(n, [*k, "id"], "left_anti")
    dsts = edges.select(*k, F.col("dst").alias("id")).distinct().join(n, [*k, "id"], "left_anti")
    parts = [
        dups.agg(F.count(F.lit(1)).alias("n")).select(F.lit("duplicate node id").alias("problem"), "n"),
        srcs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("unknown source").alias("problem"), "n"),
        dsts.agg(F.count(F.lit(1)).alias("n")).select(F.lit("unknown target").alias("problem"), "n"),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.filter("n > 0")
