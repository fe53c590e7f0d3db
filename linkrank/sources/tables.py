"""Graphs built from the warehouse tables (``part``, ``lineitem``, ``orders``), whole and row by row.

* parts graph: nodes are all parts; every order line gives one edge between its part and
  the part with its supplier's number. The edge points away from the part on odd lines,
  towards it on even lines and always for parts divisible by 3, so these are dangling
  (unless they share a supplier's number). It has parallel edges and self-loops.
* batch graphs: the same edges, one graph per return flag, or per flag and order number
  modulo 50 (many small graphs).
* bipartite graph: customer -> supplier of every ordered line, customers on even and
  suppliers on odd ids; every supplier is dangling.
* flag graph: every return flag is a node with edges to and from all its parts: three
  hubs whatever the scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.operators.graph import node_set


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, *keys: Column) -> DataFrame:
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    inward = (part % 3 == 0) | (F.col("l_linenumber") % 2 == 0)
    return (
        table(spark, sf_dir, "lineitem")
        .filter(part.isNotNull() & supplier.isNotNull())
        .select(
            *keys,
            F.when(inward, supplier).otherwise(part).alias("src"),
            F.when(inward, part).otherwise(supplier).alias("dst"),
        )
    )


def parts_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(nodes(id), edges(src, dst))`` of the parts graph."""
    nodes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return nodes, _lines(spark, sf_dir)


def batch_graphs(spark: SparkSession, sf_dir: str, many: bool = False) -> tuple[DataFrame, DataFrame]:
    """``nodes(graph_id, id)``, ``edges(graph_id, src, dst)``; nodes are the endpoints of the edges."""
    graph = F.col("l_returnflag")
    if many:
        graph = F.concat_ws("-", graph, (F.col("l_orderkey") % 50).cast("string"))
    edges = _lines(spark, sf_dir, graph.alias("graph_id"))
    return node_set(edges, ["graph_id"]), edges


def bipartite_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customer -> supplier edges; the nodes are their endpoints."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return (
        items.join(orders, items.l_orderkey == orders.o_orderkey)
        .select((F.col("o_custkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst"))
        .filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .distinct()
    )


def flag_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between the return flags (negative ids) and the parts returned under them, both ways."""
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_partkey").isNotNull() & F.col("l_returnflag").isNotNull())
    flag = -F.ascii("l_returnflag").cast("bigint")
    there = lines.select(flag.alias("src"), F.col("l_partkey").alias("dst"))
    return there.unionByName(lines.select(F.col("l_partkey").alias("src"), flag.alias("dst")))


def seed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed candidates of the personalized queries: parts with key below 5."""
    return table(spark, sf_dir, "part").filter(F.col("p_partkey") < 5).select(
        F.col("p_partkey").alias("id")
    )
