"""PageRank and personalized PageRank as a DataFrame loop.

Update rule, for every node ``v`` of a graph with ``N`` nodes::

    new(v) = T(v) * ((1 - d) + d * D) + d * sum_{u -> v} old(u) * m(u, v) / outdeg(u)

``D`` is the rank held by nodes without out-edges, ``m`` the multiplicity of the
edge (parallel edges count), ``T`` the teleport distribution: ``1/N`` for every
node, or ``1/|S|`` on the seed set ``S`` and 0 elsewhere. The start vector is
``1/N`` in both cases. The loop stops after the first update whose L1 change is
strictly below ``epsilon``, or after ``max_iter`` updates.

One loop ranks any number of graphs (``keys``) and, for a comparison, several
vectors per graph over one edge table (one teleport column and one rank column
each).

Physical layout:

* nodes are dealt to as many blocks as the loop has partitions. A graph takes a range of blocks as wide as
  its share of all rows, and its nodes are spread over that range by hash, so a small graph
  lies in one or two blocks. Every table of the loop is hashed by block.
* an edge lies with the end that has more distinct edges at its other side: with the block of its target if
  the source has more out-edges than the target has in-edges ("pull"), else with its source ("push").
  Pulled, a rank is sent once to every block that has targets of it (``routes``). Pushed, the terms of a
  target are added up in the source's block and sent once. So a node sends or receives at most one row per
  block, and no node has more than the root of all edges on its own side, hubs included.
* ``prop``, written once as Parquet, holds the node rows and the edges; the loop holds the edges cached
  (memory, then disk) and hashed by block; what an executor loses is dealt out again from the files. No
  table is entered in a catalog.
* the state ``(block, keys, id, rank, teleport, dangling)`` comes out of an update hashed by block, so all its joins are
  partition-local, and node rows never travel. The one exchange carries the pushed sums and the pulled ranks.
  The state is written to the shared folder and read again every ``checkpoint_interval`` iterations, and at
  least every third: that cuts the plan and bounds recomputation after an executor loss.
* the width is ``num_partitions``, by default the cluster's cores and ``spark.sql.shuffle.partitions`` at most; where a
  partition would hold more than ``MOST_ROWS`` rows or ``MOST_NODES`` nodes (or ``MOST_NODES_APART``, where
  graphs are many), it is raised. Few wide partitions send less: a node's row per block.
* the numbers of a single graph (dangling mass, L1 change) are observed while its new
  vector is cached, so an iteration is one job. With ``keys`` they are a table with a
  row per graph, written every iteration as the log and joined by key; the driver
  sees only how many graphs are still running. The join is a broadcast up to
  ``MAX_BROADCAST_GRAPHS`` rows; beyond, a shuffle join that deals large graphs to salts.
* a vector that has ended in every graph takes no part in further updates: nothing is sent or added up for it.
* sums over edges and nodes are fixed-point (:func:`exact_sum`), so ranks, log and number of
  iterations are the same bit by bit whatever the width and the order of arrival.

With ``run_dir`` a run leaves what it needs to go on: its inputs, and at every checkpoint
the vectors and a manifest. The same call after the loss of the driver goes on from the last
manifest.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from linkrank.session import (
    Scratch,
    default_partitions,
    delete_path,
    ensure_checkpoint_dir,
    local_table,
    loop_settings,
    names_in,
    put_text,
)

# Defaults of the algorithm.
DAMPING = 0.85
MAX_ITER = 100
EPSILON = 1e-6
CHECKPOINT_INTERVAL = 3
# Up to this many graphs the table with a row per graph is broadcast (a few MB).
MAX_BROADCAST_GRAPHS = 50_000
# Rows (nodes and distinct edges) that a partition of the loop holds at most, in the mean. Edges are
# sorted once and then streamed, so their bound is wide: every further block has ranks sent to it in every update.
MOST_ROWS = 12_000_000
# Nodes among them: their ranks are in a hash table.
MOST_NODES = 4_000_000
# Nodes in a partition where graphs are many: a graph lies in few blocks then, so narrow ones send hardly more.
MOST_NODES_APART, BLOCKS_APART = 250_000, 4
# An update's plan refers to the state twice, so it is cut after so many updates at the latest.
MOST_UNCUT = 3
# Key column of a run without keys.
SINGLE = "_graph"
SALT, SALTS = "_salt", "_salts"
STANDARD = "standard"
PERSONALIZED = "personalized"
# Bits after the point of a fixed-point sum, and further bits for what is left of each term.
HIGH_BITS, LOW_BITS = 60, 24


def wide_enough(asked: int, n_nodes: int, n_pairs: int, n_graphs: int = 1) -> int:
    """The loop's width: ``asked``, or more where its partitions would hold too many rows.

    The tables of a partition's ranks cannot spill, and with many graphs most rows may be nodes. Up to
    ``BLOCKS_APART`` blocks a graph the width follows ``MOST_NODES_APART``.
    """
    apart = min(BLOCKS_APART * n_graphs, -(-n_nodes // MOST_NODES_APART))
    return max(asked, -(-(n_nodes + n_pairs) // MOST_ROWS), -(-n_nodes // MOST_NODES), apart)


def exact_terms(value: Column) -> tuple[Column, Column]:
    """The whole numbers that :func:`exact_sum` adds up for a double."""
    scaled = value * F.lit(2.0**HIGH_BITS)
    high = scaled.cast("bigint")
    return high, ((scaled - high) * F.lit(2.0**LOW_BITS)).cast("bigint")


def exact_total(high: Column, low: Column) -> Column:
    """The double of two sums of :func:`exact_terms`."""
    return high * F.lit(2.0**-HIGH_BITS) + low * F.lit(2.0 ** -(HIGH_BITS + LOW_BITS))


def exact_sum(value: Column) -> Column:
    """Sum of doubles that is the same in any order: whole numbers are added, in two parts.

    Totals stay below 8 and terms below 2**39 (sums of ranks are at most 2); beyond that the sum
    is an overflow error in ANSI mode. Each term is exact to 2**-84.
    """
    high, low = exact_terms(value)
    return exact_total(F.sum(high), F.sum(low))


@dataclass
class RankResult:
    """Outcome of a ranking.

    ``ranks``: ``(keys..., id, rank)`` for every node. ``iterations``: ``(keys...,
    iteration, l1_diff, dangling_mass, seconds)``, where ``dangling_mass`` is the
    mass of the vector the update started from. ``runs``: ``(keys..., n_nodes,
    iterations, converged)``. ``keys`` names the key columns (``mode`` is the last
    one where several vectors were ranked). ``unknown_seeds`` counts seeds that are
    not nodes, which are ignored. The tables live in the checkpoint folder until
    :meth:`release`.
    """

    ranks: DataFrame
    iterations: DataFrame
    runs: DataFrame
    keys: list[str]
    n_iterations: int
    converged: bool
    total_seconds: float
    unknown_seeds: int = 0
    phase_seconds: dict = field(default_factory=dict)
    store: Scratch | None = field(default=None, repr=False)

    def release(self) -> None:
        """Delete the result's tables."""
        if self.store is not None:
            self.store.release()


def pagerank(
    edges: DataFrame,
    nodes: DataFrame | None = None,
    seeds: DataFrame | None = None,
    keys: Sequence[str] = (),
    damping: float = DAMPING,
    max_iter: int = MAX_ITER,
    epsilon: float = EPSILON,
    checkpoint_interval: int = CHECKPOINT_INTERVAL,
    num_partitions: int | None = None,
    hub_threshold: int = 0,
    validate: bool = True,
    run_dir: str | None = None,
) -> RankResult:
    """Rank every node of one graph, or of many graphs keyed by ``keys``.

    ``edges(keys..., src, dst)``; ``nodes(keys..., id)`` defaults to the edge
    endpoints and is needed for isolated nodes. ``seeds(keys..., id)`` turns a
    graph personalized: seeds that are not nodes are ignored and counted, and a
    graph whose seeds are all unknown (or an empty seed table for a single graph)
    is an error. With ``keys``, a graph without seed rows is ranked with uniform
    teleport. NULL endpoints, NULL or repeated node ids and, with ``validate``,
    edges whose endpoints are not nodes are errors.

    ``num_partitions`` is the loop's width (by default the number of cores, and
    ``spark.sql.shuffle.partitions`` at most); it is raised where a partition would hold more than
    ``MOST_ROWS`` rows or ``MOST_NODES`` nodes. Sources of at most ``hub_threshold`` distinct out-edges always push.
    ``checkpoint_interval`` counts up to ``MOST_UNCUT`` updates.

    ``run_dir`` names a folder, in a store that all machines share, for one run that can be
    resumed: if an earlier call with the same arguments left it unfinished, this one goes on
    from its last checkpoint and does not read ``edges``, ``nodes`` and ``seeds`` again (the folder
    stands for them); if it ended, its result is returned. Other arguments are an error. The
    folder stays until ``release()``.
    """
    return _rank(
        edges, nodes, seeds, keys, {None: seeds is not None}, damping, max_iter, epsilon,
        checkpoint_interval, num_partitions, hub_threshold, validate, run_dir,
    )


def pagerank_both(
    edges: DataFrame,
    nodes: DataFrame | None,
    seeds: DataFrame,
    keys: Sequence[str] = (),
    damping: float = DAMPING,
    max_iter: int = MAX_ITER,
    epsilon: float = EPSILON,
    checkpoint_interval: int = CHECKPOINT_INTERVAL,
    num_partitions: int | None = None,
    hub_threshold: int = 0,
    validate: bool = True,
    run_dir: str | None = None,
) -> RankResult:
    """Standard and personalized ranks over one edge table; results have a key column ``mode``."""
    return _rank(
        edges, nodes, seeds, keys, {STANDARD: False, PERSONALIZED: True}, damping, max_iter, epsilon,
        checkpoint_interval, num_partitions, hub_threshold, validate, run_dir,
    )


def _rank(
    edges, nodes, seeds, keys, vectors, damping, max_iter, epsilon, interval, num_partitions, hub_threshold, validate, run_dir
) -> RankResult:
    if not 0.0 <= damping <= 1.0:
        raise ValueError(f"damping must be in [0, 1], got {damping}")
    if max_iter < 0:
        raise ValueError(f"max_iter must be >= 0, got {max_iter}")
    if epsilon < 0:
        raise ValueError(f"epsilon must be >= 0, got {epsilon}")
    if interval < 1:
        raise ValueError(f"checkpoint_interval must be >= 1, got {interval}")
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    width = num_partitions or max(1, min(default_partitions(spark), spark.sparkContext.defaultParallelism))
    loop = _Loop(
        edges, nodes, seeds, list(keys), vectors, float(damping), int(max_iter), float(epsilon), int(interval),
        width, int(hub_threshold or 0), validate, run_dir,
    )
    # A width that was not asked for follows from the cores there are, which may be others when a run goes on.
    loop.argument_width = num_partitions
    ended = False
    try:
        at = loop.found()
        if at is None:
            # Adaptive execution stays on while the input is derived.
            loop.setup()
        with loop_settings(spark, loop.width):
            result = loop.run(at)
        ended = True
        return result
    except BaseException:
        if run_dir is None:
            loop.result.release()
        raise
    finally:
        loop.clean_up(keep=not ended and run_dir is not None)


class _Loop:
    def __init__(self, edges, nodes, seeds, keys, vectors, d, max_iter, eps, interval, width, hub_threshold, validate, run_dir=None):
        self.spark = edges.sparkSession
        self.given, self.k = keys, keys or [SINGLE]
        self.names, self.personalized = list(vectors), list(vectors.values())
        self.m = range(len(self.names))
        self.d, self.max_iter, self.eps, self.interval = d, max_iter, eps, interval
        self.asked, self.width, self.hub_threshold = width, width, hub_threshold
        self.argument_width: int | None = width
        self.validate = validate and nodes is not None
        self.edges = self._keyed(edges, "src", "dst")
        self.nodes = None if nodes is None else self._keyed(nodes, "id")
        self.seeds = None if seeds is None else self._keyed(seeds, "id").distinct()
        self.run_dir = run_dir and f"{run_dir.rstrip('/')}/linkrank-run"
        self.scratch, self.result = Scratch(self.spark), Scratch(self.spark, self.run_dir)
        # What the loop reads; it outlives a run that stops, if that can be resumed.
        self.inputs = Scratch(self.spark, self.run_dir and f"{self.run_dir}/loop")
        self.saved: list[str] = []
        self.cached: list[DataFrame] = []
        # The vectors that some graph still updates; the others stay as they are.
        self.active = tuple(self.m)
        self.columns: dict[tuple, dict[str, list]] = {}
        self.rows: list[dict] = []  # the log of a single graph, a row per iteration
        self.phases: dict[str, float] = {}
        self.started = self._clock = time.time()

    def _keyed(self, df: DataFrame, *ids: str) -> DataFrame:
        single = [] if self.given else [F.lit(0).alias(SINGLE)]
        return df.select(*single, *self.given, *[F.col(c).cast("bigint").alias(c) for c in ids])

    def _lap(self, name: str) -> None:
        now = time.time()
        self.phases[name] = round(self.phases.get(name, 0.0) + now - self._clock, 4)
        self._clock = now

    def _with_numbers(self, rows: DataFrame, numbers: DataFrame) -> DataFrame:
        """``rows(keys..., id, ...)`` joined with the one row of their graph.

        Few graphs are broadcast. Beyond that it is a shuffle join in which a graph of more nodes than a
        mean partition is dealt to salts, and its row is copied to each of them. There are fewer such
        graphs than partitions, so their list is small however many graphs there are, and the copies
        add at most two rows per partition.
        """
        k = self.k
        if not self.given or self.n_graphs <= MAX_BROADCAST_GRAPHS:
            return rows.join(F.broadcast(numbers), k)
        large = F.broadcast(
            self.graphs.filter(F.col("n") > self.share).select(*k, F.ceil(F.col("n") / self.share).cast("int").alias(SALTS))
        )
        salts = F.coalesce(SALTS, F.lit(1))
        dealt = rows.join(large, k, "left").withColumn(SALT, F.pmod(F.xxhash64("id"), salts).cast("int")).drop(SALTS)
        copies = numbers.join(large, k, "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), salts - 1))).drop(SALTS)
        return dealt.join(copies, [*k, SALT]).drop(SALT)

    # ----------------------------------------------------------------- setup
    def setup(self) -> None:
        """Distinct edges, then one row per id from a single aggregation over all its roles."""
        k = self.k
        pairs = self.scratch.store(
            self.edges.groupBy(*k, "src", "dst").agg(F.count(F.lit(1)).alias("mult"))
        )
        roles = self._roles(pairs)
        if self.given:
            info = self.scratch.store(roles)
            per_graph = info.groupBy(*k).agg(*self._counts())
            per_graph.write.parquet(self.result.path("graphs"))
            self.graphs = self.spark.read.schema(per_graph.schema).parquet(self.result.path("graphs"))
            sums = [F.sum(c).alias(c) for c in self.graphs.columns if c not in (*k, "max_fanout", "max_fanin")]
            total = self.graphs.agg(
                F.count(F.lit(1)).alias("graphs"), F.min("n").alias("least"), F.max("max_fanout").alias("max_fanout"),
                F.max("max_fanin").alias("max_fanin"), F.count_if((F.col("wanted") > 0) & (F.col("n_seeds") == 0)).alias("lost"), *sums,
            ).first().asDict()
            total["nodes"] = total["n"]
        else:
            # A single graph's numbers are observed while its nodes are written.
            seen = Observation(f"linkrank_{uuid.uuid4().hex}")
            info = self.scratch.store(roles.observe(seen, *self._counts()))
            total = {c: v or 0 for c, v in seen.get.items()}
            self.single = {SINGLE: 0} | total
            self.graphs = local_table(self.spark, [self.single])
            lost = total["wanted"] > 0 and total["n_seeds"] == 0
            total |= {"graphs": 1, "least": total["n"], "nodes": total["n"], "lost": int(lost)}
        self._check({c: v or 0 for c, v in total.items()})
        self.n_graphs, self.unknown_seeds = total["graphs"], total["wanted"] - total["n_seeds"]
        self.n_rows = total["nodes"] + total["n_pairs"]
        self.width = wide_enough(self.asked, total["nodes"], total["n_pairs"], self.n_graphs)
        # More nodes than a mean partition: fewer graphs than there are partitions.
        self.share = max(1, -(-total["nodes"] // self.width))
        self._lap("setup_stats")
        self._build(pairs, info, total)
        self._lap("setup")

    @staticmethod
    def _counts() -> list[Column]:
        """What is counted per graph over its rows of :meth:`_roles`."""
        is_node, has_out, null_id = F.col("copies") > 0, F.col("outdeg") > 0, F.col("id").isNull()
        return [
            F.count_if(is_node).alias("n"),
            F.count_if(is_node & ~has_out).alias("n_dangling"),
            F.count_if(is_node & F.col("is_seed")).alias("n_seeds"),
            F.count_if(F.col("is_seed")).alias("wanted"),
            F.sum("fanout").alias("n_pairs"),
            F.max("fanout").alias("max_fanout"),
            F.max("fanin").alias("max_fanin"),
            F.count_if(~is_node & has_out).alias("unknown"),
            F.count_if(~is_node & F.col("is_end")).alias("unknown_ends"),
            F.count_if(F.col("copies") > 1).alias("repeated"),
            F.count_if(is_node & null_id).alias("null_ids"),
            F.count_if(null_id & (has_out | F.col("is_end"))).alias("null_ends"),
        ]

    def _roles(self, pairs: DataFrame) -> DataFrame:
        """``(keys..., id, copies, outdeg, fanout, fanin, is_end, is_seed)`` for every id in any role.

        The node rows, both ends of the distinct edges and the seeds are one stream of rows with a
        column per role, so counting, degrees and all checks of unknown ids need one shuffle and no join.
        """
        k, zero, no = self.k, F.lit(0).cast("bigint"), F.lit(False)

        def role(df: DataFrame, id_: str, copies=zero, outdeg=zero, fanout=zero, fanin=zero, end=no, seed=no) -> DataFrame:
            return df.select(
                *k, F.col(id_).alias("id"), copies.alias("copies"), outdeg.alias("outdeg"),
                fanout.alias("fanout"), fanin.alias("fanin"), end.alias("is_end"), seed.alias("is_seed"),
            )

        one = F.lit(1).cast("bigint")
        rows = role(pairs, "src", outdeg=F.col("mult"), fanout=one).unionByName(
            role(pairs, "dst", fanin=one, end=F.lit(True))
        )
        if self.nodes is not None:
            rows = rows.unionByName(role(self.nodes, "id", copies=one))
        if self.seeds is not None:
            rows = rows.unionByName(role(self.seeds, "id", seed=F.lit(True)))
        info = rows.groupBy(*k, "id").agg(
            *[F.sum(c).alias(c) for c in ("copies", "outdeg", "fanout", "fanin")], *[F.max(c).alias(c) for c in ("is_end", "is_seed")]
        )
        if self.nodes is None:  # the nodes are the ends of the edges
            known = F.col("is_end") | (F.col("outdeg") > 0)
            info = info.withColumn("copies", F.when(known, one).otherwise(zero))
        return info

    def _check(self, total) -> None:
        if total["null_ends"]:
            raise ValueError("edges have NULL endpoints")
        if total["unknown"] and self.validate:
            raise ValueError("edges start at ids that are not in the node table")
        if not total["graphs"] or not total["least"]:
            raise ValueError("graph has no nodes")
        if total["null_ids"]:
            raise ValueError("node table has NULL ids")
        if total["repeated"]:
            raise ValueError("node table has duplicate ids")
        if total["unknown_ends"] and self.validate:
            raise ValueError("edges end at ids that are not in the node table")
        if self.seeds is not None and not self.given and not total["wanted"]:
            raise ValueError("seed set is empty")
        if total["lost"]:
            raise ValueError("none of the seeds of a graph is a node")

    def _places(self) -> DataFrame:
        """Per graph ``n``, ``n_seeds`` and its range of blocks: where it starts in [0, 1), and its share of all rows."""
        k, rows = self.k, F.col("n") + F.coalesce("n_pairs", F.lit(0))
        if not self.given:
            start = F.lit(0.0)
        elif self.n_graphs <= MAX_BROADCAST_GRAPHS:
            before = Window.orderBy(*k).rowsBetween(Window.unboundedPreceding, -1)
            start = F.coalesce(F.sum(rows).over(before), F.lit(0)) / F.lit(float(self.n_rows))
        else:
            start = F.pmod(F.xxhash64(*k), F.lit(1 << 20)) / F.lit(float(1 << 20))
        return self.graphs.select(*k, "n", "n_seeds", start.alias("start"), (rows / F.lit(float(self.n_rows))).alias("span"))

    def _labels(self) -> list[int]:
        """A number per partition that Spark's hash deals to it, so that blocks and partitions are the same."""
        numbers = self.spark.range(40 * self.width).select(F.col("id").cast("int").alias("label"))
        found = numbers.groupBy(F.pmod(F.hash("label"), F.lit(self.width)).alias("at")).agg(F.min("label").alias("label"))
        labels = dict(found.collect())  # one row per partition
        return [labels.get(i, i) for i in range(self.width)]

    def _by_end(self, rows: DataFrame, ends: DataFrame, on: str, degree: str, most: int) -> DataFrame:
        """``rows`` joined with the one row of their end; ends of more edges than a mean partition are broadcast."""
        bound, on = max(1, math.ceil(self.n_rows / self.width)), [*self.k, on]
        if most <= bound:
            return rows.join(ends, on)
        often = F.col(degree) > bound  # fewer than there are partitions
        hubs = F.broadcast(ends.filter(often))
        others = rows.join(hubs.select(*on), on, "left_anti").join(ends.filter(~often), on)
        return rows.join(hubs, on).unionByName(others)

    def _build(self, pairs: DataFrame, info: DataFrame, total: dict) -> None:
        k, places, width = self.k, self._places(), self.width
        labels = F.array(*map(F.lit, self._labels()))

        def block(id_: str) -> Column:
            spread = F.pmod(F.xxhash64(id_), F.lit(1 << 20)) / F.lit(float(1 << 20))
            place = F.pmod(F.col("start") + spread * F.col("span"), F.lit(1.0))
            return F.element_at(labels, F.least(F.floor(place * width).cast("int"), F.lit(width - 1)) + 1)

        nodes = info.filter(F.col("copies") > 0)
        # Blocks are told after the joins: what they follow from is in the row already, so it need not be sent.
        edges = pairs.withColumnRenamed("src", "id")
        edges = self._by_end(edges, nodes.select(*k, "id", "outdeg", "fanout"), "id", "fanout", total["max_fanout"])
        targets = info.filter(F.col("fanin") > 0).select(*k, F.col("id").alias("dst"), "fanin")
        edges = self._by_end(edges, targets, "dst", "fanin", total["max_fanin"])
        pull = (F.col("fanout") > F.col("fanin")) & (F.col("fanout") > self.hub_threshold)
        edge_rows = self._with_numbers(edges, places).select(
            *k, "id", "dst", (F.col("mult") / F.col("outdeg")).alias("w"), block("id").alias("block"), block("dst").alias("dst_block"),
            F.when(pull, "pull").otherwise("push").alias("way"),
        )
        uniform = F.lit(1.0) / F.col("n")
        seeded = F.when(F.col("n_seeds") == 0, uniform).when(F.col("is_seed"), F.lit(1.0) / F.col("n_seeds"))
        node_rows = self._with_numbers(nodes, places).select(
            *k, "id", F.col("id").alias("dst"), F.lit(0.0).alias("w"), block("id").alias("block"), F.lit("node").alias("way"),
            *[(seeded.otherwise(0.0) if p else uniform).alias(f"t{i}") for i, p in enumerate(self.personalized)],
            uniform.alias("r0"), (F.col("outdeg") == 0).alias("dangling"),
        )
        seen = Observation(f"linkrank_{uuid.uuid4().hex}")
        rows = node_rows.unionByName(edge_rows, allowMissingColumns=True)
        rows.observe(seen, F.count_if(F.col("way") == "pull").alias("pull")).write.parquet(self.inputs.path("prop"))
        self.has_hubs = seen.get["pull"] > 0
        self._hold(self.spark.read.schema(rows.schema).parquet(self.inputs.path("prop")))
        self.scratch.release()

    def _hold(self, rows: DataFrame) -> None:
        """Keep the edges cached and hashed by block, so their joins with the state need no exchange.

        Written once and read back, they depend on the given tables no more.
        """
        k, way = self.k, F.col("way")
        self.prop = rows.filter(way != "pull").withColumn("node_row", way == "node")
        self.prop_hub = rows.filter(way == "pull")
        with loop_settings(self.spark, self.width):
            links = self.prop.filter(~F.col("node_row")).select("block", *k, "id", "dst_block", "dst", "w")
            if self.has_hubs:
                pull = self.prop_hub.select("dst_block", *k, F.col("id").alias("src"), "block", F.col("dst").alias("target"), F.col("w"))
                held = self._cached(pull, "dst_block", "target")
                # Where a rank is wanted, told by the blocks of its targets.
                routes = held.select("dst_block", *k, F.col("src").alias("id"), "block").distinct()
                self.pull = held.select("dst_block", *k, "src", "target", F.col("w"))
                links = links.unionByName(routes, allowMissingColumns=True)
            self.links = self._cached(links, "block", "id")

    def _cached(self, rows: DataFrame, by: str, order: str | None = None) -> DataFrame:
        """``rows`` hashed by block and kept; with ``order``, the rows of an id side by side.

        So an update looks up, or adds to, the same entry of a hash table for all edges of an id in turn:
        in the order of arrival every edge would be a miss of the processor's caches in large blocks.
        """
        rows = rows.repartition(self.width, by)
        if order:
            rows = rows.sortWithinPartitions(*self.k, order)
        rows = rows.persist()
        self.cached.append(rows)
        return rows

    def clean_up(self, keep: bool = False) -> None:
        """Free caches, and delete the loop's tables and checkpoints; ``keep`` what a later call resumes from."""
        for df in self.cached:
            df.unpersist()
        self.scratch.release()
        if not keep:
            self.inputs.release()
        self.cached = []

    # --------------------------------------------------------------- restart
    def _arguments(self) -> dict:
        return {
            "keys": self.given, "vectors": self.names, "personalized": self.personalized, "damping": self.d,
            "max_iter": self.max_iter, "epsilon": self.eps, "width": self.argument_width, "hub_threshold": self.hub_threshold,
        }

    def _note(self, iteration: int, running: int, seconds: list, ended: bool = False) -> None:
        """Write the manifest of an iteration, then delete what only earlier ones need."""
        if not self.run_dir:
            return
        facts = {
            "arguments": self._arguments(), "iteration": iteration, "running": running, "seconds": seconds,
            "ended": ended, "rows": self.rows, "saved": self.saved, "n_graphs": self.n_graphs, "share": self.share,
            "unknown_seeds": self.unknown_seeds, "has_hubs": self.has_hubs,
            "width": self.width, "single": None if self.given else self.single,
        }
        put_text(self.spark, f"{self.run_dir}/manifest/{iteration}.{int(ended)}", json.dumps(facts))
        for name in names_in(self.spark, f"{self.run_dir}/manifest"):
            if name != f"{iteration}.{int(ended)}":
                delete_path(self.spark, f"{self.run_dir}/manifest/{name}")
        for name in names_in(self.spark, self.inputs.path("state")):
            if name != str(iteration):
                delete_path(self.spark, self.inputs.path(f"state/{name}"))

    def found(self) -> dict | None:
        """The last manifest of the run folder; without one the folder's leftovers are deleted."""
        if not self.run_dir:
            return None
        names = names_in(self.spark, f"{self.run_dir}/manifest")
        places = [tuple(map(int, n.split("."))) for n in names if not n.endswith(".unfinished")]
        if not places:
            self.result.release()
            return None
        last = ".".join(map(str, max(places)))
        at = json.loads(self.spark.read.text(f"{self.run_dir}/manifest/{last}", wholetext=True).first()[0])
        if at["arguments"] != self._arguments():
            raise ValueError(f"{self.run_dir} is a run with other arguments: {at['arguments']}")
        self.rows, self.saved, self.n_graphs, self.share = at["rows"], at["saved"], at["n_graphs"], at["share"]
        self.unknown_seeds, self.has_hubs, self.width, self.single = at["unknown_seeds"], at["has_hubs"], at["width"], at["single"]
        read = self.spark.read
        self.graphs = read.parquet(self.result.path("graphs")) if self.given else local_table(self.spark, [self.single])
        if not at["ended"]:
            self._hold(read.parquet(self.inputs.path("prop")))
        return at

    def _log_path(self, iteration: int) -> str:
        return self.result.path(f"log/{iteration}")

    def _going_on(self, log: DataFrame | dict) -> DataFrame | dict:
        """The numbers of the next update, from the log of the last one."""
        if not self.given:
            return log
        return log.filter(~self._all("done")).select(
            *self.k, *[f"mass{i}" for i in self.m], *[f"done{i}" for i in self.m]
        )

    def _state(self, iteration: int, schema=None) -> DataFrame:
        read = self.spark.read.schema(schema) if schema else self.spark.read
        return self._cached(read.parquet(self.inputs.path(f"state/{iteration}")), "block")

    def _cut(self, state: DataFrame, iteration: int) -> DataFrame:
        """The state written to the shared folder and read again: it depends on nothing else, and earlier ones go.

        Not ``checkpoint()``: Spark does not know copies of its result for the same, and would compute them all.
        """
        state.write.mode("overwrite").parquet(self.inputs.path(f"state/{iteration}"))
        if not self.run_dir:  # else they stay until the manifest is written
            for name in names_in(self.spark, self.inputs.path("state")):
                if name != str(iteration):
                    delete_path(self.spark, self.inputs.path(f"state/{name}"))
        return self._state(iteration, state.schema)

    # ------------------------------------------------------------------ loop
    def _all(self, name: str) -> Column:
        out = F.col(f"{name}0")
        for i in self.m[1:]:
            out = out & F.col(f"{name}{i}")
        return out

    def start(self) -> tuple[DataFrame, DataFrame]:
        """The start vectors and the per-graph numbers of the first update."""
        state = self.prop.filter("node_row").select(
            "block", *self.k, "id", *[F.col("r0").alias(f"rank{i}") for i in self.m], *[f"t{i}" for i in self.m],
            F.col("dangling").alias("dng"),
        )
        state = self._cached(state, "block")
        numbers = self.graphs.select(
            *self.k, *[(F.col("n_dangling") / F.col("n")).alias(f"mass{i}") for i in self.m],
            *[F.lit(False).alias(f"done{i}") for i in self.m],
        )
        return state, numbers if self.given else numbers.first().asDict()

    def step(self, state: DataFrame, numbers: DataFrame | dict) -> DataFrame:
        """One update: ``(block, keys..., id, rank0.., prev0.., t0.., dng)``; graphs without ``numbers`` drop out.

        ``numbers`` is a dict for a single graph, a table with keys otherwise.
        """
        k, x = self.k, self._step_columns()
        sent = state.select(*x["ranks"]).hint("shuffle_hash").join(self.links, ["block", *k, "id"]).select(*x["sent"])
        # Added up in the block they come from, then in the one they go to.
        sent = sent.groupBy(*x["by"]).agg(*x["sums"]).repartition(self.width, "dst_block")
        if self.has_hubs:
            sent = sent.hint("shuffle_hash").join(self.pull, ["dst_block", *k, "src"], "left")
        rows = state.select(*x["own"]).unionByName(sent.select(*x["arrived"]), allowMissingColumns=True)
        # Without validation, contributions to ids that are not nodes are lost.
        moved = rows.groupBy("block", *k, "id").agg(*x["moved"]).filter("dng is not null")
        moved = self._with_numbers(moved, numbers if self.given else self._one_row(numbers))
        if self.given and self.n_graphs > MAX_BROADCAST_GRAPHS:
            moved = moved.repartition(self.width, "block")
        return moved.select(*x["new"])

    def _step_columns(self) -> dict[str, list]:
        """The columns of an update of the active vectors; made once, as making them takes longer than a small update."""
        if self.active in self.columns:
            return self.columns[self.active]
        k, m, active = self.k, self.m, self.active
        names = [f"{part}{i}" for i in active for part in ("high", "low")]
        terms = [c for i in active for c in exact_terms(F.col("w") * F.col(f"rank{i}"))]
        # A link without target is a route: the rank itself goes there, once.
        route = F.col("dst").isNull()
        src = [F.when(route, F.col("id")).alias("src")] if self.has_hubs else []
        copies = [f"rank{i}" for i in active] if self.has_hubs else []
        arrived = [F.coalesce("target", "dst").alias("id") if self.has_hubs else F.col("dst").alias("id")]
        if self.has_hubs:
            pulled = F.col("target").isNotNull()
            arrived += [F.when(pulled, c).otherwise(F.col(name)).alias(name) for c, name in zip(terms, names)]

        def rank(i: int) -> Column:
            if i not in active:
                return F.col(f"prev{i}").alias(f"rank{i}")
            base = F.lit(1.0 - self.d) + F.lit(self.d) * F.col(f"mass{i}")
            new = F.col(f"t{i}") * base + F.lit(self.d) * F.col(f"in{i}")
            return F.when(F.col(f"done{i}"), F.col(f"prev{i}")).otherwise(new).alias(f"rank{i}")

        self.columns[active] = {
            "ranks": ["block", *k, "id", *[f"rank{i}" for i in active]],
            "sent": ["block", "dst_block", *k, "dst", *src, *copies, *[c.alias(name) for c, name in zip(terms, names)]],
            "by": ["block", "dst_block", *k, "dst", *["src" for _ in src]],
            "sums": [F.sum(c).alias(c) for c in names] + [F.max(F.when(route, F.col(c))).alias(c) for c in copies],
            "arrived": [F.col("dst_block").alias("block"), *k, *arrived, *(names if not self.has_hubs else [])],
            "own": [
                "block", *k, "id", *[F.lit(0).cast("bigint").alias(c) for c in names],
                *[F.col(f"rank{i}").alias(f"prev{i}") for i in m], *[f"t{i}" for i in m], "dng",
            ],
            "moved": [
                *[exact_total(F.sum(f"high{i}"), F.sum(f"low{i}")).alias(f"in{i}") for i in active],
                *[F.max(c).alias(c) for i in m for c in (f"prev{i}", f"t{i}")], F.max("dng").alias("dng"),
            ],
            "new": [
                "block", *k, "id", *[rank(i) for i in m], *[f"prev{i}" for i in m], *[f"t{i}" for i in m], "dng",
                *([c for i in m for c in (f"mass{i}", f"done{i}")] if self.given else []),
            ],
            "sums_of_vectors": self._sums(),
        }
        return self.columns[active]

    def _one_row(self, numbers: dict) -> DataFrame:
        """A single graph's numbers as a table: as literals they would have every update compiled anew."""
        names = [SINGLE, *[f"{c}{i}" for i in self.m for c in ("mass", "done")]]
        values = ", ".join(f":{c}" for c in names)
        return self.spark.sql(f"SELECT * FROM VALUES ({values}) AS t({', '.join(names)})", args={c: numbers[c] for c in names})

    def _sums(self) -> list[Column]:
        change = [exact_sum(F.abs(F.col(f"rank{i}") - F.col(f"prev{i}"))).alias(f"diff{i}") for i in self.m]
        held = [
            F.coalesce(exact_sum(F.when(F.col("dng"), F.col(f"rank{i}"))), F.lit(0.0)).alias(f"mass{i}") for i in self.m
        ]
        return change + held

    def _move(self, state: DataFrame, numbers: DataFrame | dict, iteration: int):
        """The cached new vectors, the numbers after the update, how many graphs run on and how many just ended."""
        seen = Observation(f"linkrank_{uuid.uuid4().hex}")
        new = self.step(state, numbers)
        if not self.given:
            new = new.persist()
            self.cached.append(new)
            # Observed on the way out: the next update's plan has the vectors only.
            new.observe(seen, *self._step_columns()["sums_of_vectors"]).write.format("noop").mode("overwrite").save()
            row = {SINGLE: 0, "iteration": iteration}
            for i in self.m:
                diff, mass = seen.get[f"diff{i}"] or 0.0, seen.get[f"mass{i}"]
                was, before = numbers[f"done{i}"], numbers[f"mass{i}"]
                row |= {f"diff{i}": diff, f"mass{i}": mass, f"from{i}": before, f"was{i}": was, f"done{i}": was or diff < self.eps}
            self.rows.append(row)
            self.active = tuple(i for i in self.m if not row[f"done{i}"])
            running = int(not all(row[f"done{i}"] for i in self.m))
            return new, row, running, 1 - running
        k, m = self.k, self.m
        new = new.persist()
        self.cached.append(new)
        # The numbers that the update started from came along with every row.
        start = [c for i in m for c in (F.first(f"mass{i}").alias(f"from{i}"), F.first(f"done{i}").alias(f"was{i}"))]
        rows = new.groupBy(*k).agg(*self._step_columns()["sums_of_vectors"], *start).select(
            *k, F.lit(iteration).alias("iteration"),
            *[c for i in m for c in (f"diff{i}", f"mass{i}", f"from{i}", f"was{i}")],
            *[(F.col(f"was{i}") | (F.col(f"diff{i}") < self.eps)).alias(f"done{i}") for i in m],
        )
        rows = rows.observe(
            seen, F.count_if(~self._all("done")).alias("running"), F.count(F.lit(1)).alias("all"),
            *[F.count_if(~F.col(f"done{i}")).alias(f"running{i}") for i in m],
        )
        if self.n_graphs <= MAX_BROADCAST_GRAPHS:
            rows = rows.coalesce(1)
        path = self._log_path(iteration)
        rows.write.mode("overwrite").parquet(path)
        counts = seen.get
        self.active = tuple(i for i in m if counts[f"running{i}"])
        log = self.spark.read.schema(rows.schema).parquet(path)
        return new, log, counts["running"], counts["all"] - counts["running"]

    def run(self, at: dict | None = None) -> RankResult:
        """All updates, or those after the manifest ``at``."""
        running, iteration, seconds = self.n_graphs, 0, []
        if at:
            running, iteration, seconds = at["running"], at["iteration"], [tuple(x) for x in at["seconds"]]
            if at["ended"]:
                return self._outcome(iteration, running == 0, seconds)
        if iteration:
            state = self._state(iteration)
            log = self.spark.read.parquet(self._log_path(iteration)) if self.given else self.rows[-1]
            numbers = self._going_on(log)
        else:
            state, numbers = self.start()
            if at is None:
                self._note(0, running, seconds)
        held = state
        for iteration in range(iteration + 1, self.max_iter + 1):
            began = time.time()
            new, log, running, ended = self._move(state, numbers, iteration)
            seconds.append((iteration, time.time() - began))
            held.unpersist()
            self.cached.remove(held)
            state, held = new, new
            if not running or iteration == self.max_iter:
                break
            if ended:
                # They leave the loop: the next update joins running graphs only.
                over = log.filter(self._all("done")).select(*self.k)
                self._save(self._with_numbers(new, over), str(iteration))
            numbers = self._going_on(log)
            if iteration % min(self.interval, MOST_UNCUT) == 0:
                kept = [c for i in self.m for c in (f"rank{i}", f"t{i}")]
                held = self._cut(new.select("block", *self.k, "id", *kept, "dng"), iteration)
                new.unpersist()
                self.cached.remove(new)
                state = held
                self._note(iteration, running, seconds)
        self._lap("iterations")
        self._save(state, "last")
        self._note(iteration, running, seconds, ended=True)
        self._lap("result")
        return self._outcome(iteration, running == 0, seconds)

    def _long(self, df: DataFrame, shared: list[str], per_vector: dict[str, str]) -> DataFrame:
        """Per-vector columns as rows with a ``mode``, or plain columns for a single vector."""
        if self.names == [None]:
            return df.select(*self.given, *shared, *[F.expr(e.format(i=0)).alias(c) for c, e in per_vector.items()])
        rows = [
            F.struct(F.lit(name).alias("mode"), *[F.expr(e.format(i=i)).alias(c) for c, e in per_vector.items()])
            for i, name in enumerate(self.names)
        ]
        names = ["mode", *per_vector]
        return df.select(*self.given, *shared, F.inline(F.array(*rows))).select(*self.given, "mode", *shared, *names[1:])

    def _save(self, state: DataFrame, name: str) -> None:
        ranks = self._long(state, ["id"], {"rank": "rank{i}"})
        ranks.write.mode("overwrite").parquet(self.result.path(f"ranks/{name}"))
        self.saved.append(name)

    def _outcome(self, iteration: int, converged: bool, seconds: list) -> RankResult:
        k = self.k
        if seconds:
            if self.given:
                log = self.spark.read.parquet(*[self._log_path(i) for i, _ in seconds])
            else:
                log = local_table(self.spark, self.rows)
            times = local_table(self.spark, [{"iteration": i, "seconds": t} for i, t in seconds])
            steps = self._long(
                log.join(F.broadcast(times), "iteration"), ["iteration", "seconds"],
                {"l1_diff": "diff{i}", "dangling_mass": "from{i}", "was": "was{i}"},
            ).filter("not was")
            last = log.groupBy(*k).agg(
                *[F.count_if(~F.col(f"was{i}")).alias(f"its{i}") for i in self.m],
                *[F.max(f"done{i}").alias(f"done{i}") for i in self.m],
            )
            graphs = self.graphs.join(last, k, "left")
        else:
            empty = "iteration int, seconds double, l1_diff double, dangling_mass double"
            steps = self._long(self.graphs, [], {"x": "0"}).drop("x").limit(0)
            for c in empty.split(", "):
                name, kind = c.split(" ")
                steps = steps.withColumn(name, F.lit(None).cast(kind))
            graphs = self.graphs
            for i in self.m:
                graphs = graphs.withColumn(f"its{i}", F.lit(0)).withColumn(f"done{i}", F.lit(False))
        keys = [*self.given, *([] if self.names == [None] else ["mode"])]
        runs = self._long(
            graphs.withColumnRenamed("n", "n_nodes"), ["n_nodes"],
            {"iterations": "int(coalesce(its{i}, 0))", "converged": "coalesce(done{i}, false)"},
        )
        return RankResult(
            ranks=self.spark.read.parquet(*[self.result.path(f"ranks/{name}") for name in self.saved]),
            iterations=steps.select(
                *keys, F.col("iteration").cast("int").alias("iteration"), "l1_diff", "dangling_mass", "seconds"
            ),
            runs=runs.select(*keys, "n_nodes", "iterations", "converged"),
            keys=keys,
            n_iterations=iteration if seconds else 0,
            converged=converged and bool(seconds),
            total_seconds=time.time() - self.started,
            unknown_seeds=self.unknown_seeds,
            phase_seconds=dict(self.phases),
            store=self.result,
        )


def contributions(ranks: DataFrame, wedges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rank sent along each distinct edge: ``(keys..., src, dst, contribution)``.

    ``wedges`` as from :func:`linkrank.operators.graph.weighted_edges`; a source
    without out-edges sends nothing.
    """
    from linkrank.operators.graph import join_by_source

    k = list(keys)
    sources = ranks.select(*k, F.col("id").alias("src"), "rank")
    return join_by_source(wedges, sources, k).select(
        *k, "src", "dst", (F.col("weight") * F.col("rank")).alias("contribution")
    )


def inflow(contribs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of incoming contributions per target: ``(keys..., id, inflow)``."""
    k = list(keys)
    return contribs.groupBy(*k, F.col("dst").alias("id")).agg(
        F.sum("contribution").alias("inflow")
    )
