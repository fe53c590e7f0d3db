import random

import pytest
from pyspark.sql import functions as F

from brute import brute_rank
from linkrank.operators.rank import pagerank


def graph(spark, edges, nodes=None, key=None):
    e = spark.createDataFrame(edges or [], "src long, dst long")
    n = spark.createDataFrame([(i,) for i in nodes], "id long") if nodes is not None else None
    return n, e


def ranks_of(res, keys=()):
    return {tuple(r[k] for k in keys) + (r["id"],) if keys else r["id"]: r["rank"] for r in res.ranks.collect()}


def test_dangling_three_nodes_converges_to_analytic_limit(spark):
    # The limit of the rule (checked in numpy) is r2 = 1/5.4225, r0 = 1.85 r2, r1 = 2.5725 r2.
    limit, _, _ = brute_rank([0, 1, 2], [(0, 1), (2, 0)], eps=1e-15, max_iter=500)
    assert [round(limit[i], 6) for i in (0, 1, 2)] == [0.341171, 0.474412, 0.184417]
    nodes, edges = graph(spark, [(0, 1), (2, 0)], [0, 1, 2])
    r = ranks_of(pagerank(edges, nodes))
    want, _, _ = brute_rank([0, 1, 2], [(0, 1), (2, 0)])
    assert max(abs(r[i] - want[i]) for i in want) < 1e-15
    assert max(abs(r[i] - limit[i]) for i in want) < 1e-6
    assert abs(sum(r.values()) - 1) < 1e-12


def test_dangling_three_nodes_default_stop_and_first_step(spark):
    nodes, edges = graph(spark, [(0, 1), (2, 0)], [0, 1, 2])
    res = pagerank(edges, nodes, max_iter=20)
    assert res.n_iterations == 20 and res.converged
    log = {r["iteration"]: r["l1_diff"] for r in res.iterations.collect()}
    assert log[20] < 1e-6 <= log[19]
    one = ranks_of(pagerank(edges, nodes, max_iter=1))
    assert [round(one[i], 6) for i in (0, 1, 2)] == [0.427778, 0.427778, 0.144444]


def test_personalized_three_nodes(spark):
    limit, _, _ = brute_rank([0, 1, 2], [(0, 1), (2, 0)], seeds=[2], eps=1e-15, max_iter=500)
    assert [round(limit[i], 6) for i in (0, 1, 2)] == [0.330418, 0.280855, 0.388727]
    nodes, edges = graph(spark, [(0, 1), (2, 0)], [0, 1, 2])
    seeds = spark.createDataFrame([(2,)], "id long")
    r = ranks_of(pagerank(edges, nodes, seeds=seeds))
    want, _, _ = brute_rank([0, 1, 2], [(0, 1), (2, 0)], seeds=[2])
    assert max(abs(r[i] - want[i]) for i in want) < 1e-15


def test_cycle_is_uniform_after_one_iteration(spark):
    nodes, edges = graph(spark, [(i, (i + 1) % 4) for i in range(4)])
    res = pagerank(edges)
    assert res.n_iterations == 1 and res.converged
    assert all(abs(v - 0.25) < 1e-15 for v in ranks_of(res).values())


@pytest.mark.parametrize(
    "edges,nodes",
    [
        ([(0, 1), (0, 1), (0, 2), (1, 0), (2, 0)], None),  # parallel edges
        ([(0, 0), (0, 1), (1, 0)], None),  # self-loop counts as an out-edge
        ([(0, 1), (1, 0)], [0, 1, 2]),  # isolated node
        ([], [0, 1]),  # every node dangling
        ([], [0]),  # single node
    ],
)
def test_small_graphs_match_brute_force(spark, edges, nodes):
    n, e = graph(spark, edges, nodes)
    res = pagerank(e, n)
    want, iters, conv = brute_rank(nodes or {x for p in edges for x in p}, edges)
    got = ranks_of(res)
    assert set(got) == set(want)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-12
    assert res.n_iterations == iters and res.converged == conv


def test_parallel_edges_send_two_thirds(spark):
    from linkrank.operators.graph import weighted_edges

    _, e = graph(spark, [(0, 1), (0, 1), (0, 2), (1, 0), (2, 0)])
    w = {(r["src"], r["dst"]): r["weight"] for r in weighted_edges(e).collect()}
    assert w[(0, 1)] == pytest.approx(2 / 3) and w[(0, 2)] == pytest.approx(1 / 3)


def random_edges(n, m, seed):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graph_matches_brute_force_with_hubs_split(spark, seed):
    edges = random_edges(60, 400, seed) + [(7, j) for j in range(60)]  # node 7 is a hub
    nodes = list(range(65))
    n, e = graph(spark, edges, nodes)
    want, iters, _ = brute_rank(nodes, edges)
    for threshold in (0, 1000):
        res = pagerank(e, n, hub_threshold=threshold)
        got = ranks_of(res)
        assert max(abs(got[k] - want[k]) for k in want) < 1e-12
        assert res.n_iterations == iters


def test_personalized_random_graph_and_unknown_seeds(spark):
    edges = random_edges(40, 200, 3)
    nodes = list(range(40))
    n, e = graph(spark, edges, nodes)
    seeds = spark.createDataFrame([(3,), (5,), (999,)], "id long")
    want, iters, _ = brute_rank(nodes, edges, seeds=[3, 5])
    res = pagerank(e, n, seeds=seeds)
    got = ranks_of(res)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-12
    assert res.unknown_seeds == 1
    assert min(got[3], got[5]) >= 0.15 / 2


def test_seeds_all_nodes_equals_standard(spark):
    edges = random_edges(30, 120, 4)
    n, e = graph(spark, edges, list(range(30)))
    seeds = spark.range(30).select(F.col("id"))
    a = ranks_of(pagerank(e, n))
    b = ranks_of(pagerank(e, n, seeds=seeds))
    assert max(abs(a[k] - b[k]) for k in a) < 1e-15


def test_doubling_every_edge_changes_nothing(spark):
    edges = random_edges(30, 120, 5)
    n, e = graph(spark, edges, list(range(30)))
    _, e2 = graph(spark, edges + edges)
    a, b = ranks_of(pagerank(e, n)), ranks_of(pagerank(e2, n))
    assert max(abs(a[k] - b[k]) for k in a) < 1e-15


def test_zero_damping_gives_teleport_and_max_iter_zero_gives_start(spark):
    n, e = graph(spark, [(0, 1), (1, 2)], [0, 1, 2])
    seeds = spark.createDataFrame([(1,)], "id long")
    r = ranks_of(pagerank(e, n, seeds=seeds, damping=0.0))
    assert r == {0: 0.0, 1: 1.0, 2: 0.0}
    res = pagerank(e, n, max_iter=0)
    assert res.n_iterations == 0 and not res.converged
    assert all(abs(v - 1 / 3) < 1e-15 for v in ranks_of(res).values())


def test_epsilon_zero_runs_max_iter(spark):
    n, e = graph(spark, [(i, (i + 1) % 4) for i in range(4)])
    res = pagerank(e, n, epsilon=0.0, max_iter=4)
    assert res.n_iterations == 4 and not res.converged


def test_batch_of_graphs_equals_separate_runs(spark):
    g1, g2 = random_edges(25, 80, 6), random_edges(35, 150, 7)
    e = spark.createDataFrame(
        [("a", s, t) for s, t in g1] + [("b", s, t) for s, t in g2], "g string, src long, dst long"
    )
    seeds = spark.createDataFrame([("b", 1), ("b", 2)], "g string, id long")
    res = pagerank(e, seeds=seeds, keys=["g"])
    got = ranks_of(res, ["g"])
    wa, ia, _ = brute_rank({x for p in g1 for x in p}, g1)
    wb, ib, _ = brute_rank({x for p in g2 for x in p}, g2, seeds=[1, 2])
    assert max(abs(got[("a", k)] - v) for k, v in wa.items()) < 1e-12
    assert max(abs(got[("b", k)] - v) for k, v in wb.items()) < 1e-12
    runs = {r["g"]: r["iterations"] for r in res.runs.collect()}
    assert runs == {"a": ia, "b": ib}
    assert len(got) == len(wa) + len(wb)


def test_argument_and_graph_errors(spark):
    n, e = graph(spark, [(0, 1)], [0, 1])
    with pytest.raises(ValueError, match="no nodes"):
        pagerank(spark.createDataFrame([], "src long, dst long"))
    with pytest.raises(ValueError, match="empty"):
        pagerank(e, n, seeds=spark.createDataFrame([], "id long"))
    with pytest.raises(ValueError, match="none of the seeds"):
        pagerank(e, n, seeds=spark.createDataFrame([(9,)], "id long"))
    with pytest.raises(ValueError, match="duplicate"):
        pagerank(e, spark.createDataFrame([(0,), (1,), (1,)], "id long"))
    with pytest.raises(ValueError, match="not in the node table"):
        pagerank(e, spark.createDataFrame([(0,)], "id long"))
    with pytest.raises(ValueError, match="not in the node table"):
        pagerank(spark.createDataFrame([(5, 0)], "src long, dst long"), n)
    for bad in (dict(damping=1.5), dict(max_iter=-1), dict(epsilon=-1.0)):
        with pytest.raises(ValueError):
            pagerank(e, n, **bad)


def test_many_graphs_with_and_without_broadcast(spark, monkeypatch):
    from linkrank.operators import rank as R

    graphs = {g: random_edges(20, 70, 10 + g) + [(1, j) for j in range(20)] for g in range(3)}
    e = spark.createDataFrame(
        [(g, s, t) for g, es in graphs.items() for s, t in es], "g long, src long, dst long"
    )
    for limit in (R.MAX_BROADCAST_GRAPHS, 0):
        monkeypatch.setattr(R, "MAX_BROADCAST_GRAPHS", limit)
        res = pagerank(e, keys=["g"])
        got = ranks_of(res, ["g"])
        runs = {r["g"]: r["iterations"] for r in res.runs.collect()}
        for g, es in graphs.items():
            want, iters, _ = brute_rank({x for p in es for x in p}, es)
            assert max(abs(got[(g, k)] - v) for k, v in want.items()) < 1e-12
            assert runs[g] == iters
        res.release()


def test_two_vectors_over_one_edge_table(spark):
    from linkrank.operators.rank import pagerank_both

    edges = random_edges(30, 120, 8)
    n, e = graph(spark, edges, list(range(30)))
    res = pagerank_both(e, n, spark.createDataFrame([(3,), (4,)], "id long"))
    got = {(r["mode"], r["id"]): r["rank"] for r in res.ranks.collect()}
    runs = {r["mode"]: r["iterations"] for r in res.runs.collect()}
    for mode, seeds in (("standard", None), ("personalized", [3, 4])):
        want, iters, _ = brute_rank(range(30), edges, seeds=seeds)
        assert max(abs(got[(mode, k)] - v) for k, v in want.items()) < 1e-12
        assert runs[mode] == iters
        assert res.iterations.filter(F.col("mode") == mode).count() == iters


def test_hub_path_is_taken_by_a_rule_that_is_always_on(spark):
    from linkrank.operators import rank as R

    edges = [(0, j) for j in range(1, 40)] + [(j, 0) for j in range(1, 40, 3)]
    _, e = graph(spark, edges)
    loop = R._Loop(e, None, None, [], {None: False}, 0.85, 5, 1e-6, 3, 8, 0, True)
    try:
        loop.setup()
        assert loop.has_hubs
        assert loop.prop_hub.select("id").distinct().count() == 1
        assert loop.prop.filter("not node_row and id = 0").count() == 0
    finally:
        loop.clean_up()
        loop.result.release()
    want, _, _ = brute_rank(range(40), edges)
    got = ranks_of(pagerank(e))
    assert max(abs(got[k] - v) for k, v in want.items()) < 1e-12


def test_null_endpoints_and_null_nodes_are_errors(spark):
    e = spark.createDataFrame([(0, 1), (1, 0), (1, None)], "src long, dst long")
    with pytest.raises(ValueError, match="NULL endpoints"):
        pagerank(e)
    with pytest.raises(ValueError, match="NULL ids"):
        pagerank(e.filter("dst is not null"), spark.createDataFrame([(0,), (1,), (None,)], "id long"))


def test_duplicate_nodes_are_found_without_an_iteration(spark):
    e = spark.createDataFrame([(0, 1)], "src long, dst long")
    with pytest.raises(ValueError, match="duplicate"):
        pagerank(e, spark.createDataFrame([(0,), (1,), (1,)], "id long"), max_iter=0)


def test_only_the_result_stays_in_the_checkpoint_folder(spark):
    import os

    def files():
        root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if not f.startswith(".")}

    before = files()
    res = pagerank(spark.createDataFrame([(0, 1), (1, 2), (2, 0), (2, 1)], "src long, dst long"), max_iter=7)
    left = files() - before
    assert left and all("/tables-" in f for f in left)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("linkrank_")]
    assert res.ranks.count() == 3
    res.release()
    assert not files() - before


def test_adaptive_execution_is_on_while_the_input_is_derived(spark, monkeypatch):
    from linkrank.operators import rank as R

    seen = {}
    build, step = R._Loop._build, R._Loop.step
    monkeypatch.setattr(R._Loop, "_build", lambda self, *a: (seen.update(setup=spark.conf.get("spark.sql.adaptive.enabled")), build(self, *a))[1])
    monkeypatch.setattr(R._Loop, "step", lambda self, *a: (seen.update(loop=spark.conf.get("spark.sql.adaptive.enabled")), step(self, *a))[1])
    pagerank(spark.createDataFrame([(0, 1), (1, 0)], "src long, dst long"))
    assert seen == {"setup": "true", "loop": "false"}
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_checkpoint_interval_does_not_change_results(spark):
    edges = random_edges(40, 160, 11)
    n, e = graph(spark, edges, list(range(40)))
    base = ranks_of(pagerank(e, n, checkpoint_interval=3))
    for interval in (1, 50):
        res = pagerank(e, n, checkpoint_interval=interval)
        assert ranks_of(res) == base


def test_numbers_per_graph_by_salted_join(spark, monkeypatch):
    """Beyond the broadcast bound a graph of half of all nodes is dealt to many tasks, with equal results."""
    from pyspark.sql import functions as F

    from linkrank.operators import rank as R

    edges = spark.range(1200).selectExpr("if(id < 600, 0, id % 40) AS g", "(id * 13) % 300 AS src", "(id * 7) % 290 AS dst")
    want = {(r.g, r.id): r["rank"] for r in R.pagerank(edges, keys=["g"], max_iter=4).ranks.collect()}
    monkeypatch.setattr(R, "MAX_BROADCAST_GRAPHS", 0)
    seen = []
    original = R._Loop._with_numbers

    def watched(self, rows, numbers):
        joined = original(self, rows, numbers)
        if "dng" in rows.columns and not seen:
            seen.append(joined.filter("g = 0").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect())
        return joined

    monkeypatch.setattr(R._Loop, "_with_numbers", watched)
    got = {(r.g, r.id): r["rank"] for r in R.pagerank(edges, keys=["g"], max_iter=4).ranks.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    counts = [r["count"] for r in seen[0]]
    assert len(counts) > 2 and max(counts) < 0.7 * sum(counts)


def test_a_vector_with_one_id_twice_fails(spark):
    from linkrank.operators.validate import rank_report

    nodes = spark.range(4).select("id")
    good = spark.createDataFrame([(i, 0.25) for i in range(4)], "id long, rank double")
    bad = spark.createDataFrame([(0, 0.25), (1, 0.25), (2, 0.25), (2, 0.25)], "id long, rank double")
    one, other = rank_report(good, nodes).first(), rank_report(bad, nodes).first()
    assert one.all_checks_passed and one.ids_match
    assert other.count_matches and not other.ids_match and not other.all_checks_passed


def log_of(res):
    rows = res.iterations.drop("seconds").collect()
    return sorted(tuple(r) for r in rows)


def test_width_and_order_do_not_change_a_bit(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60) ** 2 % 60, rng.randrange(60)) for _ in range(400)] + [(7, j) for j in range(60)]
    n, e = graph(spark, edges, list(range(64)))
    seeds = spark.createDataFrame([(1,), (9,)], "id long")
    for given, widths in ((None, (3, 8, 211)), (seeds, (3, 8))):
        seen = []
        for width in widths:
            res = pagerank(e.repartition(width), n, seeds=given, num_partitions=width, max_iter=4)
            seen.append((ranks_of(res), log_of(res)))
            res.release()
        assert all(x == seen[0] for x in seen)


def test_exact_sum_keeps_small_terms(spark):
    from fractions import Fraction

    from linkrank.operators.rank import exact_sum

    rng = random.Random(4)
    values = [rng.random() * 10.0 ** -rng.randrange(3, 16) for _ in range(3000)] + [0.0, 1.0]
    want = float(sum(map(Fraction, values)))
    got = {
        spark.createDataFrame([(v,) for v in rng.sample(values, len(values))], "v double").repartition(k)
        .agg(exact_sum(F.col("v"))).first()[0] for k in (1, 5, 30)
    }
    assert len(got) == 1 and abs(got.pop() - want) < 1e-15
    assert spark.createDataFrame([], "v double").agg(exact_sum(F.col("v"))).first()[0] is None


KILLED = """
import os, sys
sys.path[:0] = {path!r}
from pyspark.sql import SparkSession
from linkrank.operators import rank as R
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
move = R._Loop._move
def stops(self, state, numbers, iteration):
    if iteration == 6:
        os._exit(9)
    return move(self, state, numbers, iteration)
R._Loop._move = stops
e = spark.createDataFrame({edges!r}, "src long, dst long")
R.pagerank(e, spark.range(42).select("id"), max_iter=8, run_dir={run!r})
"""


def test_a_run_goes_on_after_its_driver_was_killed(spark, tmp_path):
    import os
    import subprocess
    import sys

    edges = random_edges(40, 160, 11) + [(5, j) for j in range(40)]
    run = str(tmp_path / "run")
    script = KILLED.format(path=sys.path[:3], folder=str(tmp_path / "ckpt"), edges=edges, run=run)
    assert subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=300).returncode == 9
    assert "3.0" in os.listdir(f"{run}/linkrank-run/manifest")

    nodes = spark.range(42).select("id")
    whole = pagerank(spark.createDataFrame(edges, "src long, dst long"), nodes, max_iter=8)
    # The folder stands for the input, which is not read again.
    unread = spark.range(3).selectExpr("id as src", "cast(raise_error('read again') as bigint) as dst")
    with pytest.raises(ValueError, match="other arguments"):
        pagerank(unread, nodes, damping=0.5, max_iter=8, run_dir=run)
    for _ in range(2):  # goes on; then returns what is there
        res = pagerank(unread, nodes, max_iter=8, run_dir=run)
        assert ranks_of(res) == ranks_of(whole)
        assert log_of(res) == log_of(whole) and res.n_iterations == 8
    assert sorted(os.listdir(f"{run}/linkrank-run")) == ["manifest", "ranks"]
    res.release()
    assert os.listdir(run) == []


def test_many_graphs_go_on_after_a_failure(spark, tmp_path, monkeypatch):
    from linkrank.operators import rank as R

    e = spark.range(600).selectExpr("id % 5 as g", "(id * 13) % 41 as src", "(id * id) % (11 + id % 5) as dst")
    seeds = spark.createDataFrame([(g, s) for g in range(5) for s in (1, 2)], "g long, id long")
    whole = R.pagerank_both(e, None, seeds, keys=["g"], epsilon=2e-2, max_iter=9)
    run, move = str(tmp_path / "run"), R._Loop._move

    def fails(self, state, numbers, iteration):
        if iteration in stops:
            stops.remove(iteration)
            raise RuntimeError("lost")
        return move(self, state, numbers, iteration)

    monkeypatch.setattr(R._Loop, "_move", fails)
    stops = [2, min(5, whole.n_iterations)]
    for _ in range(2):
        with pytest.raises(RuntimeError, match="lost"):
            R.pagerank_both(e, None, seeds, keys=["g"], epsilon=2e-2, max_iter=9, run_dir=run)
    res = R.pagerank_both(e, None, seeds, keys=["g"], epsilon=2e-2, max_iter=9, run_dir=run)
    assert not stops and ranks_of(res, ["g", "mode"]) == ranks_of(whole, ["g", "mode"])
    assert log_of(res) == log_of(whole)
    assert sorted(map(tuple, res.runs.collect())) == sorted(map(tuple, whole.runs.collect()))
    res.release()


def test_no_catalog_entry_is_ever_made(spark, monkeypatch):
    from linkrank.operators import rank as R

    before, seen, step = {t.name for t in spark.catalog.listTables()}, set(), R._Loop.step
    monkeypatch.setattr(
        R._Loop, "step", lambda self, *a: (seen.update(t.name for t in spark.catalog.listTables()), step(self, *a))[1]
    )
    R.pagerank(spark.createDataFrame([(0, 1), (1, 0), (1, 2)], "src long, dst long"), max_iter=2).release()
    assert seen <= before


def test_a_rank_is_sent_once_a_block_and_no_partition_holds_too_many_rows(spark, monkeypatch):
    from linkrank.operators import rank as R

    monkeypatch.setattr(R, "MOST_ROWS", 400)
    edges = spark.range(1600).selectExpr("id % 8 as src", "100 + id div 8 as dst")  # 8 sources, 200 targets each
    loop = R._Loop(edges, None, None, [], {None: False}, 0.85, 5, 1e-6, 3, 3, 0, True)
    try:
        loop.setup()
        assert loop.width == 5  # 1,808 rows
        assert loop.links.count() == 8 * 5 and loop.pull.count() == 1600
    finally:
        loop.clean_up()
        loop.result.release()
