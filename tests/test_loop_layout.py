"""How the rank loop holds its edges, and what its small tables cost."""

import random

import pytest
from pyspark.sql import functions as F

from linkrank.operators import rank as R
from linkrank.session import local_table, loop_settings
from test_plan import main_tree_lines


def in_order(df, key) -> bool:
    """The rows of every partition are sorted by ``key``, nulls first."""
    rows = df.select(F.spark_partition_id().alias("p"), key).collect()
    last = {}
    for p, value in rows:
        if p in last and value < last[p]:
            return False
        last[p] = value
    return len(last) > 1


def test_edges_of_an_id_lie_side_by_side(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(3000)] + [(0, i) for i in range(200)]
    rng.shuffle(pairs)
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    loop = R._Loop(edges, None, None, [], {None: False}, 0.85, 5, 1e-6, 3, 4, 0, True)
    try:
        loop.setup()
        assert loop.has_hubs
        assert in_order(loop.links, "id") and in_order(loop.pull, "target")
    finally:
        loop.clean_up()
        loop.result.release()


def test_rows_of_the_driver_are_local_to_the_plan(spark):
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (0, 2)], "src bigint, dst bigint")
    res = R.pagerank(edges, max_iter=3, epsilon=0.0)
    for table in (res.runs, res.iterations):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "LocalTableScan" in plan and "ExistingRDD" not in plan
    assert [r["iteration"] for r in res.iterations.orderBy("iteration").collect()] == [1, 2, 3]
    assert res.runs.collect()[0].asDict() == {"n_nodes": 3, "iterations": 3, "converged": False}
    res.release()


def test_local_table_keeps_types_and_values(spark):
    rows = [{"a": 1, "b": 0.1, "c": True}, {"a": 2**40, "b": 1e-300, "c": False}]
    table = local_table(spark, rows)
    assert table.dtypes == [("a", "bigint"), ("b", "double"), ("c", "boolean")]
    assert [r.asDict() for r in table.orderBy("a").collect()] == rows


@pytest.mark.parametrize("before", [None, "extended"])
def test_the_loop_describes_its_plans_shortly_and_puts_the_setting_back(spark, before):
    name = "spark.sql.ui.explainMode"
    default = spark.conf.get(name)
    if before:
        spark.conf.set(name, before)
    try:
        with loop_settings(spark, 4):
            assert spark.conf.get(name) == "simple"
        assert spark.conf.get(name) == (before or default)
    finally:
        spark.conf.unset(name)


def test_the_width_follows_memory_not_the_number_of_edges():
    """Every further block has ranks sent to it in every update, so what is sent would outgrow the input."""
    assert R.wide_enough(12, 3_600_000, 36_000_000) == 12
    assert R.wide_enough(12, 21_600_000, 215_000_000) == 20
    assert R.wide_enough(12, 100_000_000, 100_000_000) == 25  # ranks in hash tables
    assert R.wide_enough(12, 0, 0) == 12


def test_many_graphs_have_narrow_blocks():
    """Their rows are mostly nodes, and the hash tables of a block's ranks cannot spill."""
    assert R.wide_enough(12, 40_000_000, 36_000_000, 150) == 160
    assert R.wide_enough(12, 21_600_000, 215_000_000, 3) == 20  # three large graphs: ranks sent to every block cost more
    assert R.wide_enough(12, 3_600_000, 36_000_000, 1) == 12


def test_a_run_of_many_graphs_takes_that_width(spark, monkeypatch):
    monkeypatch.setattr(R, "MOST_NODES_APART", 40)
    edges = spark.range(900).selectExpr("id % 30 as g", "id % 20 as src", "(id * 7 + 3) % 20 as dst")
    loop = R._Loop(edges, None, None, ["g"], {None: False}, 0.85, 5, 1e-6, 3, 2, 0, True)
    try:
        loop.setup()
        nodes = loop.graphs.agg(F.sum("n")).first()[0]
        assert loop.width == -(-nodes // 40) > 2
    finally:
        loop.clean_up()
        loop.result.release()
    few, many = (R.pagerank(edges, keys=["g"], num_partitions=n, max_iter=4) for n in (2, 40))
    assert sorted(few.ranks.collect()) == sorted(many.ranks.collect())
    few.release()
    many.release()


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_a_vector_that_has_ended_is_sent_no_more(spark, monkeypatch, keys):
    """The standard vector ends first here; later updates neither send nor add up its ranks."""
    rng, graphs = random.Random(8), 3 if keys else 1
    # The ring is at rest under the standard vector, and the seed in it stirs it for long.
    rows = [(g, rng.randrange(40), rng.randrange(40)) for g in range(graphs) for _ in range(300)]
    rows += [(g, 0, i) for g in range(graphs) for i in range(40)] + [(g, 100 + i, 100 + (i + 1) % 6) for g in range(graphs) for i in range(6)]
    edges = spark.createDataFrame(rows, "g int, src bigint, dst bigint").select(*keys, "src", "dst")
    seeds = spark.createDataFrame([(g, 100) for g in range(graphs)], "g int, id bigint").select(*keys, "id")
    sent, step = [], R._Loop.step

    def watched(self, state, numbers):
        new = step(self, state, numbers)
        plan = "\n".join(main_tree_lines(new))
        sent.append(tuple(i for i in self.m if f"high{i}#" in plan))
        return new

    monkeypatch.setattr(R._Loop, "step", watched)
    res = R.pagerank_both(edges, None, seeds, keys, num_partitions=3, epsilon=0.02)
    ended = [max(r["iterations"] for r in res.runs.collect() if r["mode"] == mode) for mode in (R.STANDARD, R.PERSONALIZED)]
    assert ended[0] + 3 < ended[1] and res.converged
    assert sent == [(0, 1)] * ended[0] + [(1,)] * (ended[1] - ended[0])
    for mode, given in ((R.STANDARD, None), (R.PERSONALIZED, seeds)):
        alone = R.pagerank(edges, seeds=given, keys=keys, num_partitions=3, epsilon=0.02)
        mine = res.ranks.filter(F.col("mode") == mode).drop("mode")
        assert sorted(mine.collect()) == sorted(alone.ranks.select(*mine.columns).collect())
        alone.release()
    res.release()


def test_blocks_are_told_after_the_edges_are_joined(spark):
    """Nothing that follows from a row's own ids is sent with it to the joins with its ends."""
    edges = spark.createDataFrame([(i % 7, i % 11 + 1) for i in range(200)], "src bigint, dst bigint")
    loop, sent = R._Loop(edges, None, None, [], {None: False}, 0.85, 5, 1e-6, 3, 4, 0, True), []
    by_end = loop._by_end
    loop._by_end = lambda rows, *a: sent.append(set(rows.columns)) or by_end(rows, *a)
    try:
        loop.setup()
        assert len(sent) == 2 and not any(c in {"block", "dst_block"} for columns in sent for c in columns)
        assert loop.links.columns[:1] == ["block"] and loop.links.count() > 0
    finally:
        loop.clean_up()
        loop.result.release()
