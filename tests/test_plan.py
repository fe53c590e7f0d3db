"""Plan shape of the rank loop: one exchange per iteration, no Python, bounded plans."""

from linkrank.operators import rank as R


def main_tree_lines(df) -> list[str]:
    """Lines of the physical plan, skipping the inside of cached relations."""
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    out, skip_below = [], None
    for line in buf.getvalue().splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip_below is not None and indent > skip_below:
            continue
        skip_below = None
        out.append(line)
        if "InMemoryRelation" in line:
            skip_below = indent
    return out


def test_one_exchange_of_contributions_per_iteration_and_no_python(spark):
    edges = spark.range(400).selectExpr("id % 50 as src", "(id * 7 + 3) % 50 as dst")
    nodes = spark.range(55).select("id")
    loop = R._Loop(edges, nodes, None, [], {None: False}, 0.85, 5, 1e-6, 3, 8, 0, True)
    try:
        loop.setup()
        with R.loop_settings(spark, 8):
            state, numbers = loop.start()
            first = loop.step(state, numbers).persist()
            first.count()
            lines = main_tree_lines(loop.step(first, numbers))
            first.unpersist()
    finally:
        loop.clean_up()
        loop.result.release()
    exchanges = [ln for ln in lines if "Exchange" in ln and "BroadcastExchange" not in ln]
    assert len(exchanges) == 1 and "dst" in exchanges[0]
    text = "\n".join(lines)
    assert "ShuffledHashJoin" in text
    assert "Python" not in text and "ArrowEval" not in text


def test_result_is_read_from_reliable_storage(spark):
    edges = spark.range(200).selectExpr("id % 20 as src", "(id * 3 + 1) % 20 as dst")
    res = R.pagerank(edges)
    lines = main_tree_lines(res.ranks)
    assert not any("Exchange" in ln or "Join" in ln for ln in lines)
    assert any("FileScan parquet" in ln for ln in lines)


def test_adjacency_lists_are_dealt_out_by_part(spark):
    from linkrank.operators.graph import adjacency

    edges = spark.range(100).selectExpr("0L as src", "id as dst")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = "\n".join(main_tree_lines(adjacency(spark.range(100).select("id"), edges, max_list=10)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_part = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(" in ln and "part#" in ln]
    assert by_part, plan


def test_edges_are_read_twice_for_weights(spark, tmp_path):
    """Once by the sketch that finds hubs and once by the join: both its sides share one shuffle."""
    from linkrank.operators.graph import weighted_edges

    path = str(tmp_path / "edges")
    spark.range(20_000).selectExpr("if(id % 2 = 0, -1, id % 50) as src", "id % 900 as dst").write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = weighted_edges(spark.read.parquet(path))
        assert len(df.collect()) > 0
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = plan.split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("FileScan") == 1, plan
