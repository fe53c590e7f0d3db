import contextlib
import json
import os

import pytest

from linkrank.operators.rank import pagerank
from linkrank.sources.edge_list import parse_edge_lines, read_edge_list
from linkrank.sources import graph_json as GJ
from linkrank.sources.graph_json import parse_graph_json, read_graph_json, write_graph_json
from linkrank.sources.seeds import read_seeds, resolve_seeds, seeds_from_string
from linkrank.sources.writers import rank_summary, write_rank_result


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


@contextlib.contextmanager
def split_of(spark, size):
    """Scans in splits of at most ``size`` bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    kept = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_edge_lines_accepted_and_skipped(spark):
    lines = ["# comment", "  # comment", "", "   ", "  1 2 ", "3\t4", "+5 -6"]
    edges, rejects = parse_edge_lines(lines_df(spark, lines))
    assert sorted((r.src, r.dst) for r in edges.collect()) == [(1, 2), (3, 4), (5, -6)]
    assert rejects.count() == 0


def test_edge_lines_rejected(spark):
    lines = ["1,2", "1 2 3", "a b", "1_0 2", "99999999999999999999 1"]
    edges, rejects = parse_edge_lines(lines_df(spark, lines))
    assert edges.count() == 0
    reasons = {r.line: r.reason for r in rejects.collect()}
    assert reasons["1,2"] == "expected two fields"
    assert reasons["1 2 3"] == "expected two fields"
    assert reasons["a b"] == "fields must be integers"
    assert reasons["1_0 2"] == "fields must be integers"
    assert reasons["99999999999999999999 1"] == "fields must be integers"


def test_edge_lines_with_delimiter(spark):
    edges, rejects = parse_edge_lines(lines_df(spark, ["1,2", "1, 2", "3 4"]), delimiter=",")
    assert sorted((r.src, r.dst) for r in edges.collect()) == [(1, 2), (1, 2)]
    assert [r.line for r in rejects.collect()] == ["3 4"]


def test_read_edge_list_file_strict_and_rank(spark, tmp_dir):
    path = os.path.join(tmp_dir, "g.txt")
    with open(path, "w") as f:
        f.write("# three nodes\n0 1\n\n2 0\n")
    edges = read_edge_list(spark, path)
    res = pagerank(edges)
    assert res.ranks.count() == 3
    bad = os.path.join(tmp_dir, "bad.txt")
    with open(bad, "w") as f:
        f.write("0 1\n0 1 2\n")
    with pytest.raises(ValueError, match="bad edge line"):
        read_edge_list(spark, bad)


def test_graph_json_document_and_lines(spark, tmp_dir):
    doc = {"nodes": [{"id": 0, "outNeighbors": [1, 1]}, {"id": 1, "outNeighbors": []}, {"id": 2, "outNeighbors": [0]}]}
    path = os.path.join(tmp_dir, "doc.json")
    with open(path, "w") as f:
        json.dump(doc, f, indent=2)
    nodes, edges = read_graph_json(spark, path, lines=False)
    assert sorted(r.id for r in nodes.collect()) == [0, 1, 2]
    assert sorted((r.src, r.dst) for r in edges.collect()) == [(0, 1), (0, 1), (2, 0)]
    out = os.path.join(tmp_dir, "lines")
    write_graph_json(nodes, edges, out)
    n2, e2 = read_graph_json(spark, out)
    assert sorted(r.id for r in n2.collect()) == [0, 1, 2]
    assert sorted((r.src, r.dst) for r in e2.collect()) == [(0, 1), (0, 1), (2, 0)]
    missing = os.path.join(tmp_dir, "missing.json")
    with open(missing, "w") as f:
        json.dump({"vertices": []}, f)
    with pytest.raises(ValueError, match="nodes"):
        read_graph_json(spark, missing, lines=False)


def test_parse_graph_json_rows_of_both_layouts(spark):
    texts = ['{"id": 5, "outNeighbors": [6]}', '{"nodes": [{"id": 7, "outNeighbors": [5, 6]}]}']
    nodes, edges, rejects = parse_graph_json(lines_df(spark, texts))
    assert sorted(r.id for r in nodes.collect()) == [5, 7]
    assert sorted((r.src, r.dst) for r in edges.collect()) == [(5, 6), (7, 5), (7, 6)]
    assert rejects.count() == 0


def test_graph_json_rejects_instead_of_dropping(spark, tmp_dir):
    good = ['{"meta": 1, "nodes": [{"id": 1, "outNeighbors": [2]}]}', '{"outNeighbors": [], "id": 2}', "  "]
    bad = {
        '{"foo": 3}': "neither 'id' nor 'nodes'", '{"id": 1, "outNeighbors": [2': "not graph JSON", "nonsense": "not graph JSON",
        '{"id": "x"}': "not graph JSON", '{"nodes": [{"outNeighbors": [1]}]}': "NULL node id or neighbor",
        '{"id": 4, "outNeighbors": [null]}': "NULL node id or neighbor", '{"id": 99999999999999999999}': "not graph JSON",
    }
    nodes, edges, rejects = parse_graph_json(lines_df(spark, good + list(bad)))
    assert sorted(r.id for r in nodes.collect()) == [1, 2] and [(r.src, r.dst) for r in edges.collect()] == [(1, 2)]
    assert {r.line: r.reason for r in rejects.collect()} == bad
    path = os.path.join(tmp_dir, "mixed.json")
    with open(path, "w") as f:
        f.write(good[1] + "\n" + '{"foo": 3}\n')
    with pytest.raises(ValueError, match="foo"):
        read_graph_json(spark, path)


def test_seeds_from_string_and_file(spark, tmp_dir):
    assert sorted(r.id for r in seeds_from_string(spark, "3,17, 42").collect()) == [3, 17, 42]
    for bad in ("3,x", "3,+-5,17", "3,99999999999999999999", "3,,4", ""):
        with pytest.raises(ValueError):
            seeds_from_string(spark, bad)
    for bad in ("3\n+-5\n", "99999999999999999999\n"):
        path = os.path.join(tmp_dir, f"bad{len(bad)}.txt")
        with open(path, "w") as f:
            f.write(bad)
        with pytest.raises(ValueError, match="bad seed"):
            read_seeds(spark, path)
    nodes = spark.createDataFrame([(3,), (4,)], "id long")
    known, unknown = resolve_seeds(spark, nodes, text="3,9", path="/nowhere")
    assert [r.id for r in known.collect()] == [3] and [r.id for r in unknown.collect()] == [9]
    with pytest.raises(ValueError):
        resolve_seeds(spark, nodes)
    with pytest.raises(ValueError, match="none of the seeds"):
        resolve_seeds(spark, nodes, text="8")
    path = os.path.join(tmp_dir, "seeds.txt")
    with open(path, "w") as f:
        f.write("3\n\n 17 \n3\n")
    assert sorted(r.id for r in read_seeds(spark, path).collect()) == [3, 17]


def test_rank_summary_and_writer(spark, tmp_dir):
    e = spark.createDataFrame([(0, 1), (2, 0)], "src long, dst long")
    res = pagerank(e)
    row = rank_summary(res, 2).collect()[0]
    assert [x.id for x in row.top_k] == [1, 0]
    assert row.iterations == res.n_iterations and len(row.iteration_times) == res.n_iterations
    assert row.mean_iteration_time is not None
    zero = rank_summary(pagerank(e, max_iter=0), 2).collect()[0]
    assert zero.iterations == 0 and zero.mean_iteration_time is None and zero.iteration_times == []
    write_rank_result(res, os.path.join(tmp_dir, "out"), k=2)
    back = spark.read.parquet(os.path.join(tmp_dir, "out", "ranks"))
    assert back.count() == 3


def test_rank_summary_keeps_graphs_apart(spark):
    e = spark.createDataFrame([("a", 0, 1), ("a", 1, 0), ("b", 0, 1), ("b", 2, 1)], "g string, src long, dst long")
    res = pagerank(e, keys=["g"])
    rows = {r.g: r for r in rank_summary(res, 2).collect()}
    assert set(rows) == {"a", "b"}
    assert [x.id for x in rows["a"].top_k] == [0, 1] and rows["b"].top_k[0].id == 1
    for r in res.runs.collect():
        assert rows[r.g].iterations == r.iterations == len(rows[r.g].iteration_times)


def test_experiment_report_round_trip(spark, tmp_dir):
    from linkrank.operators.batch import run_experiment
    from linkrank.sources.writers import write_experiment

    details, summary, seeds = run_experiment(spark, num_graphs=2, n=20, e=60, k=3)
    out = os.path.join(tmp_dir, "experiment")
    write_experiment(details, summary, seeds, out)
    assert spark.read.json(os.path.join(out, "seeds")).groupBy("graph_id").count().filter("count = 5").count() == 2
    back = spark.read.json(os.path.join(out, "details")).collect()
    assert sorted(r.graph_id for r in back) == [0, 1]
    assert all(len(r.std_top_k) == 3 for r in back)
    s = spark.read.json(os.path.join(out, "summary")).collect()[0]
    assert s.num_graphs == 2
    assert abs(s.average_overlap - sum(r.overlap_score for r in back) / 2) < 1e-12


def test_a_document_of_several_splits_round_trips(spark, tmp_path):
    import json
    import os

    nodes = spark.range(400).select("id")
    edges = spark.range(3000).selectExpr("id % 350 AS src", "(id * 7) % 400 AS dst")
    path = str(tmp_path / "graph.json")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would write so few rows in one part
    try:
        GJ.write_graph_document(nodes, edges, path, max_list=5)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    text = "".join(open(os.path.join(path, f)).read() for f in files)
    assert len(files) > 1 and {n["id"] for n in json.loads(text)["nodes"]} == set(range(400))
    with split_of(spark, 2000):
        back, again = GJ.read_graph_document(spark, path)
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > len(files)
        assert sorted(r.id for r in back.collect()) == list(range(400))
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, edges.collect()))
    empty = str(tmp_path / "empty.json")
    GJ.write_graph_document(nodes.limit(0), edges.limit(0), empty)
    assert [d.count() for d in GJ.read_graph_document(spark, empty)] == [0, 0]


@pytest.mark.parametrize("size", [40, 300, 100_000])
@pytest.mark.parametrize("indent", [None, 1])
def test_quotes_and_depth_are_carried_over_splits(spark, tmp_path, size, indent):
    import json
    import random

    rng = random.Random(size)
    odd = [*'{}{}{}[]":,', "\\", "\n", "ü", "x", '"}', "\\}"]

    def node(i):
        out = {"id": i, "outNeighbors": [rng.randrange(50) for _ in range(rng.randrange(4))]}
        if rng.random() < 0.5:
            out["label"] = "".join(rng.choices(odd, k=rng.randrange(12)))
        if rng.random() < 0.3:
            out = {"meta": {"a}": {"b": "".join(rng.choices(odd, k=5))}, "c": {}}, **out}
        return out

    document = {"nodes": [node(i) for i in range(80)], "tail": "}{"}
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(document, indent=indent, ensure_ascii=False) + "\n")
    with split_of(spark, size):
        nodes, edges = GJ.read_graph_document(spark, str(path))
        assert sorted(r.id for r in nodes.collect()) == list(range(80))
        want = sorted((n["id"], d) for n in document["nodes"] for d in n["outNeighbors"])
        assert sorted(map(tuple, edges.collect())) == want


def test_what_is_no_node_is_an_error(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{"nodes": [{"id": 1, "outNeighbors": [2]}, {"name": "x"}]}')
    with pytest.raises(ValueError):
        GJ.read_graph_document(spark, str(path))
