import pytest

from brute import brute_rank

from linkrank.operators import compare as C
from linkrank.operators import generate as G
from linkrank.operators import graph as GR
from linkrank.operators.batch import experiment_details, compare_rankings, sample_seeds


def test_shaping_on_a_small_graph(spark):
    nodes = spark.createDataFrame([(i,) for i in range(4)], "id long")
    edges = spark.createDataFrame([(0, 1), (0, 1), (0, 0), (1, 2)], "src long, dst long")
    assert sorted(r.id for r in GR.node_set(edges).collect()) == [0, 1, 2]
    deg = {r.id: r.out_degree for r in GR.out_degree(nodes, edges).collect()}
    assert deg == {0: 3, 1: 1, 2: 0, 3: 0}
    assert sorted(r.id for r in GR.dangling_nodes(nodes, edges).collect()) == [2, 3]
    s = GR.graph_summary(nodes, edges).collect()[0]
    assert (s.n_nodes, s.n_edges, s.n_dangling) == (4, 4, 2)
    assert sorted((r.src, r.dst) for r in GR.clean_edges(edges).collect()) == [(0, 1), (1, 2)]
    adj = {r.id: list(r.out_neighbors) for r in GR.adjacency(nodes, edges).collect()}
    assert adj == {0: [0, 1, 1], 1: [2], 2: [], 3: []}
    back = sorted((r.src, r.dst) for r in GR.explode_adjacency(GR.adjacency(nodes, edges)).collect())
    assert back == sorted((r.src, r.dst) for r in edges.collect())
    assert GR.check_graph(nodes, edges).count() == 0


def test_adjacency_splits_a_hub_into_parts(spark):
    nodes = spark.range(101).select("id")
    edges = spark.range(1, 101).selectExpr("0L as src", "id as dst")
    adj = GR.adjacency(nodes, edges, max_list=10).filter("id = 0").collect()
    assert len(adj) == 10 and {r.out_degree for r in adj} == {100}
    assert sorted(x for r in adj for x in r.out_neighbors) == list(range(1, 101))


@pytest.mark.parametrize("pairs", [[(0, i) for i in range(1, 101)], [(0, 7)] * 100, [(0, 7)] * 60 + [(0, 0)] * 40])
def test_no_adjacency_list_is_longer_than_asked(spark, pairs):
    nodes = spark.range(101).select("id")
    edges = spark.createDataFrame(pairs, "src long, dst long")
    rows = GR.adjacency(nodes, edges, max_list=10).filter("id = 0").collect()
    assert sorted(r.part for r in rows) == list(range(10))
    assert {len(r.out_neighbors) for r in rows} == {10} and {r.out_degree for r in rows} == {100}
    assert sorted(x for r in rows for x in r.out_neighbors) == sorted(d for _, d in pairs)


def test_joins_by_source_split_hubs(spark):
    edges = [(0, j) for j in range(200)] + [(j, 0) for j in range(1, 30)]
    df = spark.createDataFrame(edges, "src long, dst long")
    w = {(r.src, r.dst): r.weight for r in GR.weighted_edges(df).collect()}
    assert w == {p: 1 / 200 if p[0] == 0 else 1.0 for p in edges}


def test_frequent_keys_misses_none_above_its_share(spark):
    from pyspark.sql import functions as F

    rows = spark.range(60_000).selectExpr("CASE WHEN id % 5 = 0 THEN -1 WHEN id % 7 = 0 THEN 3 ELSE id END AS k")
    assert sorted(GR.frequent_keys(rows, F.col("k"), 1 / 16)) == [-1, 3]
    assert GR.frequent_keys(rows.limit(0), F.col("k"), 1 / 16) == []
    assert GR.frequent_keys(spark.range(5000), F.col("id"), 1 / 16) == []


def test_a_hub_is_dealt_to_many_tasks(spark):
    from pyspark.sql import functions as F

    edges = spark.range(40_000).selectExpr("CASE WHEN id % 2 = 0 THEN -5 ELSE id % 300 END AS src", "id AS dst")
    sources = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    kept = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], "-1")
        spark.conf.set(keys[1], "false")
        joined = GR.join_by_source(edges, sources)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in zip(keys, kept, strict=True):
            spark.conf.set(k, v)
    assert sum(r["count"] for r in sizes) == 40_000 and max(r["count"] for r in sizes) < 15_000
    assert joined.filter("n != if(src = -5, 20000, n)").isEmpty()


def test_parallel_edges_are_one_run(spark):
    from pyspark.sql import functions as F

    many = 10_000_000
    edges = spark.range(many).selectExpr("1L AS src", "2L AS dst").union(spark.createDataFrame([(1, 0), (1, 5), (2, 2)], "src long, dst long"))
    runs = GR.adjacency_runs(edges, max_list=1000).cache()
    longest = F.max(F.size("runs")).alias("longest")
    filled = F.aggregate("runs", F.lit(0).cast("bigint"), lambda a, r: a + r["multiplicity"])
    got = runs.filter("id = 1").agg(F.count(F.lit(1)), F.sum(filled), F.max(filled), F.min("part"), F.max("part"), longest).first()
    assert tuple(got) == (10_001, many + 2, 1000, 0, 10_000, got.longest) and got.longest <= 3
    lists = GR.adjacency(spark.range(4).select("id"), edges, max_list=1000)
    sizes = lists.agg(F.sum(F.size("out_neighbors")), F.max(F.size("out_neighbors")), F.count(F.lit(1))).first()
    assert tuple(sizes) == (many + 3, 1000, 10_001 + 3)


def test_random_graph_rules(spark):
    nodes, edges = G.random_graph(spark, 50, 300, seed=7)
    e = [(r.src, r.dst) for r in edges.collect()]
    assert len(e) == len(set(e)) == 300
    assert all(s != d and 0 <= s < 50 and 0 <= d < 50 for s, d in e)
    assert nodes.count() == 50
    _, dense = G.random_graph(spark, 10, 80, seed=7)
    d = [(r.src, r.dst) for r in dense.collect()]
    assert len(set(d)) == 80 and all(s != t for s, t in d)
    _, clamp = G.random_graph(spark, 3, 100)
    assert clamp.count() == 6
    with pytest.raises(ValueError):
        G.random_graph(spark, 0, 1)
    with pytest.raises(ValueError):
        G.random_graph(spark, 5, -1)
    again = sorted((r.src, r.dst) for r in G.random_graph(spark, 50, 300, seed=7)[1].collect())
    assert again == sorted(e)


def test_smallest_is_exact_against_sorting(spark, monkeypatch):
    monkeypatch.setattr(G, "_BUCKETS", 8)
    df = spark.range(5000).selectExpr("id", "(id * 7919) % 5003 as k")
    got = sorted(r.id for r in G.smallest(df, "k", 1234, 0, 5002).collect())
    want = sorted(r.id for r in df.orderBy("k").limit(1234).collect())
    assert got == want
    ties = spark.range(100).selectExpr("id", "id % 2 as k")
    assert sorted(r.id for r in G.smallest(ties, "k", 53, 0, 1, tie=["id"]).collect()) == sorted([*range(0, 100, 2), 1, 3, 5])


def test_generator_covers_large_id_ranges(spark):
    n = 4_000_000_000
    _, edges = G.random_graph(spark, n, 400)
    got = [(r.src, r.dst) for r in edges.collect()]
    assert len(set(got)) == 400 and max(s for s, _ in got) > 0.9 * n and max(d for _, d in got) > 0.9 * n
    with pytest.raises(ValueError):
        G.random_graph(spark, 1 << 60, 5)


def test_keyed_graphs_equal_single_ones(spark):
    for n, e in ((30, 120), (8, 50)):
        _, edges = G.random_graphs(spark, 3, n, e, 42)
        for i in range(3):
            one = sorted((r.src, r.dst) for r in G.random_graph(spark, n, e, seed=42 + i)[1].collect())
            assert sorted((r.src, r.dst) for r in edges.filter(f"graph_id = {i}").collect()) == one


def test_top_k_ties_side_by_side_and_jaccard(spark):
    ranks = spark.createDataFrame([(3, 0.2), (1, 0.2), (2, 0.5), (4, 0.1)], "id long, rank double")
    top = C.top_k(ranks, 3).collect()
    assert [(r.position, r.id) for r in top] == [(1, 2), (2, 1), (3, 3)]
    a = spark.createDataFrame([(1, i, 0.1) for i in range(1, 11)], "position long, id long, rank double")
    a = a.selectExpr("id as position", "id", "rank")
    b = spark.createDataFrame([(i, i + 9, 0.1) for i in range(1, 11)], "position long, id long, rank double")
    # One common id out of 19 distinct ids.
    assert C.jaccard(a, b).collect()[0].overlap == pytest.approx(1 / 19)
    empty = a.limit(0)
    assert C.jaccard(empty, empty).collect()[0].overlap == 0.0
    short = b.filter("position <= 4")
    pairs = C.side_by_side(a, short).collect()
    assert len(pairs) == 10 and sum(r.right_id is None for r in pairs) == 6
    assert C.mean_overlap(spark.createDataFrame([(0.0,), (0.5,)], "overlap double")).collect()[0].average_overlap == 0.25


def test_compare_rankings_batch(spark):
    edges = spark.createDataFrame(
        [("a", i, (i * 3 + 1) % 20) for i in range(20)] + [("b", i, (i + 1) % 15) for i in range(15)],
        "g string, src long, dst long",
    )
    nodes = GR.node_set(edges, ["g"])
    seeds = sample_seeds(nodes, ["g"], 5)
    assert {r.g: r["count"] for r in seeds.groupBy("g").count().collect()} == {"a": 5, "b": 5}
    cmp = compare_rankings(nodes, edges, keys=["g"], k=5)
    top = cmp.top.collect()
    assert len(top) == 20
    ppr_b = [r.id for r in sorted(top, key=lambda r: r.position) if r.g == "b" and r.mode == "personalized"]
    seeds_b = [r.id for r in seeds.filter("g = 'b'").collect()]
    want, _, _ = brute_rank(range(15), [(i, (i + 1) % 15) for i in range(15)], seeds=seeds_b)
    assert ppr_b == sorted(want, key=lambda i: (-round(want[i], 12), i))[:5]
    details = experiment_details(cmp, ["g"]).collect()
    assert len(details) == 2 and all(len(r.std_top_k) == 5 for r in details)
    assert cmp.summary.collect()[0].num_graphs == 2


def test_run_experiment_matches_brute_force(spark):
    from linkrank.operators.batch import run_experiment
    from linkrank.operators.generate import random_graph

    details, summary, seeds = run_experiment(spark, num_graphs=2, n=30, e=120, k=5)
    rows = {r.graph_id: r for r in details.collect()}
    assert sorted(rows) == [0, 1]
    overlaps = []
    for gid, r in rows.items():
        _, ge = random_graph(spark, 30, 120, seed=42 + gid)
        edges = [(x.src, x.dst) for x in ge.collect()]
        std, _, _ = brute_rank(range(30), edges)
        ppr, _, _ = brute_rank(range(30), edges, seeds=[s.id for s in seeds.filter(f"graph_id = {gid}").collect()])
        top = lambda w: sorted(w, key=lambda i: (-round(w[i], 9), i))[:5]
        assert [x.id for x in r.std_top_k] == top(std)
        assert [x.id for x in r.ppr_top_k] == top(ppr)
        a, b = set(top(std)), set(top(ppr))
        assert r.overlap_score == pytest.approx(len(a & b) / len(a | b))
        overlaps.append(r.overlap_score)
    s = summary.collect()[0]
    assert s.num_graphs == 2 and s.average_overlap == pytest.approx(sum(overlaps) / 2)


def test_check_graph_reports_each_problem(spark):
    nodes = spark.createDataFrame([(0,), (1,), (1,)], "id long")
    edges = spark.createDataFrame([(0, 1), (5, 0), (1, 7)], "src long, dst long")
    got = {r.problem: r.n for r in GR.check_graph(nodes, edges).collect()}
    assert got == {"duplicate node id": 1, "unknown source": 1, "unknown target": 1}


def test_seed_membership_and_teleport(spark):
    from linkrank.operators.seeding import all_known, seed_check, teleport

    nodes = spark.createDataFrame([(0,), (1,), (2,), (3,)], "id long")
    seeds = spark.createDataFrame([(1,), (3,), (9,)], "id long")
    assert {r.id: r.known for r in seed_check(seeds, nodes).collect()} == {1: True, 3: True, 9: False}
    assert not all_known(seeds, nodes) and all_known(seeds.filter("id < 5"), nodes)
    t = {r.id: r.teleport for r in teleport(nodes, seeds).collect()}
    assert t == {0: 0.0, 1: 0.5, 2: 0.0, 3: 0.5}
    assert {r.teleport for r in teleport(nodes).collect()} == {0.25}


@pytest.mark.parametrize("pieces, ordered", [(1 << 14, 1_000_000), (4, 3)])
def test_smallest_is_exact_with_ties_and_skew(spark, monkeypatch, pieces, ordered):
    monkeypatch.setattr(G, "_BUCKETS", pieces)
    monkeypatch.setattr(G, "_ORDERED", ordered)
    rows = [(i % 7 if i % 3 else 5, i) for i in range(300)] + [(10**15 + i, i) for i in range(50)] + [(0, -1)]
    df = spark.createDataFrame(rows, "k long, t long")
    for n in (0, 1, 50, 130, 200, 299, 301, 350, 351, 999):
        got = sorted((r.k, r.t) for r in G.smallest(df, "k", n, 0, 1 << 60, tie=["t"]).collect())
        assert got == sorted(rows)[:n], n


def test_smallest_passes_three_times(spark, tmp_path):
    """The sketch, one count and the result, whatever the number of rows asked for."""
    df = spark.range(20_000).selectExpr("pmod(xxhash64(id), 1L << 60) as k")
    for n in (10, 9_999, 19_000):
        counts = []
        original = type(df).groupBy
        try:
            type(df).groupBy = lambda self, *c, _o=original: (counts.append(c), _o(self, *c))[1]
            assert G.smallest(df, "k", n, 0, 1 << 60).count() == n
        finally:
            type(df).groupBy = original
        assert sum("b" in str(c) for c in counts) >= 1 and len(counts) <= 3
