import math
import random

import numpy as np
from llm_helpers import Union

from linkrank.llm.vector_dedup import near_vectors
from linkrank.llm.vector_search import exact_nearest, nearest
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, node long, id string, v int"


def rows(seed, clusters=12, dim=32):
    rng = np.random.default_rng(seed)
    out, i = [], 0
    for c in range(clusters):
        center = rng.standard_normal(dim)
        for _ in range(1 + 3 * (c % 5)):
            out.append((i, (center + 0.3 * rng.standard_normal(dim) * (c % 3)).astype("f4").tolist()))
            i += 1
    out += [(i + k, v) for k, v in enumerate(
        [None, [], [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] + [1.0] * (dim - 1),
         [None] + [1.0] * (dim - 1), [1.0] * (dim - 1), out[0][1], [x * 7 for x in out[1][1]]]
    )]
    out.append((None, out[2][1]))
    out.append(out[3])  # a repeated row
    return [(a, b, 1, 5, "x", 2) for a, b in out]


def usable(v, dim=32):
    return v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_near_vectors_match_brute_force(spark):
    data = rows(1)
    df = spark.createDataFrame(data, SCHEMA)
    vec = {r[0]: np.array(r[1]) for r in data if r[0] is not None and usable(r[1])}
    unit = {k: v / np.linalg.norm(v) for k, v in vec.items()}
    union, links = Union(), dict.fromkeys(vec, 0)
    ids = sorted(vec)
    for a in ids:
        for b in ids:
            if a < b and float(unit[a] @ unit[b]) >= 0.9:
                links[a] += 1
                links[b] += 1
                union.join(a, b)
    assert sum(links.values()) > 20
    for options in ({}, {"cell_rows": 7, "max_pivots": 4, "tile": 5, "block_dims": 8}):
        got = {r.vec_id: r for r in near_vectors(df, **options).collect()}
        assert set(got) == {r[0] for r in data}
        for k in got:
            if k is None:
                assert got[k].n_links == 0 and got[k].component_id is None and got[k].kept
                continue
            assert got[k].n_links == links.get(k, 0)
            assert got[k].component_id == union.root(k) and got[k].kept == (union.root(k) == k)
    assert near_vectors(df.limit(0)).count() == 0


def test_vectors_are_dealt_out_once(spark, monkeypatch):
    """Each lives in one slice; slices that meet are read again, neither sent as copies nor broadcast."""
    from linkrank.llm import vector_dedup

    tables, plans = [], []

    def kept(df, cut=vector_dedup.cut):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        tables.append(cut(df))
        return tables[-1]

    monkeypatch.setattr(vector_dedup, "cut", kept)
    rng = np.random.default_rng(4)
    v = rng.standard_normal((300, 32)).astype("f4")
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    assert near_vectors(df, cell_rows=20).count() == 300
    dealt, found = plans
    assert "Exchange" not in found and "CartesianProduct" in found, found
    ids = np.concatenate([np.frombuffer(r.ids, "i8") for r in tables[0].collect()])
    assert tables[0].count() >= 15 and sorted(ids.tolist()) == list(range(300))


def test_nearest_reaches_the_recall(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((600, 64)).astype("f4")
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = nearest(df, F.col("id") % 50 == 0, chunk_rows=100, block_queries=5).collect()
    queries = [i for i in range(600) if i % 50 == 0]
    want = exact_nearest(np.arange(600), v, queries)
    found = {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in queries}
    assert all(len(found[q]) == 5 for q in queries)
    assert sum(len(set(found[q]) & set(want[q])) for q in queries) >= 0.9 * 5 * len(queries)
    u = v.astype("f8") / np.linalg.norm(v.astype("f8"), axis=1, keepdims=True)
    assert all(abs(r.score - float(u[r.query_id] @ u[r.vec_id])) < 1e-12 for r in got)


def test_nearest_skips_unusable_vectors_and_breaks_ties_by_id(spark):
    data = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (100, [float("nan"), 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id) for r in nearest(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 1), (50, 2, 2), (50, 3, 0)]
    assert nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_components(spark):
    from linkrank.llm.common import components

    rng = random.Random(3)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)] + [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 240)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    df = spark.createDataFrame(edges + [(5, None), (None, None)], "src long, dst long")
    for finish in (0, 1000):
        got = {r.node: r.component for r in components(df, finish=finish).collect()}
        assert got == {x: union.root(x) for e in edges for x in e if any(a != b and x in (a, b) for a, b in edges)}
    assert components(df.limit(0)).count() == 0
