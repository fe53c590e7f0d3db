"""Mixing, tokens, toxicity, URLs and the pipeline."""

import collections
import hashlib
import math
import os
import random

import pytest
from llm_helpers import Union, prose, shingles, words
from pyspark.sql import functions as F

from linkrank.llm.mixing import apply_mix, mix
from linkrank.llm.toxicity import keep_clean, toxicity
from linkrank.llm.url_filter import url_verdicts

SF = "/root/testdata/sf0.001"


def brute_targets(size, weights=(3, 1, 2)):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [s for s in size if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(size.values()), {}, set(names)
    while open_:
        share = {s: left * w[s] / sum(w[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix(spark, make_docs):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        source = rng.choice(["a", "a", "a", "b", "c", "é", "", None, "z"])
        rows.append((i, prose(rng, rng.randrange(0, 60)) if rng.random() < 0.97 else None, source))
    rows += [(1000, "", "empty"), (1001, None, "empty"), (1002, prose(rng, 300), "b"), rows[5], rows[5], (None, "x y", "a")]
    docs = make_docs(rows, clash=True)
    got = mix(docs, slice_rows=16).collect()
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    target = brute_targets(size)
    assert len(got) == len(rows)
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source])
    for s in size:
        assert abs(taken[s] - target[s]) <= max(3, 0.01 * target[s]), s
    again = sorted((r.doc_id or -1, r.copies) for r in mix(docs, slice_rows=16).collect())
    assert again == sorted((r.doc_id or -1, r.copies) for r in got)
    out = apply_mix(docs)
    assert out.columns == docs.columns
    # A repeated row is taken as often as the larger of its decisions, each time.
    once = {i for i, n in collections.Counter(r[0] for r in rows).items() if n == 1}
    copies = {r.doc_id: r.copies for r in mix(docs).collect()}
    seen = collections.Counter(r.doc_id for r in out.collect())
    assert all(seen[i] == copies[i] for i in once)
    assert mix(make_docs([])).count() == 0 and apply_mix(make_docs([])).count() == 0


def test_rates_solve_the_dual(spark, make_docs):
    """Rates against bisection: a capped source, one that shrinks, one that grows, very long documents."""
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(0, 80)), "aaaabccc"[i % 8]) for i in range(240)]
    rows += [(900, prose(rng, 6000), "a"), (901, prose(rng, 6000), "b"), (902, None, "c"), (903, "", "d")]
    rates = {}
    for r in mix(make_docs(rows)).collect():
        rates.setdefault(r.source, []).append((r.size, r.rate, r.target, r.source_size))
    kinds = set()
    for found in rates.values():
        target, total = found[0][2], found[0][3]
        sizes = [s for s, *_ in found]
        if not total:
            assert all(rate == 0 for _, rate, *_ in found)
            continue
        if target >= 2 * total * (1 - 1e-9):
            kinds.add("full")
            assert all(rate == 2 for _, rate, *_ in found)
            continue
        kinds.add("more" if target > total else "fewer")
        low, high = -100.0, 100.0
        for _ in range(300):
            at = (low + high) / 2
            got = sum(s * min(2.0, math.exp(min(50.0, at * s))) for s in sizes)
            low, high = (at, high) if got < target else (low, at)
        for s, rate, *_ in found:
            assert rate == pytest.approx(min(2.0, math.exp(min(50.0, at * s))), rel=1e-5, abs=1e-9)
    assert kinds == {"full", "fewer", "more"}


def test_mix_with_a_tilt_and_without_python(spark, make_docs, monkeypatch):
    from linkrank.llm import mixing

    rng, plans, cut = random.Random(2), [], mixing.cut
    monkeypatch.setattr(mixing, "cut", lambda df: (plans.append(df), cut(df))[1])
    docs = make_docs([(i, prose(rng, 5 + i % 70), "ab"[i % 3 == 0]) for i in range(300)])
    out = mix(docs, tilt=0.5)
    assert len(plans) > 5
    for df in [*plans, out]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    taken, target = collections.Counter(), {}
    for r in out.collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in target)


def test_bpe_equals_the_library(spark, make_docs):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from linkrank.llm.bpe import encode_decode

    path = public.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(3)
    pool = "abcABC'stremvldST  \n\t0123!?.,'’“éÉßñİΣςſK\u0308\u030a\u200b\xa0\x1c\x85　中文字ｶﾞ½Ⅷ😀\U000e0001ำ한ǅ"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(150)]
    texts += ["", None, "   ", "<|endoftext|>a<|startoftext|>", "we're 'S x''s don'tt", "<|endoftext|", prose(rng, 20000, 9000)]
    rows = list(enumerate(texts)) + [(None, "null id"), (3, texts[3])]
    got = encode_decode(make_docs(rows, clash=True), path).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert encode_decode(make_docs([]), path).count() == 0


def toxic_rows(seed, n=500):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        t = prose(rng, rng.randrange(30, 120), 3000)
        bad = rng.random() < 0.3
        if bad:
            w = t.split(" ")
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "nasty", "dummox", "loweiter", "loweisch"]))
            t = " ".join(w)
        docs.append((i, t))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity(spark, make_docs):
    rows, labels = toxic_rows(4)
    rows += [(2000, None), (2001, ""), (2002, "..."), (None, rows[0][1]), (2003, prose(random.Random(9), 9000, 3000)), rows[1]]
    lab = spark.createDataFrame(
        [(i, None, t) for i, t in labels] + [(3, 1, None), (None, 1, 1), (99999, 0, 1)], "doc_id long, quality int, toxic int"
    )
    docs = make_docs(rows, clash=True)
    got = toxicity(docs, lab).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80
    right = sum(r.predicted == truth[r.doc_id] for r in held) / len(held)
    assert right >= 0.95
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if r.doc_id in (2000, 2001, 2002))
    assert next(r for r in got if r.doc_id == 2003).predicted == 0
    text = {i: t.encode() for i, t in rows if i is not None and t}
    named = [text[r.doc_id][r.worst_start : r.worst_end].decode() for r in held if r.predicted and truth[r.doc_id]]
    hits = sum(any(w in s for w in ("vile", "nasty", "dummox", "lowei")) for s in named)
    assert hits >= 0.95 * len(named), "the worst sentence holds the offence"
    kept = keep_clean(docs, lab)
    assert kept.columns == docs.columns
    flagged = collections.Counter(r.doc_id for r in got if not r.predicted)
    assert collections.Counter(r.doc_id for r in kept.collect()) == flagged
    assert {r.score for r in toxicity(docs, lab.limit(0)).collect()} == {0.0}
    assert toxicity(make_docs([]), lab).count() == 0


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def test_urls(spark):
    link = '<html><head><LINK href="{}" rel="canonical"></head>'
    hop = '<meta http-equiv="Refresh" content="0; url={}">'
    rows = [
        (1, "http://A.Net/x?q#f", None), (2, "https://x.example.net/en/1", ""), (3, "example.net/en/", "x"), (4, None, "x"),
        (5, "http://www.Example.com/de/1", "x"), (6, "http://example.com/en/", "x"), (7, "http://a.org/fr/1", "x"),
        (8, "http://notnet/", "x"), (9, "http://net", "x"), (10, "x://b.example.net/en", "x"),
        (11, "http://mirror.io/a", link.format("http://a.net/x?q")), (12, "http://mirror.io/b", hop.format("http://mirror.io/a")),
        (13, "http://m.org/fr/2", hop.format("/../b")), (14, "http://mirror.io/c", hop.format("/b")),
        (15, "http://fine.io/a", link.format("http://fine.io/b")), (1, "http://A.Net/x?q#f", None), (16, "://", ""), (17, "", ""),
        (18, "http://m.org/fr/2", hop.format("http://mirror.io/a")),
    ]
    pages = spark.createDataFrame([r + (0, "c") for r in rows], "page_id long, url string, html string, node int, component string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(pages, RULES).collect()}
    assert got[1] == ("a.net", "/x", "net/", "block") and got[2] == ("x.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3] == ("", "", None, "allow") and got[4] == ("", "", None, "allow")
    assert got[5][2:] == ("example.com/de/", "block") and got[6][2:] == (None, "allow") and got[7][2:] == ("org/fr/", "allow")
    assert got[8][2:] == (None, "allow") and got[9] == ("net", "", None, "allow") and got[10][2:] == ("net/", "block")
    assert [got[i][2:] for i in (11, 12, 14)] == [(None, "block")] * 3, "aliases of a blocked page"
    assert got[15][3] == "allow" and got[16][:2] == ("", "") and got[17][:2] == ("", "")
    assert got[13][2:] == got[18][2:] == ("org/fr/", "allow"), "an explicit allow comes before the alias's block"
    assert url_verdicts(pages, RULES).count() == len(rows)
    extra = spark.createDataFrame([("http://fine.io/a", "http://a.net/x?q")], "url string, target string")
    assert {r.page_id: r.verdict for r in url_verdicts(pages, RULES, extra).collect()}[15] == "block"
    assert url_verdicts(pages.limit(0), RULES).count() == 0


def test_urls_relative_targets(spark):
    from urllib.parse import urljoin

    from linkrank.llm.url_filter import resolved

    bases = ["http://h.io/a/b/c?q=1", "http://h.io", "http://h.io/", "http://h.io/a/", "http://h.io/a?u=x/y"]
    targets = ["i.php", "../a", "../../../z/", "?id=3", "./", "..", ".", "a/./b/../c?x=../y", "/r/../s", "//o.org/p", "x/y",
               "http://o.org/q", "i?u=http://o.org/", "#top"]
    pairs = spark.createDataFrame([(b, t) for b in bases for t in targets], "url string, to string")
    for r in pairs.withColumn("got", resolved(F.col("url"), F.col("to"))).collect():
        want = urljoin(r.url, r.to).split("://", 1)[1]
        assert r.got.split("://", 1)[1].rstrip("/") == want.rstrip("/"), r
    assert pairs.select(resolved(F.col("url"), F.lit("mailto:a@h.io")).alias("x")).distinct().collect() == [(None,)]

    link = '<link rel="canonical" href="{}">'.format
    rows = [
        (1, "http://h.io/good/p", link("../bad/x")), (2, "http://h.io/good/bad/q", link("p")),
        (3, "http://h.io/q?id=1", link("?id=3")), (4, "http://h.io/q?id=3", link("bad/y?u=http://o.org/")),
        (5, "http://h.io/good/r", link("s")), (6, "http://h.io/good/s", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_verdicts(pages, [("block", "h.io/bad/")]).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "allow"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_pipeline_stages_against_brute_force(spark, tmp_path):
    public = pytest.importorskip("public_tokenizers")
    from test_texts import brute_lines
    from tokenizers import Tokenizer

    import corpus_pipeline

    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF).write.parquet(f"{tmp_path}/{i}")
        tables.append(spark.read.parquet(f"{tmp_path}/{i}"))
    assert all(t.columns == docs.columns and t.dtypes == docs.dtypes for t in tables[1:-1])
    rows = [[(r.doc_id, r.text) for r in t.collect()] for t in tables[:-1]]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = [r.doc_id for r in toxicity(docs, labels).collect() if not r.predicted]
    assert sorted(i for i, _ in rows[1]) == sorted(clean)
    want = brute_lines(rows[1])
    assert sorted(rows[2]) == sorted((i, want[i, t]) for i, t in rows[1])
    union, sets = Union(), {i: shingles(t) for i, t in rows[2]}
    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
                union.join(a, b)
    assert sorted(rows[3]) == sorted((i, t) for i, t in rows[2] if union.root(i) == i)
    copies = {r.doc_id: r.copies for r in mix(tables[3]).collect()}
    assert collections.Counter(i for i, _ in rows[4]) == collections.Counter({i: n for i, n in copies.items() if n})
    library = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows[4]}
    digest = {i: hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for i, x in ids.items()}
    got = [(r.doc_id, r.n_tokens, r.ids_sha256) for r in tables[-1].collect()]
    assert sorted(got) == sorted((i, len(ids[i]), digest[i]) for i, _ in rows[4])
    run = [(r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(run) == sorted(got)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_url_query_matches_its_sql(spark):
    import duckdb

    from linkrank.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    con.sql(f"create view pages as select * from read_parquet('{SF}/pages.parquet')")
    rel = con.sql(ORACLE_SQL["op8_url_filter"])
    want = sorted(map(repr, (dict(zip(rel.columns, r)) for r in rel.fetchall())))
    got = QUERIES["op8_url_filter"](spark, SF).select(rel.columns)
    assert sorted(repr(r.asDict()) for r in got.collect()) == want
    assert F is not None


def test_url_sql_states_the_rules_of_links(spark, tmp_path):
    """Relative, query-only, absolute and dotted targets through the registered query and its SQL."""
    import duckdb

    from linkrank.llm.queries import ORACLE_SQL, op8_url_filter

    link, hop = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; URL={}">'
    targets = [
        "../bad", "./bad", "bad", "/bad/x", "?q=1", "?q=1#f", "#f", "//a.net/x", "http://a.net/x", "mailto:x@a.net", "../../../..", "a/./b/../c",
        "a/b/..", ".", "..", "http://example.com/de/1", "https://b.org/fr/1", "x//y", "?", "/../bad/x",
    ]
    bases = ["http://h.io/p/q/page?z=1", "http://h.io", "http://H.io/p/", "no scheme", "http://a.net/p/q/r", "http://example.com/fr/x"]
    rows = [(i, b, (link if i % 2 else hop).format(t)) for i, (b, t) in enumerate((b, t) for b in bases for t in targets)]
    more = ["http://h.io/p/bad", "http://h.io/bad/x", "http://h.io/p/q/page?q=1", "http://a.net/x", "http://h.io/p/", "http://h.io/", "http://h.io/p/q/bad"]
    rows += [(1000 + i, u, None) for i, u in enumerate(more)] + [(2000, None, link.format("http://a.net/x"))]
    rows += [(3000, "http://h.io/p/bad", hop.format("http://z.net/1")), (3001, "http://c.org/de/1", link.format("../../de/2?x"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(tuple, op8_url_filter(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.sql(f"select page_id, host, path, rule, verdict from ({ORACLE_SQL['op8_url_filter']})").fetchall())
    assert got == want
    spread = [v for i, _, _, r, v in got if r is None]
    assert spread.count("block") > 5 and spread.count("allow") > 5
