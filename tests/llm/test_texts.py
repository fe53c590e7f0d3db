"""Operators on texts against brute force, with nulls, empty and long texts, ties, repeated rows and clashing names."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from llm_helpers import Union, prose, shingles, words

from linkrank.llm.line_dedup import drop_repeated_lines, line_dedup
from linkrank.llm.ngram_join import keep_one, ngram_classes
from linkrank.llm.paragraph_dedup import paragraph_dedup
from linkrank.llm.suffix_dedup import SuffixIndex, substring_dedup, suffix_array

BLANKS = str.maketrans("\t\v\f\r", "    ")


def edge_rows(rng):
    passage = prose(rng, 90)
    long_text = prose(rng, 9000, 30000)
    base = [prose(rng, rng.randrange(5, 160)) for _ in range(25)]
    rows = list(enumerate(base))
    rows += [(100 + i, t) for i, t in enumerate(base[:6])]  # copies
    for i, t in enumerate(base[:12]):  # one word replaced, added or left out
        w = t.split(" ")
        j = rng.randrange(len(w))
        w[j : j + 1] = [["new"], ["new", w[j]], []][i % 3]
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, f"{prose(rng, 12)} {passage} {prose(rng, 12)}") for i in range(5)]
    rows += [(400, None), (401, ""), (402, " \t\n "), (None, base[0]), (None, None), (403, long_text), (404, long_text + " x")]
    rows += [(405, "é" * 150 + "ß" * 150), (406, "z" + "é" * 150 + "ß" * 150), (407, "ab" * 400), (408, "a" * 500)]
    rows += [(409, "one two"), (410, "one two"), (0, base[0])]  # short ties, and a repeated row
    return rows


def brute_lines(rows, min_words=5, near_words=10):
    """``{(id, text): kept text}``."""

    def near(a, b):
        p = s = 0
        m = min(len(a), len(b))
        while p < m and a[p] == b[p]:
            p += 1
        while s < m and a[-1 - s] == b[-1 - s]:
            s += 1
        return abs(len(a) - len(b)) <= 1 and p + s >= max(len(a), len(b)) - 1

    first, order = {}, []
    known = sorted({(i, t) for i, t in rows if i is not None and t is not None})
    places = sorted((i, n, line) for i, t in known for n, line in enumerate(t.split("\n")))
    norm = lambda line: tuple(line.translate(BLANKS).strip(" ").split(" "))
    for i, n, line in places:
        w = norm(line)
        if len(w) >= min_words and w not in first:
            first[w] = (i, n)
            order.append(w)
    order.sort(key=first.get)
    gone = {w for k, w in enumerate(order) if len(w) >= near_words and any(len(v) >= near_words and near(w, v) for v in order[:k])}
    out = {}
    for i, t in known:
        lines = t.split("\n")
        out[i, t] = "\n".join(
            x for n, x in enumerate(lines) if len(norm(x)) < min_words or (norm(x) not in gone and first[norm(x)] == (i, n))
        )
    return out


@pytest.mark.parametrize("seed", [1])
def test_lines(spark, make_docs, seed):
    rows = edge_rows(random.Random(seed))
    got = line_dedup(make_docs(rows, clash=True)).collect()
    want = brute_lines(rows)
    assert len(got) == len(rows)
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(i for i, _ in rows)
    by_id = {i: t for i, t in rows if i is not None}
    for r in got:
        if r.doc_id is not None and by_id[r.doc_id] is not None:
            t = by_id[r.doc_id]
            assert r.text == want[r.doc_id, t]
            assert r.n_lines == len(t.split("\n"))
            assert r.n_removed == r.n_lines - (len(r.text.split("\n")) if r.text or not r.n_removed else 0) or r.text == ""
    assert {r.text for r in got if r.doc_id is None} == {rows[0][1], None}
    assert next(r for r in got if r.doc_id == 400).n_lines == 0
    kept = drop_repeated_lines(make_docs(rows, clash=True))
    assert kept.columns == make_docs(rows, clash=True).columns
    assert sorted(repr((r.doc_id, r.text)) for r in kept.collect()) == sorted(repr((r.doc_id, r.text)) for r in got)
    assert line_dedup(make_docs([])).count() == 0


def test_lines_run_without_python(spark, make_docs):
    plan = drop_repeated_lines(make_docs([(1, "a b c d e f")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_ngram_classes(spark, make_docs):
    rows = edge_rows(random.Random(2))
    docs = make_docs(rows, clash=True)
    got = {r.doc_id: r for r in ngram_classes(docs).collect()}
    texts = {i: t for i, t in rows if i is not None}
    sets = {i: shingles(t) for i, t in texts.items()}
    union, links = Union(), collections.Counter()
    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if 9 * common >= 4 * (len(sets[a]) + len(sets[b])):
                links[a] += 1
                links[b] += 1
                union.join(a, b)
    assert set(got) == {i for i, _ in rows}
    for i in texts:
        assert got[i].class_id == union.root(i), i
        assert got[i].n_links == links[i], i
        assert got[i].kept == (union.root(i) == i)
    assert got[None].kept and got[None].n_links == 0
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert collections.Counter(ids) == collections.Counter(
        [i for i in texts if union.root(i) == i] + [i for i, _ in rows if i is None]
    )
    assert ngram_classes(make_docs([])).count() == 0


def test_ngram_blocks_split_a_large_family(spark, make_docs):
    from linkrank.llm import similar

    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        w[rng.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    docs = make_docs(rows)
    before = similar.verified.__defaults__
    similar.verified.__defaults__ = (20, 1000)
    try:
        got = ngram_classes(docs).collect()
    finally:
        similar.verified.__defaults__ = before
    assert {r.class_id for r in got} == {0} and {r.n_links for r in got} == {89}


def brute_bytes(rows, length=200):
    seen = collections.Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        seen.update(b[k : k + length] for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        cover = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                cover[k : k + length] = [True] * length
        kept = bytes(x for x, c in zip(b, cover) if not c)
        spans = sum(c and not (k and cover[k - 1]) for k, c in enumerate(cover))
        out.append((i, len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_rows", [2048, 2])
def test_suffix_dedup(spark, make_docs, slice_rows):
    rows = edge_rows(random.Random(3))
    got = substring_dedup(make_docs(rows, clash=True, partitions=5), slice_rows=slice_rows).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr)
    assert got == brute_bytes(rows)


def test_suffix_index_levels_merge_geometrically(spark, make_docs):
    assert substring_dedup(make_docs([])).count() == 0
    index = SuffixIndex(spark)
    rng = random.Random(4)
    sizes = []
    text = prose(rng, 200)
    for i in range(5):
        docs = make_docs([(i, prose(rng, 300) + text)], partitions=1).withColumn("chunk", F.lit(i).cast("long"))
        array = suffix_array(docs).cache()
        matches = index.add(array)
        sizes.append([n for n, _ in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
    # The shared text is found across all levels and the new batch.
    assert matches.filter("equal").count() > 0
    index.scratch.release()


def test_near_short_lines(spark, make_docs):
    lines, rows = {}, []  # more recall than by default: about the bound, not the chance of the bands
    for n in range(8, 14):  # a word added at either end, or one replaced in the middle
        for k in range(8):
            line = [f"n{n}k{k}w{i}" for i in range(n)]
            other = [[*line, "more"], ["more", *line], [*line[: n // 2], "other", *line[n // 2 + 1 :]]][k % 3]
            i = len(rows)
            lines[i + 1] = (line, other)
            fresh = "\n".join(" ".join(f"f{i}r{r}w{w}" for w in range(6)) for r in range(2))
            rows += [(i, " ".join(line) + "\n" + fresh), (i + 1, " ".join(other) + "\n" + fresh.replace("r", "s"))]
    got = {r.doc_id: r for r in paragraph_dedup(make_docs(rows), recall=0.999999, min_words=8).collect()}
    for i, (line, other) in lines.items():
        a, b = shingles(" ".join(line)), shingles(" ".join(other))
        near = len(a & b) >= 0.8 * len(a | b)
        assert not got[i - 1].n_removed
        assert got[i].n_removed == near * len(" ".join(other)), (line, other)


def brute_passages(rows, size=20):
    """``{id: removed words}``: windows of ``size`` words that stand earlier, too, but for the words of that earlier one."""
    first, out = {}, {}
    for i, text in sorted(rows):
        w = words(text)
        gone = [False] * len(w)
        for a in range(len(w) - size + 1):
            d, b = first.setdefault(tuple(w[a : a + size]), (i, a))
            if (d, b) != (i, a):
                begin = max(a, b + size) if d == i else a
                gone[begin : a + size] = [True] * (a + size - begin)
        out[i], run = [], []
        for word, g in zip([*w, None], [*gone, False], strict=True):
            if g:
                run.append(word)
            else:
                out[i] += run if len(run) >= size else []
                run = []
    return out


def test_passages_inside_sentences(spark, make_docs):
    rng = random.Random(26)
    fresh = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    rows = []
    for n in [19, 20, 21, 25, 35, 50, 60, 88] * 3:  # no sentence or line begins or ends with the passage
        passage = fresh(n)
        for _ in range(rng.randrange(2, 5)):
            rows.append((len(rows), f"{fresh(60 + rng.randrange(40))} {passage} {fresh(90)}"))
    long = fresh(300).split()
    for _ in range(30):  # cuts that overlap each other
        a = rng.randrange(270)
        rows.append((len(rows), f"{fresh(130)} {' '.join(long[a : a + rng.randrange(15, 120)])} {fresh(130)}"))
    rows += [(len(rows) + i, f"{fresh(99)} {'and ' * n}{fresh(99)}") for i, n in enumerate((30, 50, 70, 41))]
    rows += [(len(rows), f"{fresh(80)} {'one two three ' * 30}{fresh(50)}"), (len(rows) + 1, f"{fresh(70)} {fresh(30)} é")]
    rows += [(len(rows), f"{fresh(9)} {(p := fresh(40))} {fresh(60)} {p} {fresh(9)}")]  # twice in one document
    rows += [rows[5], (None, rows[7][1]), (len(rows) + 5, None)]
    want = brute_passages({r for r in rows if r[0] is not None and r[1]})
    got = {r.doc_id: r for r in paragraph_dedup(make_docs(rows, partitions=7)).collect()}
    for i, text in rows:
        if i is not None and text:
            taken = b" ".join(text.encode()[s.start : s.end] for s in got[i].spans).decode()
            assert words(taken) == want[i], i
    assert not got[None].n_removed and sum(map(len, want.values())) > 2000


def test_paragraphs(spark, make_docs):
    rng = random.Random(6)
    fresh = [prose(rng, 120, 100000) for _ in range(20)]
    passage = prose(rng, 70, 100000).replace("\n", " ")
    line = " ".join(f"q{i}" for i in range(60))
    near = line.replace("q20", "other")
    rows = list(enumerate(fresh))
    rows += [(50 + i, f"{prose(rng, 20, 100000)} {passage} {prose(rng, 20, 100000)}") for i in range(4)]
    rows += [(60, prose(rng, 30, 100000) + "\n" + line), (61, prose(rng, 30, 100000) + "\n" + near)]
    rows += [(70, fresh[3]), (80, None), (81, ""), (None, fresh[4]), (3, fresh[3]), (82, prose(rng, 8000, 100000))]
    got = {r.doc_id: r for r in paragraph_dedup(make_docs(rows, clash=True)).collect()}
    text = {i: (t or "").encode() for i, t in rows if i is not None}
    taken = {i: b" ".join(text[i][s.start : s.end] for s in got[i].spans).decode() for i in text}
    assert all(not got[i].n_removed for i in range(20)), "clean and first documents stay"
    assert not got[50].n_removed
    for i in (51, 52, 53):  # whole sentences of the passage, but nothing else
        assert len(words(taken[i])) >= 40
        assert set(words(taken[i])) <= set(words(passage))
    assert not got[60].n_removed and taken[61] == near
    # Short lines at the ends may stay, all that is long enough goes.
    assert got[70].n_removed > 0.8 * got[70].n_bytes
    assert not got[80].n_removed and not got[81].n_removed and not got[82].n_removed and not got[None].n_removed
    assert paragraph_dedup(make_docs([])).count() == 0


def test_keep_one_loses_no_text(spark, make_docs):
    """Repeated ids with different texts: each distinct text has a row, or a near text that counts."""
    from linkrank.llm import ngram_join

    rng = random.Random(31)
    a, b, c = (prose(rng, 60, 3000) for _ in range(3))
    rows = [(3, a + " tail"), (5, a), (5, b), (7, b), (8, c), (8, c), (8, None), (9, ""), (9, " "), (None, c)]
    for k in range(4):
        kept = ngram_join.keep_one(make_docs(rows, clash=True, partitions=1 + k)).collect()
        texts = [(r.doc_id, r.text) for r in kept]
        # Of id 5 the lesser of both texts counts; the other one stands on 7 or stays on its own.
        assert (3, a + " tail") in texts and any(t == b for _, t in texts) and (None, c) in texts
        assert [t for t in texts if t[0] == 8] == [(8, c)]
        assert len(texts) == len(set(texts))
    odd = [(1, a), (1, b), (1, c), (2, c)]
    kept = [(r.doc_id, r.text) for r in ngram_join.keep_one(make_docs(odd)).collect()]
    assert sorted(t for _, t in kept) == sorted([a, b, c])


def test_repeated_ids_count_one_text(spark, make_docs):
    from linkrank.llm import ngram_join, paragraph_dedup

    rng = random.Random(32)
    a, b, tail = prose(rng, 40, 3000), prose(rng, 40, 3000), prose(rng, 30, 3000)
    low, high = sorted([a + "\n" + tail, b])
    rows = [(1, a + "\n" + tail), (1, b), (2, tail), (3, a + "\n" + tail)]
    one = [(1, low), (2, tail), (3, a + "\n" + tail)]
    for operator in (paragraph_dedup.paragraph_dedup, ngram_join.ngram_classes):
        assert sorted(map(str, operator(make_docs(rows)).collect())) == sorted(map(str, operator(make_docs(one)).collect()))


def test_suffix_chunks_do_not_depend_on_the_split(spark, make_docs, tmp_path):
    """Both scans of op2 agree on the chunks when files are split differently in between."""
    from linkrank.llm import suffix_dedup

    rng = random.Random(33)
    shared = prose(rng, 80, 3000)
    rows = [(i, prose(rng, 40, 3000) + (" " + shared if i % 3 == 0 else "")) for i in range(400)]
    path = str(tmp_path / "docs")
    make_docs(rows, partitions=2).write.option("parquet.block.size", 1 << 14).parquet(path)
    docs = spark.read.parquet(path)
    want = None
    key = "spark.sql.files.maxPartitionBytes"
    kept, original = spark.conf.get(key), suffix_dedup.SuffixIndex.add
    try:
        for second in ("16k", "128m"):
            spark.conf.set(key, "128m")

            def add(self, array, second=second):
                spark.conf.set(key, second)
                return original(self, array)

            suffix_dedup.SuffixIndex.add = add
            got = suffix_dedup.substring_dedup(docs, written=True).select("doc_id", "n_removed", "kept_sha256")
            got = sorted(map(tuple, got.collect()))
            assert sum(r[1] for r in got) > 0
            assert want in (None, got)
            want = got
    finally:
        suffix_dedup.SuffixIndex.add = original
        spark.conf.set(key, kept)


def test_a_text_is_split_once_not_for_every_line_that_stays(spark, make_docs):
    """Inside the function that takes lines by number there is no split of the whole text."""
    docs = line_dedup(make_docs([(1, "a b c d e\nx\ny"), (2, "a b c d e\nz")]))
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    taken = [part.split("lambdafunction(")[1] for part in plan.split("transform(")[1:]]
    assert taken and not any(part.startswith("get(split(") for part in taken), plan
    assert {r.doc_id: r.text for r in docs.collect()} == {1: "a b c d e\nx\ny", 2: "z"}
