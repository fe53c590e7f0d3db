"""Spelling groups against a plain count and a comparison through deletions."""

import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from linkrank.llm import spelling as S
from linkrank.llm.queries import op13_spelling_variants

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(S.CAPITALS, S.SMALL)


def brute_words(rows, every=97):
    n = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_near(words):
    meet = defaultdict(set)
    for w in words:
        for v in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            meet[v].add(w)
    near = defaultdict(set)
    for group in meet.values():
        for a in group:
            near[a] |= {b for b in group if b != a and one_edit(a, b)}
    return near


def brute(rows, every=97):
    n = brute_words(rows, every)
    near = brute_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x.encode()), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: r[0])


def result(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted(map(tuple, rows), key=lambda r: r[0])


def family(rng, size):
    """Words that are edits of each other, chains of forms among them."""
    out = []
    for _ in range(size):
        w = "".join(rng.choices("abé", k=rng.randrange(5, 9)))
        for _ in range(rng.randrange(4)):
            out.append(w)
            i, c = rng.randrange(len(w)), rng.choice("abcÿ÷")
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :], w[:i] + c + w[i:]])
        out.append(w)
    return out


def texts(seed, size=120):
    rng = random.Random(seed)
    words = family(rng, size)
    return [
        (i, rng.choice([" ", ", ", "1", "\n"]).join(rng.choices(words, [1 / (j + 1) for j in range(len(words))], k=200)))
        for i in range(40)
    ]


ODD = [
    (None, "Lettering LETTERING lettering Ärger ÄRGER ärger"), (100, None), (101, ""), (102, "1234 -- …"),
    (103, "repeated repeated"), (103, "repeated repeated"), (103, "other repeatad repeatad repeatad"),
    (104, "tiedaa tiedaa tiedaa tiedbb tiedbb tiedbb " + "tiedab " * 3 + "tie " * 9), (105, ("x" * 3000 + " ") * 3 + ("x" * 2999 + " ") * 7),
    (106, "cafétal×÷ cafétal×÷ cafétal×÷ cafétal× cafétal× cafétal× 東京語"),
]


@pytest.mark.parametrize("options", [{}, {"qmin": 2, "qmax": 3, "least_limit": 5, "long_list": 1}, {"qmin": 3, "qmax": 6, "least_limit": 3, "long_list": 20}])
def test_groups_are_brute_force(spark, make_docs, options):
    rows = texts(1) + ODD
    got = result(S.spelling_groups(make_docs(rows, clash=True), 97, **options))
    want = brute(rows)
    assert got == want and any(r[1] not in (None, r[2]) for r in want)


def test_without_misspelling(spark, make_docs):
    rows = texts(2, 40)
    assert result(S.spelling_groups(make_docs(rows))) == brute(rows, None)


def test_a_hot_list(spark, make_docs):
    """Thousands of words that share a beginning of many places and differ behind it."""
    rng = random.Random(6)
    words = ["commonbeginning" + "".join(rng.choices("abcdefgh", k=rng.randrange(3, 6))) for _ in range(1500)]
    rows = [(i, " ".join(words)) for i in range(3)]
    distinct = spark.createDataFrame([(w, c) for w, c in brute_words(rows, None).items()], "word string, n long")
    want = {tuple(sorted((a, b))) for a, bs in brute_near([r.word for r in distinct.collect()]).items() for b in bs}
    for long_list in (1, 50, 10**9):
        got = S.near_pairs(distinct, long_list=long_list).collect()
        assert len(got) == len(want) and {tuple(sorted((r.a, r.b))) for r in got} == want


@pytest.mark.parametrize("qmin, qmax", [(2, 5), (2, 3), (3, 6)])
def test_an_edit_changes_no_more_grams_than_the_bound(qmin, qmax):
    rng = random.Random(qmax)
    known = family(rng, 300)
    p = S.Padded(pa.array(sorted(set(known))), qmax)
    rows = {}
    for q in range(qmin, qmax + 1):
        gram, n = np.unique(p.grams(p.places(q), q), return_counts=True)
        rows[q] = gram[n > 6], n[n > 6]
    frequent = S.Frequent(rows)

    def grams(word):
        one = S.Padded(pa.array([word]), qmax)
        w, at, length = S.decompose(one, frequent, qmin)
        bound = int(S.affected(one, w, at + length)[0])
        return Counter(zip(at.tolist(), one.grams(at, length).tolist(), strict=True)), bound

    for word in known[:400]:
        own, bound = grams(word)
        assert bound < sum(own.values())
        for _ in range(8):
            i, c = rng.randrange(len(word) + 1), rng.choice("abcé")
            edited = rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :], word[:i] + c + word[i:]])
            if edited == word or len(edited) < 2:
                continue
            other, _ = grams(edited)
            move = len(edited) - len(word)
            common = sum(1 for at, g in own if (at, g) in other or (at + move, g) in other)
            assert common >= sum(own.values()) - bound


def test_no_list_is_broadcast(spark, tmp_path):
    """The words are a small file, the lists made of them are not: estimates follow the file."""
    words = spark.createDataFrame([(f"wordly{i:05}", 3) for i in range(500)], "word string, n long")
    words.write.parquet(str(tmp_path / "words"))
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 1 << 20
    pairs = S.near_pairs(spark.read.parquet(str(tmp_path / "words")))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert pairs.count() == len([1 for i in range(500) for j in range(i) if one_edit(f"{i:05}", f"{j:05}")])


def test_empty_tables(make_docs):
    assert S.spelling_groups(make_docs([]), 97).collect() == []
    assert S.spelling_groups(make_docs([(1, "few words"), (2, None)]), 97).collect() == []


def test_long_chains_of_forms(spark):
    from linkrank.llm.common import Scratch

    forms = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(100)], "word string, form string")
    got = {r.word: r.root for r in S.roots(forms, Scratch(spark)).collect()}
    assert got == {f"w{i:03}": "w100" for i in range(100)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_registered_query_is_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op13_spelling_variants(spark, SF)) == brute(rows)
