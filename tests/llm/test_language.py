"""The byte network against plain loops and finite differences, and its accuracy on held-out texts."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkrank.llm import language as L
from linkrank.llm.hashing import text_blocks
from linkrank.llm.queries import op12_language_id

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, score double, held_out string, letters string"
SYLLABLES = {"aa": ["ka", "lo", "mi", "ru"], "bb": ["sch", "ung", "ter", "ö"], "cc": ["że", "ści", "ow", "rz"]}


def words(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "s", 0.5, "x", "y") for r in rows], COLUMNS).repartition(3)


def naive(net, raw):
    """Log probabilities of one window, filter by filter and place by place."""
    z = net.out_bias.astype("f8").copy()
    unit = 0
    for width, bank, bias in zip(L.WIDTHS, net.banks, net.biases, strict=True):
        for f in range(L.FILTERS):
            best = max(
                sum(float(net.embedding[raw[p + j], e]) * float(bank[j * L.EMBEDDING + e, f])
                    for j in range(width) for e in range(L.EMBEDDING))
                for p in range(len(raw) - width + 1)
            )
            z += max(best + float(bias[f]), 0.0) * net.out[unit]
            unit += 1
    return z - np.log(np.exp(z).sum())


def test_network_is_its_definition():
    net = L.Network.new(["a", "b", "c"], 4, 12)
    raw = np.random.default_rng(1).integers(0, 256, (3, 12)).astype("u1")
    for row, got in zip(raw, net.log_odds(raw, batch=2), strict=True):
        assert np.allclose(naive(net, row), got, atol=1e-4)


def test_gradients_are_finite_differences():
    net = L.Network.new(["a", "b", "c"], 4, 16)
    for name in ("embedding", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype("f8"))
    net.banks = [b.astype("f8") for b in net.banks]
    net.biases = [b.astype("f8") + 0.1 for b in net.biases]
    rng = np.random.default_rng(2)
    raw, label = rng.integers(0, 256, (5, 16)).astype("u1"), np.array([0, 1, 2, 1, 0])
    weight = np.array([1.0, 2, 1, 3, 1])

    def loss():
        _, top, _ = net.pooled(raw)
        z = top @ net.out + net.out_bias
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        return -(z[np.arange(5), label] * weight).sum() / weight.sum()

    for p, g in zip(net.parameters(), net.gradients(raw, label, weight), strict=True):
        flat, grad = p.reshape(-1), g.reshape(-1)
        for i in np.argsort(-np.abs(grad))[:4]:
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - grad[i]) < 1e-3 * max(1, abs(grad[i]))


@pytest.mark.parametrize("window", [8, 16])
def test_windows_cover_every_run_of_bytes(window):
    import pyarrow as pa

    rng = random.Random(3)
    texts = ["x" * n for n in range(40)] + [words(rng, "bb", 30)]
    for _, data, offsets in text_blocks(pa.array(texts)):
        rows, text, new = L.windows_of(data, offsets, window)
        assert np.bincount(text, new, len(texts)).tolist() == np.diff(offsets).tolist()
        for i in range(len(texts)):
            own = data[offsets[i] : offsets[i + 1]].tobytes()
            mine = [r.tobytes() for r in rows[text == i]]
            for width in L.WIDTHS:
                runs = {own[p : p + width] for p in range(len(own) - width + 1)}
                assert runs <= {m[p : p + width] for m in mine for p in range(window - width + 1)}


def test_learns_and_defined_results(spark):
    rng = random.Random(7)
    rows = [(i, words(rng, lang, rng.randrange(5, 60)), lang) for i, lang in enumerate(sorted(SYLLABLES) * 60)]
    odd = [
        (None, words(rng, "aa", 20), "bb"), (900, None, "aa"), (901, "", "aa"), (902, "123 ... !! 456", "bb"), (903, words(rng, "bb", 8), None),
        (904, words(rng, "cc", 200_000), "cc"), (905, words(rng, "aa", 9), "aa"), (905, words(rng, "aa", 9), "aa"),
    ]
    got = L.identify(docs_of(spark, rows + odd), max_docs=40, epochs=8)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = got.collect()
    assert len(found) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    held = [i for i, _, _ in rows if by_id[i].held_out]
    assert held == [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([by_id[i].lang_pred == rows[i][2] for i in held]) > 0.95
    assert [by_id[i].lang_pred for i in (900, 901, 902, 903, 904, 905)] == ["und", "und", "und", "bb", "cc", "aa"]
    assert [by_id[i].score for i in (900, 901, 902)] == [0.0, 0.0, 0.0]
    assert by_id[None].lang_pred == "aa" and not by_id[None].held_out
    again = L.identify(docs_of(spark, rows + odd), max_docs=40, epochs=8)
    assert sorted(map(str, again.collect())) == sorted(map(str, found))


def test_held_out_labels_are_not_read(spark):
    rng = random.Random(9)
    rows = [(i, words(rng, "aa", 20), "aa") for i in range(80)] + [(100 + i, words(rng, "bb", 20), "bb") for i in range(80)]
    lies = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    a, b = (L.train(docs_of(spark, r), epochs=1) for r in (rows, lies))
    assert a.languages == b.languages == ["aa", "bb"]
    assert all(np.array_equal(x, y) for x, y in zip(a.parameters(), b.parameters(), strict=True))


def test_bounds_of_the_sample(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, "aa", 400), "aa") for i in range(30)] + [(100, words(rng, "bb", 400), "bb")]
    got = L.sample(docs_of(spark, rows), 5, 3, 64, 1).groupBy("lang", "doc_id").count().collect()
    assert sum(r.lang == "aa" for r in got) == 5 and all(r["count"] <= 3 for r in got)


def test_no_languages_and_empty_table(spark):
    assert L.identify(docs_of(spark, [])).collect() == []
    one = L.identify(docs_of(spark, [(1, "text", None), (2, "more", None)])).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("und", 0.0)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_registered_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    got = op12_language_id(spark, SF).join(docs, "doc_id")
    assert got.count() == docs.count()
    right = F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))
    assert got.filter("held_out").agg(right).first()[0] > 0.9
