"""Toxicity by multiple-instance learning: labels on documents, scores on sentences.

A sentence has probability ``sigmoid(b + sum of the weights of its features)``; a
document is toxic if any of its sentences is, ``1 - prod(1 - p)`` (noisy-or). The weights are
trained from document labels alone, so the same model names the offending sentences.
Features are words and their beginnings of 3 to 7 bytes (inflected forms share them);
case is folded for ASCII and Latin-1 letters.

Training uses a bounded sample of labelled rows (``max_toxic``, ``max_clean``, taken in the order
of a hash of the id, and weighted back to the classes' full counts) and at most
``max_features`` features, those with the strongest log-likelihood ratio in favour of toxic.
Counting and feature extraction are Spark jobs; only the sample's feature numbers come
to the driver for the gradient steps. Scoring covers every whole text.

Defined results: a null, empty or wordless text scores the probability that the model
gives to no sentence at all, 0; without labelled rows of both classes every score is 0; a
null doc_id is kept and never used for training; contradicting labels of a document
count as toxic; repeated rows get equal scores; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import bounded_batches
from linkrank.llm.hashing import BYTES, Words, as_long, range_hash, text_blocks

PREFIXES = (3, 4, 5, 6, 7)
GAPS = np.ones(256, bool)
GAPS[0x80:] = False
GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), 39]] = False
ENDS = np.zeros(256, bool)
ENDS[list(b".!?\n")] = True
FOLD = np.arange(256, dtype="u1")
FOLD[65:91] += 32
WHOLE = np.uint64(0x5851F42D4C957F2D)
CHECK_BITS = 22


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the Latin-1 letters in UTF-8."""
    out = FOLD[data]
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][capital] += 0x20
    return out


class Sentences:
    """Words and sentences of a block, and the features of the words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = w = Words(folded(data), offsets, GAPS)
        n = len(w.start)
        self.text = np.repeat(np.arange(len(offsets) - 1), w.last - w.first)
        ends = np.append(0, np.cumsum(ENDS[data]))[w.start]
        new = np.ones(n, bool)
        new[1:] = (ends[1:] != ends[:-1]) | (self.text[1:] != self.text[:-1])
        self.first = np.flatnonzero(new)  # first word of each sentence
        self.of_word = np.cumsum(new) - 1
        self.text_of = self.text[self.first]
        self.last = np.append(self.first[1:], n)

    def features(self):
        """``(word positions, feature hashes)`` for every kind of feature."""
        w = self.words
        yield np.arange(len(w.start)), w.hash ^ WHOLE
        for k in PREFIXES:
            at = np.flatnonzero(w.end - w.start >= k)
            yield at, range_hash(w.prefix, w.start[at], w.start[at] + k, BYTES)


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the bias of a sentence."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def sentence_logits(self, s: Sentences) -> np.ndarray:
        out = np.full(len(s.first), self.bias)
        for at, found in self.hits(s):
            np.add.at(out, s.of_word[at], self.weights[found])
        return out

    def hits(self, s: Sentences):
        """``(word positions, feature numbers)`` of the known features of a block."""
        if not len(self.features):
            return
        mask = np.uint64((1 << CHECK_BITS) - 1)
        maybe = np.zeros(1 << CHECK_BITS, bool)
        maybe[(self.features & mask).astype("i8")] = True
        for at, h in s.features():
            near = np.flatnonzero(maybe[(h & mask).astype("i8")])
            found = np.searchsorted(self.features, h[near])
            ok = self.features[np.minimum(found, len(self.features) - 1)] == h[near]
            yield at[near[ok]], found[ok]


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def fit_noisy_or(
    doc: np.ndarray, plain: np.ndarray, label: np.ndarray, weight: np.ndarray, sentence: np.ndarray,
    feature: np.ndarray, n_features: int, start: np.ndarray, steps: int = 400, rate: float = 0.05, l2: float = 1e-3,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimize the weighted log loss of the noisy-or (Adam, full batch).

    ``doc``: document of each sentence with features; ``plain``: sentences without any, per
    document; ``sentence`` and ``feature``: the pairs of the sparse matrix.
    """
    w, b = start.copy(), -6.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    weight = weight / weight.sum()
    for step in range(1, steps + 1):
        z = b + np.bincount(sentence, w[feature], len(doc))
        calm = np.bincount(doc, softplus(z), len(label)) + plain * softplus(b)  # -log(1 - P)
        # d loss / d calm: 1 for clean documents, -(1 - P) / P for toxic ones.
        g = weight * np.where(label == 1, -1 / np.maximum(np.expm1(np.minimum(calm, 500)), 1e-12), 1.0)
        gz = g[doc] * sigmoid(z)
        grad = np.append(
            np.bincount(feature, gz[sentence], n_features) + l2 * w / max(1, n_features),
            gz.sum() + (g * plain).sum() * sigmoid(np.array(b)),
        )
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


def train(
    docs: DataFrame, labels: DataFrame, max_toxic: int = 3000, max_clean: int = 6000,
    max_features: int = 4000, seed: int = 1,
) -> Model:
    """A model from the rows of ``labels(doc_id, toxic)``."""
    bounded_batches(docs.sparkSession)
    none = Model(np.zeros(0, "u8"), np.zeros(0), -np.inf)
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("label"))
        .join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    )
    total = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(total) < 2:
        return none
    order = F.xxhash64(F.lit(seed), "doc_id")
    picked = []
    for label, most in ((1, max_toxic), (0, max_clean)):
        picked += known.filter(F.col("label") == label).orderBy(order, "doc_id").limit(most).collect()
    label_of = {r["doc_id"]: r["label"] for r in picked}  # at most max_toxic + max_clean
    counts = {c: sum(v == c for v in label_of.values()) for c in (0, 1)}
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in label_of], "doc_id long")), "doc_id"
    )

    def count(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            hashes, classes = [], []
            for row, data, offsets in text_blocks(batch.column(1)):
                s = Sentences(data, offsets)
                label = np.array([label_of[i] for i in ids[row : row + len(offsets) - 1]], "i8")
                text, h = [], []
                for at, found in s.features():
                    text.append(s.text[at])
                    h.append(found)
                text, h = np.concatenate(text), np.concatenate(h)
                order = np.lexsort((text, h))
                text, h = text[order], h[order]
                new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])) if len(h) else np.zeros(0, bool)
                hashes.append(h[new])
                classes.append(label[text[new]])
            h, c = np.concatenate(hashes), np.concatenate(classes)
            f, at = np.unique(h, return_inverse=True)
            toxic = np.bincount(at, c, len(f)).astype("i8")
            clean = np.bincount(at, 1 - c, len(f)).astype("i8")
            yield pa.record_batch([as_long(f), toxic, clean], names=["f", "t", "c"])

    seen = sample.mapInArrow(count, "f long, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    nt, nc = counts[1], counts[0]
    share = (F.col("t") + F.col("c")) / (nt + nc)
    ratio = F.col("t") * F.log(F.col("t") / (share * nt)) + F.when(
        F.col("c") > 0, F.col("c") * F.log(F.col("c") / (share * nc))
    ).otherwise(0.0)
    best = (
        seen.filter((F.col("t") >= 3) & (F.col("t") * nc > F.col("c") * nt * 2))
        .withColumn("llr", ratio).filter("llr > 6").orderBy(F.desc("llr"), "f").limit(max_features).collect()
    )
    if not best:
        return none
    hashes = np.array([r["f"] for r in best], "i8").view("u8")
    odds = np.array([np.log((r["t"] + 0.5) / (nt + 1)) - np.log((r["c"] + 0.5) / (nc + 1)) for r in best])
    place = np.argsort(hashes)
    hashes, odds = hashes[place], odds[place]
    finder = Model(hashes, odds, 0.0)

    def extract(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = {"doc_id": [], "plain": [], "sentence": [], "feature": []}
            for row, data, offsets in text_blocks(batch.column(1)):
                s = Sentences(data, offsets)
                hits = list(finder.hits(s))
                at = np.concatenate([s.of_word[a] for a, _ in hits])
                feature = np.concatenate([f for _, f in hits])
                total = np.bincount(s.text_of, minlength=len(offsets) - 1)
                text = s.text_of[at]
                for t, doc in enumerate(ids[row : row + len(offsets) - 1]):
                    mine = text == t
                    numbers, where = np.unique(at[mine], return_inverse=True)
                    out["doc_id"].append(doc)
                    out["plain"].append(int(total[t] - len(numbers)))
                    out["sentence"].append(where.astype("i4"))
                    out["feature"].append(feature[mine].astype("i4"))
            yield pa.record_batch(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["plain"], pa.int64()),
                 pa.array(out["sentence"], pa.list_(pa.int32())), pa.array(out["feature"], pa.list_(pa.int32()))],
                names=list(out),
            )

    rows = sample.mapInArrow(extract, "doc_id long, plain long, sentence array<int>, feature array<int>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")  # the sum's order, hence the result, is fixed
    doc, sentence, feature, base = [], [], [], 0
    for i, (s, f) in enumerate(zip(rows["sentence"], rows["feature"], strict=True)):
        n = int(max(s, default=-1)) + 1
        doc.append(np.full(n, i))
        sentence.append(np.asarray(s, "i8") + base)
        feature.append(np.asarray(f, "i8"))
        base += n
    label = np.array([label_of[i] for i in rows["doc_id"]])
    weight = np.where(label == 1, total[1] / nt, total[0] / nc)
    w, b = fit_noisy_or(
        np.concatenate(doc), rows["plain"].to_numpy(), label, weight, np.concatenate(sentence),
        np.concatenate(feature), len(hashes), odds / 2,
    )
    return Model(hashes, w, b)


SCORES = pa.schema(
    [("doc_id", pa.int64()), ("score", pa.float64()), ("worst_start", pa.int32()), ("worst_end", pa.int32()),
     ("worst_score", pa.float64())]
)
SCORES_DDL = "doc_id long, score double, worst_start int, worst_end int, worst_score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, worst_start, worst_end, worst_score)``: the document's and its worst sentence's probability.

    Offsets are bytes of the UTF-8 text, null where there is no sentence.
    """

    def run(batches):
        for batch in batches:
            parts = []
            for _, data, offsets in text_blocks(batch.column(1)):
                s, n = Sentences(data, offsets), len(offsets) - 1
                z = model.sentence_logits(s)
                calm = np.bincount(s.text_of, softplus(z), n)
                some = np.unique(s.text_of)
                worst = np.lexsort((np.arange(len(z)), -z, s.text_of))
                worst = worst[np.searchsorted(s.text_of, some)]
                has = np.zeros(n, bool)
                has[some] = True
                start, end, top = np.zeros(n, "i4"), np.zeros(n, "i4"), np.zeros(n)
                start[some] = s.words.start[s.first[worst]] - offsets[some]
                end[some] = s.words.end[s.last[worst] - 1] - offsets[some]
                top[some] = sigmoid(z[worst])
                parts.append((-np.expm1(-calm), start, end, top, ~has))
            p, start, end, top, none = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield pa.record_batch(
                [batch.column(0), pa.array(p), pa.array(start, mask=none), pa.array(end, mask=none),
                 pa.array(top, mask=none)], schema=SCORES,
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, SCORES_DDL)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted, worst_start, worst_end, worst_score)``, a row per document."""
    model = train(docs, labels.filter(~held_out()), **options)
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "worst_start", "worst_end", "worst_score",
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, in the columns of ``docs``."""
    model = train(docs, labels.filter(~held_out()), **options)

    def clean(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            keep = []
            for _, data, offsets in text_blocks(batch.column(at)):
                s = Sentences(data, offsets)
                calm = np.bincount(s.text_of, softplus(model.sentence_logits(s)), len(offsets) - 1)
                keep.append(-np.expm1(-calm) < threshold)
            yield batch.filter(pa.array(np.concatenate(keep))) if keep else batch

    return docs.mapInArrow(clean, docs.schema)
