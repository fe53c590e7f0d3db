"""Language identification by a byte convolutional network, trained and applied with NumPy.

A text is cut into windows of ``window`` bytes that overlap by the widest filter less one, so every
run of bytes a filter can see lies in some window. A window's bytes are embedded, filters of several
widths run over them, each filter's largest activation over the window is kept (max pooling), and
a linear layer with softmax gives the languages' probabilities. A document's probability is that of
the mean log odds of its windows, each weighted by the bytes it brings. Whole texts are scored.

The network is trained from document labels on a bounded sample: ``max_docs`` documents of each
language, in the order of a hash of the id, and ``max_windows`` windows of each, in the order of a hash
of their place. Only these windows come to the driver.

Defined results: a text that is null or holds no letter (Unicode category L) is ``und`` with
score 0; so is every text if no document with a letter has a language. A null doc_id is kept, not
held out and not learned from; contradicting languages of one doc_id all count; equal
probabilities go to the language first in code-point order; repeated rows get equal results; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import bounded_batches
from linkrank.llm.hashing import mixed, text_blocks

WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4, 5), 16, 8
UNKNOWN = "und"
LETTER = r"\p{L}"


def windows_of(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(windows x bytes, text of each, new bytes of each)`` of a block; the rest of a window is byte 0."""
    step = window - max(WIDTHS) + 1
    size = np.diff(offsets)
    count = np.where(size > 0, np.maximum(1, -(-(size - window) // step) + 1), 0)
    text = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][text] + nth * step
    end = np.minimum(start + window, offsets[1:][text])
    at = start[:, None] + np.arange(window)
    inside = at < end[:, None]
    rows = np.where(inside, data[np.minimum(at, len(data) - 1)], 0) if len(data) else np.zeros((0, window), "u1")
    return rows.astype("u1"), text, end - start - np.where(nth > 0, window - step, 0)


@dataclass
class Network:
    """Embedding ``(256, E)``; per width a filter bank ``(width * E, F)`` and its bias; output ``(all F, languages)``."""

    languages: list[str]
    embedding: np.ndarray
    banks: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    window: int = WINDOW

    @classmethod
    def new(cls, languages: list[str], seed: int, window: int) -> Network:
        rng = np.random.default_rng(seed)
        e = rng.normal(0, 1, (256, EMBEDDING)).astype("f4")
        banks = [rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)).astype("f4") for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        out = rng.normal(0, n**-0.5, (n, len(languages))).astype("f4")
        return cls(languages, e, banks, [np.zeros(FILTERS, "f4") for _ in WIDTHS], out, np.zeros(len(languages), "f4"), window)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.banks, *self.biases, self.out, self.out_bias]

    def patches(self, embedded: np.ndarray, width: int) -> np.ndarray:
        """Every run of ``width`` embedded bytes of each window, as a view of flat rows."""
        n, length, e = embedded.shape
        s = embedded.strides
        return np.lib.stride_tricks.as_strided(embedded, (n, length - width + 1, width * e), (s[0], s[1], s[2]))

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """``(embedded, largest activation of each filter, where it is)``."""
        embedded = self.embedding[windows]
        tops, places = [], []
        for width, bank, bias in zip(WIDTHS, self.banks, self.biases, strict=True):
            h = self.patches(embedded, width) @ bank
            at = h.argmax(axis=1)
            places.append(at)
            tops.append(np.take_along_axis(h, at[:, None, :], 1)[:, 0] + bias)
        return embedded, np.maximum(np.concatenate(tops, axis=1), 0), places

    def log_odds(self, windows: np.ndarray, batch: int = 256) -> np.ndarray:
        """Log probabilities (windows x languages), a batch of windows at a time."""
        out = np.zeros((len(windows), len(self.languages)), "f4")
        for i in range(0, len(windows), batch):
            embedded = self.embedding[windows[i : i + batch]]
            tops = [
                (self.patches(embedded, width) @ bank).max(axis=1) + bias
                for width, bank, bias in zip(WIDTHS, self.banks, self.biases, strict=True)
            ]
            z = np.maximum(np.concatenate(tops, axis=1), 0) @ self.out + self.out_bias
            z -= z.max(axis=1, keepdims=True)
            out[i : i + batch] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        return out

    def gradients(self, windows: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weighted mean cross entropy, in the order of :meth:`parameters`."""
        embedded, top, places = self.pooled(windows)
        z = top @ self.out + self.out_bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(label)), label] -= 1
        p *= (weight / weight.sum())[:, None]
        d_top = (p @ self.out.T) * (top > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_banks, d_biases = [], []
        rows = np.arange(len(windows))[:, None]
        for k, (width, bank) in enumerate(zip(WIDTHS, self.banks, strict=True)):
            d = d_top[:, k * FILTERS : (k + 1) * FILTERS]
            # Only the run of bytes that won the pooling moves a filter.
            won = places[k][:, :, None] + np.arange(width)  # windows x filters x width
            x = embedded[rows[:, :, None], won].reshape(len(windows), FILTERS, width * EMBEDDING)
            d_banks.append(np.einsum("nf,nfx->xf", d, x).astype("f4"))
            d_biases.append(d.sum(axis=0).astype("f4"))
            back = (d[:, :, None] * bank.T[None]).reshape(-1, EMBEDDING)
            np.add.at(d_embedding, windows[rows[:, :, None], won].ravel(), back)
        return [d_embedding, *d_banks, *d_biases, (top.T @ p).astype("f4"), p.sum(axis=0).astype("f4")]

    def fit(self, windows: np.ndarray, label: np.ndarray, weight: np.ndarray, epochs: int, seed: int,
            batch: int = 128, rate: float = 4e-3) -> None:
        """Adam over shuffled batches, the rate falling to nothing."""
        rng = np.random.default_rng(seed)
        parameters = self.parameters()
        m, v = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
        step, total = 0, epochs * -(-len(windows) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for i in range(0, len(order), batch):
                some = order[i : i + batch]
                step += 1
                now = rate * (1 - step / (total + 1))
                for p, g, a, b in zip(parameters, self.gradients(windows[some], label[some], weight[some]), m, v, strict=True):
                    a *= 0.9
                    a += 0.1 * g
                    b *= 0.999
                    b += 0.001 * g * g
                    p -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, max_docs: int, max_windows: int, window: int, seed: int) -> DataFrame:
    """``(lang, doc_id, bytes)``: windows of up to ``max_docs`` documents of each language."""
    spark = docs.sparkSession
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out() & F.col("text").rlike(LETTER)
    )
    ids = known.select("lang", "doc_id").distinct()
    order = F.xxhash64(F.lit(seed), "doc_id")
    languages = sorted(r["lang"] for r in ids.select("lang").distinct().collect())
    if not languages:
        return spark.createDataFrame([], "lang string, doc_id long, bytes binary")
    # A sorted limit per language keeps max_docs rows of each task; no task sees a whole language.
    picks = [ids.filter(F.col("lang") == lang).orderBy(order, "doc_id").limit(max_docs) for lang in languages]
    chosen = picks[0]
    for p in picks[1:]:
        chosen = chosen.unionByName(p)
    texts = known.join(F.broadcast(chosen), ["lang", "doc_id"])

    def cut(batches):
        for batch in batches:
            lang, doc = batch.column(0), batch.column(1)
            for row, data, offsets in text_blocks(batch.column(2)):
                rows, text, _ = windows_of(data, offsets, window)
                nth = np.arange(len(text)) - np.searchsorted(text, text)
                turn = mixed(nth.astype("u8") * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
                order = np.lexsort((turn, text))
                rank = np.arange(len(text)) - np.searchsorted(text, text)
                keep = np.sort(order[rank < max_windows])
                at = pa.array(text[keep] + row)
                yield pa.record_batch(
                    [lang.take(at), doc.take(at), pa.array([r.tobytes() for r in rows[keep]], pa.binary())],
                    names=["lang", "doc_id", "bytes"],
                )

    return texts.select("lang", "doc_id", "text").mapInArrow(cut, "lang string, doc_id long, bytes binary")


def train(
    docs: DataFrame, max_docs: int = 500, max_windows: int = 4, window: int = WINDOW, epochs: int = 6, seed: int = 1,
) -> Network:
    """A network from the documents that are not held out; without languages it knows none."""
    bounded_batches(docs.sparkSession)
    rows = sample(docs, max_docs, max_windows, window, seed).collect()
    rows.sort(key=lambda r: (r["lang"], r["doc_id"], bytes(r["bytes"])))  # the result does not depend on row order
    languages = sorted({r["lang"] for r in rows})
    net = Network.new(languages, seed, window)
    if len(languages) > 1:
        windows = np.frombuffer(b"".join(r["bytes"] for r in rows), "u1").reshape(-1, window)
        label = np.searchsorted(languages, [r["lang"] for r in rows])
        # Every language weighs the same, however many windows it has.
        net.fit(windows, label, (1 / np.bincount(label))[label].astype("f4"), epochs, seed)
    return net


SCORES = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """``(doc_id, lang_pred, score)``, a row per document."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.coalesce(F.col("text").rlike(LETTER), F.lit(False)).alias("letters"),
    )

    def run(batches):
        names = np.array([*net.languages, UNKNOWN], object)
        for batch in batches:
            best, score = [], []
            for _, data, offsets in text_blocks(batch.column(1)):
                n = len(offsets) - 1
                total = np.zeros((n, len(net.languages)))
                if net.languages:
                    rows, text, new = windows_of(data, offsets, net.window)
                    odds = net.log_odds(rows) * new[:, None]
                    bytes_ = np.maximum(np.diff(offsets), 1)[:, None]
                    for k in range(total.shape[1]):
                        total[:, k] = np.bincount(text, odds[:, k], n)
                    total = np.exp(total / bytes_)
                    total /= total.sum(axis=1, keepdims=True)
                    best.append(total.argmax(axis=1))
                    score.append(total.max(axis=1))
                else:
                    best.append(np.zeros(n, "i8"))
                    score.append(np.zeros(n))
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.concatenate(best), np.concatenate(score)
            best = np.where(letters, best, len(net.languages))
            yield pa.record_batch(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(np.where(letters, score, 0.0))], schema=SCORES
            )

    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, a row per document."""
    found = predict(docs, train(docs, **options))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
