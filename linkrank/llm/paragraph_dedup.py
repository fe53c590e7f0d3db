"""Substring dedup by paragraphs: MinHash banding, exact Jaccard, removal of all but the earliest.

Paragraphs are lines. Equal ones fall together by hash; lines of enough shingles for two
different sets to reach the threshold (t / (1 - t): 4 at 0.8, 8 words) are also joined by MinHash bands tuned for high
recall, verified with the exact Jaccard similarity of their full shingle sets, and
clustered by connected components. The sentences of a line count as units too, by
equality. Of every cluster the earliest occurrence (by document, then position) stays;
the others are removed where runs of neighbouring removed units reach ``min_words``
words, so short phrases that recur by chance stay. Sentences of fewer words than a
shingle are no units; one between two removed units goes with them.

Passages. As shared text often begins and ends inside a sentence, every window of
``min_words`` words that stands earlier too is removed as well, wherever it begins, and
runs of units grow by the windows that touch them. Windows are kept as spans: neighbours
whose least hash of ``min_words / 2`` words stands at the same place. Spans equal as a whole need
no more; those that share that least hash (the key) and differ are read again, window by
window. Equal windows have their least hash at the same place, so none is missed. Of
windows that overlap their own first occurrence only the words after it go.

Hot units: a task reduces its own occurrences first. Those after its earliest are
removed for certain and go on under keys of their own, so a unit has at most one row
per task in the window that finds the earliest of all.

Defined results: null and empty texts, and null doc_ids, lose nothing; rows with the
same doc_id are one document (of its texts the least counts); an empty table gives an
empty result; extra columns are ignored. Offsets are bytes of the UTF-8 text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkrank.llm.common import cut, one_text_per_id
from linkrank.llm.hashing import (
    SENTENCE_END, U, WORDS, Words, as_long, band_keys, bands_for, mixed, prefix_hash, range_hash, text_blocks,
)
from linkrank.llm.line_dedup import _may_contain
from linkrank.llm.similar import arrow_rows, candidate_components, classes, verified

SIZE = 5  # words of a shingle
UNIT = pa.schema(
    [("key", pa.int64()), ("unit", pa.int64()), ("doc_id", pa.int64()), ("w0", pa.int32()), ("w1", pa.int32()),
     ("b0", pa.int32()), ("b1", pa.int32()), ("line", pa.bool_()), ("later", pa.bool_())]
)
UNIT_DDL = "key long, unit long, doc_id long, w0 int, w1 int, b0 int, b1 int, line boolean, later boolean"


def units(words: Words, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Lines and sentences of a block with at least ``SIZE`` words: word bounds, text and hash."""
    n = len(words.start)
    if not n:
        return {k: np.zeros(0, "i8") for k in ("first", "last", "text")} | {
            "line": np.zeros(0, bool), "hash": np.zeros(0, "u8")}
    text = np.repeat(np.arange(len(offsets) - 1), words.last - words.first)
    breaks = np.cumsum(words.data == 10)[words.start]
    new_line = np.ones(n, bool)
    new_line[1:] = (breaks[1:] != breaks[:-1]) | (text[1:] != text[:-1])
    new_sentence = new_line.copy()
    new_sentence[1:] |= SENTENCE_END[words.data[words.end[:-1] - 1]]
    first, last, line = [], [], []
    for new, is_line in ((new_line, True), (new_sentence, False)):
        a = np.flatnonzero(new)
        b = np.append(a[1:], n)
        whole = new_line[a] & np.append(new_line, True)[b]
        keep = (b - a >= SIZE) & (is_line | ~whole)  # a line of one sentence counts once
        first.append(a[keep])
        last.append(b[keep])
        line.append(np.full(keep.sum(), is_line))
    first, last, line = map(np.concatenate, (first, last, line))
    prefix = prefix_hash(words.hash, WORDS)
    return {"first": first, "last": last, "text": text[first], "line": line,
            "hash": range_hash(prefix, first, last, WORDS)}


def _blocks(batch: pa.RecordBatch):
    """``(doc ids, words, offsets, units)`` of the blocks of a batch, without units of unknown documents."""
    ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("i8")
    known = ~np.asarray(batch.column(0).is_null())
    for row, data, offsets in text_blocks(batch.column(1)):
        words = Words(data, offsets)
        u = units(words, offsets)
        keep = known[row + u["text"]]
        u = {k: v[keep] for k, v in u.items()}
        yield ids[row : row + len(offsets) - 1], words, offsets, u


def _occurrences(flush: int = 1 << 21):
    """A ``mapInArrow`` function: the units of a task, the earliest of each under its own hash."""

    def reduced(held):
        t = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
        order = np.lexsort((t["w0"], t["doc_id"], t["unit"]))
        t = {k: v[order] for k, v in t.items()}
        same = np.append(False, t["unit"][1:] == t["unit"][:-1])
        at = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
        again = (t["doc_id"] == t["doc_id"][at]) & (t["w0"] == t["w0"][at])  # a repeated row
        later = same & ~again
        place = t["doc_id"].view("u8") * np.uint64(0x9E3779B97F4A7C15) + t["w0"].astype("u8")
        own = as_long(mixed(place ^ mixed(t["unit"].view("u8"))))
        t |= {"key": np.where(later, own, t["unit"]), "later": later}
        for i in range(0, len(later), 1 << 16):
            yield pa.record_batch([pa.array(t[f.name][i : i + (1 << 16)], f.type) for f in UNIT], schema=UNIT)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for ids, words, offsets, u in _blocks(batch):
                first, last, text = u["first"], u["last"], u["text"]
                held.append(
                    {"unit": as_long(u["hash"]), "doc_id": ids[text],
                     "w0": first - words.first[text], "w1": last - words.first[text],
                     "b0": words.start[first] - offsets[text], "b1": words.end[last - 1] - offsets[text],
                     "line": u["line"]}
                )
                size += len(first)
                if size >= flush:
                    yield from reduced(held)
                    held, size = [], 0
        if size:
            yield from reduced(held)

    return run


# ``at``: first word, number of words (18 bits), later, open.
SPAN = pa.schema([("key", pa.int64()), ("span", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64())])
SPAN_DDL = "key long, span long, doc_id long, at long"
WINDOW = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("w0", pa.int32()), ("w1", pa.int32()), ("b0", pa.int32()),
     ("b1", pa.int32()), ("next", pa.int32()), ("later", pa.bool_())]
)
WINDOW_DDL = "key long, doc_id long, w0 int, w1 int, b0 int, b1 int, next int, later boolean"


def spans(words: Words, offsets: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """Spans of neighbouring windows of ``size`` words with the same least hash: bounds, text, key and hash."""
    n, gram = len(words.start), max(1, size // 2)
    text = np.repeat(np.arange(len(offsets) - 1), words.last - words.first)
    start = np.flatnonzero(text[: max(0, n - size + 1)] == text[size - 1 :])
    if not len(start):
        return {k: np.zeros(0, "i8") for k in ("first", "last", "text")} | {k: np.zeros(0, "u8") for k in ("key", "hash")}
    prefix = prefix_hash(words.hash, WORDS)
    place = np.arange(n - gram + 1)
    grams = range_hash(prefix, place, place + gram, WORDS)
    # Least hash first, then leftmost: the place rides in the low half.
    least = (grams & U(0xFFFFFFFF00000000)) | place.astype("u8")
    least = np.lib.stride_tricks.sliding_window_view(least, size - gram + 1).min(axis=1)
    at = (least[start] & U(0xFFFFFFFF)).astype("i8")
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (text[start][1:] != text[start][:-1])))
    first, last = start[new], start[np.append(new[1:], len(start)) - 1] + size
    return {"first": first, "last": last, "text": text[first], "key": grams[at[new]],
            "hash": range_hash(prefix, first, last, WORDS)}


def _earlier(held: list[dict[str, np.ndarray]], size: int) -> dict[str, np.ndarray]:
    """Spans of a task, at most one per key under the key itself, the others under keys of their own.

    Those after an equal one are ``later`` for certain; where a key has different spans, all are ``open``.
    """
    t = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
    order = np.lexsort((t["w0"], t["doc_id"], t["span"], t["key"]))
    t = {k: v[order] for k, v in t.items()}
    n = len(order)
    same = np.append(False, (t["span"][1:] == t["span"][:-1]) & (t["key"][1:] == t["key"][:-1]))
    at = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    again = same & (t["doc_id"] == t["doc_id"][at]) & (t["w0"] == t["w0"][at])  # a repeated row
    later = same & ~again
    head = np.flatnonzero(np.append(True, t["key"][1:] != t["key"][:-1]))
    extra = t["span"] != np.repeat(t["span"][head], np.diff(np.append(head, n)))
    open_ = np.repeat(np.logical_or.reduceat(extra, head), np.diff(np.append(head, n)))
    own = _own(t["doc_id"], t["w0"], t["span"])
    # What overlaps the first occurrence stays.
    over = later & (t["doc_id"] == t["doc_id"][at]) & (t["w0"] < t["w0"][at] + size)
    if "next" in t:
        t["b0"] = np.where(over, t["next"][at], t["b0"])
    w0 = np.where(over, t["w0"][at] + size, t["w0"])
    later |= t.pop("done", False)
    t |= {"key": np.where(later | extra, own, t["key"]), "later": later, "open": open_, "w0": w0}
    return {k: v[~again] for k, v in t.items()}


def _own(doc_id: np.ndarray, w0: np.ndarray, span: np.ndarray) -> np.ndarray:
    """A key of a place's own."""
    place = doc_id.view("u8") * U(0x9E3779B97F4A7C15) + w0.astype("u8")
    return as_long(mixed(place ^ mixed(span.view("u8"))))


def _held(rows, size: int, schema: pa.Schema, flush: int = 1 << 18):
    """``rows`` reduced by :func:`_earlier`, about ``flush`` of them at a time, as record batches."""
    held, n = [], 0

    def reduced():
        t = _earlier(held, size)
        if "at" in schema.names:
            t["at"] = t["w0"] << 20 | (t["w1"] - t["w0"]) << 2 | t["later"].astype("i8") << 1 | t["open"].astype("i8")
        for i in range(0, len(t["key"]), 1 << 16):
            yield pa.record_batch([pa.array(t[f.name][i : i + (1 << 16)], f.type) for f in schema], schema=schema)

    for row in rows:
        if len(row["key"]):
            held.append(row)
            n += len(row["key"])
        if n >= flush:
            yield from reduced()
            held, n = [], 0
    if n:
        yield from reduced()


def _windows_of(words: Words, doc_id: int, at: np.ndarray, later: np.ndarray, size: int):
    """The windows of open spans ``at`` of a document, and the ranges that the ``later`` spans cover."""
    a, b = at[later].T
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.flatnonzero(np.append(True, a[1:] > b[:-1])[: len(a)])
    a, b = a[new], b[np.append(new[1:], len(a))[: len(new)] - 1]
    n = at[~later, 1] - at[~later, 0] - size + 1
    first = np.repeat(at[~later, 0] - np.append(0, np.cumsum(n))[: len(n)], n) + np.arange(n.sum())
    key = as_long(range_hash(prefix_hash(words.hash, WORDS), first, first + size, WORDS))
    place = np.full(len(first) + len(a), doc_id)
    w0, w1 = np.append(first, a), np.append(first + size, b)
    key = np.append(key, _own(place[len(first) :], a, b))
    # The byte where the word after the window begins, if there is one.
    after = np.append(words.start, words.end[-1:])[np.minimum(w0 + size, len(words.start))]
    done = np.arange(len(place)) >= len(first)
    return {"key": key, "span": key, "doc_id": place, "w0": w0, "w1": w1, "b0": words.start[w0],
            "b1": words.end[w1 - 1], "next": after, "done": done}


def repeated_windows(texts: DataFrame, size: int) -> DataFrame:
    """``(doc_id, w0, w1, b0, b1)``: ranges that cover all windows of ``size`` words that stand earlier, too."""

    def collect(batches):
        def rows():
            for batch in batches:
                ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("i8")
                known = ~np.asarray(batch.column(0).is_null())
                for row, data, offsets in text_blocks(batch.column(1)):
                    words = Words(data, offsets)
                    s = spans(words, offsets, size)
                    s = {k: v[known[row + s["text"]]] for k, v in s.items()}
                    base = words.first[s["text"]]
                    yield {"key": as_long(s["key"]), "span": as_long(s["hash"]), "doc_id": ids[row + s["text"]],
                           "w0": s["first"] - base, "w1": s["last"] - base}

        yield from _held(rows(), size, SPAN)

    def windows(batches):
        def rows():
            for batch in _slices(batches):
                columns = (batch.column(i).to_pylist() for i in range(3))
                for doc_id, text, wanted in zip(*columns, strict=True):
                    data = np.frombuffer((text or "").encode(), "u1")
                    words = Words(data, np.array([0, len(data)]))
                    at = np.array([(w["w0"], w["w1"], w["later"]) for w in wanted], "i8")
                    at = at[at[:, 1] <= len(words.start)]  # another text under the same id may be shorter
                    if len(at):
                        yield _windows_of(words, doc_id, at[:, :2], at[:, 2] == 1, size)

        yield from _held(rows(), size, WINDOW)

    # Unpacked only after the shuffle.
    s = texts.mapInArrow(collect, SPAN_DDL).repartition("key")
    s = s.withColumn("w0", F.shiftright("at", 20)).withColumn("later", F.col("at").bitwiseAND(F.lit(2)) != 0)
    s = s.withColumn("w1", F.col("w0") + F.shiftright("at", 2).bitwiseAND(F.lit((1 << 18) - 1)))
    key = W.partitionBy("key")
    s = s.withColumn("open", F.max(F.col("at").bitwiseAND(F.lit(1))).over(key))
    s = s.withColumn("open", (F.col("open") == 1) | (F.min("span").over(key) != F.max("span").over(key)))
    seen = cut(_moved(s, W.partitionBy("key", "span"), size).filter("later or open").select("doc_id", "w0", "w1", "later"))
    wanted = seen.groupBy("doc_id").agg(F.collect_list(F.struct("w0", "w1", "later")).alias("at"))
    again = _may_contain(texts, seen, "doc_id").join(wanted, "doc_id").mapInArrow(windows, WINDOW_DDL)
    again = _moved(again, key, size, F.col("next")).filter("later")
    return again.select("doc_id", *(F.col(c).cast("int") for c in ("w0", "w1")), "b0", "b1")


def _moved(rows: DataFrame, equal, size: int, following: Column | None = None) -> DataFrame:
    """``rows`` with ``later`` for all but the first of ``equal``; those that overlap it begin behind it."""
    first = [F.col("doc_id"), F.col("w0")] + ([following.alias("next")] if following is not None else [])
    rows = rows.withColumn("first", F.min(F.struct(*first)).over(equal))
    same = F.col("doc_id") == F.col("first.doc_id")
    found = ~same | (F.col("w0") != F.col("first.w0"))
    over = same & found & (F.col("w0") < F.col("first.w0") + size)
    if following is not None:
        rows = rows.withColumn("b0", F.when(over, F.col("first.next")).otherwise(F.col("b0")))
    return rows.withColumn("later", F.col("later") | found).withColumn(
        "w0", F.when(over, F.col("first.w0") + size).otherwise(F.col("w0"))
    )


def repeated_spans(
    docs: DataFrame, threshold: float = 0.8, rows: int = 3, recall: float = 0.995, min_words: int = 20, seed: int = 17,
) -> DataFrame:
    """``(doc_id, start, end, words)``: the byte ranges to remove, every row a maximal run of units."""
    bands = bands_for(threshold, rows, recall)
    # Different sets share at most all of the smaller one, of a union that has one more.
    enough = int(np.ceil(threshold / (1 - threshold) - 1e-9)) + SIZE - 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def keys(batch):
        for _, words, _, u in _blocks(batch):
            able = u["line"] & (u["last"] - u["first"] >= enough)
            first, last = u["first"][able], u["last"][able]
            if len(first):
                # Lines of a block follow each other; the words between them form segments that are dropped.
                bounds = np.empty(2 * len(first), "i8")
                bounds[0::2], bounds[1::2] = first, last
                grams, at = words.shingles(SIZE, bounds[:-1], bounds[1:])
                # reduceat takes no empty segments: neighbouring lines have none between them.
                full = at[1:] > at[:-1]
                start = np.append(at[:-1][full], at[-1])
                key = band_keys(grams, start, bands, rows, seed)[(np.arange(len(at) - 1) % 2 == 0)[full]]
                yield as_long(key.ravel()), np.repeat(as_long(u["hash"][able]), bands)

    star = texts.mapInArrow(arrow_rows(keys), "key long, node long")
    near = candidate_components(star)

    place = F.struct("doc_id", "w0")
    first = F.min(place).over(W.partitionBy("key"))
    occ = texts.mapInArrow(_occurrences(), UNIT_DDL).withColumn("first", first)
    later = F.col("later") | (place != F.col("first"))
    wide = F.col("line") & (F.col("w1") - F.col("w0") >= enough)
    occ = cut(
        occ.select("unit", "doc_id", "w0", "w1", "b0", "b1", later.alias("later"), wide.alias("wide"))
        .filter("later or wide")
    )
    firsts = occ.filter("wide and not later").dropDuplicates(["unit"])
    firsts = cut(firsts.join(near.withColumnRenamed("node", "unit"), "unit").drop("later", "wide"))

    wanted = firsts.groupBy("doc_id").agg(F.collect_list(F.struct("component", "unit", "b0", "b1")).alias("at"))
    one = _may_contain(texts, firsts, "doc_id").join(wanted, "doc_id")
    members = one.mapInArrow(
        _unit_sets, "component long, node long, weight long, shingles binary"
    ).dropDuplicates(["node"])
    found = classes(verified(cut(members), threshold))
    in_class = firsts.join(found.select(F.col("node").alias("unit"), "class"), "unit")
    earliest = in_class.groupBy("class").agg(F.min(place).alias("first"))
    moved = in_class.join(earliest, "class").filter(place != F.col("first"))

    cols = ["doc_id", "w0", "w1", "b0", "b1"]
    out = occ.filter("later").select(cols).unionByName(moved.select(cols)).withColumn("unit", F.lit(True))
    # Sentences too short to be units may lie between two removed ones.
    windows = repeated_windows(texts, max(1, min_words)).withColumn("unit", F.lit(False))
    runs = _runs(out.unionByName(windows), ["unit"], F.when(F.col("unit"), SIZE).otherwise(1))
    runs = _runs(runs, [], F.lit(1))
    runs = runs.select(
        "doc_id", F.col("b0").alias("start"), F.col("b1").alias("end"), (F.col("w1") - F.col("w0")).alias("words")
    )
    return runs.filter(F.col("words") >= min_words).select("doc_id", "start", "end", "words")


def _runs(ranges: DataFrame, also: list[str], gap: Column) -> DataFrame:
    """Ranges of a document (and ``also``) with fewer than ``gap`` words between them as one."""
    order = W.partitionBy("doc_id", *also).orderBy("w0", F.desc("w1"))
    reach = F.max("w1").over(order.rowsBetween(W.unboundedPreceding, -1))
    new = F.when(F.col("w0") < F.col("reach") + gap, 0).otherwise(1)
    runs = ranges.withColumn("reach", reach).withColumn("new", new)
    runs = runs.withColumn("run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    bounds = (F.min("w0").alias("w0"), F.max("w1").alias("w1"), F.min("b0").alias("b0"), F.max("b1").alias("b1"))
    return runs.groupBy("doc_id", *also, "run").agg(*bounds).drop("run")


def _slices(batches, rows: int = 128):
    """Batches of few rows, as those turned into Python objects take many times their size."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _unit_sets(batches):
    schema = pa.schema([("component", pa.int64()), ("node", pa.int64()), ("weight", pa.int64()), ("shingles", pa.binary())])
    for batch in _slices(batches):
        texts, lists = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        component, node, sets = [], [], []
        for text, wanted in zip(texts, lists, strict=True):
            raw = (text or "").encode()
            for w in wanted:
                piece = np.frombuffer(raw[w["b0"] : w["b1"]], "u1")
                words = Words(piece, np.array([0, len(piece)]))
                grams, _ = words.shingles(SIZE, words.first, words.last)
                component.append(w["component"])
                node.append(w["unit"])
                sets.append(np.unique(grams).tobytes())
        if node:
            yield pa.record_batch(
                [pa.array(component, pa.int64()), pa.array(node, pa.int64()),
                 pa.array(np.ones(len(node), "i8")), pa.array(sets, pa.binary())], schema=schema
            )


def paragraph_dedup(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, spans)``, a row per document."""
    docs = one_text_per_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    size = F.min(F.coalesce(F.octet_length("text"), F.lit(0))).cast("long")
    everyone = docs.groupBy("doc_id").agg(size.alias("n_bytes"))
    spans = repeated_spans(docs, **options)
    span = F.struct("start", "end")
    per = spans.groupBy("doc_id").agg(
        F.sum(F.col("end") - F.col("start")).cast("long").alias("n_removed"),
        F.count(F.lit(1)).alias("n_spans"),
        F.sort_array(F.collect_list(span)).alias("spans"),
    )
    return everyone.join(per, "doc_id", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )
