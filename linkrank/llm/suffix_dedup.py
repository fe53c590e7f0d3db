"""Exact substring dedup with a logarithmic family of suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else goes,
same document included; matches do not cross documents and are judged on the input.

Sampled suffix arrays. Of the suffixes only those are kept that start at the minimizer
of some window: the position of the least hash of ``GRAM`` bytes among all that lie in
the window. Equal windows have their minimizer at the same place, so a repeat of
``LENGTH`` bytes is always seen from a kept suffix, though only about one in 80 is kept. An
array row stands for a run, the neighbouring windows with the same minimizer: the hash of
the suffix's first ``GRAM`` bytes (its sort key), the hash of the run's whole text, the
chunk (some rows of a file that follow each other) it lies in, and how often it does. Arrays are sorted by key, so
equal prefixes are neighbours, which is all that a scan for long matches asks of the order.

Index family. A new batch's array is merge-scanned with the existing levels, which finds
every run whose key occurs twice; then levels of equal size are merged, so there are at
most log2(batches) + 1 levels and a row is rewritten as often.

From matches to bytes. Runs equal as a whole are repeats in full. Runs with equal keys
and different texts share only some of their windows: their texts are gathered, and the
hashes of their windows compared. Contexts with many partners are dealt to several tasks
(slices); windows left over there are compared by a shuffle. Chunks get the answers back
and cut the bytes out. Hashes have 64 bits, and a wrong match needs two equal ones at once
(key and text).

Defined results: null and empty texts and texts under ``LENGTH`` bytes keep everything; a
null doc_id is kept as null; repeated rows are separate documents, so they lose the text
that they share; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkrank.llm.common import Scratch, bounded_batches, cut, width
from linkrank.llm.hashing import BASE, BYTE_VALUE, BYTES, as_long, mixed, prefix_hash, range_hash, text_blocks

U = np.uint64
LENGTH, GRAM = 200, 40
CHUNK_ROWS = 2048
ARRAY = pa.schema([("key", pa.int64()), ("run", pa.int64()), ("chunk", pa.int64()), ("n", pa.int32())])
ARRAY_DDL = "key long, run long, chunk long, n int"
NO_RUNS = {k: np.zeros(0, t) for k, t in (("doc", "i8"), ("a", "i8"), ("b", "i8"), ("key", "u8"), ("run", "u8"))}


def runs(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The runs of a block: document, first and last window start, key and text hash, by position."""
    n = len(data)
    if n < LENGTH:
        return NO_RUNS
    windows = LENGTH - GRAM + 1
    prefix = prefix_hash(BYTE_VALUE[data], BYTES)
    _, down = BYTES.get(n + 1)
    grams = mixed((prefix[GRAM:] - prefix[: n - GRAM + 1]) * down[: n - GRAM + 1])
    # Least hash first, then leftmost: the place rides in the low half.
    least = (grams & U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype="u8")
    span = 1
    while span * 2 <= windows:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < windows:
        least = np.minimum(least[: len(least) - (windows - span)], least[windows - span :])
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.flatnonzero(doc[: n - LENGTH + 1] == doc[LENGTH - 1 :])
    if not len(start):
        return NO_RUNS
    at, doc = (least[start] & U(0xFFFFFFFF)).astype("i8"), doc[start]
    new = np.append(True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]))
    first = np.flatnonzero(new)
    a, b = start[first], start[np.append(first[1:], len(start)) - 1]
    at = at[first]
    text = range_hash(prefix, a, b + LENGTH, BYTES)
    return {"doc": doc[first], "a": a, "b": b, "key": grams[at], "run": mixed(text + (at - a).astype("u8") * U(BASE))}


def suffix_array(docs: DataFrame) -> DataFrame:
    """``(key, run, chunk, n)``: the sampled suffixes of every chunk of ``docs(chunk, text)``, sorted by key."""

    def collect(batches):
        key, run, n, last = np.zeros(0, "u8"), np.zeros(0, "u8"), np.zeros(0, "i8"), None

        def told():
            for i in range(0, len(key), 1 << 16):
                part = slice(i, i + (1 << 16))
                size = len(key[part])
                yield pa.record_batch(
                    [as_long(key[part]), as_long(run[part]), np.full(size, last, "i8"), n[part].astype("i4")], schema=ARRAY
                )

        for chunk, batch in by_chunk(batches):
            if chunk != last:
                yield from told()
                key, run, n, last = np.zeros(0, "u8"), np.zeros(0, "u8"), np.zeros(0, "i8"), chunk
            found = [runs(data, offsets) for _, data, offsets in text_blocks(batch.column(1))]
            key = np.concatenate([key, *(f["key"] for f in found)])
            run = np.concatenate([run, *(f["run"] for f in found)])
            n = np.append(n, np.ones(len(key) - len(n), "i8"))
            order = np.lexsort((run, key))
            key, run, n = key[order], run[order], n[order]
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (run[1:] != run[:-1])))[: len(key)]
            n = np.add.reduceat(n, first) if len(first) else n
            key, run = key[first], run[first]
        yield from told()

    return docs.select("chunk", "text").mapInArrow(collect, ARRAY_DDL)


def by_chunk(batches):
    """``(chunk, rows)`` of batches whose first column is the chunk."""
    for batch in batches:
        chunk = batch.column(0).to_numpy()
        ends = [*(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)]
        begin = 0
        for end in ends if len(chunk) else []:
            yield int(chunk[begin]), batch.slice(begin, end - begin)
            begin = end


def chunked(docs: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """``(chunk, doc_id, text)`` of a table of files: ``rows`` rows of a file that follow each other are a chunk.

    A row's file and number do not depend on how a scan is split, so two scans agree on the chunks.
    """
    nth = F.expr(f"_metadata.row_index div {int(rows)}")
    chunk = F.xxhash64(F.col("_metadata.file_path"), nth).alias("chunk")
    return docs.select(chunk, F.col("doc_id").cast("long").alias("doc_id"), "text")


class SuffixIndex:
    """Levels of sorted arrays, each twice as large as the next."""

    def __init__(self, spark: SparkSession):
        self.scratch = Scratch(spark)
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, array: DataFrame) -> DataFrame:
        """Takes in a batch's array; returns all matches among it and the levels (see :meth:`scan`), lazily."""
        matches = self.scan([array, *(df for _, df in self.levels)])
        self.levels.append((1, array))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (_, b) = self.levels.pop(), self.levels.pop()
            both = a.unionByName(b)
            merged = both.repartition(width(both.sparkSession), "key", "run").sortWithinPartitions("key", "run")
            self.levels.append((2 * n, self.scratch.store(merged)))
        return matches

    @staticmethod
    def scan(arrays: list[DataFrame]) -> DataFrame:
        """``(key, run, chunk, equal, others, speaker)`` of the rows whose key occurs twice.

        ``equal``: the run as a whole occurs twice; ``others``: how many different runs share
        the key; ``speaker``: the one chunk that speaks for equal runs.
        """
        rows = arrays[0]
        for df in arrays[1:]:
            rows = rows.unionByName(df)
        per_run = W.partitionBy("key", "run")
        per_key = W.partitionBy("key").orderBy("run").rangeBetween(W.unboundedPreceding, W.unboundedFollowing)
        new = F.when(F.row_number().over(per_run.orderBy("chunk")) == 1, 1).otherwise(0)
        rows = rows.select(
            "key", "run", "chunk", F.sum("n").over(per_run).alias("times"),
            F.min("chunk").over(per_run).alias("speaker"), new.alias("new"),
        )
        rows = rows.withColumn("others", F.sum("new").over(per_key) - 1)
        return rows.filter("times > 1 or others > 0").select(
            "key", "run", "chunk", (F.col("times") > 1).alias("equal"), F.col("others").cast("int").alias("others"),
            (F.col("speaker") == F.col("chunk")).alias("speaker"),
        )


def union_of(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals covered by ``[start, end)``; touching ones join."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    return start[first], end[np.append(first[1:], len(start)) - 1]


def result_row(doc_id, raw: bytes, start: np.ndarray, end: np.ndarray) -> dict:
    kept, at = hashlib.sha256(), 0
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        kept.update(raw[at:a])
        at = b
    kept.update(raw[at:])
    return {"doc_id": doc_id, "n_bytes": len(raw), "n_removed": int((end - start).sum()), "n_spans": len(start),
            "kept_sha256": kept.hexdigest(), "spans": np.stack([start, end], 1).astype("i8").tobytes()}


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary"


def substring_dedup(docs: DataFrame, batches: int = 3, slice_rows: int = 2048, written: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)``, a row per row of ``docs``.

    ``spans`` packs the removed ranges as pairs of 64-bit offsets. ``docs`` is read twice, so
    anything but a table of files (``written``) is written first. A chunk whose suffixes and texts
    do not come from the same rows is an error.
    """
    import zstandard

    spark = docs.sparkSession
    bounded_batches(spark)
    index = SuffixIndex(spark)
    scratch = index.scratch
    texts = chunked(docs if written else scratch.store(docs.select("doc_id", "text")))

    array = suffix_array(texts).withColumn("batch", F.pmod("chunk", F.lit(batches)))
    array = scratch.store(array, partition_by="batch")
    columns = ["key", "run", "chunk", "n"]
    for batch in range(batches):
        matches = index.add(array.filter(F.col("batch") == batch).select(columns))

    def pack(rows):
        for chunk, batch in by_chunk(rows):
            ids = batch.column(1)
            for row, data, offsets in text_blocks(batch.column(2)):
                own = json.dumps(ids.slice(row, len(offsets) - 1).to_pylist()).encode()
                yield pa.record_batch(
                    [pa.array([chunk], pa.int64()), pa.array([own]), pa.array([offsets.tobytes()]),
                     pa.array([zstandard.compress(data.tobytes(), 3)])],
                    names=["chunk", "ids", "offsets", "texts"],
                )

    buckets = width(spark)

    def first_cut(known: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        """Whole documents where all is decided; texts of open runs, and the documents that wait for them."""
        known = known.iloc[np.argsort(known["run"].to_numpy("i8").view("u8"), kind="stable")]
        hashes = known["run"].to_numpy("i8").view("u8")
        equal, others = known["equal"].to_numpy(bool), known["others"].to_numpy()
        speaker = known["speaker"].to_numpy(bool)
        out, spoken, met = [], set(), np.zeros(len(hashes), bool)
        packs: dict[int, list] = {}
        for own, offsets, packed in zip(blocks["ids"], blocks["offsets"], blocks["texts"], strict=True):
            raw = zstandard.decompress(packed)
            data, offsets = np.frombuffer(raw, "u1"), np.frombuffer(offsets, "i8")
            r = runs(data, offsets)
            at = np.searchsorted(hashes, r["run"])
            hit = np.flatnonzero(at < len(hashes))
            hit = hit[hashes[at[hit]] == r["run"][hit]]
            at = at[hit]
            met[at] = True
            whole = hit[equal[at]]
            # One byte of distance per document: ranges of two documents never join.
            start, end = union_of(r["a"][whole] + r["doc"][whole], r["b"][whole] + LENGTH + r["doc"][whole])
            open_ = hit[~equal[at] & (others[at] > 0)]
            for i, k in zip(hit.tolist(), at.tolist(), strict=True):
                if others[k] and speaker[k] and (run := int(r["run"][i])) not in spoken:
                    if equal[k]:
                        spoken.add(run)
                    slices = -(-int(others[k] + 1) // slice_rows)
                    key = int(r["key"][i])
                    bucket = (key + run % slices * 0x9E3779B97F4A7C15) % 2**64 % buckets
                    a, b = int(r["a"][i]), int(r["b"][i])
                    packs.setdefault(bucket, []).append((run, b - a + 1, bool(equal[k]), slices > 1, raw[a : b + LENGTH]))
            first = np.searchsorted(start, offsets + np.arange(len(offsets)))
            pending = np.searchsorted(r["a"][open_], offsets)
            for i, doc in enumerate(json.loads(own)):
                lo, hi = int(offsets[i]), int(offsets[i + 1])
                s, e = start[first[i] : first[i + 1]] - lo - i, end[first[i] : first[i + 1]] - lo - i
                wait = open_[pending[i] : pending[i + 1]]
                if len(wait):
                    out.append({
                        "kind": 2, "doc_id": doc, "texts": zstandard.compress(raw[lo:hi], 3),
                        "spans": np.stack([s, e], 1).astype("i8").tobytes(),
                        "runs": np.stack([r["run"][wait].view("i8"), r["a"][wait] - lo], 1).tobytes(),
                    })
                else:
                    out.append({"kind": 0} | result_row(doc, raw[lo:hi], s, e))
        if not met[np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]].all():
            raise RuntimeError("a chunk's texts are not those that its suffixes were taken from")
        for bucket, rows in packs.items():
            run, n, flag, split, text = zip(*rows, strict=True)
            out.append({
                "kind": 1, "bucket": bucket, "texts": zstandard.compress(b"".join(text), 3),
                "runs": np.array([np.array(run, "u8").view("i8"), n, flag, split], "i8").tobytes(),
            })
        chunk = blocks["chunk"].iloc[0] if len(blocks) else known["chunk"].iloc[0]
        frame = pd.DataFrame(out, columns=[
            "kind", "chunk", "bucket", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "texts", "runs"
        ]).assign(chunk=int(chunk))
        return frame.astype({c: "Int64" for c in ("kind", "bucket", "doc_id", "n_bytes", "n_removed", "n_spans")})

    packed = texts.mapInArrow(pack, "chunk long, ids binary, offsets binary, texts binary")
    statuses = matches.select("chunk", "run", "equal", "others", "speaker")
    first = statuses.groupBy("chunk").cogroup(packed.groupBy("chunk")).applyInPandas(
        first_cut, f"kind int, chunk long, bucket int, {RESULT}, texts binary, runs binary"
    )
    first = scratch.store(first)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        """Repeated windows among the texts of a bucket, and those that other slices must see."""
        heads = [np.frombuffer(x, "i8").reshape(4, -1) for x in group["runs"]]
        chunk = np.repeat(group["chunk"].to_numpy(), [h.shape[1] for h in heads])
        run, n, equal, split = np.concatenate(heads, axis=1)
        data = np.frombuffer(b"".join(zstandard.decompress(x) for x in group["texts"]), "u1")
        begin = np.append(0, np.cumsum(n + LENGTH - 1))[:-1]
        prefix = prefix_hash(BYTE_VALUE[data], BYTES)
        of = np.repeat(np.arange(len(n)), n)
        off = np.arange(len(of)) - np.repeat(np.append(0, np.cumsum(n))[:-1], n)
        window = range_hash(prefix, begin[of] + off, begin[of] + off + LENGTH, BYTES)
        _, place, count = np.unique(window, return_inverse=True, return_counts=True)
        again = count[place] > 1
        found = ranges_of(np.flatnonzero(again & (equal[of] == 0)), of, off, chunk, run).assign(kind=0, bucket=0, windows=b"")
        told = np.flatnonzero(split[of] == 1)
        _, one = np.unique(window[told], return_index=True)
        told = told[one]
        known = again[told] | (equal[of[told]] == 1)
        facts = np.stack([window[told].view("i8"), known, chunk[of[told]], run[of[told]], off[told]])
        to = (window[told] % U(buckets)).astype("i8")
        packs = [(k, facts[:, to == k].tobytes()) for k in np.unique(to).tolist()]
        sent = pd.DataFrame(packs, columns=["bucket", "windows"]).assign(kind=1, chunk=0, run=0, start=0, end=0)
        return pd.concat([found, sent])[["kind", "bucket", "windows", "chunk", "run", "start", "end"]]

    def compare_slices(group: pd.DataFrame) -> pd.DataFrame:
        """Windows that two slices have, packed by window hash; each slice tells a window once."""
        facts = np.concatenate([np.frombuffer(x, "i8").reshape(5, -1) for x in group["windows"]], axis=1)
        window, known, chunk, run, off = facts
        _, place, count = np.unique(window, return_inverse=True, return_counts=True)
        late = np.flatnonzero((count[place] > 1) & (known == 0))
        everyone = np.arange(len(window))
        return ranges_of(late, everyone, off, chunk, run)

    def ranges_of(at: np.ndarray, of: np.ndarray, off: np.ndarray, chunk: np.ndarray, run: np.ndarray) -> pd.DataFrame:
        """Windows at ``at`` as ranges of neighbouring ones of the same run."""
        new = np.append(True, (of[at][1:] != of[at][:-1]) | (off[at][1:] != off[at][:-1] + 1))[: len(at)]
        s = np.flatnonzero(new)
        e = np.append(s[1:], len(at))[: len(s)] - 1
        return pd.DataFrame({"chunk": chunk[of[at[s]]], "run": run[of[at[s]]], "start": off[at[s]], "end": off[at[e]] + 1})

    contexts = first.filter("kind = 1").select("bucket", "chunk", "runs", "texts")
    compared = cut(contexts.groupBy("bucket").applyInPandas(
        compare, "kind int, bucket long, windows binary, chunk long, run long, start int, end int"
    ))
    columns = ["chunk", "run", "start", "end"]
    ranges = compared.filter("kind = 0").select(columns)
    late = compared.filter("kind = 1").select("bucket", "windows").groupBy("bucket").applyInPandas(
        compare_slices, "chunk long, run long, start int, end int"
    )

    def last_cut(found: pd.DataFrame, waiting: pd.DataFrame) -> pd.DataFrame:
        by_run = {k: (g["start"].to_numpy("i8"), g["end"].to_numpy("i8")) for k, g in found.groupby("run")}
        out = []
        for doc, text, spans, open_ in zip(
            waiting["doc_id"], waiting["texts"], waiting["spans"], waiting["runs"], strict=True
        ):
            spans, open_ = np.frombuffer(spans, "i8").reshape(-1, 2), np.frombuffer(open_, "i8").reshape(-1, 2)
            starts, ends = [spans[:, 0]], [spans[:, 1]]
            for run, a in open_.tolist():
                if run in by_run:
                    starts.append(a + by_run[run][0])
                    ends.append(a + by_run[run][1] - 1 + LENGTH)
            start, end = union_of(np.concatenate(starts), np.concatenate(ends))
            out.append(result_row(None if pd.isna(doc) else int(doc), zstandard.decompress(text), start, end))
        columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        return pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    waiting = first.filter("kind = 2").select("chunk", "doc_id", "texts", "spans", "runs")
    rest = ranges.unionByName(late).groupBy("chunk").cogroup(waiting.groupBy("chunk")).applyInPandas(last_cut, RESULT)
    done = first.filter("kind = 0").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
    result = cut(done.unionByName(rest))
    scratch.release()
    return result
