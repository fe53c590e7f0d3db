"""Cross-tokenizer alignment through anchors at space-marked tokens.

Each text, with one space put before it, is tokenized in full by a byte-level BPE (A) and by a
sentencepiece model with byte fallback (B). Both token sequences spell the same bytes, so
places where a token of A and a token of B end together can be verified by byte offsets. An
anchor is such a shared end before a token of A and a token of B that both begin with a
space. Anchors cut a document into windows, pairs of short id tuples, and what a window
looks like inside depends on its ids alone:

* its *groups*, the runs of tokens between shared ends;
* its *links*, the pairs of an A and a B token whose byte ranges overlap, one for every stretch
  between neighbouring ends of either side.

Neither tokenizer has a token across a single space between two other characters (the regular
expression of A starts anew there, and no piece of B goes on after a letter with a space), so the
text is tokenized in full segment by segment between such places, each with its space before
it, and a segment met again is not tokenized again. Windows are then cut inside the segments.

A chunk of documents (about ``chunk_bytes`` of text) keeps each distinct segment and window once, aligns
a window once, and writes its documents as segment numbers. A pair of ids is counted over the
corpus from the chunks' pair counts; the counts go back to the chunks that hold the pair, are
summed per distinct window and from there per document. A chunk is bounded in bytes and has
its number written beside its rows, so nothing depends on how often a task is run.

Defined results: a text that is null, empty or not spelled back by both tokenizers (it holds
U+2581, say) has no tokens: counts 0 and groups ''. Strings of special tokens are plain text.
A null doc_id is kept as null; repeated rows give a row each and count each; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import collections
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkrank.llm.common import Scratch, bounded_batches, give_back, once_per_worker
from linkrank.llm.hashing import Powers, mixed, prefix_hash, range_hash

CHUNK_BYTES = 4 << 20
MOST_SEGMENTS = 300_000  # a task forgets its segments beyond, at a chunk's end
BLOCK_BYTES, PART_BYTES = 1 << 19, 1 << 17
JOINED = 256  # segments that are tokenized as one text
IDS = Powers(0xC2B2AE3D27D4EB4F)


class Side:
    """One tokenizer: its ids for texts, and the bytes of its tokens."""

    def __init__(self, path: str):
        self.path = path
        self.token_bytes = self.load()
        self.length = np.array([len(b) for b in self.token_bytes], "i8")
        self.spaced = np.array([b[:1] == b" " for b in self.token_bytes])

    def load(self) -> list[bytes]:
        raise NotImplementedError

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def tokens(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, tokens per segment, whether they spell the segment with a space before it)``."""
        found = self.encode(segments)
        ids = np.fromiter(itertools.chain.from_iterable(found), "u4", sum(map(len, found)))
        return ids, np.array([len(x) for x in found], "u4"), spells(found, segments, self)


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevelSide(Side):
    def load(self) -> list[bytes]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(self.path)
        t.encode_special_tokens = True
        t.no_truncation()
        t.no_padding()
        letters = byte_letters()
        vocabulary = t.get_vocab(with_added_tokens=False)
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            spelled[i] = bytes(letters[c] for c in token)
        return spelled

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def tokens(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As above; segments go in as texts of many, as most of the time of a short text is not its tokenizing.

        Only those that begin and end without white space, where no token goes across the space between them;
        the tokens must spell the segments, with an end at each of theirs, or all are tokenized one by one.
        """
        if any(map(EDGE.search, segments)):
            return super().tokens(segments)
        many = [" ".join(segments[i : i + JOINED]) for i in range(0, len(segments), JOINED)]
        ids = list(itertools.chain.from_iterable(self.encode(many)))
        if b"".join(map(self.token_bytes.__getitem__, ids)) != (" " + " ".join(many)).encode():
            return super().tokens(segments)
        ids = np.array(ids, "u4")
        ends, wanted = np.cumsum(self.length[ids]), np.cumsum([len(s.encode()) + 1 for s in segments])
        last = np.searchsorted(ends, wanted)
        if not np.array_equal(ends[last], wanted):
            return super().tokens(segments)
        return ids, np.diff(last, prepend=-1).astype("u4"), np.ones(len(segments), bool)


class PieceSide(Side):
    def load(self) -> list[bytes]:
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=self.path)
        spelled = []
        for i in range(m.vocab_size()):
            piece = m.id_to_piece(i)
            if m.is_control(i) or m.is_unknown(i):
                spelled.append(b"")
            else:
                spelled.append(bytes([int(piece[3:5], 16)]) if m.is_byte(i) else piece.replace("\u2581", " ").encode())
        return spelled

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def side(path: str) -> Side:
    """The tokenizer of a file, loaded once per Python worker."""
    return once_per_worker(path, lambda: ByteLevelSide(path) if path.endswith(".json") else PieceSide(path))


def id_values(ids: np.ndarray) -> np.ndarray:
    return mixed((ids.astype("u8") + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Windows:
    """Distinct windows in flat arrays: ids of both sides and their numbers per window."""

    def __init__(self, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray):
        self.ids_a, self.n_a, self.ids_b, self.n_b = ids_a, n_a, ids_b, n_b

    def align(self, length_a: np.ndarray, length_b: np.ndarray):
        """``(links a, links b, links per window, groups per window, group of each A and B token)``.

        All windows are laid out one after the other over their bytes. A stretch between
        neighbouring ends lies in one token of each side: that pair is a link. ``length_a`` and
        ``length_b`` are the bytes of each id's token.
        """
        end_a, end_b = np.cumsum(length_a[self.ids_a]), np.cumsum(length_b[self.ids_b])
        size = int(end_a[-1]) if len(end_a) else 0
        marks = np.zeros(size + 1, "i1")
        marks[end_a] |= 1
        marks[end_b] |= 2
        ends = np.flatnonzero(marks)
        at = marks[ends]
        of_a, of_b, shared = before(at & 1), before(at >> 1), at == 3
        # Where each token ends; a token without bytes ends where the one before it does.
        place_a, place_b = places(end_a, ends, at & 1), places(end_b, ends, at >> 1)
        if len(end_a) and (of_a[-1] + 1 < len(end_a) or of_b[-1] + 1 < len(end_b)):
            of_a, of_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        last = np.zeros(len(ends), "i1")
        last[place_a[np.cumsum(self.n_a) - 1]] = 1
        window, n = before(last), len(self.n_a)
        links, groups = np.bincount(window, minlength=n), np.bincount(window[shared], minlength=n)
        group = before(shared)
        return self.ids_a[of_a], self.ids_b[of_b], links, groups, group[place_a], group[place_b]

    def strings(self, n: int, of_a: np.ndarray, of_b: np.ndarray) -> list[str]:
        """The groups of each window: ``a1,a2|b1;a3|b2,b3``, from the ``n`` groups of all and those of their tokens.

        Every token becomes its decimal digits and the sign after it, in the order of the groups.
        """
        upto_a, upto_b = np.cumsum(np.bincount(of_a, minlength=n)), np.cumsum(np.bincount(of_b, minlength=n))
        ids = np.empty(len(of_a) + len(of_b), "i8")
        ids[np.arange(len(of_a)) + np.append(0, upto_b)[of_a]] = self.ids_a
        ids[np.arange(len(of_b)) + upto_a[of_b]] = self.ids_b
        after = np.full(len(ids), ord(","), "u1")
        after[upto_a + np.append(0, upto_b)[:-1] - 1] = ord("|")
        after[upto_a + upto_b - 1] = ord(";")
        signs, digits = decimal(int(ids.max(initial=0)) + 1)
        rows, digits = signs[ids], digits[ids]
        rows[np.arange(len(ids)), digits] = after
        text = rows[np.arange(rows.shape[1]) <= digits[:, None]].tobytes().decode()
        ends = np.append(0, np.cumsum(digits + 1))[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        return [text[i : j - 1] for i, j in zip(ends[:-1], ends[1:], strict=True)]


def before(marks: np.ndarray) -> np.ndarray:
    """How many marks stand before each place."""
    return np.cumsum(marks, dtype="i8") - marks


def places(token_ends: np.ndarray, ends: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Where each of ``token_ends`` is in ``ends``, which ``marks`` tells if no two of them are equal."""
    found = np.flatnonzero(marks)
    return found if len(found) == len(token_ends) else np.searchsorted(ends, token_ends)


def decimal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(digits, a column left over; how many digits)`` of the numbers below ``n``."""
    number, wide = np.arange(n), len(str(n))
    count = 1 + sum((number >= 10**k).astype("i8") for k in range(1, wide + 1))
    signs = np.zeros((n, wide + 1), "u1")
    for k in range(wide):
        at = count - 1 - k
        some = np.flatnonzero(at >= 0)
        signs[some, at[some]] = ord("0") + number[some] // 10**k % 10
    return signs, count


# U+180E counts as a space in some versions of Unicode.
# The space stands first, so the search goes from space to space.
CUT = re.compile(" (?<=[^\\s\u180e] )(?=[^\\s\u180e])")
EDGE = re.compile("\\A[\\s\u180e]|[\\s\u180e]\\Z")


def spells(ids: list[list[int]], texts: list[str], of: Side) -> np.ndarray:
    """Whether the tokens of each text are its bytes with a space before them."""
    flat = b"".join(map(of.token_bytes.__getitem__, itertools.chain.from_iterable(ids)))
    if flat == "".join([" " + t for t in texts]).encode():
        return np.ones(len(texts), bool)
    pairs = zip(ids, texts, strict=True)
    return np.array([b"".join([of.token_bytes[i] for i in x]) == (" " + t).encode() for x, t in pairs], bool)


class Tokens:
    """Token ids of texts laid out one after the other."""

    def __init__(self):
        self.ids, self.n = [], []

    def add(self, ids: np.ndarray, n: np.ndarray) -> None:
        self.ids.append(ids)
        self.n.append(n)

    def take(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, tokens per text)`` of some texts."""
        self.ids, self.n = [joined(self.ids)], [joined(self.n)]
        n = self.n[0]
        ends, n = np.cumsum(n, dtype="i8")[texts], n[texts].astype("i8")
        return self.ids[0][flat_ranges(ends - n, ends)].astype("i8"), n


def joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, "u4")


class Segments:
    """A task's distinct segments with their tokens on both sides, numbered in order of appearance."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        # A text met for the first time gets the next number.
        self.number: dict[str, int] = collections.defaultdict(itertools.count().__next__)
        self.tokens_a, self.tokens_b, self.spelled = Tokens(), Tokens(), bytearray()

    def add(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(segment numbers, segments per text)``; a text that is not spelled back has none."""
        cuts = [CUT.split(t) if t else [] for t in texts]
        n, before = np.array([len(c) for c in cuts], "i8"), len(self.number)
        flat = np.fromiter(map(self.number.__getitem__, itertools.chain.from_iterable(cuts)), "i8", int(n.sum()))
        new = list(itertools.islice(reversed(self.number), len(self.number) - before))[::-1]
        begin, size = 0, 0
        for i, s in enumerate(new, 1):
            size += len(s)
            if size >= PART_BYTES or i == len(new):
                self._tokenize(new[begin:i])
                begin, size = i, 0
        lost = np.append(0, np.cumsum(np.frombuffer(bytes(self.spelled), "u1")[flat] == 0))
        ends = np.cumsum(n)
        whole = lost[ends] == lost[ends - n]
        return flat[np.repeat(whole, n)], np.where(whole, n, 0)

    def _tokenize(self, new: list[str]) -> None:
        (ids_a, n_a, spelled_a), (ids_b, n_b, spelled_b) = self.a.tokens(new), self.b.tokens(new)
        self.tokens_a.add(ids_a, n_a)
        self.tokens_b.add(ids_b, n_b)
        self.spelled += (spelled_a & spelled_b).astype("u1").tobytes()

    def windows(self, known: np.ndarray) -> tuple[Windows, np.ndarray, np.ndarray]:
        """``(distinct windows, window numbers, windows per segment)`` of the segments ``known``, all spelled."""
        a, b = self.a, self.b
        (ids_a, n_a), (ids_b, n_b) = self.tokens_a.take(known), self.tokens_b.take(known)
        end_a, end_b = np.cumsum(a.length[ids_a]), np.cumsum(b.length[ids_b])
        # A shared end is an anchor if both sides go on with a space; every segment begins with one.
        at_a = np.flatnonzero(np.append(a.spaced[ids_a], True)[1:])
        at_b = np.flatnonzero(np.append(b.spaced[ids_b], True)[1:])
        _, i, j = np.intersect1d(end_a[at_a], end_b[at_b], assume_unique=True, return_indices=True)
        stop_a, stop_b = at_a[i] + 1, at_b[j] + 1
        start_a, start_b = np.append(0, stop_a)[:-1], np.append(0, stop_b)[:-1]
        per_segment = np.diff(np.searchsorted(start_a, np.append(0, np.cumsum(n_a))))
        first, of = distinct(ids_a, start_a, stop_a, ids_b, start_b, stop_b)
        x, y = flat_ranges(start_a[first], stop_a[first]), flat_ranges(start_b[first], stop_b[first])
        found = Windows(ids_a[x], (stop_a - start_a)[first], ids_b[y], (stop_b - start_b)[first])
        return found, of, per_segment


def distinct(ids_a, start_a, stop_a, ids_b, start_b, stop_b) -> tuple[np.ndarray, np.ndarray]:
    """``(a position of each distinct pair of id tuples, its number for every window)``.

    Hashes bring equal windows together, and the id tuples decide.
    """
    ha = range_hash(prefix_hash(id_values(ids_a), IDS), start_a, stop_a, IDS)
    hb = range_hash(prefix_hash(id_values(ids_b), IDS), start_b, stop_b, IDS)
    _, first, of = np.unique(ha * np.uint64(31) + hb, return_index=True, return_inverse=True)
    like = first[of]
    same = all(
        np.array_equal(stop - start, (stop - start)[like])
        and np.array_equal(ids[flat_ranges(start, stop)], ids[flat_ranges(start[like], stop[like])])
        for ids, start, stop in ((ids_a, start_a, stop_a), (ids_b, start_b, stop_b))
    )
    if same:
        return first, of
    seen: dict[tuple[bytes, bytes], int] = {}
    spans = zip(start_a.tolist(), stop_a.tolist(), start_b.tolist(), stop_b.tolist(), strict=True)
    of = np.array([seen.setdefault((ids_a[i:j].tobytes(), ids_b[k:m].tobytes()), len(seen)) for i, j, k, m in spans])
    return np.unique(of, return_index=True)[1], of


def flat_ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after the other."""
    n = end - start
    return np.arange(int(n.sum())) + np.repeat(start - np.append(0, np.cumsum(n))[:-1], n)


def sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of runs of ``n`` values."""
    total = np.append(0, np.cumsum(values))
    ends = np.cumsum(n)
    return total[ends] - total[ends - n]


CHUNKS = pa.schema(
    [("chunk", pa.int64()), ("docs", pa.binary()), ("windows", pa.binary()), ("ids", pa.binary()),
     ("pair", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))]
)
CHUNKS_DDL = "chunk long, docs binary, windows binary, ids binary, pair array<long>, n array<long>"
ALIGNED = pa.schema(
    [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
     ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups", pa.string())]
)
ALIGNED_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)


def blocks(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about a block of text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype("i8")
    ends = np.cumsum(sizes)
    row = 0
    while row < len(ends):
        stop = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + BLOCK_BYTES, "right")))
        yield row, stop
        row = stop


def _pack(array: np.ndarray, kind: str = "u4") -> bytes:
    import zstandard

    return zstandard.compress(array.astype(kind).tobytes(), 3)


def _unpack(data: bytes, kind: str = "u4") -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(data), kind).astype("i8")


def _chunks(path_a: str, path_b: str, chunk_bytes: int):
    """Rows of documents as segment numbers, and at each chunk's end a row with its windows and pair counts."""

    def run(batches):
        a, b = side(path_a), side(path_b)
        chunk, segments, uses, held = TaskContext.get().partitionId() << 32, Segments(a, b), [], 0

        def closing() -> pa.RecordBatch:
            known, times = np.unique(np.concatenate(uses), return_counts=True)
            w, numbers, per_segment = segments.windows(known.astype("i8"))
            times = np.bincount(numbers, np.repeat(times, per_segment), len(w.n_a)).astype("i8")
            x, y, links, _, _, _ = w.align(a.length, b.length)
            pair, at = np.unique(x << 32 | y, return_inverse=True)
            n = np.bincount(at, np.repeat(times, links), len(pair)).astype("i8")
            parts = [known, per_segment, numbers, w.n_a, w.n_b, w.ids_a, w.ids_b]
            sizes = json.dumps([len(p) for p in parts]).encode()
            return pa.record_batch([[chunk], [sizes], [None], [_pack(np.concatenate(parts))], [pair], [n]], schema=CHUNKS)

        for batch in batches:
            doc, column = batch.column(0), batch.column(1)
            for row, stop in blocks(column):
                texts = [t or "" for t in column.slice(row, stop - row).to_pylist()]
                numbers, n = segments.add(texts)
                uses.append(numbers.astype("u4"))
                own = json.dumps([doc.slice(row, stop - row).to_pylist(), n.tolist()]).encode()
                yield pa.record_batch([[chunk], [own], [_pack(numbers)], [None], [None], [None]], schema=CHUNKS)
                held += sum(map(len, texts))
                if held >= chunk_bytes:
                    yield closing()
                    chunk, uses, held = chunk + 1, [], 0
                    if len(segments.number) > MOST_SEGMENTS:
                        segments = Segments(a, b)
                    give_back()
        if uses:
            yield closing()
        del segments, uses
        give_back()

    return run


def _documents(length_a: np.ndarray, length_b: np.ndarray):
    """Documents of a chunk from its segment numbers and the corpus counts of its pairs."""

    def run(key, counts: pa.Table, rows: pa.Table) -> pa.Table:
        give_back()  # what the group before this one took
        is_closing = rows.column("ids").is_valid()
        closing, kept = rows.filter(is_closing).to_pylist()[0], rows.filter(pc.invert(is_closing))
        sizes = json.loads(closing["docs"])
        known, per_segment, numbers, n_a, n_b, ids_a, ids_b = np.split(_unpack(closing["ids"]), np.cumsum(sizes)[:-1])
        place = np.zeros(int(known.max(initial=-1)) + 1, "i8")
        place[known] = np.arange(len(known))
        w = Windows(ids_a, n_a, ids_b, n_b)
        x, y, links, groups, of_a, of_b = w.align(length_a, length_b)
        pair = counts.column("pair").to_numpy()
        order = np.argsort(pair)
        at = np.searchsorted(pair, x << 32 | y, sorter=order)
        at = order[at] if len(order) else at
        total = counts.column("total").to_numpy()[at]
        best = counts.column("is_best").to_numpy()[at].astype("i8")
        of_window = [n_a, n_b, groups, links, sums(best, links), sums(total, links)]
        of_segment = [sums(v[numbers], per_segment) for v in of_window]
        strings = w.strings(int(groups.sum()), of_a, of_b)
        cuts, numbers = np.append(0, np.cumsum(per_segment)).tolist(), numbers.tolist()
        strings = [
            strings[numbers[i]] if k == i + 1 else ";".join(map(strings.__getitem__, numbers[i:k]))
            for i, k in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        out = []
        for r in (kept.slice(i, 1).to_pylist()[0] for i in range(kept.num_rows)):
            ids, n = json.loads(r["docs"])
            n = np.array(n, "i8")
            own = place[_unpack(r["windows"])]
            found = [sums(v[own], n) for v in of_segment]
            own, ends = own.tolist(), np.cumsum(n).tolist()
            text = [";".join(map(strings.__getitem__, own[e - k : e])) for e, k in zip(ends, n.tolist(), strict=True)]
            columns = [pa.array(c, f.type) for c, f in zip([ids, *found, text], ALIGNED, strict=True)]
            out.append(pa.Table.from_arrays(columns, schema=ALIGNED))
        return pa.concat_tables(out)

    return run


def pair_counts(want: DataFrame) -> DataFrame:
    """``(pair, total, is_best)`` of ``(pair, n)`` rows: the corpus count, and whether it is its B id's highest.

    A B id has at most as many pairs as the A vocabulary has ids, which bounds the window.
    """
    counts = want.groupBy("pair").agg(F.sum("n").alias("total"))
    of_b = W.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return counts.withColumn("is_best", F.col("total") == F.max("total").over(of_b))


def align(
    docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES, scratch: Scratch | None = None
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)``, a row per document.

    ``path_a``: a byte-level tokenizer (``.json``); ``path_b``: a sentencepiece model.
    ``groups`` is ``a1,a2|b1;a3|b2,b3``: decimal A and B ids between shared ends. The result reads
    tables in ``scratch``, which the caller may release once it is written.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scratch = scratch or Scratch(docs.sparkSession)
    chunks = scratch.store(texts.mapInArrow(_chunks(path_a, path_b, chunk_bytes), CHUNKS_DDL))
    want = chunks.filter("pair is not null").select("chunk", F.inline(F.arrays_zip("pair", "n")))
    counts = scratch.store(pair_counts(want))
    back = want.drop("n").join(counts, "pair").withColumnRenamed("chunk", "of")
    rows = chunks.select("chunk", "docs", "windows", "ids")
    return back.groupBy("of").cogroup(rows.groupBy("chunk")).applyInArrow(
        _documents(side(path_a).length, side(path_b).length), ALIGNED_DDL
    )
