"""BPE encoding and decoding through a table of distinct words.

A tokenizer that splits texts into words before its merges gives a word the same ids
wherever it stands. So texts are split into words, every distinct word is encoded once,
and ids and pieces are joined back to the words' positions:

1. each chunk (``CHUNK_BYTES`` of an input partition's texts) lists its distinct words;
2. the lists are shuffled by word and every word is encoded with the tokenizer, once;
3. ids go back to the chunks that asked for them and meet the chunk's texts, which are
   split again; ids and, through the vocabulary's id-to-piece table, pieces are placed
   by position.

Words are found with NumPy on code points. The classes of the code points (letter,
number, space, other) and their lower case are asked of the tokenizer itself, not taken
from Python's Unicode tables. Texts that need more (not in NFC, characters that change
length, strings of special tokens, rare planes) are split by the tokenizer's own
normalizer and pre-tokenizer. A word that a chunk misses in the joined table, as could
happen if its rows are recomputed in another layout, is encoded on the spot.

Supported are tokenizers of this family: lower-casing normalizer, a split into runs of
letters, single numbers, runs of others and English contractions, word-end suffix, no
decoder. :func:`check_supported` refuses others.

Defined results: a null or empty text has no tokens (hashes of the empty string); a null
doc_id is kept as null; repeated rows give a row each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import bounded_batches, once_per_worker, width
from linkrank.llm.hashing import Powers, prefix_hash, range_hash, text_blocks

SPACE, LETTER, NUMBER, OTHER, SLOW = range(5)
CHUNK_BYTES = 12 << 20
PLANES = 0x30000  # code points beyond are left to the tokenizer
SHORT, LONG = [ord(c) for c in "stmd"], [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]


def check_supported(spec: dict) -> None:
    kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = [p["type"] for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    plain = all(not t.get("normalized") and not t.get("single_word") for t in spec.get("added_tokens", []))
    if kinds != ["NFC", "Replace", "Lowercase"] or split != ["Split", "ByteLevel"] or spec.get("decoder") or not plain:
        raise ValueError("this operator encodes with lower-casing word BPE tokenizers only")


def code_point_tables(tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """``(class, lower case)`` of every code point, as the tokenizer treats them."""
    kind = np.full(0x110000, SLOW, "u1")
    lower = np.arange(0x110000, dtype="u4")
    for plane in range(0, PLANES, 0x8000):
        points = [
            c for c in range(plane, plane + 0x8000)
            if not 0xD800 <= c < 0xE000 and c != 1 and unicodedata.category(chr(c)) != "Cn"
        ]
        if not points:
            continue
        marked = "".join(chr(c) + "\x01" for c in points)
        forms = tokenizer.normalizer.normalize_str(marked).split("\x01")[:-1]
        if len(forms) != len(points):
            continue  # marks that merge with their neighbours: the whole stretch stays slow
        one = [(c, f) for c, f in zip(points, forms, strict=True) if len(f) == 1]
        # A letter leaves one piece, a space two, an other three and a number four.
        probe = " ".join("a" + f + f + "a" for _, f in one)
        starts = np.arange(len(one)) * 5
        at = np.array([b for _, (b, _) in tokenizer.pre_tokenizer.pre_tokenize_str(probe)])
        pieces = np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(one))
        for (c, f), n in zip(one, pieces.tolist(), strict=True):
            kind[c] = {1: LETTER, 2: SPACE, 3: OTHER, 4: NUMBER}.get(n, SLOW)
            lower[c] = ord(f)
    return kind, lower


class Splitter:
    """Splits blocks of text into the words that the tokenizer would encode."""

    def __init__(self, source: str, kind: np.ndarray, lower: np.ndarray):
        self.source, self.kind, self.lower = source, kind, lower
        self.special = [t["content"] for t in json.loads(source)["added_tokens"]]
        self.value = np.random.default_rng(99).integers(1, 2**63, 0x110000, dtype="u8")
        self.powers = Powers(0xA0761D6478BD642F)
        self._tokenizer = None

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_str(self.source)
            self._tokenizer.no_truncation()
            self._tokenizer.no_padding()
        return self._tokenizer

    def hashes(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return range_hash(prefix_hash(self.value[points], self.powers), start, end, self.powers)

    def hash_words(self, words: list[str]) -> np.ndarray:
        end = np.cumsum([len(w) for w in words], dtype="i8")
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "u4")
        return self.hashes(points, np.append(0, end[:-1]).astype("i8"), end)

    def slow_words(self, text: str) -> list[str]:
        """The words of one text by the tokenizer's own steps; special tokens are words."""
        out, rest = [], text
        while rest:
            found = min(
                ((i, -len(s), s) for s in self.special if (i := rest.find(s)) >= 0), default=(len(rest), 0, "")
            )
            plain = self.tokenizer.normalizer.normalize_str(rest[: found[0]])
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)
            out += [plain[a:b] for _, (a, b) in pieces]
            if found[2]:
                out.append(found[2])
            rest = rest[found[0] + len(found[2]) :]
        return out

    def split(self, data: np.ndarray, offsets: np.ndarray):
        """``(words, hash of each, first word of each text, strings)`` of a block.

        ``strings(i)`` gives the text of the words at the positions ``i``.
        """
        block = data.tobytes().decode()
        given = np.frombuffer(block.encode("utf-32-le"), "u4")
        points, kind = self.lower[given], self.kind[given]
        begins = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
        slow = self._slow(block, kind, begins)
        n = len(points)
        inside = (kind != SPACE) & (kind != SLOW)
        begin = inside.copy()
        begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        edge = begins[:-1][begins[:-1] < n]
        begin[edge] |= inside[edge]
        text_start = np.zeros(n + 3, bool)
        text_start[begins] = True
        # "'s" and the like at the start of a run of others that is just the apostrophe.
        p = np.flatnonzero(begin & (points == 39))
        p = p[p + 1 < n]
        p = p[(kind[p + 1] == LETTER) & ~text_start[p + 1]]
        after = np.append(points, [0, 0])
        two = np.zeros(len(p), bool)
        for a, b in LONG:
            two |= (after[p + 1] == a) & (after[p + 2] == b) & ~text_start[p + 2]
        one = np.isin(after[p + 1], SHORT) & ~two
        begin[p[one | two] + 1] = False
        nxt = np.concatenate([p[one] + 2, p[two] + 3])
        nxt = nxt[nxt < n]
        begin[nxt] |= (kind[nxt] == LETTER) & ~text_start[nxt]
        start = np.flatnonzero(begin)
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | begin[1:]
        end = np.flatnonzero(stop) + 1
        hashes = self.hashes(points, start, end)
        first = np.searchsorted(start, begins)
        low = points.tobytes().decode("utf-32-le", "surrogatepass")
        strings = lambda i: [low[a:b] for a, b in zip(start[i].tolist(), end[i].tolist(), strict=True)]
        if not slow:
            return hashes, first, strings
        # Slow texts take the place of their part.
        parts, extra, sizes, at = [], [], np.diff(first), []
        for t, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
            if t in slow:
                words = self.slow_words(block[begins[t] : begins[t + 1]])
                parts.append(self.hash_words(words) if words else np.zeros(0, "u8"))
                at.append(np.arange(len(extra), len(extra) + len(words)) + len(start))
                extra += words
                sizes[t] = len(words)
            else:
                parts.append(hashes[a:b])
                at.append(np.arange(a, b))
        at = np.concatenate(at)
        plain = strings

        def mixed_strings(i):
            return [extra[j - len(start)] if j >= len(start) else plain(np.array([j]))[0] for j in at[i].tolist()]

        return np.concatenate(parts), np.append(0, np.cumsum(sizes)), mixed_strings

    def _slow(self, block: str, kind: np.ndarray, begins: np.ndarray) -> set[int]:
        text_of = lambda i: int(np.searchsorted(begins, i, "right")) - 1
        slow = {text_of(i) for i in np.flatnonzero(kind == SLOW)}
        for s in self.special:
            i = block.find(s)
            while i >= 0:
                slow.add(text_of(i))
                i = block.find(s, i + 1)
        if not unicodedata.is_normalized("NFC", block):
            texts = zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)
            slow |= {t for t, (a, b) in enumerate(texts) if not unicodedata.is_normalized("NFC", block[a:b])}
        return slow


WORD = pa.schema([("chunk", pa.int64()), ("word", pa.string())])
TEXTS = pa.schema([("chunk", pa.int64()), ("ids", pa.binary()), ("offsets", pa.binary()), ("texts", pa.binary())])
IDS = pa.schema([("chunk", pa.int64()), ("hash", pa.binary()), ("count", pa.binary()), ("ids", pa.binary())])


def chunk_blocks(batches, size: int = CHUNK_BYTES):
    """``(chunk, ids, bytes, offsets)`` of the blocks of a task; a chunk is ``size`` bytes of a partition's texts."""
    first, done = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for row, data, offsets in text_blocks(batch.column(1)):
            yield first + done // size, batch.column(0).slice(row, len(offsets) - 1), data, offsets
            done += len(data)


def encode_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, a row per document."""
    import zstandard
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        source = f.read()
    check_supported(json.loads(source))
    kind, lower = code_point_tables(Tokenizer.from_str(source))
    changed = np.flatnonzero(lower != np.arange(len(lower)))
    shared = spark.sparkContext.broadcast(
        (source, zstandard.compress(kind.tobytes()), changed, lower[changed])
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    name = hashlib.sha256(source.encode()).hexdigest()

    def splitter() -> Splitter:
        return once_per_worker(name, build)

    def build() -> Splitter:
        source, packed, changed, to = shared.value
        low = np.arange(0x110000, dtype="u4")
        low[changed] = to
        return Splitter(source, np.frombuffer(zstandard.decompress(packed), "u1"), low)

    def list_words(batches):
        split, last, seen = splitter(), None, np.zeros(0, "u8")
        for chunk, _, data, offsets in chunk_blocks(batches):
            if chunk != last:
                last, seen = chunk, np.zeros(0, "u8")
            hashes, _, strings = split.split(data, offsets)
            new, at = np.unique(hashes, return_index=True)
            place = np.searchsorted(seen, new)
            fresh = np.append(seen, 0)[place] != new
            fresh |= place == len(seen)
            seen = np.insert(seen, place[fresh], new[fresh])
            words = strings(at[fresh])
            if words:
                yield pa.record_batch([pa.array([chunk] * len(words), pa.int64()), pa.array(words)], schema=WORD)

    def encode_words(batches):
        split = splitter()
        for batch in batches:
            column = batch.column(1).dictionary_encode()
            words, at = column.dictionary.to_pylist(), column.indices.to_numpy()
            if not words:
                continue
            ids = [e.ids for e in split.tokenizer.encode_batch(words, add_special_tokens=False)]
            hashes = split.hash_words(words)
            count = np.array([len(i) for i in ids], "u4")
            flat = np.array([i for x in ids for i in x], "u4")
            start = np.append(0, np.cumsum(count))[:-1].astype("i8")
            chunks = batch.column(0).to_numpy()
            out = []
            order = np.argsort(chunks, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(chunks[order])) + 1):
                w = at[part]
                n = count[w].astype("i8")
                spread = np.repeat(start[w] - np.append(0, np.cumsum(n))[:-1], n) + np.arange(n.sum())
                packed = [zstandard.compress(x[i].tobytes(), 3) for x, i in ((count, w), (flat, spread))]
                out.append((chunks[part[0]], hashes[w].tobytes(), *packed))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), IDS, strict=True)], schema=IDS)

    def pack_texts(batches):
        for chunk, ids, data, offsets in chunk_blocks(batches):
            yield pa.record_batch(
                [pa.array([chunk], pa.int64()), pa.array([json.dumps(ids.to_pylist()).encode()]),
                 pa.array([offsets.tobytes()]), pa.array([zstandard.compress(data.tobytes(), 6)])], schema=TEXTS
            )

    def place(table: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        split = splitter()
        vocabulary = split.tokenizer.get_vocab(with_added_tokens=True)
        piece = {i: p for p, i in vocabulary.items()}

        def written(ids: list[int]) -> tuple[bytes, bytes]:
            return " ".join(map(str, ids)).encode(), " ".join([piece[i] for i in ids]).encode()

        known = np.frombuffer(b"".join(table["hash"]), "u8")
        count, flat = (np.frombuffer(b"".join(map(zstandard.decompress, table[c])), "u4") for c in ("count", "ids"))
        count, flat = count.astype("i8"), flat.tolist()
        order = np.argsort(known, kind="stable")
        known, end = known[order], np.cumsum(count)
        numbers, pieces = [], []
        for a, b in zip((end - count)[order].tolist(), end[order].tolist(), strict=True):
            x, y = written(flat[a:b])
            numbers.append(x)
            pieces.append(y)
        count = count[order]
        del table, flat, end, order
        out = {"doc_id": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for own, offsets, packed in zip(blocks["ids"], blocks["offsets"], blocks["texts"], strict=True):
            data = np.frombuffer(zstandard.decompress(packed), "u1")
            offsets = np.frombuffer(offsets, "i8")
            hashes, first, strings = split.split(data, offsets)
            at = np.searchsorted(known, hashes)
            lost = np.flatnonzero(known[np.minimum(at, len(known) - 1)] != hashes) if len(known) else np.arange(len(hashes))
            n = np.zeros(len(hashes), "i8")
            have = np.ones(len(hashes), bool)
            have[lost] = False
            n[have] = count[at[have]]
            spare = {}
            for i, word in zip(lost.tolist(), strings(lost), strict=True):
                ids = split.tokenizer.encode(word, add_special_tokens=False).ids
                spare[i], n[i] = written(ids), len(ids)
            total = np.append(0, np.cumsum(n))
            at = at.tolist()
            for i, doc in enumerate(json.loads(own)):
                a, b = int(first[i]), int(first[i + 1])
                if spare:
                    both = [spare[j] if j in spare else (numbers[at[j]], pieces[at[j]]) for j in range(a, b)]
                    x, y = [p[0] for p in both], [p[1] for p in both]
                else:
                    x, y = [numbers[j] for j in at[a:b]], [pieces[j] for j in at[a:b]]
                out["doc_id"].append(doc)
                out["n_tokens"].append(int(total[b] - total[a]))
                out["ids_sha256"].append(hashlib.sha256(b" ".join(x)).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(b" ".join(y)).hexdigest())
        return pd.DataFrame(out).astype({"doc_id": "Int64", "n_tokens": "i8"})

    n = width(spark)
    words = texts.mapInArrow(list_words, "chunk long, word string")
    words = words.repartition(n, "word").sortWithinPartitions("word")
    encoded = words.mapInArrow(encode_words, "chunk long, hash binary, count binary, ids binary")
    packed = texts.mapInArrow(pack_texts, "chunk long, ids binary, offsets binary, texts binary")
    return encoded.groupBy("chunk").cogroup(packed.groupBy("chunk")).applyInPandas(
        place, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
