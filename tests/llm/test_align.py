"""The alignment of two tokenizers against a plain count over every pair of tokens."""

import functools
import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from linkrank.llm import align as A
from linkrank.llm.queries import op11_tokenizer_alignment, tokenizer_path
from llm_helpers import prose

BYTES, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@functools.cache
def loaded():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def ids_of(text):
    t, s = loaded()
    return t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)


def ends_of(ids, table):
    out, at, joined = [], 0, b""
    for i in ids:
        joined += table[i]
        at += len(table[i])
        out.append(at)
    return out, joined


def brute(rows):
    a, b = A.side(BYTES), A.side(PIECES)
    docs = []
    for doc, text in rows:
        found = None
        if text:
            x, y = ids_of(text)
            ex, jx = ends_of(x, a.token_bytes)
            ey, jy = ends_of(y, b.token_bytes)
            if jx == jy == (" " + text).encode():
                found = x, ex, y, ey
        docs.append((doc, found))
    links, counts = [], Counter()
    for _, found in docs:
        mine = []
        if found:
            x, ex, y, ey = found
            sx, sy = [0, *ex[:-1]], [0, *ey[:-1]]
            j = 0
            for i in range(len(x)):
                while ey[j] <= sx[i]:
                    j += 1
                k = j
                while k < len(y) and sy[k] < ex[i]:
                    mine.append((x[i], y[k]))
                    k += 1
        links.append(mine)
        counts.update(mine)
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for (doc, found), mine in zip(docs, links, strict=True):
        groups = ""
        n_groups = 0
        if found:
            x, ex, y, ey = found
            shared = sorted(set(ex) & set(ey))
            n_groups, i, j, parts = len(shared), 0, 0, []
            for end in shared:
                p, q = ex.index(end, i) + 1, ey.index(end, j) + 1
                parts.append(",".join(map(str, x[i:p])) + "|" + ",".join(map(str, y[j:q])))
                i, j = p, q
            groups = ";".join(parts)
        out.append(
            (doc, len(found[0]) if found else 0, len(found[2]) if found else 0, n_groups, len(mine),
             sum(counts[p] == top[p[1]] for p in mine), sum(counts[p] for p in mine), groups)
        )
    return out


def key(row):
    return tuple((v is None, v) for v in row)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "  two  spaces and a tab\tand\n\nlines "), (6, "U+2581 ▁ inside"),
    (7, "<|endoftext|> and <s>x</s> <0x41>"), (8, "naïve café — 東京 🙂🙂 é"), (9, "a" * 5000), (None, "no id here"),
    (10, "same words same words"), (10, "another text of the same id"), (11, "same words same words"), (11, "same words same words"),
    (12, "don't we'll it's 12345 678,90"), (13, "\x00 nul"), (14, " nbsp　wide"), (15, "nothing▁"),
]


def test_decimal_digits():
    signs, n = A.decimal(1205)
    assert all(bytes(signs[i, : n[i]]) == str(i).encode() for i in range(1205))


@pytest.mark.parametrize("chunk_bytes", [A.CHUNK_BYTES, 1])
def test_alignment_is_brute_force(spark, make_docs, chunk_bytes, monkeypatch):
    monkeypatch.setattr(A, "MOST_SEGMENTS", 100 * chunk_bytes)
    rng = random.Random(5)
    rows = ODD + [(100 + i, prose(rng, rng.randrange(1, 200), 60)) for i in range(40)]
    got = A.align(make_docs(rows, clash=True), BYTES, PIECES, chunk_bytes=chunk_bytes).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_windows_begin_at_anchors():
    a, b = A.side(BYTES), A.side(PIECES)
    text = "Unbelievable tokenizations of   strange  words,don't  they split   of strange"
    segments = A.Segments(a, b)
    numbers, n = segments.add([text, text, "of", "U+2581 \u2581 here"])
    w, of, per_segment = segments.windows(np.unique(numbers))
    assert n.tolist() == [5, 5, 1, 0]
    spelled = []
    at_a = at_b = 0
    for x, y in zip(w.n_a.tolist(), w.n_b.tolist(), strict=True):
        one = b"".join(a.token_bytes[j] for j in w.ids_a[at_a : at_a + x])
        assert one == b"".join(b.token_bytes[j] for j in w.ids_b[at_b : at_b + y])
        spelled.append(one.decode())
        at_a, at_b = at_a + x, at_b + y
    assert all(s[0] == " " for s in spelled) and len(set(spelled)) == len(spelled)
    cuts = np.append(0, np.cumsum(per_segment))
    whole = "".join(spelled[i] for s in numbers[:5] for i in of[cuts[s] : cuts[s + 1]])
    assert whole == " " + text
    # Anchors also lie inside a segment, where several spaces meet.
    assert per_segment.max() > 1


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    a, b = A.side(BYTES), A.side(PIECES)
    segments = A.Segments(a, b)
    known = np.unique(segments.add(["several quite different words here  and  quite  different"])[0])

    def classes():
        w, of, _ = segments.windows(known)
        assert len(set(of.tolist())) == len(w.n_a)
        return [of.tolist().index(n) for n in of]

    want = classes()
    monkeypatch.setattr(A, "range_hash", lambda p, s, e, powers: np.zeros(len(s), "u8"))
    assert classes() == want and len(set(want)) < len(want)


def test_segments_are_cut_without_a_trace():
    rng = random.Random(8)
    a, b = A.side(BYTES), A.side(PIECES)
    odd = ["\n", "\t", "\u00a0", "\u0085", "\u180e", "\u200b", "\x1c", "\u3000", "é", "東", "🙂", "\u0301"]
    alphabet = [*"aB7,.'", " ", " ", " ", *odd]
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(1, 25)))
        parts = A.CUT.split(text)
        assert [i for p in a.encode(parts) for i in p] == a.encode([text])[0], text
        assert [i for p in b.encode(parts) for i in p] == b.encode([text])[0], text


def test_several_megabytes(spark, make_docs):
    text = prose(random.Random(3), 400_000, 5000)
    assert len(text) > 2_000_000
    row = A.align(make_docs([(1, text), (2, "short text")]), BYTES, PIECES).filter("doc_id = 1").first()
    x, y = ids_of(text)
    assert (row.n_a, row.n_b) == (len(x), len(y)) and row.n_groups == row.groups.count("|")


def test_empty_table(make_docs):
    assert A.align(make_docs([]), BYTES, PIECES).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_registered_query_is_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = op11_tokenizer_alignment(spark, SF)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute(rows)]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want)


def test_memory_is_given_back_after_every_chunk_and_task(monkeypatch):
    """A Python worker outlives its task: what it took for segments must not stay with it."""
    import types

    import pyarrow as pa

    calls = []
    monkeypatch.setattr(A, "give_back", lambda: calls.append(1), raising=False)
    monkeypatch.setattr(A, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.record_batch([pa.array([1, 2], pa.int64()), pa.array(["one text", "another text"])], names=["doc_id", "text"])
    rows = list(A._chunks(BYTES, PIECES, 1)([batch, batch]))
    assert sum(r.column("ids").null_count == 0 for r in rows) == 2 and len(calls) == 3


def test_segments_are_tokenized_many_at_a_time(monkeypatch):
    """A text of many segments gives each segment the tokens that it has alone, for a fraction of the calls' texts."""
    a, texts = A.ByteLevelSide(BYTES), []
    encode = a.encode
    monkeypatch.setattr(a, "encode", lambda given: texts.extend(given) or encode(given))
    rng = random.Random(5)
    words = ["it's", "'s", "12", "x1y", "é", "é", "́", "a.\nB", "<|endoftext|>", "日本", "🙂", "--", "a\tb", "\x00"]
    segments = [rng.choice(words) + rng.choice(words) for _ in range(3000)]
    ids, n, spelled = a.tokens(segments)
    assert len(texts) <= len(segments) / 100
    alone = encode(segments)
    assert ids.tolist() == [i for x in alone for i in x] and n.tolist() == list(map(len, alone)) and spelled.all()
    # Beside white space a token may go across: one by one then.
    odd = [*segments[:300], " x", "y\n", "z᠎", *segments[:300]]
    ids, n, _ = a.tokens(odd)
    alone = encode(odd)
    assert ids.tolist() == [i for x in alone for i in x] and n.tolist() == list(map(len, alone))


def test_windows_are_aligned_by_passes_as_by_searches():
    """Links and groups against a plain search per window, tokens without bytes included."""
    rng, length = random.Random(3), np.array([0, 1, 2, 3, 4])

    def cut(size, zero):
        out = []
        while size:
            k = rng.randint(1, min(4, size))
            out.append(k)
            size -= k
            if zero and size and rng.random() < 0.3:
                out.append(0)
        return out

    for zero in (False, True):
        sizes = [rng.randint(1, 12) for _ in range(200)]
        a, b = [cut(s, False) for s in sizes], [cut(s, zero) for s in sizes]
        flat = [np.array([i for w in x for i in w]) for x in (a, b)]
        w = A.Windows(flat[0], np.array([len(x) for x in a]), flat[1], np.array([len(x) for x in b]))
        x, y, links, groups, of_a, of_b = w.align(length, length)
        want, want_links, want_groups, group_a, group_b = [], [], [], [], []
        for p, q in zip(a, b, strict=True):
            ends_p, ends_q = np.cumsum(p), np.cumsum(q)
            ends, shared = sorted({*ends_p, *ends_q}), sorted({*ends_p} & {*ends_q})
            want += [(p[np.searchsorted(ends_p, e)], q[np.searchsorted(ends_q, e)]) for e in ends]
            group_a += [len(shared[: np.searchsorted(shared, e)]) + sum(want_groups) for e in ends_p]
            group_b += [len(shared[: np.searchsorted(shared, e)]) + sum(want_groups) for e in ends_q]
            want_links.append(len(ends))
            want_groups.append(len(shared))
        assert list(zip(x.tolist(), y.tolist(), strict=True)) == want
        assert links.tolist() == want_links and groups.tolist() == want_groups
        assert of_a.tolist() == group_a and of_b.tolist() == group_b
