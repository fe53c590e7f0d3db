"""Spelling variants: words one edit apart, found through an index of variable-length grams.

Words are counted over all texts first. Near pairs are then searched among the distinct words:

1. *Dictionary.* Words are padded with ``qmax - 1`` signs on both sides. A gram (``qmin`` to ``qmax``
   code points) that occurs more than ``limit`` times is too frequent and is pruned in favour of its
   extensions; the dictionary is given by the frequent grams. Their number is at most
   characters / limit for each length, and the limit grows with the words so that this stays below
   ``MOST_GRAMS``; only they are broadcast.
2. *Decomposition.* From every place of a word the shortest gram is taken that is not too frequent
   (or the longest allowed); grams inside an earlier one's reach are left out. The ends of
   the grams that stay are all different and rising.
3. *Affected grams.* Which gram starts at a place depends on its own code points alone. So one
   edit at place ``i`` can change only grams that hold it, and can swallow only grams that end where a
   new gram around it may end: both kinds end after ``i`` and not after ``i + qmax``. The most ends in such a
   stretch bound the grams of a word that an edit affects. The padding keeps the first and
   the last gram out of one stretch, so some gram always stays.
4. *List merging.* Two near words share all but the affected grams, at the same place or one
   further, so the rarest ``affected + 1`` grams of each must have one in common: only these are in the
   lists, by gram, place and length of the word. Words that meet in a list are candidates.
5. *Verification* by the edit distance.

A list that is long all the same (``LONG_LIST`` words and more) is cut by what the words have on the
other side of the gram: the edit is either before it or after it, so two near words are equal
on one side of it, and only words with an equal side meet.

Defined results: a null text has no words, a null doc_id counts as the empty string; repeated rows
count each; ties of the form go to the word first in code-point order; an empty table, or one
without words of the wanted length and count, gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import Scratch, bounded_batches, cut
from linkrank.llm.hashing import Powers, as_long, mixed, prefix_hash, range_hash

QMIN, QMAX = 2, 5
LEAST_LIMIT, MOST_GRAMS = 50, 200_000
LONG_LIST = 500
RUN = "[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
POINTS = Powers(0x9FB21C651E98DF25)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def words(docs: DataFrame, drop_every: int | None = None, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """``(word, n)``: the runs of letters of all texts, A-Z as a-z, and how often they occur.

    With ``drop_every``, a run loses one code point where that number divides the crc32 of
    ``<doc_id>:<run>``: a fixed share of the occurrences is misspelled.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.translate("text", CAPITALS, SMALL), F.lit(RUN), F.lit(0))).alias("run"),
    ).filter(F.char_length("run") >= min_length)
    word = F.col("run")
    if drop_every:
        runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        less = F.concat(F.expr("left(run, cast(h % char_length(run) as int))"), F.substr("run", at + 2))
        word = F.when(F.col("h") % drop_every == 0, less).otherwise(F.col("run"))
    counts = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.char_length("word") >= min_length) & (F.col("n") >= min_count))


class Padded:
    """Words of a batch as code points laid out one after the other, with their padding."""

    def __init__(self, column: pa.Array, qmax: int):
        texts = column.to_pylist()
        pad = qmax - 1
        left, right = "\x01" * pad, "\x02" * pad
        points = np.frombuffer("".join([left + t + right for t in texts]).encode("utf-32-le"), "u4")
        self.pad, self.qmax = pad, qmax
        self.length = np.array([len(t) for t in texts], "i8")
        self.end = np.cumsum(self.length + 2 * pad)
        self.start = self.end - self.length - 2 * pad
        self.prefix = prefix_hash(mixed((points.astype("u8") + np.uint64(1)) * GOLDEN) | np.uint64(1), POINTS)
        self.size = len(points)

    def grams(self, at: np.ndarray, q: int | np.ndarray) -> np.ndarray:
        return range_hash(self.prefix, at, at + q, POINTS)

    def places(self, q: int) -> np.ndarray:
        """Where grams of ``q`` code points start, without crossing words."""
        end_of = np.repeat(self.end, self.end - self.start)
        at = np.arange(self.size)
        return at[at + q <= end_of]


class Frequent:
    """The frequent grams by length: sorted hashes and their counts."""

    def __init__(self, rows: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.rows = rows

    def count(self, hashes: np.ndarray, q: int) -> np.ndarray:
        """How often grams of length ``q`` occur, 0 if they are not frequent."""
        known, counts = self.rows.get(q, (np.zeros(0, "u8"), np.zeros(0, "i8")))
        if not len(known):
            return np.zeros(len(hashes), "i8")
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[at] == hashes, counts[at], 0)


def decompose(p: Padded, frequent: Frequent, qmin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(word, start, length)`` of the grams of every word, in order."""
    at = p.places(qmin)
    word = np.searchsorted(p.end, at, "right")
    length = np.full(len(at), qmin, "i8")
    for q in range(qmin, p.qmax):
        more = np.flatnonzero((length == q) & (at + q < p.end[word]))
        length[more[frequent.count(p.grams(at[more], q), q) > 0]] += 1
    end = at + length
    # A gram that reaches no further than an earlier one says nothing new.
    kept = np.ones(len(at), bool)
    kept[1:] = end[1:] > np.maximum.accumulate(end)[:-1]
    return word[kept], at[kept], length[kept]


def affected(p: Padded, word: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Per word, the most grams that one edit can change: ends in a stretch of ``qmax`` places after the edit."""
    ends = np.zeros(p.size + 2, "i8")
    ends[end] = 1
    upto = np.cumsum(ends)
    # Edits fall on the word's own code points or right behind the last of them.
    n = p.length + 1
    owner = np.repeat(np.arange(len(n)), n)
    i = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + (p.start + p.pad)[owner]
    hit = upto[np.minimum(i + p.qmax, p.end[owner])] - upto[i]
    return np.maximum.reduceat(hit, np.cumsum(n) - n) if len(n) else np.zeros(0, "i8")


def rarest(p: Padded, frequent: Frequent, qmin: int):
    """``(word, gram, place in the word, length, occurrences of the gram if it is frequent)`` for the lists."""
    word, at, length = decompose(p, frequent, qmin)
    gram = p.grams(at, length)
    often = np.zeros(len(at), "i8")
    for q in range(qmin, p.qmax + 1):
        some = np.flatnonzero(length == q)
        often[some] = frequent.count(gram[some], q)
    need = affected(p, word, at + length) + 1
    order = np.lexsort((at, gram, often, word))
    rank = np.arange(len(order)) - np.searchsorted(word, word[order])
    chosen = order[rank < need[word[order]]]
    return word[chosen], gram[chosen], at[chosen] - p.start[word[chosen]], length[chosen], often[chosen]


def mix(*parts: np.ndarray | int) -> np.ndarray:
    h = np.zeros(1, "u8")
    for x in parts:
        h = mixed((h ^ np.atleast_1d(x).astype("u8")) * GOLDEN + GOLDEN)
    return h


LISTS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("key", pa.list_(pa.int64())), ("probe", pa.list_(pa.int64()))])
LISTS_DDL = "word string, n long, key array<long>, probe array<long>"


def list_keys(p: Padded, frequent: Frequent, qmin: int, long_list: int):
    """``(word, keys)`` of the lists a word stands in and ``(word, keys)`` of those it looks through.

    A word stands in the lists of its own length. It looks through these and, for words with one
    code point more, through the lists of that length at the same place and one further.
    """
    word, gram, place, length, often = rarest(p, frequent, qmin)
    size = p.length[word]
    keys, probes = [], []
    short = np.flatnonzero(often < long_list)
    keys.append((word[short], mix(gram[short], place[short], size[short])))
    for longer, further in ((0, 0), (1, 0), (1, 1)):
        probes.append((word[short], mix(gram[short], place[short] + further, size[short] + longer)))
    far = np.flatnonzero(often >= long_list)
    if len(far):
        w, start = word[far], p.start[word[far]] + place[far]
        before = range_hash(p.prefix, p.start[w], start, POINTS)
        after = range_hash(p.prefix, start + length[far], p.end[w], POINTS)
        for tag, rest, moves in ((1, before, (0,)), (2, after, (0, 1))):
            # Equal before the gram: it has not moved. Equal after it: it may stand one further.
            keys.append((w, mix(tag, gram[far], place[far], size[far], rest)))
            probes.append((w, mix(tag, gram[far], place[far], size[far], rest)))
            for further in moves:
                probes.append((w, mix(tag, gram[far], place[far] + further, size[far] + 1, rest)))
    return [tuple(np.concatenate(x) for x in zip(*pairs, strict=True)) for pairs in (keys, probes)]


def frequent_grams(distinct: DataFrame, qmin: int, qmax: int, least: int, most: int) -> Frequent:
    """Grams that occur more often than the limit, at most ``most`` of each length."""
    total = distinct.agg(F.sum(F.char_length("word") + 2 * (qmax - 1))).first()[0] or 0
    limit = max(least, -(-int(total) // most))

    def count(batches):
        for batch in batches:
            p = Padded(batch.column(0), qmax)
            for q in range(qmin, qmax + 1):
                gram, n = np.unique(p.grams(p.places(q), q), return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(gram), q, "i4")), as_long(gram), n.astype("i8")], names=["q", "gram", "n"])

    seen = distinct.select("word").mapInArrow(count, "q int, gram long, n long")
    found = seen.groupBy("q", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") > limit).toArrow()
    q, gram, n = (found.column(c).to_numpy() for c in ("q", "gram", "n"))
    rows = {}
    for k in range(qmin, qmax + 1):
        at = np.flatnonzero(q == k)
        order = at[np.argsort(gram[at].view("u8"))]
        rows[k] = gram[order].view("u8"), n[order]
    return Frequent(rows)


def one_edit(a: str, b: str) -> Column:
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def near_pairs(
    distinct: DataFrame, qmin: int = QMIN, qmax: int = QMAX, least_limit: int = LEAST_LIMIT,
    most_grams: int = MOST_GRAMS, long_list: int = LONG_LIST,
) -> DataFrame:
    """``(a, n_a, b, n_b)``, each pair of words of ``distinct(word, n)`` one edit apart once.

    ``distinct`` should be a stored table: it is read three times. No list is broadcast, however small its estimate.
    """
    spark = distinct.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(frequent_grams(distinct, qmin, qmax, least_limit, most_grams).rows)

    def lists(batches):
        frequent = Frequent(shared.value)
        for batch in batches:
            p = Padded(batch.column(0), qmax)
            columns = []
            for word, key in list_keys(p, frequent, qmin, long_list):
                order = np.argsort(word, kind="stable")
                offsets = np.searchsorted(word[order], np.arange(batch.num_rows + 1)).astype("i4")
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(as_long(key[order]))))
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], schema=LISTS)

    listed = distinct.select("word", "n").mapInArrow(lists, LISTS_DDL)
    of = listed.select(F.explode("key").alias("key"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    probes = listed.select(F.explode("probe").alias("key"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    more = F.char_length("b") - F.char_length("a")
    # Spark sizes a table by what it was made from, so the lists seem as small as the words; broadcast they would fill the driver.
    met = probes.hint("merge").join(of.hint("merge"), "key").filter((more == 1) | ((more == 0) & (F.col("a") < F.col("b"))))
    return met.filter(one_edit("a", "b")).select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: the last word reached by following forms.

    Every round doubles the steps taken; a form is more frequent than its word, so there are no rings.
    """
    now = scratch.store(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(ahead.hint("merge"), "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("on")
        )
        moved = scratch.store(moved)
        if moved.filter("on").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def spelling_groups(
    docs: DataFrame, drop_every: int | None = None, min_length: int = 5, min_count: int = 3, times: int = 2, **options
) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)``, a row per word.

    A word's form is its near word of largest count, if that is at least ``times`` the word's own.
    """
    scratch = Scratch(docs.sparkSession)
    distinct = scratch.store(words(docs, drop_every, min_length, min_count))
    pairs = scratch.store(near_pairs(distinct, **options))
    both = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("m"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("less"), "other"))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"), F.max("n").alias("n"))
    enough = -F.col("best.less") >= times * F.col("n")
    near = scratch.store(
        near.select(
            "word", "n_near", F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")
        )
    )
    last = roots(near.filter("form is not null"), scratch)
    result = cut(
        distinct.join(near.hint("merge"), "word", "left").join(last.hint("merge"), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )
    scratch.release()
    return result
