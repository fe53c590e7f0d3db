"""Line dedup with a deletion-neighbourhood join, in DataFrame functions only.

A line is a duplicate of an earlier one if they are equal or, from ``near_words`` words
on, one word edit apart (a word replaced, added or left out). Words are separated by
single spaces after tabs, ``\\v``, ``\\f`` and ``\\r`` have become spaces and the ends are trimmed.

1. Equal lines fall together by hash; the earliest occurrence stands for them.
2. Of two lines one edit apart, either the first or the second half is equal. Lines that
   share no half with another line have no neighbour and need no variants; that leaves
   a small part of the lines for the next step and loses no pair.
3. Every remaining line emits its deletion neighbourhood: for each word the hash of the
   line without it, as far as the halves it shares leave that word open. Two lines with
   an equal variant at the same place differ by a replaced word; a variant equal to a
   whole line differs from it by that one word. Per key only the earliest line matters,
   so keys are joined by grouped minima, never as pairs within a group.
4. The edit distance of each line and its candidates is verified on the words. A line
   with a verified earlier neighbour goes, with all its copies.

"Earlier" is by document id, then line number, of first occurrences. Lines shorter than
``min_words`` words always stay, so do blank lines.

Defined results: a null text stays null and has no lines; an empty text keeps its one
empty line; rows with a null doc_id are kept as they are and take no part; rows equal in
id and text lose the same lines; an empty table gives an empty result; extra columns
are carried along by :func:`drop_repeated_lines`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkrank.llm.common import cut, fresh

BREAK = "\n"


def all_spaces(text: str) -> Column:
    """``\\t``, ``\\v``, ``\\f`` and ``\\r`` become spaces (byte by byte, much faster than ``translate``)."""
    out = F.col(text)
    for c in "\t\v\f\r":
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def n_words(line: str) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(F.col(line), F.lit(" "), F.lit(""))) + 1


def all_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, no, line)`` of every line; ``version`` tells texts with the same id apart."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    lines = known.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"),
        F.posexplode(F.split(all_spaces("text"), BREAK)).alias("no", "line"),
    )
    return lines.withColumn("line", F.trim("line"))


def _words(line: str, count: Column) -> Column:
    """The first ``count`` words of a line, or the last ones if it is negative."""
    return F.call_function("substring_index", F.col(line), F.lit(" "), count)


def half_keys(line: str, n: str) -> Column:
    """Keys of the halves: a pair one edit apart shares one of them at the shorter length."""
    keys = []
    for shorter in (F.col(n), F.col(n) - 1):
        head = F.floor(shorter / 2).cast("int")
        tail = (shorter - head).cast("int")
        keys.append(F.xxhash64(F.lit("head"), shorter, _words(line, head)))
        keys.append(F.xxhash64(F.lit("tail"), shorter, _words(line, -tail)))
    return F.array(*keys)


def repeated_lines(docs: DataFrame, min_words: int = 5, near_words: int = 10) -> DataFrame:
    """``(doc_id, version, no)`` of the lines to remove."""
    n = F.col("n")
    lines = all_lines(docs).withColumn("n", n_words("line")).filter(n >= min_words)
    lines = cut(
        lines.select(
            "doc_id", "version", "no", F.xxhash64("line").alias("id"), "n",
            F.when(n >= near_words, half_keys("line", "n")).alias("halves"),
        )
    )
    place = F.struct("doc_id", "no")
    firsts = cut(lines.groupBy("id").agg(F.min(place).alias("first")))

    # Lines that share a half with another line, and which halves.
    halves = lines.filter("halves is not null").select("id", F.posexplode("halves").alias("half", "key"))
    shared = halves.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a != b")
    able = halves.join(shared.select("key"), "key", "left_semi")
    able = able.groupBy("id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("half"))).alias("halves"))
    able = cut(able.join(firsts, "id").select("id", "halves", "first.doc_id", "first.no"))
    # One text per line, from its first occurrence; a repeated row brings it twice.
    texts = _may_contain(all_lines(docs), able, "doc_id", "no").filter(n_words("line") >= near_words)
    texts = texts.select("doc_id", "no", F.xxhash64("line").alias("id"), "line")
    texts = cut(texts.join(able, ["id", "doc_id", "no"]).dropDuplicates(["id"]))
    gone = cut(_near(texts).withColumn("near", F.lit(True)))

    judged = lines.select("doc_id", "version", "no", "id").join(firsts, "id").join(gone, "id", "left")
    again = place != F.col("first")
    return judged.filter(F.col("near") | again).select("doc_id", "version", "no")


def _may_contain(rows: DataFrame, wanted: DataFrame, *key: str, bits: int = 26) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``wanted``.

    A bitmap of ``2 ** bits`` hash values, 8 MB however many rows are wanted, is broadcast in
    slices of 4 KB.
    """
    place = F.pmod(F.xxhash64(F.lit("bit"), *key), F.lit(1 << bits)) + 1
    maps = wanted.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("slice"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bitmap", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("getbit", byte, at.bitwiseAND(F.lit(7)).cast("int"))
    found = rows.withColumn("slice", F.bitmap_bucket_number(place)).join(F.broadcast(maps), "slice")
    return found.filter(bit == 1).select(rows.columns)


def _near(texts: DataFrame) -> DataFrame:
    """``(id)`` of the lines ``texts(id, doc_id, no, line, halves)`` that have an earlier line one word edit away."""
    words = texts.select("id", "halves", F.posexplode(F.split("line", " ")).alias("at", "word"))
    # Hashes of words at places, combined by XOR: a prefix keeps its places, a suffix moves up by one.
    here, moved = F.xxhash64("at", "word"), F.xxhash64(F.col("at") - 1, F.col("word"))
    whole_line = W.partitionBy("id")
    upto = whole_line.orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    words = words.select(
        "id", "halves", "at", F.count(F.lit(1)).over(whole_line).alias("n"),
        F.bit_xor(here).over(whole_line).alias("all"),
        F.bit_xor(here).over(upto).bitwiseXOR(here)
        .bitwiseXOR(F.bit_xor(moved).over(upto)).bitwiseXOR(F.bit_xor(moved).over(whole_line)).alias("rest"),
    )

    def key(kind: str, when: Column, n: Column, *hashed: Column) -> Column:
        of = F.struct(F.xxhash64(n, *hashed).alias("key"), F.lit(kind).alias("kind"))
        return F.when(when, of)

    def has(half: int) -> Column:
        return F.col("halves").bitwiseAND(F.lit(1 << half)) != 0

    n, at = F.col("n"), F.col("at")
    same, shorter = F.floor(n / 2), F.floor((n - 1) / 2)
    # The word in question lies in the half that is not shared.
    replaced = (has(0) & (at >= same)) | (has(1) & (at < same))
    missing = (has(2) & (at >= shorter)) | (has(3) & (at <= shorter))
    keys = F.array(
        key("replaced", replaced, n, at, F.col("rest")), key("added", missing, n - 1, F.col("rest")),
        key("whole", at == 0, n, F.col("all")),
    )
    rows = words.select("id", F.explode(F.array_compact(keys)).alias("k")).select("id", "k.key", "k.kind")
    # A whole line meets the variants that lack a word: same key, other kind.
    joint = F.when(F.col("kind") == "replaced", F.lit("replaced")).otherwise(F.lit("added"))
    rows = cut(rows.select("id", F.xxhash64(joint, "key").alias("key"), (F.col("kind") == "whole").alias("whole"),
                           (F.col("kind") == "replaced").alias("replaced")))
    met = rows.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a != b").select("key")
    order_of = texts.select("id", F.struct("doc_id", "no", "id").alias("place"))
    rows = cut(rows.join(met, "key", "left_semi").distinct().join(order_of, "id"))
    least = rows.groupBy("key").agg(
        F.min("place").alias("any"), F.min(F.when(F.col("whole"), F.col("place"))).alias("full")
    )
    met = rows.join(least, "key")
    # In an "added" group the whole line neighbours all others, they only it.
    partner = F.when(F.col("replaced") | F.col("whole"), F.col("any")).otherwise(F.col("full"))
    pairs = met.select("id", "place", partner.alias("partner")).filter("partner < place")
    pairs = pairs.select("id", F.col("partner.id").alias("other")).distinct()
    mine = texts.select("id", F.split("line", " ").alias("a"))
    theirs = texts.select(F.col("id").alias("other"), F.split("line", " ").alias("b"))
    verified = pairs.join(mine, "id").join(theirs, "other").filter(one_edit("a", "b"))
    return verified.select("id").distinct()


def one_edit(a: str, b: str) -> Column:
    """Whether two arrays of words are at most one replaced, added or missing word apart."""

    def same(x: Column, y: Column) -> Column:
        differs = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False))
        shorter = F.least(F.size(x), F.size(y))
        return F.when(differs > 0, differs - 1).otherwise(shorter)

    x, y = F.col(a), F.col(b)
    longer = F.greatest(F.size(x), F.size(y))
    near = F.abs(F.size(x) - F.size(y)) <= 1
    return near & (same(x, y) + same(F.reverse(x), F.reverse(y)) >= longer - 1)


def drop_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """The rows and columns of ``docs`` with the repeated lines taken out of ``text``."""
    return _cleaned(docs, **options)[0].select(docs.columns)


def _cleaned(docs: DataFrame, **options) -> tuple[DataFrame, str]:
    """``docs`` without the repeated lines, and the name of a further column with their number."""
    own, version, gone = (fresh(docs, c) for c in ("line_doc", "line_version", "line_gone"))
    removed = (
        repeated_lines(docs, **options)
        .groupBy(F.col("doc_id").alias(own), F.col("version").alias(version))
        .agg(F.collect_set("no").alias(gone))
    )
    joined = docs.join(
        removed, (docs["doc_id"] == removed[own]) & (F.xxhash64(docs["text"]) == removed[version]), "left"
    )
    # A column of its own: inside the function below a text would be split again for every line that stays.
    split = fresh(joined, "line_split")
    joined = joined.withColumn(split, F.when(F.col(gone).isNotNull(), F.split(docs["text"], BREAK)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone))
    # Sorting the kept numbers is not needed: array_except keeps their order.
    kept = F.array_join(F.transform(stay, lambda i: F.get(split, i)), BREAK)
    text = F.when(F.col(gone).isNotNull(), kept).otherwise(docs["text"])
    columns = [text.alias("text") if c == "text" else docs[c] for c in docs.columns]
    count = F.when(F.col(gone).isNull(), 0).otherwise(F.size(F.col(gone))).cast("long")
    return joined.select(*columns, count.alias(gone)), gone


def line_dedup(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_lines, n_removed, text)``, a row per row of ``docs``; ``text`` is what stays."""
    lines = F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit(BREAK), F.lit(""))) + 1, F.lit(0))
    texts = docs.select("doc_id", "text", lines.cast("long").alias("n_lines"))
    cleaned, removed = _cleaned(texts, **options)
    return cleaned.select("doc_id", "n_lines", F.col(removed).alias("n_removed"), "text")
