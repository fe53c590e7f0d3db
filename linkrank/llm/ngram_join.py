"""N-gram Jaccard join of documents: MinHash banding, then exact verification on full n-gram sets.

Words are the runs of characters other than space and ``\\t`` to ``\\r``, taken as they are; an
n-gram is ``n`` consecutive words (a text of fewer words has one, all its words). Texts
equal byte for byte form a class first; their representative, the smallest doc_id,
takes part in the join with the class's size as weight. The bands and rows of the MinHash
table follow from the target recall at the threshold; see :mod:`linkrank.llm.similar` for
what happens to the band keys.

Every document gets its class (the smallest doc_id reached by links of at least the
threshold) and its number of links, copies included.

Defined results: a null, empty or blank text and a null doc_id link with nothing and are
classes of their own; rows with the same doc_id are one document, and if their texts
differ the least counts, for its digest and its n-grams alike; :func:`keep_one` also keeps a row of
every other text of such an id, unless a document that counts has the same text; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkrank.llm.common import bounded_batches, cut, fresh, one_text_per_id
from linkrank.llm.hashing import Words, as_long, band_keys, bands_for, text_blocks
from linkrank.llm.similar import arrow_rows, candidate_components, classes, verified

BLANK = " \t\n\v\f\r"
DIGEST = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary())])
SETS = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])


def _digests(batches):
    for b in batches:
        texts = b.column(1).to_pylist()
        # Blank texts have no words: without a digest they link with nothing.
        digests = [
            hashlib.blake2b(t.encode(), digest_size=16).digest() if t and t.strip(BLANK) else None
            for t in texts
        ]
        yield pa.record_batch([b.column(0), pa.array(digests, pa.binary())], schema=DIGEST)


def ngram_classes(
    docs: DataFrame, threshold: float = 0.8, n: int = 5, rows: int = 4, recall: float = 0.999, seed: int = 3,
) -> DataFrame:
    """``(doc_id, class_id, n_links, n_copies, kept)``, a row per document."""
    bounded_batches(docs.sparkSession)
    bands = bands_for(threshold, rows, recall)
    texts = one_text_per_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    digests = texts.mapInArrow(_digests, "doc_id long, digest binary")
    # Rows without an id are classes of their own, told as one.
    digest = F.when(F.col("doc_id").isNotNull(), F.col("digest"))
    digests = cut(digests.groupBy("doc_id").agg(F.min(digest).alias("digest")))
    copies = digests.filter(F.col("digest").isNotNull())
    copies = cut(
        copies.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    )

    def keys(batch):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        known = ~np.asarray(batch.column(0).is_null())
        for row, data, offsets in text_blocks(batch.column(1)):
            words = Words(data, offsets)
            own = slice(row, row + len(offsets) - 1)
            some = (words.last > words.first) & known[own]
            if some.any():
                # Unknown and empty texts are left out; the others keep their order.
                grams, at = words.shingles(n, words.first[some], words.last[some])
                key = band_keys(grams, at, bands, rows, seed)
                yield as_long(key.ravel()), np.repeat(ids[own][some].astype("i8"), bands)

    def sets(batches):
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            out = []
            for _, data, offsets in text_blocks(column):
                words = Words(data, offsets)
                grams, at = words.shingles(n, words.first, words.last)
                out += [np.unique(grams[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.record_batch([ids, pa.array(out, pa.large_binary()).cast(pa.binary())], schema=SETS)

    star = texts.mapInArrow(arrow_rows(keys), "key long, node long")
    # Copies share all keys of their representative, so dropping them here loses no candidate.
    reps = cut(candidate_components(star).join(copies.select("node", "copies"), "node"))
    one = texts.join(reps.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    members = one.mapInArrow(sets, "doc_id long, shingles binary").withColumnRenamed("doc_id", "node")
    members = members.join(reps, "node").select(
        "component", "node", F.col("copies").alias("weight"), "shingles"
    )
    found = classes(verified(cut(members), threshold))

    per = copies.join(found, "node", "left").select(
        "digest", "copies", F.coalesce("class", "node").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return digests.join(per, "digest", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
        F.coalesce(F.coalesce("class_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document stays: one of each class, and no text is lost.

    A repeated doc_id stands for its least text; its other texts stay too, one row each, unless a
    document that counts has the same text.
    """
    own, mark = fresh(docs, "kept_id"), fresh(docs, "kept_digest")
    kept = ngram_classes(docs, **options).filter(F.col("kept") & F.col("doc_id").isNotNull())
    kept = kept.select(F.col("doc_id").alias(own))
    known, unknown = docs.filter(F.col("doc_id").isNotNull()), docs.filter(F.col("doc_id").isNull())
    least = F.min("text").alias(mark)
    repeated = known.groupBy(F.col("doc_id").alias(own)).agg(F.count(F.lit(1)).alias("rows"), least)
    repeated = cut(repeated.filter("rows > 1").drop("rows"))
    if repeated.isEmpty():
        return known.join(kept, known["doc_id"] == kept[own], "left_semi").unionByName(unknown)
    alone = known.join(repeated, known["doc_id"] == repeated[own], "left_anti")
    several = known.join(repeated, known["doc_id"] == repeated[own])
    counted = F.col("text").eqNullSafe(F.col(mark))
    first = several.filter(counted).dropDuplicates(["doc_id"]).drop(mark)
    first = first.drop(own).unionByName(alone)
    first = first.join(kept, first["doc_id"] == kept[own], "left_semi")
    # Blank texts are no texts that could be lost.
    others = several.filter(~counted & (F.trim("text", F.lit(BLANK)) != "")).drop(own, mark)
    counts = repeated.select(F.col(mark)).unionByName(alone.select(F.col("text").alias(mark)))
    turn = fresh(others, "kept_turn")
    of_text = W.partitionBy(F.sha2("text", 256)).orderBy("doc_id")
    others = others.withColumn(turn, F.row_number().over(of_text)).filter(F.col(turn) == 1).drop(turn)
    others = others.join(counts, F.sha2(others["text"], 256) == F.sha2(counts[mark], 256), "left_anti")
    return first.unionByName(others).unionByName(unknown)
