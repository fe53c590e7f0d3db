"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

Of all rates ``r`` with ``sum(size * r) = target`` per source and none above ``cap``, the ones
nearest to "every document once" (least relative entropy, counted per document) are an exponential
tilt, ``r = min(cap, exp(lambda * size))``: one multiplier per source, found by Newton steps on the
convex dual. Gradient and curvature are grouped sums over a table that counts the documents of
each source and size. A source that wants more words is taken more of in its long documents, one
that wants fewer keeps its short ones. Where the entropy counts words instead (``tilt=0``), all
documents of a source have one rate.

The rates become whole copies by systematic rounding: within a source, documents are
laid out by size and the running sum of rates is rounded, so the words taken differ
from the target by about one document. Groups of one source and size are cut into
slices of ``slice_rows`` expected rows, so no task holds a whole group.

Defined results: a null text has size 0; null and empty sources are sources of their
own; rows equal in id, source and size are separate rows, each with its own decision;
a source of size 0 has target 0; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkrank.llm.common import cut, fresh, null_safe_key

WORD = r"[^\x20\x09-\x0D]+"


def text_size(col: str = "text") -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """``(key, source, source_size, target)`` of ``sized(key, source, size)``.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` of all sizes by weight. A target stops at ``cap`` times its source's
    size; the excess goes to the others by weight until none is above. That is one
    water level ``L`` with ``target = min(cap * size, weight * L)``, found along the
    sources in the order in which they fill up.
    """
    per = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("full", F.col("source_size") * F.lit(cap))
    order = W.orderBy((F.col("full") / F.col("w")).asc(), F.col("key").asc())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everyone = W.partitionBy()
    total = F.sum("source_size").over(everyone) * F.lit(share)
    left = total - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    weight_left = F.sum("w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    per = per.withColumn("level", left / weight_left)
    # The first source that its level does not fill sets the level of all after it; levels only
    # fall from there on, so it is the largest one that fits.
    stays = F.when(F.col("w") * F.col("level") <= F.col("full"), F.col("level"))
    level = F.max(stays).over(everyone)
    target = F.least(F.col("full"), F.col("w") * F.coalesce(level, F.lit(float("inf"))))
    return per.select("key", "source", "source_size", target.alias("target"))


def tilted_rates(
    counts: DataFrame, targets: DataFrame, cap: float = 2.0, tilt: float = 1.0,
    tolerance: float = 1e-9, max_iter: int = 60,
) -> DataFrame:
    """``(key, lambda, mean_size)`` with ``sum(n * size * min(cap, exp(lambda * z))) = target``.

    ``counts(key, size, n)``. ``z = (size / mean size) ** tilt``, the dual of an entropy in which a
    document weighs ``size ** (1 - tilt)``: 1 counts documents, 0 words. The bracket ends where
    the shortest document reaches the cap, and where it keeps ``exp(-60)`` of its words.
    """
    per = counts.groupBy("key").agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean_size"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("shortest"),
    )
    least = F.coalesce(F.pow(F.col("shortest") / F.col("mean_size"), F.lit(float(tilt))), F.lit(1.0))
    start = targets.join(per, "key").select(
        "key", "target", "source_size", "mean_size", F.lit(0.0).alias("lambda"),
        (F.lit(-60.0) / least).alias("low"), (F.lit(math.log(cap)) / least).alias("high"),
    )
    state = cut(start)
    for _ in range(max_iter):
        rate = tilted_rate(cap, tilt)
        words = F.col("n") * F.col("size") * rate
        capped = F.exp(F.col("lambda") * size_tilt(tilt)) > cap * (1 + 1e-12)
        free = F.when(capped, 0.0).otherwise(words * size_tilt(tilt))
        sums = counts.join(state, "key").groupBy("key").agg(
            F.sum(words).alias("reached"), F.sum(free).alias("slope")
        )
        over = F.col("reached") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.col("lambda"))
        high = F.when(over, F.col("lambda")).otherwise(F.col("high"))
        newton = F.col("lambda") + (F.col("target") - F.col("reached")) / F.col("slope")
        # A Newton step beyond the bracket goes to its untried upper end, or becomes a bisection.
        above = (F.col("slope") > 0) & (newton >= high) & (F.col("lambda") < high)
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        off = F.when(F.col("target") > 0, F.abs(F.col("reached") / F.col("target") - 1)).otherwise(0.0)
        off = F.when(_full(cap), 0.0).otherwise(off)
        done = off <= tolerance
        state = cut(
            state.join(sums, "key").select(
                "key", "target", "source_size", "mean_size",
                F.when(done, F.col("lambda")).when(inside, newton)
                .when(above, high).otherwise((low + high) / 2).alias("lambda"),
                low.alias("low"), high.alias("high"), off.alias("off"),
            )
        )
        worst = state.agg(F.max("off")).first()[0]
        state = state.drop("off")
        if worst is None or worst <= tolerance:
            break
    return state.drop("low", "high")


def size_tilt(tilt: float) -> Column:
    if tilt == 0:
        return F.lit(1.0)
    return F.pow(F.col("size") / F.greatest(F.col("mean_size"), F.lit(1e-9)), F.lit(tilt))


def _full(cap: float) -> Column:
    """Whether a source's target is all that the cap allows, so that every document is taken ``cap`` times."""
    return F.col("target") >= F.col("source_size") * F.lit(cap * (1 - 1e-12))


def tilted_rate(cap: float, tilt: float) -> Column:
    """The rate of a document; a source whose target is 0 has rate 0."""
    r = F.exp(F.col("lambda") * size_tilt(tilt))
    capped = F.when(_full(cap), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), r))
    return F.when(F.col("target") <= 0, 0.0).otherwise(capped)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5,
    cap: float = 2.0, tilt: float = 1.0, slice_rows: int = 256,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, rate, copies, taken)``, a row per document."""
    sized = cut(docs.select("doc_id", "source", null_safe_key("source").alias("key"), text_size().alias("size")))
    counts = cut(sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")))
    targets = cut(source_targets(sized, weights, share, cap))
    lambdas = tilted_rates(counts, targets, cap, tilt).drop("source_size", "target")

    # Slices of the groups (source, size), laid out by size.
    slices = F.ceil(F.col("n") / F.lit(slice_rows))
    slot = F.pmod(F.xxhash64(F.lit("slice"), "doc_id"), slices)
    rows = sized.join(counts, ["key", "size"]).select("doc_id", "key", "size", slot.alias("slot"))
    # Dealt out by slice here: the join's own layout would keep a whole group in one task.
    rows = cut(rows.repartition("key", "size", "slot"))
    cells = rows.groupBy("key", "size", "slot").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.join(targets, "key").join(lambdas, "key").select(
        "key", "source", "size", "slot", "n", "source_size", "target",
        tilted_rate(cap, tilt).alias("rate"),
        F.floor(F.log2(F.col("size") + 1) * 8).alias("stretch"),
    )
    cells = cut(cells)
    due = F.col("n") * F.col("rate")
    stretches = cells.groupBy("key", "stretch").agg(F.sum(due).alias("due"))
    ahead = W.partitionBy("key").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    stretches = stretches.select(
        "key", "stretch", F.coalesce(F.sum("due").over(ahead), F.lit(0.0)).alias("ahead")
    )
    inner = W.partitionBy("key", "stretch").orderBy("size", "slot")
    upto = F.sum(due).over(inner.rowsBetween(W.unboundedPreceding, W.currentRow)) + F.col("ahead")
    # Rounding at a half; the small shift keeps sums that are whole in theory from falling below.
    whole = F.floor(F.col("upto") + F.lit(0.5 + 1e-7))
    cells = cells.join(stretches, ["key", "stretch"]).withColumn("upto", upto)
    cells = cells.withColumn("whole", whole)
    first = F.floor(F.col("ahead") + F.lit(0.5 + 1e-7))
    copies = F.col("whole") - F.coalesce(F.lag("whole").over(inner), first)
    base = F.floor(F.col("rate"))
    extra = F.greatest(F.lit(0), F.least(F.col("n"), copies - F.col("n") * base))
    cells = cells.select(
        "key", "source", "size", "slot", "source_size", "target", "rate",
        base.alias("base"), extra.alias("extra"),
    )
    turn = F.row_number().over(
        W.partitionBy("key", "size", "slot").orderBy(F.xxhash64(F.lit("turn"), "doc_id"), "doc_id")
    )
    chosen = rows.withColumn("turn", turn).join(cells, ["key", "size", "slot"])
    copies = (F.col("base") + (F.col("turn") <= F.col("extra")).cast("long")).cast("long")
    chosen = cut(chosen.withColumn("copies", copies).drop("base", "extra"))
    change = _corrections(chosen, cap)
    copies = F.col("copies") + F.coalesce(F.col("change"), F.lit(0))
    return chosen.join(change, ["key", "size", "slot", "turn"], "left").select(
        "doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def _corrections(chosen: DataFrame, cap: float, per_stretch: int = 4) -> DataFrame:
    """``(key, size, slot, turn, change)``: rows that take one copy more or less.

    What rounding left over per source is made up greedily, largest documents first,
    from a few documents of each size class (so from a list that does not grow with
    the source).
    """
    sums = chosen.groupBy("key").agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("left")
    )
    # A few rows of each size class that could take a copy more, and a few that could give one.
    ways = F.filter(
        F.array(
            F.when(F.col("copies") + 1 <= cap, F.lit(1)), F.when(F.col("copies") >= 1, F.lit(-1))
        ),
        lambda x: x.isNotNull(),
    )
    able = chosen.filter("size > 0").select("key", "size", "slot", "turn", F.explode(ways).alias("change"))
    able = able.withColumn("stretch", F.floor(F.log2(F.col("size") + 1) * 8))
    place = F.row_number().over(
        W.partitionBy("key", "change", "stretch").orderBy(F.desc("size"), "slot", "turn")
    )
    few = able.withColumn("place", place).filter(F.col("place") <= per_stretch).join(sums, "key")
    few = few.filter(F.col("change") == F.signum("left"))
    item = F.struct("size", "slot", "turn")
    lists = few.groupBy("key").agg(
        F.first("left").alias("left"), F.sort_array(F.collect_list(item), asc=False).alias("items")
    )
    start = F.struct(F.abs("left").alias("left"), F.filter("items", lambda x: F.lit(False)).alias("took"))

    def step(acc, x):
        fits = x["size"] <= acc["left"]
        return F.struct(
            F.when(fits, acc["left"] - x["size"]).otherwise(acc["left"]).alias("left"),
            F.when(fits, F.concat(acc["took"], F.array(x))).otherwise(acc["took"]).alias("took"),
        )

    took = lists.select(
        "key", F.signum("left").cast("long").alias("change"),
        F.explode(F.aggregate("items", start, step)["took"]).alias("x"),
    )
    return took.select("key", "x.size", "x.slot", "x.turn", "change")


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them: each row ``copies`` times, in the columns of ``docs``.

    Rows equal in id, source and size share the larger of their decisions.
    """
    doc, key, size, copies = (fresh(docs, f"mix_{c}") for c in ("id", "key", "size", "copies"))
    decided = (
        mix(docs, **options)
        .groupBy(F.col("doc_id").alias(doc), null_safe_key("source").alias(key), F.col("size").alias(size))
        .agg(F.max("copies").alias(copies))
        .filter(F.col(copies) > 0)
    )
    same = docs["doc_id"].eqNullSafe(decided[doc]) & (null_safe_key("source") == decided[key])
    joined = docs.join(decided, same & (text_size() == decided[size]))
    again = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(copies)
    return joined.select(*[docs[c] for c in docs.columns], again).drop(copies)
