"""Helpers shared by the operators: table access, reliable cuts of the lineage, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import random
import sys
import types
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.session import Scratch, ensure_checkpoint_dir

__all__ = ["Scratch", "bounded_batches", "components", "cut", "fresh", "give_back", "null_safe_key", "once_per_worker", "one_text_per_id", "table", "width"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the reliable checkpoint folder: later jobs neither recompute it nor lose it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def null_safe_key(col: str) -> Column:
    """A non-null string that differs for every value of ``col``, null included."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(""))


def once_per_worker(key: str, make: Callable[[], object], most: int = 2) -> object:
    """What ``make`` returns, kept for later tasks of the same Python process (the ``most`` last keys).

    Functions of this subpackage reach workers by value, each task with globals of its own, so the
    objects are held by a module that only names them.
    """
    home = sys.modules.setdefault("linkrank_worker_state", types.ModuleType("linkrank_worker_state"))
    held = home.__dict__.setdefault("held", {})
    found = held.pop(key, None)
    found = make() if found is None else found
    held[key] = found
    while len(held) > most:
        del held[next(iter(held))]
    return found


def give_back() -> None:
    """Return freed memory of this process to the system: a Python worker outlives its task, idle or not."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: int = 2 << 20) -> None:
    """Bound the bytes of a batch that goes to a Python worker, unless the session has a bound of its own.

    Spark counts rows only by default, so 10,000 long texts make one batch, held by the JVM and by Python.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(size))


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def one_text_per_id(texts: DataFrame) -> DataFrame:
    """``texts(doc_id, text)`` with one row per doc_id, the one of the least text; null ids keep their rows.

    Only rows of repeated ids are shuffled; without any the table comes back as it is.
    """
    repeated = texts.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    repeated = cut(repeated.filter("rows > 1").select("doc_id"))
    if repeated.isEmpty():
        return texts
    alone = texts.join(repeated, "doc_id", "left_anti")
    least = texts.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return cut(alone.unionByName(least))


FINISH_EDGES = 200_000


def components(edges: DataFrame, seed: int = 7, finish: int = FINISH_EDGES) -> DataFrame:
    """Connected components of ``edges(src, dst)`` (longs): ``(node, component)``, the smallest node id.

    Rounds of contraction: every node points to the smallest of itself and its
    neighbours in an order that changes with the round (ids XOR a random constant),
    and edges are redrawn between the nodes pointed to. A constant share of the
    nodes goes away in each round, so the rounds grow with the logarithm of the
    graph whatever its shape. What is left of at most ``finish`` edges (a few MB) is
    solved in one task, and the pointers are followed backwards. Each step is a grouped
    minimum (partial sums first) or a join with one row per node on one side.
    Self-loops and null ends are ignored; nodes without edges have no row.
    """
    rng = random.Random(seed)
    e = cut(
        edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .filter(F.col("src") != F.col("dst"))
        .distinct()
    )
    pointers: list[DataFrame] = []
    while e.count() > finish:
        c = F.lit(rng.getrandbits(63))
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        nearest = both.groupBy("src").agg(F.min(F.col("dst").bitwiseXOR(c)).alias("m"))
        own = F.col("src").bitwiseXOR(c)
        pointer = cut(
            nearest.select(F.col("src").alias("node"), F.least("m", own).bitwiseXOR(c).alias("to"))
        )
        pointers.append(pointer)
        left = pointer.select(F.col("node").alias("src"), F.col("to").alias("a"))
        right = pointer.select(F.col("node").alias("dst"), F.col("to").alias("b"))
        e = cut(
            e.join(left, "src")
            .join(right, "dst")
            .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
            .filter(F.col("src") != F.col("dst"))
            .distinct()
        )
    roots = e.repartition(1).mapInPandas(_solve, "node long, to long")
    for pointer in reversed(pointers):
        after = roots.select(F.col("node").alias("to"), F.col("to").alias("root"))
        roots = pointer.join(after, "to", "left").select("node", F.coalesce("root", "to").alias("to"))
    roots = cut(roots)
    if not pointers:
        return roots.withColumnRenamed("to", "component")
    least = roots.groupBy("to").agg(F.min("node").alias("component"))
    return roots.join(least, "to").select("node", "component")


def _solve(batches):
    """Components of the edges of one task."""
    parts = [b[["src", "dst"]].to_numpy("i8") for b in batches]
    if not parts or not sum(map(len, parts)):
        return
    ends, at = np.unique(np.concatenate(parts), return_inverse=True)
    src, dst = at.reshape(-1, 2).T
    root = np.arange(len(ends))
    while True:
        low = np.minimum(root[src], root[dst])
        before = root.copy()
        np.minimum.at(root, root[src], low)
        np.minimum.at(root, root[dst], low)
        while (up := root[root]).tolist() != root.tolist():
            root = up
        if (before == root).all():
            break
    yield pd.DataFrame({"node": ends, "to": ends[root]})
