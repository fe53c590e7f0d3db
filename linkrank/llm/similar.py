"""From band keys to verified similarity classes, shared by the operators on documents and paragraphs.

Candidates that share a band key are joined as a star: every task first reduces its own
rows per key, so a key brings at most a row per task to the shuffle and a hot key is
never a large group there. The stars' connected components hold every pair that
shares a key. Inside a component all pairs are verified on full shingle sets, in
square blocks of bounded size: a component is dealt to blocks by a hash of its
members, two blocks meet in one task, and a task returns at most one row per member
(its number of links and the root of its links). So no pair is emitted, and no task
holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkrank.llm.common import components, cut
from linkrank.llm.hashing import as_long, mixed

BLOCK_MEMBERS, BLOCK_SHINGLES = 256, 200_000
STAR = pa.schema([("key", pa.int64()), ("node", pa.int64())])


def stars(pairs: Iterator[tuple[np.ndarray, np.ndarray]], flush: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """``(key, node)`` rows that connect the nodes of each key, from ``(keys, nodes)`` arrays.

    The smallest node of a key stands for the others; each of them is tied to it by a
    key of their own. ``flush`` bounds the rows held; a key met again afterwards adds a
    row to its star.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def reduced() -> Iterator[pa.RecordBatch]:
        key = np.concatenate([k for k, _ in held])
        node = np.concatenate([n for _, n in held])
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
        key, node = key[new], node[new]
        first = np.append(True, key[1:] != key[:-1])
        least = node[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        a, b = node[~first], least[~first]
        # Distinct ties only: copies of a pair under many keys are one tie.
        tie = mixed(a.view("u8") * np.uint64(0x9E3779B97F4A7C15) ^ mixed(b.view("u8")))
        tie, at = np.unique(tie, return_index=True)
        a, b, tie = a[at], b[at], as_long(tie)
        keys = np.concatenate([key[first], tie, tie])
        nodes = np.concatenate([node[first], a, b])
        for i in range(0, len(keys), 1 << 16):
            yield pa.record_batch([keys[i : i + (1 << 16)], nodes[i : i + (1 << 16)]], schema=STAR)

    for k, n in pairs:
        held.append((k, n))
        size += len(k)
        if size >= flush:
            yield from reduced()
            held, size = [], 0
    if size:
        yield from reduced()


def candidate_components(star: DataFrame) -> DataFrame:
    """``(node, component)`` of ``star(key, node)`` rows; nodes without a partner have no row."""
    least = F.min("node").over(W.partitionBy("key"))
    edges = star.select("node", least.alias("least")).filter("node != least")
    return components(edges.select(F.col("node").alias("src"), F.col("least").alias("dst")))


class Forest:
    """Union of linked positions inside a task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Boolean (left x right): whether the Jaccard similarity of two sets reaches the threshold, exactly."""
    size = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), size)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    if len(column):
        column = np.cumsum(np.append(0, column[1:] != column[:-1]))
    common = np.zeros((len(left), len(right)), "f4")
    step = 4096
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [c, c + step])
        m = np.zeros((len(sets), min(step, int(column[-1]) + 1 - c)), "f4")
        m[row[a:b], column[a:b] - c] = 1
        common += m[left] @ m[right].T
    common = common.astype("i8")
    p, q = threshold.numerator, threshold.denominator
    return common * (p + q) >= p * (size[left][:, None] + size[right][None, :])


def verified(
    members: DataFrame, threshold: float, block_members: int = BLOCK_MEMBERS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``(node, n, root)`` partial links of ``members(component, node, weight, shingles)``.

    ``shingles`` is binary: the sorted distinct 64-bit hashes of the full set. ``n``
    sums the weights of the members linked; ``root`` is one of them or the node itself.
    """
    bound = Fraction(str(threshold))
    members = members.withColumn("size", (F.length("shingles") / 8).cast("long"))
    shape = members.groupBy("component").agg(
        F.count(F.lit(1)).alias("members"), F.sum("size").alias("total")
    ).filter("members > 1").withColumn(
        "blocks",
        F.greatest(
            F.ceil(F.col("members") / F.lit(block_members)),
            F.least(F.col("members"), F.ceil(F.col("total") / F.lit(block_shingles))),
        ).cast("int"),
    )
    shape = cut(shape)
    total = shape.agg(F.sum("total")).first()[0] or 0
    # Components of one block share tasks, about a block's worth each.
    tasks = max(1, -(-int(total) // block_shingles))
    dealt = members.join(shape.select("component", "blocks"), "component")
    own = F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other)
    single = F.col("blocks") == 1
    dealt = dealt.select(
        F.when(single, F.pmod(F.xxhash64("component"), F.lit(tasks))).otherwise(F.col("component")).alias("task"),
        F.when(single, -1).otherwise(F.least("own", "other")).alias("a"),
        F.when(single, -1).otherwise(F.greatest("own", "other")).alias("b"),
        "component", "own", "node", "weight", "shingles",
    )

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        a, b = int(group["a"].iloc[0]), int(group["b"].iloc[0])
        for _, part in group.groupby("component", sort=False):
            part = part.sort_values("node")
            node, weight = part["node"].to_numpy(), part["weight"].to_numpy()
            sets = [np.frombuffer(x, "u8") for x in part["shingles"]]
            everyone = np.arange(len(node))
            block = part["own"].to_numpy()
            left, right = (everyone, everyone) if a == b else (everyone[block == a], everyone[block == b])
            if not len(left) or not len(right):
                continue
            ok = linked(sets, left, right, bound)
            n = np.zeros(len(node), "i8")
            forest = Forest(len(node))
            if a == b:
                np.fill_diagonal(ok, False)
                n += ok @ weight
            else:
                n[left] += ok @ weight[right]
                n[right] += ok.T @ weight[left]
            for x in np.flatnonzero(ok.any(axis=1)):
                for y in np.flatnonzero(ok[x]):
                    forest.join(int(left[x]), int(right[y]))
            seen = np.flatnonzero(n > 0)
            root = np.array([forest.root(int(i)) for i in seen], "i8")
            out.append(pd.DataFrame({"node": node[seen], "n": n[seen], "root": node[root] if len(root) else root}))
        empty = pd.DataFrame({"node": [], "n": [], "root": []}, dtype="i8")
        return pd.concat(out) if out else empty

    return dealt.groupBy("task", "a", "b").applyInPandas(verify, "node long, n long, root long")


def classes(found: DataFrame) -> DataFrame:
    """``(node, links, class)`` of partial links: their sum, and the least node reached by links."""
    found = cut(found)
    groups = components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    links = found.groupBy("node").agg(F.sum("n").alias("links"))
    return links.join(groups.withColumnRenamed("component", "class"), "node")


def arrow_rows(fn: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]):
    """A ``mapInArrow`` function that turns batches into star rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from stars(pair for b in batches for pair in fn(b))

    return run
