"""Near-duplicate vectors by cosine: a pigeonhole join over blocks of a rotated space.

For unit vectors, cosine >= t means a squared distance of at most ``2 - 2t``. A random
rotation spreads the variance evenly; the dimensions are then split into blocks, and
a pair within the total budget lies within a block's proportional share of it in at
least one block. So each block is range-joined on its own under its share, and every
candidate is verified with the cosine of the original vectors in double precision. A
pair found by several blocks counts in the first of them only.

Range join: ``pivots`` sampled rows cut the space into cells, and cells with many rows are
cut into slices by a hash of the id. Every row is dealt once, to the slice it lives in, and a slice
is packed into one row of the packed table. Slices meet pair by pair: the few partitions of that table are read again for
each other (a Cartesian product, which sends and stores no copies), and a task holds one
partition and two unpacked slices. In each block only the rows within the radius of the other slice's ball
around its pivot are compared, in tiles of fixed size. A pair of slices returns at most
one row per vector: how many links it has seen, and the root of the vector's links in this pair.
No pairs of vectors leave a task.

Defined results: vectors that are null, empty, zero, of another length than the
commonest, or with null or non-finite components link with nothing (0 links, their own
component); rows with the same id are one vector (the least counts); a null id links
with nothing and has no component; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import Scratch, bounded_batches, components, cut
from linkrank.llm.vectors import precision, rotation, unit, vectors

SLACK = 1e-4  # what single precision may add to a distance between unit vectors
SIDE_ROWS = 65_536  # vectors in a partition of the packed table, which a task holds besides two slices
TASKS_PER_CORE = 6  # where there are fewer vectors than that, at least so many pairs of partitions


class Links:
    """Counts links and joins their ends, by position in a task."""

    def __init__(self, n: int):
        self.count = np.zeros(n, "i8")
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        n = len(self.count)
        self.count += np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
        while True:
            apart = self.root[i] != self.root[j]
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            for a, b in zip(i[:512].tolist(), j[:512].tolist(), strict=True):
                a, b = self._find(a), self._find(b)
                if a != b:
                    self.root[max(a, b)] = min(a, b)
            while (up := self.root[self.root]).tolist() != self.root.tolist():
                self.root = up

    def _find(self, a: int) -> int:
        while self.root[a] != a:
            a = self.root[a]
        return int(a)


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", col: str = "embedding", threshold: float = 0.9,
    block_dims: int = 16, cell_rows: int = 8192, max_pivots: int = 1024, tile: int = 2048, seed: int = 5,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row per id.

    ``max_pivots`` bounds the sampled pivots; cells beyond ``cell_rows`` rows are sliced.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark)
    rows, dim = vectors(df, id_col, col)
    kind = precision(rows)
    everyone = df.select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    turn = rotation(dim, seed).T if dim else None
    n_blocks = max(1, dim // block_dims)
    parts = np.array_split(np.arange(dim), n_blocks)
    budget = [(2 - 2 * threshold) * len(p) / max(dim, 1) * (1 + 1e-9) + 1e-12 for p in parts]
    radius = [float(np.sqrt(b)) + SLACK for b in budget]

    def packed(batches):
        for b in batches:
            if len(b):
                v = np.stack(b["v"].to_numpy()).astype(kind)
                yield pd.DataFrame({"id": b["id"], "v": [x.tobytes() for x in v]})

    rows = scratch.store(rows.mapInPandas(packed, "id long, v binary"))

    def load(col) -> np.ndarray:
        return np.frombuffer(b"".join(col), kind).reshape(-1, dim)

    n = rows.count()
    wanted = min(max_pivots, max(1, -(-n // cell_rows)))
    sample = rows.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(wanted).collect()
    pivots = unit(load([r["v"] for r in sample])) @ turn if sample else np.zeros((1, max(dim, 1)))

    def cells(raw) -> np.ndarray:
        """The cells that vectors live in, those of their nearest pivots."""
        v = unit(load(raw)) @ turn
        return ((pivots * pivots).sum(1) - 2 * v @ pivots.T).argmin(axis=1)

    def home(batches):
        for batch in batches:
            cell, size = np.unique(cells(batch["v"]), return_counts=True)
            yield pd.DataFrame({"cell": cell, "n": size})

    # One row per pivot, at most max_pivots.
    shape = rows.mapInPandas(home, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    slices = np.ones(len(pivots), "i8")
    for r in shape:
        slices[r["cell"]] = -(-r["n"] // cell_rows)
    first = np.cumsum(slices) - slices

    def deal(batches):
        for batch in batches:
            cell = cells(batch["v"])
            mix = (batch["id"].to_numpy().astype("u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            own = (mix % slices[cell].astype("u8")).astype("i8")
            yield pd.DataFrame({"slice": first[cell] + own, "cell": cell, "id": batch["id"], "v": batch["v"]})

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        ids = group["id"].to_numpy("i8").tobytes()
        return group[["slice", "cell"]].head(1).assign(ids=ids, v=b"".join(group["v"]))

    def unpacked(cell: int, ids: bytes, raw: bytes):
        """``(ids, unit vectors, turned ones, their cell, and per block what a product makes distances of)``."""
        u = unit(load([raw]))
        v = u @ turn
        sides = []
        for p in parts:
            x = v[:, p].astype("f4")
            half = (x * x).sum(1, keepdims=True) / 2
            ones = np.ones_like(half)
            sides.append((np.hstack([x, -half, ones]), np.hstack([x, ones, -half])))
        return np.frombuffer(ids, "i8"), u, v, cell, sides

    def within(v: np.ndarray, other: np.ndarray, cell: int, b: int) -> np.ndarray:
        """Which of ``v`` are within the radius of the ball of ``other``, rows of that cell, in a block."""
        p = pivots[cell, parts[b]]
        reach = np.sqrt(((other[:, parts[b]] - p) ** 2).sum(1)).max()
        return np.flatnonzero(np.sqrt(((v[:, parts[b]] - p) ** 2).sum(1)) <= reach + radius[b])

    def links_of(s, t) -> pd.DataFrame:
        """The links between two slices, or within one."""
        alone = s is t
        (ids, u, v, _, left), (other, w, x, _, right) = s, t
        start = 0 if alone else len(ids)
        ids = ids if alone else np.concatenate([ids, other])
        links = Links(len(ids))
        for b in range(n_blocks):
            limit = np.float32(-budget[b] / 2 - SLACK)
            rows_i = np.arange(len(u)) if alone else within(v, x, t[3], b)
            rows_j = rows_i if alone else within(x, v, s[3], b)
            one, two = left[b][0][rows_i], right[b][1][rows_j]
            for i0 in range(0, len(one), tile):
                for j0 in range(i0 if alone else 0, len(two), tile):
                    near = one[i0 : i0 + tile] @ two[j0 : j0 + tile].T >= limit
                    flat = np.flatnonzero(near)
                    for k in range(0, len(flat), 65536):
                        i, j = np.divmod(flat[k : k + 65536], near.shape[1])
                        i, j = rows_i[i + i0], rows_j[j + j0]
                        if alone:
                            i, j = i[i < j], j[i < j]
                        ok = (u[i] * w[j]).sum(axis=1) >= threshold
                        i, j = i[ok], j[ok]
                        gap = (v[i] - x[j]) ** 2
                        ok = gap[:, parts[b]].sum(axis=1) <= budget[b]
                        for earlier in range(b):
                            ok &= gap[:, parts[earlier]].sum(axis=1) > budget[earlier]
                        links.add(i[ok], j[ok] + start)
        seen = links.count > 0
        return pd.DataFrame({"id": ids[seen], "n": links.count[seen], "root": ids[links.root[seen]]})

    def meet(batches):
        held, s = None, None
        for batch in batches:
            for a, cell_a, ids_a, v_a, b, cell_b, ids_b, v_b in batch.itertuples(index=False, name=None):
                if a != held:
                    held, s = a, unpacked(cell_a, ids_a, v_a)
                yield links_of(s, s if a == b else unpacked(cell_b, ids_b, v_b))

    sides = max(1, min(int(slices.sum()), max(math.ceil((TASKS_PER_CORE * spark.sparkContext.defaultParallelism) ** 0.5), -(-n // SIDE_ROWS))))
    dealt = rows.mapInPandas(deal, "slice int, cell int, id long, v binary").repartition(sides, "slice")
    table = cut(dealt.groupBy("slice").applyInPandas(pack, "slice int, cell int, ids binary, v binary")).coalesce(sides)
    one, two = (table.select(*[F.col(c).alias(f"{c}_{x}") for c in ("slice", "cell", "ids", "v")]) for x in "ab")
    # Read again, not sent: the hint keeps Spark from a broadcast, which would pass the table through the driver.
    pairs = one.hint("shuffle_replicate_nl").join(two, F.col("slice_a") <= F.col("slice_b"))
    found = cut(pairs.mapInPandas(meet, "id long, n long, root long"))
    scratch.release()
    groups = components(found.select(F.col("id").alias("src"), F.col("root").alias("dst")))
    links = found.groupBy(F.col("id").alias("vec_id")).agg(F.sum("n").alias("n_links"))
    return (
        everyone.join(links, "vec_id", "left")
        .join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )
