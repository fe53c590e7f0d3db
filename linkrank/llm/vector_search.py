"""Nearest neighbours by cosine with randomly rotated one-bit codes.

Every vector is scaled to length 1, rotated, and stored as one bit per dimension with
one correction scalar: the inner product ``f`` of the vector with the corner of the
cube that its signs name. For a rotated query ``q``, ``<corner, q> / f`` estimates the
cosine without bias, with an error of about ``sqrt((1 - f^2) / (f^2 * (dim - 1)))``.
Candidates whose upper bound reaches the k-th best lower bound are reranked exactly on
the original vectors; all others cannot be among the nearest, up to the bound's
failure rate (``bound`` standard errors).

Rows are dealt to chunks of about ``chunk_rows`` by a hash of their id, queries to
blocks of about ``block_queries``; a task meets one chunk with one block and returns k
rows per query. So memory per task is fixed and no row is skipped. The chunks' results
meet in a ranked window per query.

Defined results: vectors that are null, empty, zero, of another length than the
commonest, or with null or non-finite components take no part (as query or candidate),
nor do rows without id; of rows with the same id one counts (see ``vectors``); equal
scores rank by smaller id; fewer than k candidates give fewer rows; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkrank.llm.common import cut
from linkrank.llm.vectors import precision, rotation, unit, vectors


def encode(rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and the correction scalar of each rotated unit vector."""
    signs = rotated >= 0
    f = np.abs(rotated).sum(axis=1) / np.sqrt(rotated.shape[1])
    return np.packbits(signs, axis=1), f


def estimate(
    codes: np.ndarray, f: np.ndarray, queries: np.ndarray, bound: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (codes x queries) and the error bound of each code."""
    dim = queries.shape[1]
    corners = np.unpackbits(codes, axis=1, count=dim).astype("f4") * 2 - 1
    est = corners @ queries.T.astype("f4") / (np.sqrt(dim) * f[:, None]).astype("f4")
    err = bound * np.sqrt(np.maximum(1 - f * f, 0) / (f * f * max(dim - 1, 1)))
    return est, err.astype("f4")[:, None]


def nearest(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", col: str = "embedding", k: int = 5,
    bound: float = 3.0, chunk_rows: int = 2048, block_queries: int = 1024, seed: int = 11,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest other rows of every row that ``is_query`` selects.

    ``is_query`` is a condition on the column ``id``.
    """
    rows, dim = vectors(df, id_col, col)
    kind = precision(rows)
    turn = rotation(dim, seed).astype("f8") if dim else None

    def code(batches):
        for b in batches:
            if len(b):
                v = np.stack(b["v"].to_numpy()).astype(kind)
                bits, f = encode(unit(v) @ turn.T)
                yield pd.DataFrame(
                    {"id": b["id"], "f": f, "code": [x.tobytes() for x in bits],
                     "v": [x.tobytes() for x in v]}
                )

    coded = cut(rows.mapInPandas(code, "id long, f double, code binary, v binary"))
    asked = coded.filter(is_query).select("id", "v")
    n, m = coded.count(), asked.count()
    chunks, blocks = max(1, -(-n // chunk_rows)), max(1, -(-m // block_queries))
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "id"), F.lit(chunks))
    block = F.pmod(F.xxhash64(F.lit("block"), "id"), F.lit(blocks))
    left = coded.withColumn("chunk", chunk).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    right = asked.withColumn("block", block.cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))
    )

    def meet(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(data) and len(queries):
            ids = data["id"].to_numpy()
            v = np.frombuffer(b"".join(data["v"]), kind).reshape(len(data), dim)
            codes = np.frombuffer(b"".join(data["code"]), "u1").reshape(len(data), -1)
            q = np.frombuffer(b"".join(queries["v"]), kind).reshape(len(queries), dim)
            q1, v1 = unit(q), unit(v)
            est, err = estimate(codes, data["f"].to_numpy(), q1 @ turn.T, bound)
            low = est - err
            at_least = min(k + 1, len(data))  # one more: the query itself may be among them
            reach = np.partition(low, len(data) - at_least, axis=0)[len(data) - at_least]
            maybe = est + err >= reach
            for j, own in enumerate(queries["id"].to_numpy()):
                at = np.flatnonzero(maybe[:, j])
                at = at[ids[at] != own]
                score = (v1[at] * q1[j]).sum(axis=1)
                best = np.lexsort((ids[at], -score))[:k]
                out["query_id"] += [own] * len(best)
                out["vec_id"] += ids[at[best]].tolist()
                out["score"] += score[best].tolist()
        return pd.DataFrame(out).astype({"query_id": "i8", "vec_id": "i8", "score": "f8"})

    found = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInPandas(
        meet, "query_id long, vec_id long, score double"
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def exact_nearest(ids: np.ndarray, v: np.ndarray, queries: list[int], k: int = 5) -> dict[int, list[int]]:
    """Brute force over arrays, for measuring recall."""
    u = unit(v)
    out = {}
    for own in queries:
        score = (u * u[np.flatnonzero(ids == own)[0]]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != own][:k]
        out[own] = ids[order].tolist()
    return out
