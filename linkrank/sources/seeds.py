"""Seed lists for personalized ranking: a text file with one id per line, or a comma string.

One parser serves both: an entry is an integer ``[+-]?digits`` that fits in a BIGINT, with
whitespace around it ignored. Everything else is a reject, and the readers raise for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.functions.columns import strip_ws

_INT = r"^[+-]?[0-9]+$"


def _parsed(entries: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``entries(keys..., entry)`` to ``(seeds(keys..., id) distinct, rejects(keys..., entry, reason))``."""
    text = strip_ws(F.col("entry"))
    whole = text.rlike(_INT)
    rows = entries.select(*keys, "entry", whole.alias("_int"), F.when(whole, text.try_cast("bigint")).alias("id"))
    reason = F.when(F.col("_int"), F.lit("out of range")).otherwise(F.lit("not an integer"))
    return (
        rows.filter(F.col("id").isNotNull()).select(*keys, "id").distinct(),
        rows.filter(F.col("id").isNull()).select(*keys, "entry", reason.alias("reason")),
    )


def parse_seed_lines(
    lines: DataFrame, column: str = "value", keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """One id per line, blank lines skipped: ``(seeds, rejects)``."""
    entry: Column = F.col(column)
    rows = lines.filter(F.length(strip_ws(entry)) > 0).select(*keys, entry.alias("entry"))
    return _parsed(rows, list(keys))


def parse_seed_string(
    texts: DataFrame, column: str = "value", keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Comma-separated ids per row, e.g. ``"3,17,42"``: ``(seeds, rejects)``; an empty entry is a reject."""
    return _parsed(texts.select(*keys, F.explode(F.split(F.col(column), ",")).alias("entry")), list(keys))


def _strict(parsed: tuple[DataFrame, DataFrame], where: str) -> DataFrame:
    seeds, rejects = parsed
    bad = rejects.take(1)
    if bad:
        raise ValueError(f"{where}: bad seed {bad[0]['entry']!r}: {bad[0]['reason']}")
    return seeds


def seeds_from_string(spark: SparkSession, text: str) -> DataFrame:
    """``"3,17,42"`` -> ``seeds(id)``; bad entries raise ``ValueError``."""
    return _strict(parse_seed_string(spark.createDataFrame([(text,)], "value string")), "seed string")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed file(s) -> ``seeds(id)``; a bad line raises ``ValueError``."""
    return _strict(parse_seed_lines(spark.read.text(path)), path)


def resolve_seeds(
    spark: SparkSession, nodes: DataFrame, text: str | None = None, path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Seeds given as a string or else as a file: ``(seeds that are nodes, unknown ones)``.

    A string takes precedence over a file. Without either, or without a known seed,
    ``ValueError``.
    """
    if text:
        seeds = seeds_from_string(spark, text)
    elif path:
        seeds = read_seeds(spark, path)
    else:
        raise ValueError("seeds must be given as a string or a file")
    known = seeds.join(nodes.select("id"), "id", "left_semi")
    if known.isEmpty():
        raise ValueError("none of the seeds is a node")
    return known, seeds.join(nodes.select("id"), "id", "left_anti")
