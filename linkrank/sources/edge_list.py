"""Edge-list text: one ``src dst`` pair per line.

Rules: surrounding whitespace is ignored; blank lines and lines starting with
``#`` are skipped; the rest must split into exactly two fields (any run of
whitespace by default, or a literal ``delimiter``), each an integer
``[+-]?digits`` that fits in a BIGINT. Everything else is a reject.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.functions.columns import strip_ws

_INT = r"^[+-]?[0-9]+$"


def _fields(line: Column, delimiter: str | None) -> Column:
    if delimiter is None:
        return F.split(line, r"\s+")
    return F.split(line, re.escape(delimiter))


def _as_long(field: Column) -> Column:
    f = strip_ws(field)
    return F.when(f.rlike(_INT), f.try_cast("bigint"))


def parse_edge_lines(
    lines: DataFrame, delimiter: str | None = None, column: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Parse a DataFrame of text lines into ``(edges(src, dst), rejects(line, reason))``.

    Other columns of ``lines`` (e.g. a file name) are carried into both outputs.
    """
    if delimiter == "":
        raise ValueError("delimiter must not be empty")
    extra = [c for c in lines.columns if c != column]
    text = strip_ws(F.col(column))
    body = lines.select(*extra, F.col(column).alias("line"), text.alias("_t")).filter(
        (F.length("_t") > 0) & ~F.col("_t").startswith("#")
    )
    parts = body.withColumn("_f", _fields(F.col("_t"), delimiter))
    parsed = parts.select(
        *extra,
        "line",
        F.size("_f").alias("_n"),
        _as_long(F.col("_f")[0]).alias("src"),
        _as_long(F.col("_f")[1]).alias("dst"),
    )
    ok = (F.col("_n") == 2) & F.col("src").isNotNull() & F.col("dst").isNotNull()
    edges = parsed.filter(ok).select(*extra, "src", "dst")
    reason = F.when(F.col("_n") != 2, F.lit("expected two fields")).otherwise(
        F.lit("fields must be integers")
    )
    rejects = parsed.filter(~ok).select(*extra, "line", reason.alias("reason"))
    return edges, rejects


def read_edge_list(
    spark: SparkSession, path: str, delimiter: str | None = None, strict: bool = True
) -> DataFrame:
    """Read edge-list text files into ``edges(src, dst)``.

    ``strict`` raises ``ValueError`` naming the file and text of a bad line (the
    check is a distributed ``isEmpty``); otherwise bad lines are dropped — use
    :func:`parse_edge_lines` to keep them.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    edges, rejects = parse_edge_lines(lines, delimiter)
    if strict:
        bad = rejects.take(1)
        if bad:
            b = bad[0]
            raise ValueError(f"{b['file']}: bad edge line {b['line']!r}: {b['reason']}")
    return edges.select("src", "dst")
