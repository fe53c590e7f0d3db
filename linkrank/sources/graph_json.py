"""Graph JSON: nodes with their out-neighbor lists.

Two layouts:

* JSON lines, one node per line ``{"id": 1, "outNeighbors": [2, 3]}`` — splittable,
  the layout to use at scale (and what :func:`write_graph_json` writes);
* one document ``{"nodes": [{"id": ..., "outNeighbors": [...]}, ...]}``. As a row of
  :func:`parse_graph_json` it is a single record; :func:`read_graph_document` reads a large one in splits
  and :func:`write_graph_document` writes one in ordered parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkrank.operators.graph import adjacency

_NODE = "id BIGINT, outNeighbors ARRAY<BIGINT>"
_SCHEMA = f"{_NODE}, nodes ARRAY<STRUCT<{_NODE}>>, _broken STRING"


def parse_graph_json(
    docs: DataFrame, column: str = "value", keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parse JSON text per row; each row is a node object or a whole ``{"nodes": [...]}`` document.

    Returns ``(nodes(id), edges(src, dst), rejects(line, reason))``. Rejected, each with its
    whole row: text that is not such JSON, objects with neither ``id`` nor ``nodes``, nodes
    without id, and NULL neighbors. Blank rows are skipped.
    """
    keys = list(keys)
    parsed = F.from_json(F.col(column), _SCHEMA, {"columnNameOfCorruptRecord": "_broken"})
    rows = docs.filter(F.length(F.trim(F.col(column))) > 0).select(
        *keys, F.col(column).alias("line"), parsed.alias("p")
    )
    single = F.struct(F.col("p.id").alias("id"), F.col("p.outNeighbors").alias("outNeighbors"))
    listed = F.coalesce("p.nodes", F.when(F.col("p.id").isNotNull(), F.array(single)))
    gap = F.exists(listed, lambda n: n["id"].isNull() | F.exists(F.coalesce(n["outNeighbors"], F.array()), lambda x: x.isNull()))
    reason = (
        F.when(F.col("p._broken").isNotNull() | F.col("p").isNull(), F.lit("not graph JSON"))
        .when(listed.isNull(), F.lit("neither 'id' nor 'nodes'"))
        .when(gap, F.lit("NULL node id or neighbor"))
    )
    rows = rows.select(*keys, "line", listed.alias("listed"), reason.alias("reason"))
    node_rows = rows.filter(F.col("reason").isNull()).select(*keys, F.inline("listed"))
    nodes = node_rows.select(*keys, "id").distinct()
    edges = node_rows.select(*keys, F.col("id").alias("src"), F.explode("outNeighbors").alias("dst"))
    return nodes, edges, rows.filter(F.col("reason").isNotNull()).select(*keys, "line", "reason")


def read_graph_json(spark: SparkSession, path: str, lines: bool = True) -> tuple[DataFrame, DataFrame]:
    """Read graph JSON files (JSON lines by default, or one document per file); rejects raise ``ValueError``."""
    nodes, edges, rejects = parse_graph_json(spark.read.text(path, wholetext=not lines))
    bad = rejects.take(1)
    if bad:
        raise ValueError(f"{path}: {bad[0]['reason']} (a graph has a 'nodes' key, or nodes with an 'id'): {bad[0]['line'][:80]!r}")
    return nodes, edges


def graph_json_rows(
    nodes: DataFrame, edges: DataFrame, keys: Sequence[str] = (), max_list: int = 1_000_000
) -> DataFrame:
    """One JSON text per node and list part: ``(keys..., id, part, json)``."""
    keys = list(keys)
    adj = adjacency(nodes, edges, keys, max_list=max_list)
    text = F.to_json(F.struct(F.col("id"), F.col("out_neighbors").alias("outNeighbors")))
    return adj.select(*keys, "id", "part", text.alias("json"))


def write_graph_json(
    nodes: DataFrame, edges: DataFrame, path: str, mode: str = "error", max_list: int = 1_000_000
) -> None:
    """Write the graph as JSON lines, one node (or node list part) per line."""
    adj = adjacency(nodes, edges, max_list=max_list)
    adj.select("id", F.col("out_neighbors").alias("outNeighbors")).write.mode(mode).json(path)


def write_graph_document(
    nodes: DataFrame, edges: DataFrame, path: str, mode: str = "error", max_list: int = 1_000_000
) -> None:
    """Write the graph as one ``{"nodes": [...]}`` document in ordered parts.

    The part files, one after the other by name, are the document: nodes in the order of their ids,
    sorted and written in parallel. Every file ends with the brace that ends an object, so no file
    is cut inside one. A node list longer than ``max_list`` goes on in a further object of that id.
    """
    rows = graph_json_rows(nodes, edges, max_list=max_list)
    open_ = F.expr("left(json, length(json) - 1)")  # the closing brace is the record separator
    least = nodes.agg(F.min("id")).first()[0]
    if least is None:
        text = nodes.sparkSession.createDataFrame([('{"nodes": []',)], "value string")
    else:
        first = (F.col("id") == F.lit(least)) & (F.col("part") == 0)
        before = F.when(first, '{"nodes": [').otherwise(",\n")
        body = rows.select(F.lit(0).alias("end"), "id", "part", F.concat(before, open_).alias("value"))
        end = body.sparkSession.range(1).select(
            F.lit(1).alias("end"), F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("int").alias("part"),
            F.lit("]").alias("value"),
        )
        text = body.unionByName(end).orderBy("end", "id", "part").select("value")
    text.write.mode(mode).option("lineSep", "}").text(path)


def document_objects(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``: the objects in the array of one JSON document, which may be a folder of ordered parts.

    The document is read in splits, as records that end with a brace. Whether a brace stands inside a
    string, and how deep it is, follows from all that stands before it. That state is carried by a
    prefix scan: each split tells its effect for both states it may start in (outside or inside a
    string), the effects are composed over the small table of splits, and every record
    gets its own from its split's start. An object of one record is complete; only objects that
    hold further braces are put together by a shuffle.
    """
    records = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("nth"),
    )
    # Stretches between quotes, escaped characters left out: outside and inside a string by turns.
    stretches = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')

    def braces(turn: int) -> Column:
        n = F.transform(
            stretches,
            lambda x, i: F.when(i % 2 == turn, F.length(x) - F.length(F.replace(x, F.lit("{"), F.lit("")))).otherwise(0),
        )
        return F.aggregate(n, F.lit(0).cast("bigint"), lambda a, x: a + x)

    in_split = W.partitionBy("file", "split").orderBy("nth")
    before = in_split.rowsBetween(W.unboundedPreceding, -1)
    facts = records.withColumn("odd", (F.size(stretches) - 1) % 2).withColumn("open0", braces(0)).withColumn("open1", braces(1))
    facts = facts.withColumn("turn", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    ends_outside = (F.col("turn") + F.col("odd")) % 2 == 0
    opened = [F.when(F.col("turn") == s, F.col("open0")).otherwise(F.col("open1")) for s in (0, 1)]
    # A record's own closing brace counts if it stands outside a string.
    facts = facts.withColumn("step0", opened[0] - ends_outside.cast("int"))
    facts = facts.withColumn("step1", opened[1] - (~ends_outside).cast("int"))
    for s in (0, 1):
        facts = facts.withColumn(f"deep{s}", F.coalesce(F.sum(f"step{s}").over(before), F.lit(0)))
    facts = facts.drop("open0", "open1")

    splits = facts.groupBy("file", "split").agg(
        (F.sum("odd") % 2).alias("odd"), F.sum("step0").alias("step0"), F.sum("step1").alias("step1")
    )
    # One row per split of the file: small enough to be scanned in order.
    order = W.partitionBy(F.lit(0)).orderBy("file", "split").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("start", F.coalesce(F.sum("odd").over(order), F.lit(0)) % 2)
    step = F.when(F.col("start") == 0, F.col("step0")).otherwise(F.col("step1"))
    splits = splits.withColumn("depth", F.coalesce(F.sum(step).over(order), F.lit(0)))

    known = facts.join(splits.select("file", "split", "start", "depth"), ["file", "split"])
    at = lambda name: F.when(F.col("start") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    known = known.select(
        "file", "split", "nth", "value", (F.col("depth") + at("deep")).alias("depth"), at("step").alias("step"),
        ((F.col("turn") + F.col("start")) % 2 == 0).alias("outside"),
        ((F.col("turn") + F.col("odd") + F.col("start")) % 2 == 0).alias("closes"),
    )
    after = F.col("depth") + F.col("step")
    ends = F.col("closes") & (after == 1)
    whole = F.col("outside") & (F.col("depth") <= 1) & ends
    known = known.withColumn("whole", whole).withColumn("ends", ends.cast("int")).withColumn("after", after)
    single = known.filter("whole").select("depth", "value")

    # Objects of several records: numbered by the ends before them, again split by split.
    ended = known.groupBy("file", "split").agg(F.sum("ends").alias("n"))
    ended = ended.withColumn("told", F.coalesce(F.sum("n").over(order), F.lit(0))).drop("n")
    number = F.coalesce(F.sum("ends").over(before), F.lit(0))
    parts = known.withColumn("number", number).filter("not whole and after >= 1").join(ended, ["file", "split"])
    pieces = F.sort_array(F.collect_list(F.struct("file", "split", "nth", "value")))
    joined = parts.groupBy((F.col("told") + F.col("number")).alias("object")).agg(
        F.min("depth").alias("depth"), F.array_join(F.transform(pieces, lambda x: x["value"]), "}").alias("value"),
        F.max("ends").alias("ends"), F.max(F.col("step") + F.col("closes").cast("int")).alias("opened"),
    )
    # What follows the array opens nothing; an object that was opened and never ends stays, and fails to parse.
    joined = joined.filter("ends = 1 or opened > 0")
    texts = single.unionByName(joined.select("depth", "value"))
    # The first object has the document's opening before it, all others a comma.
    head = F.regexp_extract("value", r'(?s)^\s*\{.*?"nodes"\s*:\s*\[\s*(\{.*)$', 1)
    rest = F.regexp_extract("value", r"(?s)^[\s,]*(\{.*)$", 1)
    return texts.select(F.concat(F.when(F.col("depth") == 0, head).otherwise(rest), F.lit("}")).alias("value"))


def read_graph_document(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(nodes, edges)`` of one large ``{"nodes": [...]}`` document, read in splits (see :func:`document_objects`).

    What is no node raises ``ValueError``. A node whose list was written in several objects is one node.
    """
    nodes, edges, rejects = parse_graph_json(document_objects(spark, path))
    bad = rejects.take(1)
    if bad:
        raise ValueError(f"{path}: {bad[0]['reason']}: {bad[0]['line'][:80]!r}")
    return nodes.distinct(), edges
