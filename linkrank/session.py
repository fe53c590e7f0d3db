"""Session-level helpers: the shared folder, tables kept there, and the settings the rank loop needs."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_AQE = "spark.sql.adaptive.enabled"
_SHUFFLE = "spark.sql.shuffle.partitions"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_EXPLAIN = "spark.sql.ui.explainMode"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session if needed.

    Order: a folder already set on the context; ``spark.checkpoint.dir`` from the
    session or context configuration; a fresh temporary folder, but only for a
    ``local`` master (tests, single machine). A cluster without a shared folder is
    an error: a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="linkrank-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "no checkpoint folder: set spark.checkpoint.dir to a folder shared by the cluster"
    )


def _at(spark: SparkSession, path: str):
    """A path of any store that Spark can write to, and its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder."""
    target, store = _at(spark, path)
    store.delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it does not exist."""
    target, store = _at(spark, path)
    return [s.getPath().getName() for s in store.listStatus(target)] if store.exists(target) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all: it gets its name when it is complete."""
    target, store = _at(spark, path)
    unfinished, _ = _at(spark, f"{path}.unfinished")
    out = store.create(unfinished, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not store.rename(unfinished, target):
        raise RuntimeError(f"cannot write {path}")


class Scratch:
    """Tables of one run as Parquet in the shared checkpoint folder (or in ``root``), until :meth:`release`."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        self._n += 1
        path = self.path(str(self._n))
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        delete_path(self.spark, self.root)


def local_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A few rows of the driver as a table of the plan; made from Python rows, it would start Python workers to read them."""
    return spark.createDataFrame(pa.Table.from_pylist(rows))


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get(_SHUFFLE))


@contextlib.contextmanager
def loop_settings(spark: SparkSession, num_partitions: int):
    """Run a block with adaptive execution off, a fixed shuffle width, and joins of tables hashed by one of their keys as they lie.

    The rank loop keeps the edge tables and the rank table hash-partitioned by their
    block, so their joins on block and id need no exchange. Adaptive execution would
    coalesce the aggregation output and break that co-partitioning; skew is
    handled explicitly instead (hub sources, partial aggregation). Every query's plan is
    described for the event log; an update's plan holds those of the updates before, so the
    short form is taken. The caller's values are restored on exit.
    """
    keys = (_AQE, _SHUFFLE, _ALL_KEYS, _EXPLAIN)
    saved = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(_AQE, "false")
    spark.conf.set(_SHUFFLE, str(num_partitions))
    spark.conf.set(_ALL_KEYS, "false")
    spark.conf.set(_EXPLAIN, "simple")
    try:
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
