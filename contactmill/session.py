"""Session helpers: the shared scratch folder, lineage cuts and guarded broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when it is known to have no more bytes than this.
BROADCAST_BYTES = 24 << 20
#: Bytes of a batch of rows that goes to a Python worker.
BATCH_BYTES = 8 << 20


def scratch_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` is used whenever the session names it. Where it is unset, a local
    session gets a temporary folder; a session on a cluster uses a folder beside the warehouse,
    since a temporary folder would not be seen by the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = "file://" + tempfile.mkdtemp(prefix="contactmill-")
    else:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "step") -> tuple[DataFrame, str]:
    """Write df to the shared folder and read it back: lineage ends, lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def bounded_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """Let batches of texts that go to Python hold at most `limit` bytes, unless the session says
    otherwise: the JVM's buffers and the workers' copies of a batch then stay small together."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "1") == "1":  # what get() answers where the key is unset
        spark.conf.set(key, str(limit))


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores put before it until no column is called so, whatever the case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when rows * row_bytes is within the limit; else leave the join to shuffle."""
    return F.broadcast(df) if rows * row_bytes <= limit else df
