"""Session settings and stable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings worth having on any cluster; none of them changes results.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_fallback_dirs: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    It is the folder the cluster names in ``spark.checkpoint.dir``. A temporary
    folder replaces it only on a local master, where every task sees the same disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _fallback_dirs:
        _fallback_dirs[context.applicationId] = tempfile.mkdtemp(prefix="cartwise-")
    return _fallback_dirs[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/cartwise/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives lost executors, and fixes columns that would change
    if a stage ran again (range partition ids). Parquet also gives the optimizer
    true sizes for its join choices. Zstandard writes about a fifth less than the default.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    df.write.option("compression", "zstd").parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


# Paths of the tables that the innermost block of ``temporary_tables`` has to delete.
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block the tables that ``materialize`` wrote in it.

    A frame that leaves the block must not read them any more; ``settled`` writes it.
    """
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(token)
        for name in paths:
            remove(spark, name)


def remove(spark: SparkSession, name: str) -> None:
    """Delete a table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settled(spark: SparkSession, build: Callable[[], DataFrame], name: str = "table") -> DataFrame:
    """The frame that ``build`` returns as a written table, without the tables made on the way.

    The table itself belongs to the block around the call, if there is one.
    """
    outer = _owned.get()
    with temporary_tables(spark):
        frame = build()
        path = new_path(spark, name)
        if outer is not None:
            outer.append(path)
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


# Most bytes a table may hold, by its checked row count, to be sent to every executor.
BROADCAST_BYTES = 256 * 1024 * 1024


def broadcast_if_small(table: DataFrame, row_bytes: int) -> DataFrame:
    """Hint a broadcast if the counted rows fit the bound; larger tables join by shuffle."""
    small = table.count() * row_bytes <= BROADCAST_BYTES
    return F.broadcast(table) if small else table


# Rows that a task of a wide step gets where the session's shuffle partitions would give it more.
ROWS_PER_TASK = 1 << 18


def dealt(df: DataFrame, *keys: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows with equal keys in one task, in tasks of about ``rows_per_task`` rows at most.

    The number of shuffle partitions is fixed by the session, so that a task would grow with
    the table. Large tables get more tasks, and a task's memory stays as it is. The rows are
    counted first, so ``df`` should be a written table or a cheap plan.
    """
    parts = -(-df.count() // rows_per_task)
    if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(*keys)
    return df.repartition(parts, *keys)


def spread(scan: DataFrame) -> DataFrame:
    """Give a file scan one partition per core when it has fewer.

    A few large row groups would otherwise keep most cores idle. Scans of many
    files already have more partitions and come back unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
