"""Helpers that keep plans safe on a large cluster: shared scratch, size-checked broadcasts, salting."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local_scratch: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="run-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, **options) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there and survives lost executors.

    ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def short_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Rows of a megabyte reach Python some at a time, not 64 MiB, unless the session sets a number itself."""
    if spark.conf.get(BATCH_BYTES) == f"{64 << 20}b":
        spark.conf.set(BATCH_BYTES, f"{size}b")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition on the keys when the scan yields fewer partitions than the cluster has cores.

    A table of many files passes through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


ROWS_PER_TASK = 500_000  # what a task may group or sort: some tens of MB of short rows


def dealt(df: DataFrame, key: str, rows: float | None) -> DataFrame:
    """Hash-partition on ``key`` into as many tasks as ``rows``, the rows they will make of it, are worth.

    The session's partition count is fixed, so that each task's share would grow with the input, and
    adaptive execution only merges small partitions.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, math.ceil((rows or 0) / ROWS_PER_TASK)), key)


def bounded_broadcast(df: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """Broadcast ``df`` once it is known to hold at most ``max_rows`` rows.

    At most ``max_rows + 1`` rows reach the driver.  A larger table comes back unhinted, so the
    join shuffles and adaptive execution splits the hot keys.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def hot_keys(counted: DataFrame, key: str, count_col: str, share: float = 0.001, least: int = 10_000) -> DataFrame:
    """Keys holding more than ``share`` of all rows and ``least`` rows at that.

    No more than ``1 / share`` keys can, which is what makes broadcasting them safe; fewer rows
    than ``least`` fit one task whatever their share.
    """
    total = counted.agg(F.sum(count_col)).scalar()
    return counted.where((F.col(count_col) > total * share) & (F.col(count_col) > least)).select(key)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot: DataFrame,
    row_id: Column,
    salts: int = 64,
    how: str = "left",
) -> DataFrame:
    """Equi-join on ``key`` where rows of a hot key spread over ``salts`` tasks.

    ``hot`` comes from :func:`hot_keys`; only its keys are replicated on the right side.
    """
    marked = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    salted_left = left.join(marked, key, "left").withColumn(
        "_salt",
        F.when(F.col("_hot"), F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")).otherwise(0),
    ).drop("_hot")
    salted_right = right.join(marked, key, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        ),
    ).drop("_hot")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
