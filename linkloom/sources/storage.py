"""Tables written to the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table may be broadcast.
FEW = 10_000
#: Slices in which plans are run that move a row for each token of each record.
SLICES = 4
_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where that is unset: a local folder if all runs on one machine, as in tests,
    else an error, as each machine would write to a folder of its own."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not got:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        got = tempfile.mkdtemp(prefix="linkloom-")
        spark.sparkContext.setCheckpointDir(got)
    return got


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/linkloom-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, Spark drops a plan's shuffle files as soon as it has run; else they stay until the driver's heap is collected,
    which a large one rarely is."""
    before = spark.conf.get(_DROP, None)
    spark.conf.set(_DROP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP) if before is None else spark.conf.set(_DROP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back; what stands on it doesn't repeat it, nor loses it with an executor, and the
    shuffle files that it took are dropped."""
    return written_slices(lambda _: df, 1, name)


def slice_of(key: str, n: int) -> Column:
    """The slice, of ``n``, of a key."""
    return F.pmod(F.xxhash64(key), F.lit(n))


def written_slices(make: Callable[[int], DataFrame], n: int, name: str) -> DataFrame:
    """The frames ``make(0)`` to ``make(n - 1)`` written one after another into one table: all rows, but the disk for shuffles
    of one slice at a time."""
    schema, spark, path = None, None, None
    for k in range(n):
        df = make(k)
        if path is None:
            schema, spark = df.schema, df.sparkSession
            path = fresh_path(spark, name)
        with shuffles_dropped(spark):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def few(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, and broadcast where its count proves it small. For tables of a row a country: joined by the
    country alone, a shuffle has no more tasks than there are countries."""
    kept = written(df, name)
    return F.broadcast(kept) if kept.count() <= FEW else kept
