"""What the training-data operators share: shared storage, input shape, word splitting and hashing."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROOT = str(Path(__file__).resolve().parents[2])

#: Rows, of a few numbers each, up to which a table is broadcast.
BROADCAST_ROWS = 500_000
#: Bytes of the rows that a Python worker gets at once.
BATCH_BYTES = 16 << 20
#: ASCII white space, the separators of a "word" in every contract here.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``. Where that is unset, a local one if
    all run on this machine (tests), else an error, as each machine would write to a folder of its own."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not got:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        got = tempfile.mkdtemp(prefix="linkloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(got)
    return got


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, under this application's id."""
    return f"{shared_dir(spark)}/linkloom-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame) -> DataFrame:
    """``df`` for a join: broadcast where a count proves it to have at most ``BROADCAST_ROWS`` rows, else left to Spark's shuffle joins."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more; it does so when the driver's heap is
    collected, which a large one rarely is."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get, by rows and by bytes, as a single text may be very long; the
    same bounds for every operator, as plans run long after they are built. And let workers import this package where
    it lies (a cluster gets it by --py-files)."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (path, _ROOT) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; 2 is held out. A null id counts as the empty text's (0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 4


def extended(df: DataFrame, more: str) -> T.StructType:
    """The frame's schema followed by the columns of the DDL string."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])


def with_added(docs: DataFrame, data: Column, run, more: str) -> DataFrame:
    """``docs`` and the columns of the DDL string, which ``run`` makes of ``data``: it maps a list to arrays. Whatever the columns'
    names are; those that the string names are replaced."""
    added = T.StructType.fromDDL(more).names
    names = [c for c in docs.columns if c not in added]
    kept = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    base = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], data.alias("data"))
    at = len(names)

    def mapped(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:at], *run(b.column(at).to_pylist())], [*b.schema.names[:at], *added])

    return base.mapInArrow(mapped, extended(kept, more)).toDF(*names, *added)


def least_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- words and their hashes, vectorised over bytes ---------------------------------------------------

_M1, _M2, _S = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_tables: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "q": np.ones(1, np.uint64)}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over the 64."""
    x = (x ^ (x >> _S(30))) * _M1
    x = (x ^ (x >> _S(27))) * _M2
    return x ^ (x >> _S(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown by doubling."""
    if len(_tables["p"]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        inv = pow(_BASE, -1, 1 << 64)
        for k, b in (("p", _BASE), ("q", inv)):
            t = _tables[k]
            while len(t) < size:
                t = np.concatenate([t, t * _S(pow(b, len(t), 1 << 64))])
            _tables[k] = t
    return _tables["p"][:n], _tables["q"][:n]


def _separators(kind: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    if kind == "alnum":
        t[:128] = [not chr(i).isalnum() for i in range(128)]
    return t


_SEP = {k: _separators(k) for k in ("space", "alnum")}


def word_spans(data: np.ndarray, kind: str = "space") -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes. "space": split at ASCII white space alone; "alnum": at all
    ASCII but letters and digits."""
    word = ~_SEP[kind][data]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over the bytes, from one cumulative sum, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, q = _powers(len(data) + 1)
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + _S(1)) * p[: len(data)])])
    return mix64((run[ends] - run[starts]) * q[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (order counts)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h, b = np.zeros(m, np.uint64), _S(base)
    for k in range(n):
        h = h * b + words[k : k + m]
    return mix64(h)
