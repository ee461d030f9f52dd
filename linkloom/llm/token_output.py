"""Token ids of all documents in word-aligned binary shards.

Documents are dealt by ranges of ``doc_id`` (ties: by text hash), each range sorted, so shards follow each other in
ascending order. A shard row holds the ids of some consecutive documents, Simple-8b coded with block offsets (see
``simple8b``), their ids and their token counts. Shards are Parquet files written by Spark's own writer, so any store
will do; a lost task is written again.

Defined cases: null text is an empty document (the end id alone); a null doc_id comes first; repeated rows are each
a document; no rows give no shard; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, simple8b
from .encoding import encoder

SHARD = "part int, seq int, doc_ids array<bigint>, counts array<bigint>, n_ids long, words binary, offsets binary"


def encode(docs: DataFrame, tokenizer: str, kind: str = "byte", end: int = 0) -> DataFrame:
    """Shard rows of ``docs`` (doc_id, text); ``part`` and ``seq`` order them."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    dealt = rows.repartitionByRange(common.least_tasks(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches):
        made, part = encoder(tokenizer, kind), TaskContext.get().partitionId()
        for seq, b in enumerate(x for x in batches if x.num_rows):
            ids, counts = made.encode(b.column("text").to_pylist(), end)
            words, offsets = simple8b.encode(ids)
            yield pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "doc_ids": b.column("doc_id").to_pylist(), "counts": counts.tolist(), "n_ids": len(ids), "words": words.tobytes(), "offsets": offsets.tobytes()}], schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("words", pa.binary()), ("offsets", pa.binary())]))

    return dealt.select("doc_id", "text").mapInArrow(run, SHARD)


def write(docs: DataFrame, path: str, tokenizer: str, kind: str = "byte", end: int = 0) -> None:
    encode(docs, tokenizer, kind, end).write.option("compression", "none").parquet(path)


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, ids): every document's ids, and those of all documents before it counted."""
    shards = spark.read.schema(SHARD).parquet(path)
    return _documents(shards, lambda ids: {"ids": pa.array([x.tolist() for x in ids], pa.list_(pa.int64()))}, "ids array<bigint>")


def _documents(shards: DataFrame, of, more: str) -> DataFrame:
    spark = shards.sparkSession
    sums = sorted((r["part"], r["n"]) for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())  # one row a part
    base, run = {}, 0
    for part, n in sums:
        base[part] = run
        run += n
    small = spark.createDataFrame([(k, v) for k, v in base.items()], "part int, base long")
    inner = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("part", "seq", "n_ids").withColumn("inner", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(small, "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("first"))

    def run_(batches):
        for b in batches:
            for r in b.to_pylist():
                counts = np.array(r["counts"], np.int64)
                ids = simple8b.decode(np.frombuffer(r["words"], np.uint64), np.frombuffer(r["offsets"], np.uint32), r["n_ids"]).astype("<u4")
                ends = np.cumsum(counts)
                each = np.split(ids, ends[:-1]) if len(counts) else []
                got = {"doc_id": pa.array(r["doc_ids"], pa.int64()), "part": pa.array([r["part"]] * len(counts), pa.int32()), "seq": pa.array([r["seq"]] * len(counts), pa.int32()), "before": pa.array(ends - counts), "n_tokens": pa.array(counts)} | of(each)
                yield pa.RecordBatch.from_pydict(got)

    docs = shards.mapInArrow(run_, f"doc_id long, part int, seq int, before long, n_tokens long, {more}")
    names = [c.split()[0] for c in more.split(", ")]
    return docs.join(placed, ["part", "seq"]).select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", *names)


def digests(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the shards."""
    shards = spark.read.schema(SHARD).parquet(path)
    return _documents(shards, lambda ids: {"ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64())}, "ids_crc32 long")


def query(spark, sf_dir):
    """op8: every document's place and digest, from files written and read back."""
    import public_tokenizers

    path = common.fresh_path(spark, "token-shards")
    write(common.documents(spark, sf_dir).select("doc_id", "text"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return digests(spark, path)
