"""Candidates for a stream of new source-1 records against a written pool.

Keys of arriving records meet the pool's postings in a stream-static join. Ranking needs a whole batch, so each
micro-batch is ranked and written by ``foreachBatch``; batches are idempotent, as each overwrites its own folder.
One-to-one assignment isn't incremental (a later, stronger claim displaces an earlier one), so it stays a batch job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import common
from ..operators import blocking
from ..operators.rules import RuleSet
from ..sources.storage import written


@dataclass
class PoolIndex:
    """What a stream needs of the pool: token weights, their maximum and the capped postings, written once."""

    weights: DataFrame
    top: DataFrame
    postings: DataFrame

    @classmethod
    def build(cls, pool: DataFrame, config: blocking.Config = blocking.Config()) -> PoolIndex:
        """``pool`` is prepared. Tokens that only new records have weigh as much as one that no pool record has."""
        weights = written(blocking.idf(pool, pool.limit(0)), "weights")
        n = pool.groupBy("country").agg(F.count("*").alias("n"))
        top = written(n.select("country", F.log(1.0 + F.col("n")).alias("max_idf")), "top")
        return cls(weights, top, written(blocking.postings(blocking.keys(blocking.rarest(pool, weights, config.rarest), None, config), config.max_posting), "postings"))


def batch_candidates(new: DataFrame, index: PoolIndex, rules: RuleSet = RuleSet(), config: blocking.Config = blocking.Config()) -> DataFrame:
    """Ranked candidates of one batch of raw records."""
    s1 = blocking.prepare(new, rules)
    unseen = s1.select("country", F.explode(F.array_distinct(F.concat("name_toks", "word_toks", "num_toks"))).alias("token")).distinct().join(index.weights, ["country", "token"], "left_anti")
    more = unseen.join(index.top, "country").select("country", "token", F.lit(0).cast("long").alias("df"), F.col("max_idf").alias("idf"))
    weights = index.weights.select(*more.columns).unionByName(more)
    probe = blocking.keys(blocking.expand_words(blocking.rarest(s1, weights, config.rarest, common.thinned(index.weights, config.rarest)), weights, rules, config.rarest), index.top, config).withColumnRenamed("entity_id", "s1_id")
    met = probe.join(index.postings, ["country", "fam", "a", "b"]).groupBy("country", "s1_id", "cand_id").agg(F.round(F.sum("w"), 9).alias("block_score"))
    return blocking.top_k(met, config.top_k)


def stream_candidates(stream: DataFrame, index: PoolIndex, out: str, checkpoint: str, rules: RuleSet = RuleSet(), config: blocking.Config = blocking.Config(), **trigger):
    """Starts the query; ``stream`` has the columns of a record, each batch lands in ``out``/batch=N."""

    def land(batch: DataFrame, number: int) -> None:
        batch_candidates(batch, index, rules, config).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
