"""Candidate generation: an inverted index as a capped equi-join.

Records are prepared once; document frequencies, the rarest tokens of each record, composite keys, a cap on how many
pool records a key may have, the join, the summed weights and the best K of each source-1 record are all relational.
``country`` is part of every key. No step compares records pairwise without a shared key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import common, minhash, normalize, tokens
from ..sources.storage import SLICES, few, slice_of, written, written_slices
from .rules import RuleSet

#: Key families and the weight of a shared key. Fixed values.
NAME_ADDR, NUM_ADDR, NAME_NUM, NAME_PAIR, EXACT_NAME, NAME_LSH = range(1, 7)
WEIGHT = {NAME_ADDR: 3.0, NUM_ADDR: 3.5, NAME_NUM: 3.0, NAME_PAIR: 2.0, EXACT_NAME: 4.0, NAME_LSH: 1.2}


@dataclass(frozen=True)
class Config:
    """``families``: which keys to use; ``lsh``: "crc32" or "md5" (the one that other engines can compute)."""

    top_k: int = 25
    max_posting: int = 400
    rarest: int = 3
    families: tuple = (NAME_ADDR, NUM_ADDR, NAME_NUM, NAME_PAIR, EXACT_NAME, NAME_LSH)
    lsh: str = "crc32"


def prepare(records: DataFrame, rules: RuleSet = RuleSet()) -> DataFrame:
    """Adds name_toks, word_toks, num_toks, norm_name, norm_addr and name_key to (entity_id, name, address, country)."""
    rows = records.withColumn("norm_name", normalize.norm_text(F.col("name"))).withColumn("norm_addr", normalize.norm_text(F.col("address")))
    name = normalize.skeletonize(tokens.transliterate(normalize.tokens_of_normal(F.col("norm_name")), rules.translit))
    addr = normalize.skeletonize(tokens.apply_phrases(normalize.tokens_of_normal(F.col("norm_addr")), rules.phrases))
    rows = rows.withColumn("name_toks", tokens.strip_droppable(name, rules.drops)).withColumn("addr_toks", addr)
    rows = rows.withColumn("word_toks", normalize.words_of(F.col("addr_toks"))).withColumn("num_toks", normalize.numbers_of(F.col("addr_toks"))).drop("addr_toks")
    foreign = (F.size("name_toks") > 0) & F.col("norm_name").rlike(r"[\x{0900}-\x{10FFFF}]")
    return rows.withColumn("norm_name", F.when(foreign, F.array_join("name_toks", " ")).otherwise(F.col("norm_name"))).withColumn("name_key", normalize.name_key(F.col("name_toks")))


def _all_tokens() -> Column:
    return F.array_distinct(F.concat("name_toks", "word_toks", "num_toks"))


def document_frequency(pool: DataFrame) -> DataFrame:
    """(country, token, df): pool records that a token occurs in."""
    return pool.select("country", F.explode(_all_tokens()).alias("token")).groupBy("country", "token").agg(F.count("*").alias("df"))


def idf(pool: DataFrame, s1: DataFrame) -> DataFrame:
    """(country, token, df, idf, n) of all tokens of either side: ``ln(1 + n / (1 + df))``, the country having n pool
    records; source-1-only tokens have df 0."""
    df = document_frequency(pool)
    n = few(pool.groupBy("country").agg(F.count("*").alias("n")), "pool-sizes")
    only = s1.select("country", F.explode(_all_tokens()).alias("token")).distinct()
    every = df.join(only, ["country", "token"], "full_outer").withColumn("df", F.coalesce("df", F.lit(0)))
    known = every.join(n, "country", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return known.select("country", "token", "df", tokens.idf(F.col("df"), F.col("n")).alias("idf"), "n")


def rarest(prepared: DataFrame, weights: DataFrame, k: int = 3, thin=None) -> DataFrame:
    """(country, entity_id, name_key, names, words, nums): the k rarest distinct name and address tokens (ties by
    spelling) and the k first numbers by spelling, each with its idf. ``thin``: ``common.thinned`` of the weights, if it is at hand."""
    thin = common.thinned(weights, k) if thin is None else thin

    def tagged(field: str, c: Column) -> Column:
        return F.transform(c, lambda t: F.struct(F.lit(field).alias("field"), t.alias("token")))

    few_of = prepared.select("country", "entity_id", thin("country", "name_toks").alias("n"), thin("country", "word_toks").alias("w"), F.array_distinct("num_toks").alias("d"))
    each = few_of.select("country", "entity_id", F.explode(F.flatten(F.array(*[tagged(f, F.col(f)) for f in "nwd"]))).alias("x"))
    each = each.select("country", "entity_id", "x.field", "x.token").join(weights.select("country", "token", "df", "idf"), ["country", "token"])
    # a record's rows meet once: the window and the lists stand on one partitioning, and only k rows a field are gathered
    own = Window.partitionBy("country", "entity_id", "field").orderBy(F.when(F.col("field") != "d", F.col("df")), "token")
    best = each.repartition("country", "entity_id").withColumn("at", F.row_number().over(own)).where(F.col("at") <= k)

    def first(field: str) -> Column:
        rows = F.array_sort(F.collect_list(F.when(F.col("field") == field, F.struct("at", "token", "idf"))))
        return F.transform(rows, lambda x: F.struct(x["token"].alias("token"), x["idf"].alias("idf")))

    got = best.groupBy("country", "entity_id").agg(first("n").alias("names"), first("w").alias("words"), first("d").alias("nums"))
    return prepared.select("country", "entity_id", "name_key", "name_toks").join(got, ["country", "entity_id"], "left")


def expand_words(rare: DataFrame, weights: DataFrame, rules: RuleSet, k: int = 3) -> DataFrame:
    """Probe side only: address words and, after them, their alternates that occur somewhere; 3 k at most."""
    if not rules.alternates:
        return rare
    alt = rare.select("country", "entity_id", F.posexplode("words").alias("at", "x")).select("country", "entity_id", "at", F.posexplode(tokens.expand(F.col("x.token"), rules.alternates)).alias("nth", "token"))
    known = alt.join(weights, ["country", "token"]).groupBy("country", "entity_id", "token", "idf").agg(F.min(F.struct(F.col("nth") > 0, "at", "nth")).alias("o"))
    words = known.groupBy("country", "entity_id").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("o", "token", "idf"))), 1, 3 * k), lambda x: F.struct(x["token"].alias("token"), x["idf"].alias("idf"))).alias("words"))
    return rare.drop("words").join(words, ["country", "entity_id"], "left")


def keys(rare: DataFrame, top_idf: DataFrame | None, config: Config = Config()) -> DataFrame:
    """(country, entity_id, fam, a, b, w): a record's distinct keys. The weight needs ``top_idf`` (country, max_idf), and
    is left 0 without it."""
    empty = F.array().cast("array<struct<token:string,idf:double>>")
    n, w, d = (F.coalesce(F.col(c), empty) for c in ("names", "words", "nums"))
    key = lambda fam, a, b, i: F.struct(F.lit(fam).alias("fam"), a.alias("a"), b.alias("b"), (F.lit(WEIGHT[fam]) * i).alias("w"))
    cross = lambda fam, x, y: F.flatten(F.transform(x, lambda p: F.transform(y, lambda q: key(fam, p["token"], q["token"], p["idf"] + q["idf"]))))
    top = F.coalesce(F.col("max_idf"), F.lit(0.0))
    blank = F.array().cast("array<struct<fam:int,a:string,b:string,w:double>>")
    bands = F.transform("bands", lambda x: key(NAME_LSH, x, F.lit(""), top)) if config.lsh == "md5" else F.transform(minhash.crc32_bands(F.col("name_toks")), lambda x: key(NAME_LSH, x["band"].cast("string"), F.concat_ws(":", x["h1"], x["h2"]), top))
    made = {
        NAME_ADDR: cross(NAME_ADDR, n, w), NUM_ADDR: cross(NUM_ADDR, d, w), NAME_NUM: cross(NAME_NUM, n, d),
        NAME_PAIR: F.flatten(F.transform(n, lambda p: F.transform(F.filter(n, lambda q: q["token"] > p["token"]), lambda q: key(NAME_PAIR, p["token"], q["token"], p["idf"] + q["idf"])))),
        EXACT_NAME: F.when(F.col("name_key").isNotNull(), F.array(key(EXACT_NAME, F.col("name_key"), F.lit(""), top))).otherwise(blank),
        NAME_LSH: bands,
    }
    rows = rare.join(top_idf, "country", "left") if top_idf is not None else rare.withColumn("max_idf", F.lit(0.0))
    if config.lsh == "md5" and NAME_LSH in config.families:
        rows = rows.withColumn("bands", minhash.md5_bands(F.col("name_toks")))
    return rows.select("country", "entity_id", F.explode(F.flatten(F.array(*[made[f] for f in config.families]))).alias("k")).select("country", "entity_id", "k.*")


def postings(pool_keys: DataFrame, max_posting: int | None = 400) -> DataFrame:
    """The pool's keys without those that more than ``max_posting`` records have; None or 0 keeps every key. Counting first combines on the map
    side, so a key that a third of all records share costs a row a task, and its rows are gone before the join."""
    if not max_posting:
        return pool_keys.select("country", "fam", "a", "b", F.col("entity_id").alias("cand_id"))
    fine = pool_keys.groupBy("country", "fam", "a", "b").agg(F.count("*").alias("n")).where(F.col("n") <= max_posting).drop("n")
    return pool_keys.join(fine, ["country", "fam", "a", "b"], "left_semi").select("country", "fam", "a", "b", F.col("entity_id").alias("cand_id"))


def top_k(scored: DataFrame, k: int) -> DataFrame:
    """The k best of each source-1 record with their ``rank`` from 0; ties by candidate id."""
    best = Window.partitionBy("country", "s1_id").orderBy(F.desc("block_score"), "cand_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).withColumn("rank", F.col("rank") - 1)


def rarest_written(prepared: DataFrame, weights: DataFrame, k: int, name: str) -> DataFrame:
    """``rarest``, written a slice of the records at a time, as it moves a row for each of their tokens twice."""
    thin = common.thinned(weights, k)
    return written_slices(lambda i: rarest(prepared.where(slice_of("entity_id", SLICES) == i), weights, k, thin), SLICES, name)


def greatest_idf(weights: DataFrame) -> DataFrame:
    """(country, max_idf), a row a country."""
    return few(weights.groupBy("country").agg(F.max("idf").alias("max_idf")), "greatest-idf")


def _candidates(s1: DataFrame, pool: DataFrame, rules: RuleSet, config: Config, capped: bool, weights: DataFrame | None):
    """A function from a condition on ``s1_id`` to the candidates of those records."""
    weights = written(idf(pool, s1), "weights") if weights is None else weights
    index = written(postings(written(keys(rarest_written(pool, weights, config.rarest, "rarest-pool"), None, config), "pool-keys"), config.max_posting), "postings")
    probe = written(keys(expand_words(rarest_written(s1, weights, config.rarest, "rarest-s1"), weights, rules, config.rarest), greatest_idf(weights), config), "s1-keys").withColumnRenamed("entity_id", "s1_id")

    def part(own: Column) -> DataFrame:
        met = probe.where(own).join(index, ["country", "fam", "a", "b"]).groupBy("country", "s1_id", "cand_id").agg(F.round(F.sum("w"), 9).alias("block_score"))
        return top_k(met, config.top_k) if capped else met

    return part


def candidates(s1: DataFrame, pool: DataFrame, rules: RuleSet = RuleSet(), config: Config = Config(), capped: bool = True, weights: DataFrame | None = None) -> DataFrame:
    """(country, s1_id, cand_id, block_score, rank) from two prepared sides; ``capped`` False keeps every candidate,
    without ranks. ``weights``: those of ``idf``, written, if they are at hand."""
    return _candidates(s1, pool, rules, config, capped, weights)(F.lit(True))


def candidates_written(s1: DataFrame, pool: DataFrame, rules: RuleSet = RuleSet(), config: Config = Config(), capped: bool = True, weights: DataFrame | None = None) -> DataFrame:
    """``candidates``, written a slice of source 1 at a time, as each key that two records share is a row before they are summed."""
    part = _candidates(s1, pool, rules, config, capped, weights)
    return written_slices(lambda k: part(slice_of("s1_id", SLICES) == k), SLICES, "candidates")
