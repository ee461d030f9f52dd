"""Command-line jobs: ``python -m linkloom.plans.jobs JOB ...``.

mine-rules, make-dataset, train, predict, validate-blocking and tune-blocking, over record files (see ``Catalog``).
"""

from __future__ import annotations

import argparse
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import assign, blocking, features, metrics, mining, model, tuning
from ..operators.rules import RuleSet
from ..sources import records as files
from ..sources.storage import written


def block(s1: DataFrame, pool: DataFrame, rules: RuleSet, k: int = 25) -> DataFrame:
    """Ranked candidates of raw records."""
    return blocking.candidates(written(blocking.prepare(s1, rules), "s1"), written(blocking.prepare(pool, rules), "pool"), rules, blocking.Config(top_k=k))


def mine_rules(spark: SparkSession, catalog: files.Catalog, out: str, sample: int | None = 300_000, least: dict[str, int] | None = None) -> RuleSet:
    s1, pool = catalog.sources(spark)
    truth = files.load_ground_truth(spark, catalog.path("ground_truth"))
    got = mining.mine(truth, s1, pool, least, sample)
    got.save(spark, out)
    return got


def _sides(s1: DataFrame, pool: DataFrame, rules: RuleSet) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Source 1 and the pool, prepared, and the token weights; each written once."""
    a, b = written(blocking.prepare(s1, rules), "s1"), written(blocking.prepare(pool, rules), "pool")
    return a, b, written(blocking.idf(b, a), "weights")


def listed(s1: DataFrame, only: DataFrame) -> DataFrame:
    """The source-1 records that ``only`` (entity_id) names."""
    return s1.join(only.select("entity_id").distinct(), "entity_id", "left_semi").select(*s1.columns)


def limited(s1: DataFrame, n: int) -> DataFrame:
    """At most n source-1 records of each country, the first by id."""
    return s1.withColumn("_r", F.row_number().over(Window.partitionBy("country").orderBy("entity_id"))).where(F.col("_r") <= n).drop("_r")


def _lists(cands: DataFrame) -> DataFrame:
    """(s1_id, ids): candidates in order of rank."""
    return cands.groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "cand_id"))), lambda x: x["cand_id"]).alias("ids"))


def make_dataset(spark: SparkSession, catalog: files.Catalog, rules: RuleSet, out: str, country: str | None = None, n: int | None = None, config: blocking.Config = blocking.Config(), only: DataFrame | None = None) -> dict:
    """The labelled feature matrix as Parquet. ``n`` samples source 1, and ``only`` (entity_id) names the records to take; the
    pool is always whole."""
    s1, pool = catalog.sources(spark, [country] if country else None)
    s1 = listed(s1, only) if only is not None else s1
    s1 = mining.by_hash(s1, "entity_id", n) if n else s1
    a, b, weights = _sides(s1, pool, rules)
    truth = files.every_record(a, files.load_ground_truth(spark, catalog.path("ground_truth")))
    cands = written(blocking.candidates(a, b, rules, config, weights=weights), "candidates")
    rows = model.labelled(features.pair_features(cands, a, b, weights), files.truth_edges(truth))
    rows.write.mode("overwrite").parquet(f"{out}/matrix")
    truth.write.mode("overwrite").parquet(f"{out}/truth")
    return metrics.score_blocking(_lists(cands), truth, b.count()).first().asDict()


def train(spark: SparkSession, data: list[str], out: str, rounds: int = 60, loco: bool = False) -> dict:
    """A model, and its threshold and rescue level tuned on the held-out records of all data sets together. The result has
    the held-out records' metrics, over all and by data set, each with what one-to-one assignment is worth."""
    sets = [(spark.read.parquet(f"{d}/matrix"), spark.read.parquet(f"{d}/truth")) for d in data]
    rows, truth = (reduce(DataFrame.unionByName, x) for x in zip(*sets, strict=True))
    rows = written(rows.withColumn("val", model.held_out(F.col("s1_id"))), "rows")
    told = {}
    if loco:
        crossed = written(model.leave_one_out(rows, rounds=max(rounds // 2, 1)).where("score is not null"), "loco")
        for r in crossed.select("country").distinct().sort("country").collect():
            part = crossed.where(F.col("country") == r[0])
            told[r[0]] = tuning.best_of(tuning.sweep(part.select("s1_id", "cand_id", "score"), truth.join(part.select("s1_id").distinct(), "s1_id", "left_semi")))
    fitted = model.train(rows, rounds=rounds, validation="val")
    model.save(fitted, f"{out}/model")
    scored = written(model.predict(fitted, rows.where("val")).select("s1_id", "cand_id", "score"), "validation")
    kept = lambda t: t.where(model.held_out(F.col("s1_id")))
    got = tuning.tune(scored, kept(truth))
    spark.createDataFrame([(json.dumps(got),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/threshold")
    held = {"all": tuning.evaluate(scored, kept(truth), got["threshold"])} | {d: tuning.evaluate(scored, kept(t), got["threshold"]) for d, (_, t) in zip(data, sets, strict=True)}
    return got | {"held_out": held, "importances": model.importances(fitted, 16), "left_out": told}


def predict(spark: SparkSession, catalog: files.Catalog, rules: RuleSet, trained: str, out: str, config: blocking.Config = blocking.Config(), threshold: float | None = None, countries: list[str] | None = None, exclusive: bool = True, limit: int | None = None) -> dict:
    """Candidate and match lists of every source-1 record. ``limit`` keeps that many source-1 records a country."""
    s1, pool = catalog.sources(spark, countries)
    s1 = limited(s1, limit) if limit else s1
    tuned = json.loads(spark.read.text(f"{trained}/threshold").first()[0])
    at = tuned["threshold"] if threshold is None else threshold
    a, b, weights = _sides(s1, pool, rules)
    cands = written(blocking.candidates(a, b, rules, config, weights=weights), "candidates")
    scored = model.predict(model.load(f"{trained}/model"), features.pair_features(cands, a, b, weights))
    floor = at if tuned["rescue"] is None else min(at, tuned["rescue"])
    kept = written(scored.where(F.col("score") >= floor).select("s1_id", "cand_id", "score"), "scored")
    ids = a.select(F.col("entity_id").alias("s1_id"))
    matches = written(assign.assign(kept, at, ids, exclusive=exclusive, rescue_at=tuned["rescue"]), "matches")
    lists = written(files.every_record(a, _lists(cands)), "lists")
    sizes = lists.select("s1_id", F.size("ids").alias("c")).join(matches.select("s1_id", F.size("ids").alias("m")), "s1_id").join(a.select(F.col("entity_id").alias("s1_id"), "country"), "s1_id")
    by = sizes.groupBy("country").agg(F.count("*").alias("records"), F.sum("c").alias("candidates"), F.sum("m").alias("matches")).sort("country")
    return {
        "candidates": files.write_id_lists(lists, f"{out}/candidate_pairs", ("source1_entity_id", "candidate_entity_ids")),
        "matches": files.write_id_lists(matches, f"{out}/matching_results", ("source1_entity_id", "matched_entity_ids")),
        "countries": {r["country"]: r.asDict() for r in by.collect()},
    }


def _sample(spark: SparkSession, catalog: files.Catalog, rules: RuleSet, country: str, n: int, max_posting: int | None, cache: str | None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Source 1's sample, the pool, the weights, the truth and all candidates by key score. ``cache``: a folder that keeps them
    by country, sample and cap, for the runs after this one."""
    names = ("s1", "pool", "weights", "truth", "raw")
    at = f"{cache}/{country}-{n}-{max_posting or 0}" if cache else None
    if at:
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{at}/raw/_SUCCESS")
        if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
            return tuple(spark.read.parquet(f"{at}/{x}") for x in names)
    s1, pool = catalog.sources(spark, [country])
    a, b, weights = _sides(mining.by_hash(s1, "entity_id", n), pool, rules)
    truth = files.every_record(a, files.load_ground_truth(spark, catalog.path("ground_truth")))
    raw = written(blocking.candidates(a, b, rules, blocking.Config(max_posting=max_posting), False, weights), "raw")
    made = (a, b, weights, truth, raw)
    if at:
        for x, d in zip(names, made, strict=True):
            d.write.mode("overwrite").parquet(f"{at}/{x}")
    return made


def validate_blocking(spark: SparkSession, catalog: files.Catalog, rules: RuleSet, country: str, n: int = 5000, k: int = 25, max_posting: int | None = 400, cache: str | None = None, rerank_pool: int = 200) -> dict:
    """Of a sample of source 1: what the keys reach without a cut, and the scorecard of the best K of a shortlist of
    ``rerank_pool`` by key score, for several K."""
    a, b, _, truth, raw = _sample(spark, catalog, rules, country, n, max_posting, cache)
    size = b.count()
    ranked = written(blocking.top_k(raw, rerank_pool), "ranked")
    reached = metrics.score_blocking(raw.groupBy("s1_id").agg(F.collect_list("cand_id").alias("ids")), truth, size).first().asDict()
    cut = lambda m: metrics.score_blocking(_lists(ranked.where(F.col("rank") < m)), truth, size).first().asDict()
    return {"raw": metrics.candidate_counts(raw, a).first().asDict(), "keys_only": reached, "curve": {m: cut(m) for m in (5, 10, 15, 20, 25, 30, 50)}, "score": cut(k)}


def tune_blocking(spark: SparkSession, catalog: files.Catalog, rules: RuleSet, country: str, n: int = 5000, k: int = 20, max_posting: int | None = 400, cache: str | None = None) -> list[tuple]:
    """(variant, found, pairs, recall, ceiling F0.5) of all ranking formulas, by recall of the best k, over a shortlist of 200."""
    a, b, weights, truth, raw = _sample(spark, catalog, rules, country, n, max_posting, cache)
    rows = tuning.masses(blocking.top_k(raw, 200).drop("rank"), a, b, weights)
    rows = written(tuning.with_char_similarity(rows, a, b), "masses")
    return [tuple(r) for r in tuning.compare(rows, files.truth_edges(truth), k, True, truth).sort(F.desc("recall"), F.desc("ceiling_f05"), "variant").collect()]


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="linkloom")
    ap.add_argument("job", choices=["mine-rules", "make-dataset", "train", "predict", "validate-blocking", "tune-blocking"])
    ap.add_argument("--data", default=files.Catalog().root)
    ap.add_argument("--split", default="train")
    ap.add_argument("--rules")
    ap.add_argument("--mode", default="asis", choices=["asis", "aligned"])
    ap.add_argument("--trained", default="trained")
    ap.add_argument("--train", nargs="+", default=[])
    ap.add_argument("--out", default="out")
    ap.add_argument("--country")
    ap.add_argument("--countries", nargs="+")
    ap.add_argument("--n", type=int)
    ap.add_argument("--top-k", type=int, default=25)
    ap.add_argument("--max-posting", type=int, default=400)
    ap.add_argument("--threshold", type=float)
    ap.add_argument("--rounds", type=int, default=60)
    ap.add_argument("--loco", action="store_true")
    ap.add_argument("--no-one-to-one", action="store_true")
    ap.add_argument("--limit", type=int)
    ap.add_argument("--cache")
    ap.add_argument("--rerank-pool", type=int, default=200)
    ap.add_argument("--entities", help="a text file of source-1 ids, one a line, to which make-dataset keeps")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"linkloom {a.job}").getOrCreate()
    catalog = files.Catalog(a.data, a.split)
    rules = RuleSet.load(spark, a.rules, a.mode) if a.rules else RuleSet()
    config = blocking.Config(top_k=a.top_k, max_posting=a.max_posting)
    only = spark.read.text(a.entities).select(F.col("value").alias("entity_id")) if a.entities else None
    got = {
        "mine-rules": lambda: {k: len(getattr(r, k)) for r in [mine_rules(spark, catalog, a.out)] for k in ("droppable", "expansions", "phrases", "translit")},
        "make-dataset": lambda: make_dataset(spark, catalog, rules, a.out, a.country, a.n, config, only),
        "train": lambda: train(spark, a.train, a.out, a.rounds, a.loco),
        "predict": lambda: predict(spark, catalog, rules, a.trained, a.out, config, a.threshold, a.countries, not a.no_one_to_one, a.limit),
        "validate-blocking": lambda: validate_blocking(spark, catalog, rules, a.country, a.n or 5000, a.top_k, a.max_posting, a.cache, a.rerank_pool),
        "tune-blocking": lambda: tune_blocking(spark, catalog, rules, a.country, a.n or 5000, a.top_k, a.max_posting, a.cache),
    }[a.job]()
    print(json.dumps(got, default=str))


if __name__ == "__main__":
    main()
