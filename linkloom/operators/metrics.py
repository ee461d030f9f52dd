"""Set metrics of matches and of candidates against the truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fbeta_half(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """F0.5 of a set: 1 if both are empty, 0 if one is, or nothing is shared."""
    p, r = tp / n_pred, tp / n_true
    return F.when((n_pred == 0) & (n_true == 0), F.lit(1.0)).when((n_pred == 0) | (n_true == 0) | (tp == 0), F.lit(0.0)).otherwise(1.25 * p * r / (0.25 * p + r))


def compared(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, tp, n_pred, n_true, equal): a row for each record of the truth (s1_id, ids); no prediction counts as empty."""
    none = F.array().cast("array<string>")
    rows = truth.select("s1_id", F.array_distinct(F.coalesce("ids", none)).alias("t")).join(pred.select("s1_id", F.array_distinct("ids").alias("p")), "s1_id", "left").withColumn("p", F.coalesce("p", none))
    tp = F.size(F.array_intersect("t", "p"))
    return rows.select("s1_id", tp.alias("tp"), F.size("p").alias("n_pred"), F.size("t").alias("n_true"), ((tp == F.size("p")) & (tp == F.size("t"))).alias("equal"))


def _ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(empty))


def score_matching(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: macro F0.5, mean precision and recall, exact sets, singletons and id counts."""
    tp, p, t = F.col("tp"), F.col("n_pred"), F.col("n_true")
    n = F.count("*")
    avg = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return compared(pred, truth).agg(
        avg(fbeta_half(tp, p, t)).alias("macro_f05"), n.alias("n_entities"),
        avg(F.when(p > 0, tp / p).when(t == 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("mean_precision"),
        avg(F.when(t > 0, tp / t).otherwise(F.lit(1.0))).alias("mean_recall"),
        F.count_if("equal").alias("exact_sets"), F.count_if(t == 0).alias("singleton_total"), F.count_if((t == 0) & (p == 0)).alias("singleton_correct"),
        F.coalesce(F.sum(p), F.lit(0)).cast("long").alias("predicted_ids"), F.coalesce(F.sum(t), F.lit(0)).cast("long").alias("true_ids"))


def score_blocking(cands: DataFrame, truth: DataFrame, pool_size: int | Column) -> DataFrame:
    """One row: recall of true pairs, records found whole, candidates, reduction and the best F0.5 still in reach."""
    return blocking_scores(compared(cands, truth), pool_size)


def blocking_scores(counts: DataFrame, pool_size: int | Column) -> DataFrame:
    """The same from each record's counts: tp, n_pred, n_true."""
    tp, p, t = F.col("tp"), F.col("n_pred"), F.col("n_true")
    size = F.lit(pool_size).cast("long") if isinstance(pool_size, int) else pool_size
    got = counts.agg(
        F.sum("tp").alias("found"), F.sum(t).alias("pairs"), F.count_if(tp == t).alias("full"), F.count("*").alias("n"), F.coalesce(F.sum(p), F.lit(0)).cast("long").alias("total_candidates"),
        F.coalesce(F.max(p), F.lit(0)).cast("long").alias("max_candidates"), F.sum(fbeta_half(tp, tp, t)).alias("ceiling"))
    space = F.col("n") * size
    return got.select(_ratio(F.col("found"), F.coalesce("pairs", F.lit(0)), 1.0).alias("pair_completeness"), _ratio(F.col("full"), F.col("n")).alias("entities_full_recall"), _ratio(F.col("total_candidates"), F.col("n")).alias("avg_candidates"),
                      "max_candidates", "total_candidates", space.alias("search_space"), _ratio(F.col("total_candidates"), space).alias("reduction_ratio"), _ratio(F.col("ceiling"), F.col("n")).alias("ceiling_f05"))


def recall_curve(ranked: DataFrame, edges: DataFrame, ks: tuple[int, ...] = (5, 10, 15, 20, 25, 30, 50), pairs: int | None = None) -> DataFrame:
    """(k, found, pairs, recall) off one ranked list (s1_id, cand_id, rank): hits are counted by rank once, then summed.
    ``pairs``: the number of true pairs, where ``edges`` has only those among the ranked ones."""
    hits = edges.join(ranked.select("s1_id", "cand_id", "rank"), ["s1_id", "cand_id"], "left")
    sums = hits.agg((F.count("*") if pairs is None else F.lit(pairs).cast("long")).alias("pairs"), *[F.count_if(F.col("rank") < k).alias(f"k{k}") for k in ks])
    rows = sums.select("pairs", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("found")) for k in ks])).alias("x"))
    return rows.select("x.k", "x.found", "pairs", _ratio(F.col("x.found"), F.col("pairs"), 1.0).alias("recall"))


def candidate_counts(raw: DataFrame, s1: DataFrame) -> DataFrame:
    """Mean, median and most candidates of a source-1 record, those without one included."""
    n = s1.select(F.col("entity_id").alias("s1_id")).join(raw.groupBy("s1_id").agg(F.count("*").alias("n")), "s1_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return n.agg(F.avg("n").alias("mean"), F.median("n").alias("median"), F.max("n").alias("most"))
