"""One-to-one assignment under caps, as deferred acceptance in windows.

With one total order (score descending, then s1_id, cand_id), taking claims greedily gives the unique stable matching. It
is reached in rounds: each candidate proposes to the best source-1 record that has not rejected it; each record keeps
its best proposers up to the source's cap and rejects the rest; a round without a rejection ends it. A round is an
aggregate and a window, written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import written

#: Claims that one record may hold from each source. Fixed values.
CAPS = {"S2": 6, "S3": 7}


def _claims(triples: DataFrame, all_s1: DataFrame | None, floor: float) -> DataFrame:
    """(s1_id, cand_id, score, src) at or above the floor, each pair once, of records we were asked about."""
    rows = triples.where(F.col("score") >= floor).groupBy("s1_id", "cand_id").agg(F.max("score").alias("score"))
    rows = rows.join(all_s1.select("s1_id").distinct(), "s1_id", "left_semi") if all_s1 is not None else rows
    return rows.withColumn("src", F.substring("cand_id", 1, 2))


def _cap(caps: dict[str, int]):
    out = F.lit(None).cast("int")
    for src, n in caps.items():
        out = F.when(F.col("src") == src, F.lit(n)).otherwise(out)
    return out


def _by(*cols: str):
    return Window.partitionBy(*cols).orderBy(F.desc("score"), "s1_id", "cand_id")


def independent(triples: DataFrame, threshold: float, all_s1: DataFrame | None = None, caps: dict[str, int] | None = None) -> DataFrame:
    """Each record's best claims up to the caps; a candidate may go to several."""
    cap = _cap(caps or CAPS)
    rows = _claims(triples, all_s1, threshold).withColumn("k", F.row_number().over(_by("s1_id", "src")))
    return rows.where(cap.isNull() | (F.col("k") <= cap)).drop("k")


def _stable(claims: DataFrame, keep) -> DataFrame:
    """``keep``: from rows with ``k`` (the place among a group's proposers) to a condition; group columns in ``keep.by``. Every
    round but the last refuses a claim for good, so it ends."""
    open_ = claims.withColumn("dead", F.lit(False))
    while True:
        # the best claim of each candidate, combined before the shuffle, as one candidate may be wanted by very many
        best = open_.where(~F.col("dead")).groupBy("cand_id").agg(F.min(F.struct((-F.col("score")).alias("o"), "s1_id", "src")).alias("x"))
        proposed = best.select("x.s1_id", "cand_id", (-F.col("x.o")).alias("score"), "x.src")
        judged = proposed.withColumn("k", F.row_number().over(_by(*keep["by"]))).withColumn("ok", F.coalesce(keep["if"], F.lit(True)))
        judged = written(judged.select("s1_id", "cand_id", "score", "src", "ok"), "proposals")
        refused = judged.where(~F.col("ok")).select("s1_id", "cand_id")
        if refused.isEmpty():
            return judged.where("ok").select("s1_id", "cand_id", "score", "src")
        open_ = written(open_.join(refused.withColumn("no", F.lit(True)), ["s1_id", "cand_id"], "left").withColumn("dead", F.col("dead") | F.coalesce("no", F.lit(False))).drop("no").where(~F.col("dead")), "claims")


def one_to_one(triples: DataFrame, threshold: float, all_s1: DataFrame | None = None, caps: dict[str, int] | None = None) -> DataFrame:
    """(s1_id, cand_id, score, src): greedy by score, a candidate used once. Each round rejects at least one claim."""
    cap = _cap(caps or CAPS)
    return _stable(_claims(triples, all_s1, threshold), {"by": ("s1_id", "src"), "if": cap.isNull() | (F.col("k") <= cap)})


def rescue(triples: DataFrame, taken: DataFrame, all_s1: DataFrame, threshold: float, floor: float, exclusive: bool = True) -> DataFrame:
    """Records without a claim get their best candidate in [floor, threshold) that nobody has, one each, greedily."""
    rest = _claims(triples, all_s1, floor).where(F.col("score") < threshold).join(taken.select("s1_id").distinct(), "s1_id", "left_anti")
    if exclusive:
        rest = rest.join(taken.select("cand_id").distinct(), "cand_id", "left_anti").select("s1_id", "cand_id", "score", "src")
        return _stable(rest, {"by": ("s1_id",), "if": F.col("k") <= 1})
    return rest.withColumn("k", F.row_number().over(_by("s1_id"))).where("k = 1").drop("k")


def assign(triples: DataFrame, threshold: float, all_s1: DataFrame, caps: dict[str, int] | None = None, exclusive: bool = True, rescue_at: float | None = None) -> DataFrame:
    """(s1_id, ids): every record with its matches, best first, or none."""
    got = one_to_one(triples, threshold, all_s1, caps) if exclusive else independent(triples, threshold, all_s1, caps)
    if rescue_at is not None and rescue_at < threshold:
        got = written(got, "assigned")
        got = got.unionByName(rescue(triples, got, all_s1, threshold, rescue_at, exclusive))
    lists = got.groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("o"), "cand_id"))), lambda x: x["cand_id"]).alias("ids"))
    return all_s1.select("s1_id").distinct().join(lists, "s1_id", "left").select("s1_id", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))
