"""Threshold sweeps and a comparison of candidate-ranking formulas."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity, tokens
from ..sources.storage import SLICES, slice_of, written, written_slices
from . import assign, features, metrics

RESCUES = (0.2, 0.3, 0.4, 0.5, 0.6)
GRID = tuple(k / 100 for k in range(5, 100, 5))


def curve(triples: DataFrame, truth: DataFrame, grid=GRID, caps: dict[str, int] | None = None, exclusive: bool = True) -> DataFrame:
    """(threshold, macro_f05, mean_precision, mean_recall). Claims are taken in order of score, so what is taken above a
    threshold doesn't depend on claims below it: one assignment at the lowest threshold holds those of all, and each
    threshold cuts it."""
    taken = (assign.one_to_one if exclusive else assign.independent)(triples, min(grid), truth.select("s1_id"), caps)
    edges = taken.join(truth.select("s1_id", F.explode("ids").alias("cand_id")).distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    cut = [F.struct(F.lit(float(t)).alias("threshold"), F.count_if(F.col("score") >= t).alias("p"), F.count_if((F.col("score") >= t) & (F.col("hit") == 1)).alias("tp")) for t in grid]
    per = truth.select("s1_id", F.size(F.array_distinct("ids")).alias("t")).join(edges.groupBy("s1_id").agg(F.array(*cut).alias("cuts")), "s1_id", "left")
    none = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.lit(0).cast("long").alias("p"), F.lit(0).cast("long").alias("tp")) for t in grid])
    rows = per.select("t", F.explode(F.coalesce("cuts", none)).alias("x")).select("t", "x.*")
    tp, p, t = F.col("tp"), F.col("p"), F.col("t")
    return rows.groupBy("threshold").agg(F.avg(metrics.fbeta_half(tp, p, t)).alias("macro_f05"), F.avg(F.when(p > 0, tp / p).when(t == 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("mean_precision"), F.avg(F.when(t > 0, tp / t).otherwise(F.lit(1.0))).alias("mean_recall"))


def sweep(triples: DataFrame, truth: DataFrame, grid=GRID, caps: dict[str, int] | None = None, exclusive: bool = True) -> list[tuple[float, float, float, float]]:
    """The curve by threshold: (threshold, F0.5, precision, recall), a row a threshold."""
    return [tuple(r) for r in curve(triples, truth, grid, caps, exclusive).sort("threshold").collect()]


def best_of(curve) -> tuple[float, float]:
    """(threshold, F0.5); the lowest threshold of equals, and 0.5 for no curve."""
    best = (-1.0, 0.5)
    for t, f, *_ in curve:
        if f > best[0]:
            best = (f, t)
    return best[1], best[0]


def tune(triples: DataFrame, truth: DataFrame, caps: dict[str, int] | None = None) -> dict:
    """Coarse, then fine around the best, then rescue levels, of which one is kept only if it is better."""
    coarse, _ = best_of(sweep(triples, truth, GRID, caps))
    fine, f = best_of(sweep(triples, truth, [round(coarse + d / 100, 2) for d in range(-4, 5)], caps))
    known = written(triples.where(F.col("score") >= min(RESCUES)), "above-floor")
    rescue = None
    for level in RESCUES:
        got = metrics.score_matching(assign.assign(known, fine, truth, caps, True, level), truth).first()["macro_f05"]
        if got > f:
            f, rescue = got, level
    return {"threshold": fine, "rescue": rescue, "macro_f05": f}


def evaluate(triples: DataFrame, truth: DataFrame, threshold: float, caps: dict[str, int] | None = None) -> dict:
    """Matching metrics at a threshold, and what exclusiveness is worth: F0.5 one-to-one less F0.5 with shared candidates."""
    got = metrics.score_matching(assign.assign(triples, threshold, truth, caps), truth).first().asDict()
    shared = metrics.score_matching(assign.assign(triples, threshold, truth, caps, exclusive=False), truth).first()["macro_f05"]
    return got | {"one_to_one_delta": got["macro_f05"] - shared}


# --- ranking formulas -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Formula:
    """A ranking score: overlap of the fields' idf masses, weighted, plus the key score times ``keys``."""

    overlap: str  # cosine, dice or cover
    penalty: float  # exponent of the candidate's mass that divides the overlap
    weights: dict[str, float]  # of name (n), word (w) and number (d) tokens
    keys: float

    def field(self, f: str) -> Column:
        """Overlap of one field; 0 where either side or the shared part has no mass."""
        shared, own, cand = F.col(f"i_{f}"), F.col(f"b_{f}"), F.col(f"c_{f}")
        by = {"cover": own, "cosine": F.sqrt(own * cand), "dice": (own + cand) / 2.0}[self.overlap]
        return F.when((shared > 0) & (own > 0) & (cand > 0), shared / (by * F.pow(cand, F.lit(self.penalty)))).otherwise(F.lit(0.0))

    def score(self) -> Column:
        return reduce(lambda x, y: x + y, [F.lit(w) * self.field(f) for f, w in self.weights.items()]) + F.lit(self.keys) * F.col("block_score")


_EVEN = {"n": 3.0, "w": 2.0, "d": 2.5}
#: The weighted formulas, by number. Fixed values.
FORMULAS = {
    "f01": Formula("cosine", 0.0, _EVEN, 1e-6),
    "f02": Formula("dice", 0.0, _EVEN, 1e-6),
    "f03": Formula("cover", 0.0, _EVEN, 1e-6),
    "f04": Formula("cover", 0.15, _EVEN, 1e-6),
    "f05": Formula("cover", 0.25, _EVEN, 1e-6),
    "f06": Formula("cover", 0.35, _EVEN, 1e-6),
    "f07": Formula("cover", 0.15, _EVEN, 0.02),
    "f08": Formula("cover", 0.15, _EVEN, 0.08),
    "f09": Formula("cover", 0.15, {"n": 2.0, "w": 3.0, "d": 3.0}, 0.02),
    "f10": Formula("cover", 0.15, {"n": 4.0, "w": 1.5, "d": 2.0}, 0.02),
}
BLENDS = (0.5, 1.0, 2.0, 4.0, 8.0)


def variants(char_similarity: bool = False) -> dict[str, Column]:
    """Score expressions over i_f, b_f, c_f (shared, source-1 and candidate mass of fields n, w, d), block_score and,
    for the blends, ``csim``. ``keys`` is the key score alone."""
    out = {"keys": F.col("block_score")} | {name: f.score() for name, f in FORMULAS.items()}
    if char_similarity:
        out |= {f"keys_csim_{w}": F.col("block_score") + w * F.col("csim") for w in BLENDS} | {"csim": F.col("csim")}
    return out


def judged(shortlist: DataFrame, edges: DataFrame) -> DataFrame:
    """The shortlists of the records that have a true pair among theirs, whole. A record without one adds nothing to what
    ``compare`` counts, whatever its order, so none of its pairs needs masses or names."""
    return shortlist.join(edges.select("s1_id").distinct(), "s1_id", "left_semi").select(*shortlist.columns)


def compare(rows: DataFrame, edges: DataFrame, k: int = 20, char_similarity: bool = False, truth: DataFrame | None = None, pairs: int | None = None, slices: int = 1) -> DataFrame:
    """(variant, found, pairs, recall) of the best k of each record by each formula; ``rows`` is the shortlist with its
    masses. All formulas are scored in one scan. With ``truth`` (s1_id, ids) also ``ceiling_f05``, the mean F0.5 that a
    perfect choice among those k would reach. ``pairs``: the number of true pairs, where ``edges`` has only those of the shortlist. ``slices`` over 1: the records
    are counted in so many turns, so ``rows`` are shuffled a slice at a time."""
    made = variants(char_similarity)
    if slices > 1:
        pairs = edges.count() if pairs is None else pairs
        own = lambda d, i: d.where(slice_of("s1_id", slices) == i)
        part = lambda i: _hits_of(own(rows, i), own(edges, i), made, k, None if truth is None else own(truth, i))
        counts = written_slices(part, slices, "hits")
        hit = counts.groupBy("variant").agg(*[F.sum(c).alias(c) for c in counts.columns[1:]])
    else:
        hit = _hits_of(rows, edges, made, k, truth)
        pairs = edges.count() if pairs is None else pairs
    names = rows.sparkSession.sql("SELECT * FROM VALUES " + ", ".join(f"('{n}')" for n in made) + " AS v(variant)")
    found = F.coalesce("found", F.lit(0).cast("long"))
    more = []
    if truth is not None:
        n, alone = truth.select(F.size(F.array_distinct("ids")).alias("t")).agg(F.count("*"), F.count_if(F.col("t") == 0)).first()
        more = [((F.coalesce("c", F.lit(0.0)) + F.lit(alone)) / F.lit(max(n, 1))).alias("ceiling_f05")]
    return names.join(F.broadcast(hit), "variant", "left").select("variant", found.alias("found"), F.lit(pairs).alias("pairs"), (found / F.lit(max(pairs, 1))).alias("recall"), *more)  # a row a formula


def _hits_of(rows: DataFrame, edges: DataFrame, made: dict[str, Column], k: int, truth: DataFrame | None) -> DataFrame:
    """(variant, found), and with ``truth`` the sum ``c`` of its records' F0.5."""
    # dealt out by record before a pair becomes a row a formula, so those rows need no shuffle
    rows = rows.join(edges.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left").repartition("s1_id")
    scored = rows.select("s1_id", "cand_id", "hit", F.explode(F.array(*[F.struct(F.lit(n).alias("variant"), F.round(v, 9).alias("score")) for n, v in made.items()])).alias("x")).select("s1_id", "cand_id", "hit", "x.*")
    best = scored.withColumn("r", F.row_number().over(Window.partitionBy("variant", "s1_id").orderBy(F.desc("score"), "cand_id"))).where(F.col("r") <= k)
    per = best.where("hit = 1").groupBy("variant", "s1_id").agg(F.count("*").alias("tp"))
    if truth is None:
        return per.groupBy("variant").agg(F.sum("tp").alias("found"))
    sizes = truth.select("s1_id", F.size(F.array_distinct("ids")).alias("t"))
    return per.join(sizes, "s1_id").groupBy("variant").agg(F.sum("tp").alias("found"), F.sum(metrics.fbeta_half(F.col("tp"), F.col("tp"), F.col("t"))).alias("c"))


def with_char_similarity(rows: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Adds ``csim``, the token-sort ratio of the two names; written a slice of the records at a time, as both names travel to
    each pair."""
    names = lambda d, k, c: d.select(F.col("entity_id").alias(k), F.array_join(F.array_sort("name_toks"), " ").alias(c))

    def part(k: int) -> DataFrame:
        own = lambda d: d.where(slice_of("s1_id", 4 * SLICES) == k)
        met = own(rows).join(own(names(s1, "s1_id", "_a")), "s1_id").join(names(pool, "cand_id", "_b"), "cand_id")
        return met.withColumn("csim", similarity.measures(("token_sort",))("_a", "_b")["token_sort"]).drop("_a", "_b")

    return written_slices(part, 4 * SLICES, "blends")


def masses(cands: DataFrame, s1: DataFrame, pool: DataFrame, weights: DataFrame) -> DataFrame:
    """Shared and own idf mass of name, word and number tokens for each candidate pair."""
    rows = features.overlaps(cands, s1, pool, weights)
    return rows.select("country", "s1_id", "cand_id", "block_score", *[c for f in "nwd" for c in (F.col(f"i_{f}"), F.col(f"a_{f}").alias(f"b_{f}"), F.col(f"b_{f}").alias(f"c_{f}"))])
