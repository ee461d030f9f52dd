"""Rule mining from labelled matches: how the two sides of a true pair differ, counted and thresholded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize, tokens
from ..sources.storage import written
from .rules import RuleSet

#: How often a difference must be seen. Fixed values.
MIN_SUBST, MIN_DROP, MIN_TRANSLIT, DROP_SHARE = 40, 200, 15, 0.02


def pairs(edges: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """(n1, a1, n2, a2, foreign): token lists of both sides of each true pair (s1_id, cand_id); ids without a record drop
    out."""
    toks = lambda c: normalize.tokenize(normalize.norm_text(F.col(c)))
    left = s1.select(F.col("entity_id").alias("s1_id"), toks("name").alias("n1"), toks("address").alias("a1"))
    right = pool.select(F.col("entity_id").alias("cand_id"), toks("name").alias("n2"), toks("address").alias("a2"), normalize.is_non_latin(F.col("name")).alias("foreign"))
    return edges.join(left, "s1_id").join(right, "cand_id")


def differences(found: DataFrame) -> DataFrame:
    """(field, x, y): distinct tokens of one side alone, of pairs in Latin script whose field has tokens on both sides."""
    rows = found.where(~F.col("foreign")).select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{c}1").alias("p"), F.col(f"{c}2").alias("q")) for f, c in (("name", "n"), ("addr", "a"))])).alias("d")).select("d.*")
    return rows.where((F.size("p") > 0) & (F.size("q") > 0)).select("field", tokens.only_in(F.col("p"), F.col("q")).alias("x"), tokens.only_in(F.col("q"), F.col("p")).alias("y"))


def substitutions(diffs: DataFrame) -> DataFrame:
    """(a, b, n), a < b: one token stands for another."""
    one = diffs.where((F.size("x") == 1) & (F.size("y") == 1)).select(F.get("x", F.lit(0)).alias("x"), F.get("y", F.lit(0)).alias("y"))
    return one.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count("*").alias("n"))


def related_pairs(subst: DataFrame) -> DataFrame:
    """(a, b, n, related) of every substitution, whatever its tokens' length, script or first letters."""
    return subst.select("a", "b", "n", tokens.related(F.col("a"), F.col("b")).alias("related"))


def expansion_edges(subst: DataFrame, least: int = MIN_SUBST) -> DataFrame:
    """(token, alternates) both ways; numbers never, and only related spellings. Alternates of alternates don't join."""
    ok = subst.where((F.col("n") >= least) & ~normalize.is_number(F.col("a")) & ~normalize.is_number(F.col("b")) & tokens.related(F.col("a"), F.col("b")))
    both = ok.select(F.col("a").alias("token"), F.col("b").alias("alt")).unionByName(ok.select(F.col("b").alias("token"), F.col("a").alias("alt")))
    return both.groupBy("token").agg(F.array_sort(F.collect_set("alt")).alias("alternates"))


def phrase_counts(diffs: DataFrame) -> DataFrame:
    """(single, w1, w2, n): one token against two."""
    side = lambda s, m: diffs.where((F.size(s) == 1) & (F.size(m) == 2)).select(F.get(s, F.lit(0)).alias("single"), F.get(m, F.lit(0)).alias("w1"), F.get(m, F.lit(1)).alias("w2"))
    return side("x", "y").unionByName(side("y", "x")).groupBy("single", "w1", "w2").agg(F.count("*").alias("n"))


def phrases(counts: DataFrame, least: int = MIN_SUBST) -> DataFrame:
    """(phrase, single): initialisms without numbers or other scripts; of several for a phrase the most frequent."""
    plain = lambda c: ~normalize.is_number(F.col(c)) & ~normalize.is_non_latin(F.col(c))
    ok = counts.where((F.col("n") >= least) & plain("single") & plain("w1") & plain("w2") & tokens.is_acronym(F.col("single"), F.array("w1", "w2")))
    best = Window.partitionBy("w1", "w2").orderBy(F.desc("n"), "single")
    return ok.withColumn("r", F.row_number().over(best)).where("r = 1").select(F.concat_ws(" ", "w1", "w2").alias("phrase"), "single")


def drop_counts(diffs: DataFrame) -> DataFrame:
    """(token, n): name tokens that one side has on top of all of the other's."""
    more = F.when(F.size("x") == 0, F.col("y")).when(F.size("y") == 0, F.col("x"))
    return diffs.where((F.col("field") == "name") & ((F.size("x") == 0) != (F.size("y") == 0))).select(F.explode(more).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def seen_tokens(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """(token, seen): source-1 records of the truth whose name has the token."""
    rows = truth.where(F.size("ids") > 0).select("s1_id").join(s1.select(F.col("entity_id").alias("s1_id"), "name"), "s1_id")
    return rows.select(F.explode(F.array_distinct(normalize.tokenize(normalize.norm_text(F.col("name"))))).alias("token")).groupBy("token").agg(F.count("*").alias("seen"))


def droppable(drops: DataFrame, seen: DataFrame, least: int = MIN_DROP, share: float = DROP_SHARE) -> DataFrame:
    rows = drops.join(seen, "token", "left")
    return rows.where((F.col("n") >= least) & ~normalize.is_number(F.col("token")) & (F.col("n") / F.greatest(F.coalesce("seen", F.lit(0)), F.lit(1)) > share)).select("token")


def transliterations(found: DataFrame, least: int = MIN_TRANSLIT) -> DataFrame:
    """(token, latin): aligned tokens of names of equal length in two scripts; the most frequent, ties by spelling."""
    rows = found.where(F.col("foreign") & (F.size("n1") == F.size("n2")) & (F.size("n2") > 0)).select(F.explode(F.arrays_zip("n2", "n1")).alias("z")).select(F.col("z.n2").alias("token"), F.col("z.n1").alias("latin"))
    rows = rows.where(normalize.is_non_latin(F.col("token")) & ~normalize.is_non_latin(F.col("latin"))).groupBy("token", "latin").agg(F.count("*").alias("n"))
    best = Window.partitionBy("token").orderBy(F.desc("n"), "latin")
    return rows.withColumn("r", F.row_number().over(best)).where((F.col("r") == 1) & (F.col("n") >= least)).select("token", "latin")


def mine(truth: DataFrame, s1: DataFrame, pool: DataFrame, least: dict[str, int] | None = None, sample: int | None = 300_000, seed: str = "17") -> RuleSet:
    """A rule set from truth (s1_id, ids). ``sample``: this many records by the hash of their ids, all if null. The tables
    it returns hold only what passed the thresholds, so they are small."""
    m = {"subst": MIN_SUBST, "drop": MIN_DROP, "translit": MIN_TRANSLIT} | (least or {})
    rows = truth.where(F.size("ids") > 0)
    rows = by_hash(rows, "s1_id", sample, seed) if sample else rows
    rows = written(rows, "mined-truth")
    found = written(pairs(rows.select("s1_id", F.explode("ids").alias("cand_id")), s1, pool), "true-pairs")
    diffs = written(differences(found), "differences")
    return RuleSet(
        frozenset(r[0] for r in droppable(drop_counts(diffs), seen_tokens(s1, rows), m["drop"]).collect()),
        {r[0]: list(r[1]) for r in expansion_edges(substitutions(diffs), m["subst"]).collect()},
        {r[0]: r[1] for r in phrases(phrase_counts(diffs), m["subst"]).collect()},
        {r[0]: r[1] for r in transliterations(found, m["translit"]).collect()})


def by_hash(rows: DataFrame, key: str, n: int, seed: str = "17") -> DataFrame:
    """A reproducible sample: the n rows whose seeded key hash is least (ties by key). Rows are counted by the hash's first
    four digits; whole classes are taken while they fit, and only the class at the border is sorted."""
    hashed = rows.withColumn("_h", _seeded(key, seed)).withColumn("_c", F.substring("_h", 1, 4))
    counts = sorted(map(tuple, hashed.groupBy("_c").count().collect()))  # 65,536 rows at most
    taken, border = 0, None
    for c, m in counts:
        if taken + m > n:
            border = c
            break
        taken += m
    if border is None:
        return rows
    edge = hashed.where(F.col("_c") == border).orderBy("_h", key).limit(n - taken)
    return hashed.where(F.col("_c") < border).unionByName(edge).drop("_h", "_c")


def _seeded(key: str, seed: str) -> Column:
    return F.md5(F.encode(F.concat(F.col(key), F.lit(seed)), "UTF-8"))
