"""Disk of the linkage plans: what they shuffle is dropped once written, and pairs carry no token lists."""

import math
import random

from pyspark.sql import functions as F

from linkloom.operators import blocking, features, tuning
from linkloom.sources import storage


def shuffles(spark):
    """Shuffles whose files Spark keeps."""
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_written_drops_its_shuffle_files(spark):
    before = shuffles(spark)
    for _ in range(3):
        storage.written(spark.range(1000).repartition(4), "rows")
    assert shuffles(spark) <= before


def records(n, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    return [(f"S{1 + i % 3}-{i}", r.choice("xy"), *(r.choices(words, k=k) for k in (4, 12)), [str(r.randrange(30)) for _ in range(r.randrange(3))]) for i in range(n)]


def test_overlaps_equal_plain_sets_in_any_number_of_slices(spark, monkeypatch):
    rows = records(60, 1)
    df = spark.createDataFrame(rows, "entity_id string, country string, name_toks array<string>, word_toks array<string>, num_toks array<string>")
    s1, pool = df.where("entity_id like 'S1-%'"), df.where("entity_id not like 'S1-%'")
    weights = storage.written(blocking.idf(pool, s1), "weights")
    pairs = s1.select("country", F.col("entity_id").alias("s1_id")).join(pool.select("country", F.col("entity_id").alias("cand_id")), "country").withColumn("block_score", F.lit(1.0))
    idf = {(r["country"], r["token"]): r["idf"] for r in weights.collect()}
    of = {x[0]: (x[1], dict(zip("nwd", map(set, x[2:]), strict=True))) for x in rows}
    mass = lambda c, t: sum(idf[c, x] for x in t)
    for per in (1, 1000):
        monkeypatch.setattr(features, "PAIRS", per)
        got = features.overlaps(pairs, s1, pool, weights).collect()
        assert len(got) == pairs.count() > 60 * per * (per == 1)
        for r in got:
            (c, a), (_, b) = of[r["s1_id"]], of[r["cand_id"]]
            for f in "nwd":
                assert (r[f"k_{f}"], r[f"ak_{f}"], r[f"bk_{f}"]) == (len(a[f] & b[f]), len(a[f]), len(b[f]))
                assert all(math.isclose(r[k], v, abs_tol=1e-9) for k, v in ((f"i_{f}", mass(c, a[f] & b[f])), (f"a_{f}", mass(c, a[f])), (f"b_{f}", mass(c, b[f]))))


def test_tokens_without_a_weight_count_and_weigh_nothing(spark):
    df = spark.createDataFrame([("S1-1", "x", ["a", "b"], ["c"], []), ("S2-1", "x", ["b", "a"], [], [])], "entity_id string, country string, name_toks array<string>, word_toks array<string>, num_toks array<string>")
    s1, pool = df.where("entity_id like 'S1-%'"), df.where("entity_id like 'S2-%'")
    weights = storage.written(blocking.idf(pool, s1).where("token = 'a'"), "weights")
    r = features.overlaps(spark.createDataFrame([("x", "S1-1", "S2-1")], "country string, s1_id string, cand_id string"), s1, pool, weights).first()
    assert (r["k_n"], r["ak_w"], r["k_w"], r["bk_d"]) == (2, 1, 0, 0) and math.isclose(r["i_n"], math.log(1.5)) and r["a_w"] == 0


def test_formulas_are_not_shuffled_a_row_each(spark):
    rows = spark.createDataFrame([("x", "S1-1", "S2-1", 1.0, *[1.0] * 9)], "country string, s1_id string, cand_id string, block_score double, " + ", ".join(f"{p}_{f} double" for f in "nwd" for p in "ibc"))
    got = tuning.compare(rows, rows.select("s1_id", "cand_id"), pairs=1)
    assert {(r["found"], r["recall"]) for r in got.collect()} == {(1, 1.0)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Generate explode") :]
    above = plan[: plan.index("Generate explode")]
    assert "Exchange hashpartitioning(s1_id" in below and above.count("Window [") == 1 and "Exchange hashpartitioning(s1_id" not in above
