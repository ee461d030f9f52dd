"""Time of the linkage plans: nothing is done anew for each pair, seed or frequent token that can be done once."""

import hashlib
import math

from pyspark.sql import functions as F

from linkloom.functions import common, minhash
from linkloom.operators import blocking, features, tuning
from linkloom.sources import storage
from tests.test_disk import records

SCHEMA = "entity_id string, country string, name_toks array<string>, word_toks array<string>, num_toks array<string>"


def sides(spark, n=60):
    df = spark.createDataFrame(records(n, 1), SCHEMA).withColumn("name_key", F.array_join(F.array_sort("name_toks"), " "))
    return df.where("entity_id like 'S1-%'"), df.where("entity_id not like 'S1-%'")


def test_md5_bands_hash_each_trigram_once(spark, monkeypatch):
    text = " ".join(f"w{i % 50}" for i in range(2000))
    plain = lambda s: [f"{b}:" + ":".join(min(hashlib.md5(f"{2 * b + k}:{g}".encode()).hexdigest()[:15] for g in {s[i : i + 3] for i in range(max(len(s) - 2, 1))}) for k in (1, 2)) for b in range(4)]
    rows = [(1, ["ab"]), (2, []), (3, None), (4, ["b\u00e9\U0001f600", "a", "a"]), (5, text.split())]
    got = {r[0]: r[1] for r in spark.createDataFrame(rows, "id long, t array<string>").select("id", minhash.md5_bands(F.col("t"))).collect()}
    assert got == {1: plain("ab"), 2: [], 3: [], 4: plain("a b\u00e9\U0001f600"), 5: plain(" ".join(sorted(set(text.split()))))}
    calls, md5 = [], hashlib.md5
    monkeypatch.setattr(minhash.hashlib, "md5", lambda x: calls.append(x) or md5(x))
    assert len(minhash._least([text, text, "w1 w2"])) == 3 and len(calls) == len(set(calls)) <= 8 * len({text[i : i + 3] for i in range(len(text))})


def test_frequent_tokens_held_or_not_make_no_difference(spark, monkeypatch):
    s1, pool = sides(spark)
    weights = storage.written(blocking.idf(pool, s1), "weights")
    pairs = s1.select("country", F.col("entity_id").alias("s1_id")).join(pool.select("country", F.col("entity_id").alias("cand_id")), "country")
    got, joined = [], []
    for held in (1, 12, 1 << 16):
        monkeypatch.setattr(common, "HELD", held)
        rare = sorted((r.asDict(True) for r in blocking.rarest(pool, weights).drop("name_toks").collect()), key=lambda r: r["entity_id"])
        over = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in features.overlaps(pairs, s1, pool, weights).collect())
        got.append((rare, over))
        joined.append(pool.select(F.sum(F.size(common.thinned(weights, 3)("country", "word_toks")))).first()[0])
    assert got[0] == got[1] == got[2] and got[0][0] and got[0][1]
    assert joined[0] > joined[1] > joined[2]
    # the plain rarest: by document frequency, then spelling
    df = {(r["country"], r["token"]): r["df"] for r in weights.collect()}
    of = {r["entity_id"]: r for r in pool.collect()}
    for r in got[0][0]:
        for c, own in (("names", "name_toks"), ("words", "word_toks")):
            assert [x["token"] for x in r[c]] == sorted(set(of[r["entity_id"]][own]), key=lambda t: (df[r["country"], t], t))[:3]


def test_token_lists_are_not_shuffled_for_each_pair(spark, monkeypatch):
    s1, pool = sides(spark)
    pairs = s1.select("country", F.col("entity_id").alias("s1_id")).join(pool.select("country", F.col("entity_id").alias("cand_id")), "country")
    slices, real = {}, features.written_slices

    def seen(make, n, name):
        slices[name] = (n, make(0)._jdf.queryExecution().optimizedPlan().toString())
        return real(make, n, name)

    monkeypatch.setattr(features, "written_slices", seen)
    assert features.overlaps(pairs, s1, pool, blocking.idf(pool, s1)).count() == pairs.count() > 5 * 60
    n, plan = slices["overlaps"]
    assert n == math.ceil(pairs.count() / (20 * 60)) == 1 and "rightHint=(strategy=broadcast)" in plan


def test_only_shortlists_with_a_true_pair_are_judged(spark):
    rows = spark.createDataFrame([("x", a, b, float(i), *[float(i + len(b))] * 9) for i, (a, b) in enumerate([("S1-1", "S2-1"), ("S1-1", "S2-22"), ("S1-2", "S2-1"), ("S1-3", "S3-1"), ("S1-3", "S2-1")])], "country string, s1_id string, cand_id string, block_score double, " + ", ".join(f"{p}_{f} double" for f in "nwd" for p in "ibc"))
    edges = spark.createDataFrame([("S1-1", "S2-22"), ("S1-3", "S2-1")], "s1_id string, cand_id string")
    kept = tuning.judged(rows, edges)
    assert kept.columns == rows.columns and sorted({r["s1_id"] for r in kept.collect()}) == ["S1-1", "S1-3"] and kept.count() == 4
    for k in (1, 2):
        assert sorted(map(tuple, tuning.compare(kept, edges, k, pairs=2).collect())) == sorted(map(tuple, tuning.compare(rows, edges, k, pairs=2).collect()))
