import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators import assign, blocking, features, metrics, mining, model, tuning
from linkloom.operators.rules import RuleSet
from linkloom.sources import records as files
from linkloom.streaming import candidates as stream

RULES = RuleSet(frozenset({"llc", "inc", "ltd"}), {"street": ["st"], "st": ["street"]}, {"new york": "ny"})
ONE = [("S1-1", "Harper Bingaman LLC", "12 Oak Street, Seattle", "US"), ("S1-2", "Blue Ridge Dental", "", "US"), ("S1-3", "Blue Ridge Dental", "9 Elm", "FR")]
POOL = [
    ("S2-1", "HARPER BINGAMAN", "12 OAK ST SEATTLE", "US"), ("S3-1", "Bingaman Harper Inc", "Oak Street 12", "US"), ("S2-2", "Blue Ridge Dentai", "77 Pine", "US"),
    ("S2-3", "Quite Another", "Seattle", "US"), ("S3-9", "Harper Bingaman", "12 Oak Street", "FR"),
]
SCHEMA = "entity_id string, name string, address string, country string"


@pytest.fixture(scope="module")
def sides(spark):
    return tuple(blocking.prepare(spark.createDataFrame(x, SCHEMA), RULES).cache() for x in (ONE, POOL))


def test_retrieval_stays_in_its_country(spark, sides):
    got = blocking.candidates(*sides, RULES).collect()
    by = {}
    for r in got:
        by.setdefault(r["s1_id"], {})[r["cand_id"]] = r["rank"]
    assert {"S2-1", "S3-1"} <= set(by["S1-1"]) and "S3-9" not in by["S1-1"]
    assert "S2-2" in by["S1-2"]  # a typo and no address: the name's other tokens and its MinHash
    for ranks in by.values():
        assert sorted(ranks.values()) == list(range(len(ranks)))


def test_no_pairwise_plan(sides):
    plan = blocking.candidates(*sides, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_posting_cap(spark):
    rows = spark.createDataFrame([("c", f"S2-{i}", 1, "k", "", 0.0) for i in range(4)] + [("c", "S2-9", 1, "j", "", 0.0)], "country string, entity_id string, fam int, a string, b string, w double")
    assert [r["a"] for r in blocking.postings(rows, 3).collect()] == ["j"]
    assert blocking.postings(rows, 4).count() == 5


def test_rules_modes(spark):
    df = spark.createDataFrame([("S1-1", "Acme LLC", "", "US")], SCHEMA)
    assert blocking.prepare(df, RULES).first()["name_toks"] == ["acme", "iic"]
    assert blocking.prepare(df, RuleSet(RULES.droppable, mode="aligned")).first()["name_toks"] == ["acme"]


def test_features_are_finite(spark, sides):
    w = blocking.idf(sides[1], sides[0])
    got = features.pair_features(blocking.candidates(*sides, RULES), *sides, w)
    assert tuple(got.columns[3:]) == features.FEATURE_NAMES and len(features.FEATURE_NAMES) == 36
    for r in got.collect():
        assert all(isinstance(v, float) and v == v and abs(v) < 1e9 for v in r[3:])
    best = got.where("s1_id = 'S1-1' and cand_id = 'S2-1'").first()
    assert best["num_any"] == 1 and best["is_s2"] == 1 and best["name_token_sort"] > 0.8


def test_listwise_of_equal_scores(spark):
    rows = spark.createDataFrame([("c", "S1-1", f"S2-{i}", 5.0, i) for i in range(3)], "country string, s1_id string, cand_id string, block_score double, rank int")
    assert {(r["score_z"], r["score_ratio_to_top"], r["group_size"]) for r in features.listwise(rows).collect()} == {(0.0, 1.0, 3.0)}


def greedy(triples, threshold, all_s1, caps, exclusive=True, rescue=None):
    out, taken, used = {s: [] for s in all_s1}, set(), {}
    order = sorted(triples, key=lambda t: (-t[2], t[0], t[1]))
    for s, c, p in order:
        if p < threshold or s not in out or (exclusive and c in taken) or used.get((s, c[:2]), 0) >= caps.get(c[:2], 1 << 30):
            continue
        out[s].append(c)
        taken.add(c)
        used[s, c[:2]] = used.get((s, c[:2]), 0) + 1
    if rescue is not None:
        for s, c, p in order:
            if rescue <= p < threshold and s in out and not out[s] and not (exclusive and c in taken):
                out[s].append(c)
                taken.add(c)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_assignment_equals_greed(spark, seed):
    r = random.Random(seed)
    pairs = {(f"S1-{r.randrange(8)}", f"S{r.choice('23')}-{r.randrange(10)}"): round(r.random() * 8) / 8 for _ in range(60)}
    triples = [(s, c, p) for (s, c), p in pairs.items()]
    ids = [f"S1-{i}" for i in range(7)]  # one record that nobody asked about
    df, all_s1 = spark.createDataFrame(triples, "s1_id string, cand_id string, score double"), spark.createDataFrame([(i,) for i in ids], "s1_id string")
    caps = {"S2": 2, "S3": 1}
    for exclusive, rescue in ((True, None), (True, 0.25), (False, None)):
        got = {x["s1_id"]: sorted(x["ids"]) for x in assign.assign(df, 0.5, all_s1, caps, exclusive, rescue).collect()}
        assert got == {s: sorted(v) for s, v in greedy(triples, 0.5, ids, caps, exclusive, rescue).items()}


def lists(spark, d):
    return spark.createDataFrame(list(d.items()), "s1_id string, ids array<string>")


def test_metrics(spark):
    truth, pred = lists(spark, {"a": ["1", "2"], "b": [], "c": ["3"]}), lists(spark, {"a": ["1", "9"], "b": [], "z": ["1"]})
    r = metrics.score_matching(pred, truth).first()
    assert r["n_entities"] == 3 and r["singleton_correct"] == 1 and r["exact_sets"] == 1 and r["macro_f05"] == pytest.approx((0.5 + 1 + 0) / 3)
    worked = metrics.compared(lists(spark, {"a": ["1", "2", "9"]}), lists(spark, {"a": ["1", "2"]})).select(metrics.fbeta_half(F.col("tp"), F.col("n_pred"), F.col("n_true")).alias("f")).first()["f"]
    assert worked == pytest.approx(0.7142857, abs=1e-6)
    b = metrics.score_blocking(lists(spark, {"a": ["1", "9"]}), truth, 10).first()
    assert b["pair_completeness"] == pytest.approx(1 / 3) and b["max_candidates"] == 2 and b["search_space"] == 30
    assert metrics.score_matching(pred, truth.limit(0)).first()["macro_f05"] == 0


def test_sweep_keeps_lowest_of_equals(spark):
    t = spark.createDataFrame([("a", "S2-1", 0.9), ("b", "S2-2", 0.3)], "s1_id string, cand_id string, score double")
    truth = lists(spark, {"a": ["S2-1"], "b": []})
    curve = tuning.sweep(t, truth, (0.2, 0.5, 0.8))
    assert tuning.best_of(curve) == (0.5, 1.0) and tuning.best_of([]) == (0.5, -1.0)
    assert [tuple(map(float, x)) for x in tuning.sweep(t, truth, (0.2, 0.5, 0.8), exclusive=False)] == [tuple(map(float, x)) for x in curve]


def test_files(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text('id\tn\ta\tc\nS1-1\tAcme, "x"\t1 Oak\tUS\textra\nS1-2\tonly\n\nS1-3\t"a\nb"\tq\tFR\n')
    got = files.read_records(spark, str(p), multi_line=True).collect()
    assert [tuple(r) for r in got] == [("S1-1", 'Acme, "x"', "1 Oak", "US"), ("S1-2", "only", "", ""), ("S1-3", "a\nb", "q", "FR")]
    assert files.read_records(spark, str(p), ["FR"], True).count() == 1
    t = tmp_path / "t.tsv"
    t.write_text("id\tids\nS1-1\tS2-1,,S3-1\nS1-2\t\nS1-3\nS1-1\tS2-9\n")
    assert [tuple(r) for r in files.read_ground_truth(spark, str(t)).collect()] == [("S1-1", ["S2-1", "S3-1"]), ("S1-2", []), ("S1-3", []), ("S1-1", ["S2-9"])]
    assert dict(map(tuple, files.load_ground_truth(spark, str(t)).collect()))["S1-1"] == ["S2-9"]
    n = files.write_id_lists(lists(spark, {"S1-1": ["b", "a", "b"], "S1-2": []}), str(tmp_path / "out"), ("x", "y"))
    assert n == 2 and {tuple(r) for r in spark.read.csv(str(tmp_path / "out"), sep="\t", header=True).na.fill("").collect()} == {("S1-1", "b,a"), ("S1-2", "")}


def test_mining(spark):
    one = spark.createDataFrame([(f"S1-{i}", f"Acme{i} Corp", "1 Oak Street", "US") for i in range(5)] + [(f"S1-9{i}", "delhi traders", "x", "IN") for i in range(5)], SCHEMA)
    pool = spark.createDataFrame([(f"S2-{i}", f"Acme{i} Corp Llc", "1 Oak St", "US") for i in range(5)] + [(f"S2-9{i}", "दिल्ली traders", "y", "IN") for i in range(5)], SCHEMA)
    truth = lists(spark, {f"S1-{i}": [f"S2-{i}", "S2-missing"] for i in [*range(5), *range(90, 95)]})
    got = mining.mine(truth, one, pool, {"subst": 3, "drop": 3, "translit": 3})
    assert got.expansions == {"st": ["street"], "street": ["st"]} and got.translit == {"दिल्ली": "delhi"} and "llc" in got.droppable


def test_model(spark, tmp_path):
    r = random.Random(1)
    rows = spark.createDataFrame([(f"S1-{i}", f"S2-{i}", "ABC"[i % 2], float(i % 3 == 0) + r.random() / 2, r.random(), int(i % 3 == 0), i % 4 == 0) for i in range(300)], "s1_id string, cand_id string, country string, name_ratio double, rank double, label int, val boolean")
    m = model.train(rows, rounds=5, validation="val")
    model.save(m, str(tmp_path / "m"))
    got = model.predict(model.load(str(tmp_path / "m")), rows)
    assert got.where("label = 1").agg(F.avg("score")).first()[0] > 0.3 + got.where("label = 0").agg(F.avg("score")).first()[0]
    assert model.importances(m)[0][0] == "name_ratio"
    assert model.leave_one_out(rows, rounds=3).where("score is null").count() == 0
    assert model.predict(model.train(rows, "logistic", 20), rows).count() == 300


def test_stream_equals_batch(spark, sides, tmp_path):
    spark.createDataFrame(ONE, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    index = stream.PoolIndex.build(sides[1])
    q = stream.stream_candidates(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), index, str(tmp_path / "out"), str(tmp_path / "cp"), RULES)
    q.awaitTermination(120)
    got = {(r["s1_id"], r["cand_id"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(r["s1_id"], r["cand_id"]) for r in stream.batch_candidates(spark.createDataFrame(ONE, SCHEMA), index, RULES).collect()}
    assert ("S1-1", "S2-1") in got


def test_related_pairs_have_no_limits_of_length_prefix_or_script(spark):
    diffs = [("addr", [x], [y]) for x, y in (("road", "raod"), ("street", "st"), ("international", "internationa"), ("étoile", "etoile"), ("dr", "ltd"), ("road", "raod"))]
    got = mining.related_pairs(mining.substitutions(spark.createDataFrame(diffs, "field string, x array<string>, y array<string>"))).collect()
    assert {(r["a"], r["b"]): (r["n"], r["related"]) for r in got} == {
        ("raod", "road"): (2, True), ("st", "street"): (1, True), ("internationa", "international"): (1, True), ("etoile", "étoile"): (1, True), ("dr", "ltd"): (1, False)}
