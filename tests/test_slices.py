"""Plans that run in slices give what they give in one piece, and no texts are kept that no one reads."""

from pyspark.sql import functions as F

from linkloom.operators import blocking, features, tuning

SCHEMA = "entity_id string, name string, address string, country string"
ROWS = [(f"S{1 + i % 3}-{i}", f"acme {'abcd'[i % 4]}x trading {i % 5}", f"{i % 7} high road {i % 7} Town", "xy"[i % 2]) for i in range(40)]


def test_slices_equal_the_whole(spark):
    p = features.without_texts(blocking.prepare(spark.createDataFrame(ROWS, SCHEMA)))
    s1, pool = p.where("entity_id like 'S1-%'"), p.where("entity_id not like 'S1-%'")
    config = blocking.Config(top_k=4)
    whole = {tuple(r) for r in blocking.candidates(s1, pool, config=config).collect()}
    assert whole and {tuple(r) for r in blocking.candidates_written(s1, pool, config=config).collect()} == whole
    w = blocking.idf(pool, s1)
    rows = tuning.masses(blocking.candidates_written(s1, pool, config=config).drop("rank"), s1, pool, w)
    rows = tuning.with_char_similarity(rows, s1, pool)
    assert rows.count() == len(whole)
    edges, truth = rows.where("s1_id < cand_id").select("s1_id", "cand_id").where(F.crc32("cand_id") % 2 == 0), s1.select(F.col("entity_id").alias("s1_id"), F.array(F.lit("S2-1"), F.lit("S3-2")).alias("ids"))
    for t in (None, truth):
        got = [sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in tuning.compare(rows, edges, 2, True, t, slices=n).collect()) for n in (1, 3)]
        assert got[0] == got[1] and len(got[0]) == 17


def test_features_are_the_same_without_texts(spark):
    full = blocking.prepare(spark.createDataFrame(ROWS, SCHEMA))
    slim = features.without_texts(full)
    assert not {"norm_name", "norm_addr"} & set(slim.columns)
    got = []
    for p in (full, slim):
        s1, pool = p.where("entity_id like 'S1-%'"), p.where("entity_id not like 'S1-%'")
        w = blocking.idf(pool, s1)
        got.append({tuple(r) for r in features.pair_features(blocking.candidates(s1, pool), s1, pool, w, strings=False).select([F.round(c, 9) if k == "double" else F.col(c) for c, k in features.pair_features(blocking.candidates(s1, pool), s1, pool, w, strings=False).dtypes]).collect()})
    assert got[0] == got[1] and got[0]
