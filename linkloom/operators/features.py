"""Pair features: string similarities, weighted token overlaps, shape, and the candidate's place in its group."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import common, similarity, tokens
from ..sources.storage import FEW, SLICES, few, slice_of, written, written_slices

#: Columns of the feature matrix, in order. Fixed values.
FEATURE_NAMES = (
    "name_ratio", "name_token_sort", "name_token_set", "name_partial", "name_jw", "name_osa",
    "addr_ratio", "addr_token_sort", "addr_token_set", "addr_partial", "addr_osa",
    "name_idf_overlap", "name_cover_s1", "name_cover_cand", "name_jaccard",
    "addr_idf_overlap", "addr_cover_s1", "addr_cover_cand", "addr_jaccard",
    "num_shared", "num_jaccard", "num_any",
    "cand_addr_empty", "s1_name_len", "cand_name_len", "name_len_diff", "s1_ntok", "cand_ntok", "ntok_diff", "is_s2",
    "block_score", "rank", "score_ratio_to_top", "score_gap_to_top", "score_z", "group_size",
)
STRING = FEATURE_NAMES[:11]
#: Pairs for each record, on average, that are looked at in one slice, and token numbers of source 1 that are broadcast for it.
PAIRS, CODES = 20, 1 << 21


def listwise(cands: DataFrame) -> DataFrame:
    """Adds score_ratio_to_top, score_gap_to_top, score_z (population deviation; 1 where it is none) and group_size."""
    group = Window.partitionBy("country", "s1_id")
    top, mean, std = F.max("block_score").over(group), F.avg("block_score").over(group), F.stddev_pop("block_score").over(group)
    rows = cands.withColumn("_t", top).withColumn("_m", mean).withColumn("_s", F.when(std > 1e-9, std).otherwise(F.lit(1.0)))
    return rows.withColumns({
        "score_ratio_to_top": tokens.safe_div(F.col("block_score"), F.col("_t")), "score_gap_to_top": F.col("_t") - F.col("block_score"),
        "score_z": (F.col("block_score") - F.col("_m")) / F.col("_s"), "group_size": F.count("*").over(group).cast("double"), "rank": F.col("rank").cast("double"),
    }).drop("_t", "_m", "_s")


def same_text(prepared: DataFrame) -> Column:
    """What records of equal normal form have in common."""
    return F.col("same") if "same" in prepared.columns else F.md5(F.encode(F.concat_ws("|", "norm_name", "norm_addr"), "UTF-8"))


def without_texts(prepared: DataFrame) -> DataFrame:
    """``prepared`` for plans without string similarities: of the texts ``chars``, ``blank`` and ``same``, and each address token once."""
    rows = prepared.withColumns({"chars": F.length("norm_name").cast("double"), "blank": F.col("norm_addr") == "", "same": same_text(prepared), "word_toks": F.array_distinct("word_toks"), "num_toks": F.array_distinct("num_toks")})
    return rows.drop("norm_name", "norm_addr")


def weighed(prepared: DataFrame, codes: DataFrame, sizes: DataFrame, coded, *more: Column) -> DataFrame:
    """(country, entity_id, more, n, w, d, n_mass, w_mass, d_mass): the codes of a record's distinct name, word and number
    tokens, and the sums of their weights, which all pairs of the record share. ``codes``: country, token, code, written;
    ``sizes``: country, size; ``coded``: ``common.coded`` of the codes."""
    def tagged(field: str) -> Column:
        return F.transform(f"{field}.rest", lambda t: F.struct(F.lit(field).alias("f"), t.alias("token")))

    both = prepared.select("country", "entity_id", *more, *[coded("country", c).alias(f) for f, c in (("n", "name_toks"), ("w", "word_toks"), ("d", "num_toks"))])
    each = both.select("country", "entity_id", F.explode(F.concat(*map(tagged, "nwd"))).alias("x"))
    known = each.select("country", "entity_id", "x.f", "x.token").join(codes, ["country", "token"], "left")
    known = known.select("country", "entity_id", "f", F.coalesce("code", tokens.unknown(F.col("token"))).alias("code"))
    got = known.repartition("country", "entity_id").groupBy("country", "entity_id").agg(*[F.collect_list(F.when(F.col("f") == f, F.col("code"))).alias(f"{f}_rest") for f in "nwd"])
    rows = both.join(got, ["country", "entity_id"], "left").join(sizes, "country", "left")
    none = F.array().cast("array<long>")
    rows = rows.withColumns({f: F.concat(f"{f}.known", F.coalesce(f"{f}_rest", none)) for f in "nwd"}).drop(*[f"{f}_rest" for f in "nwd"])
    return rows.withColumns({f"{f}_mass": tokens.mass(F.col(f), F.coalesce("size", F.lit(0))) for f in "nwd"}).drop("size")


def overlaps(pairs: DataFrame, s1: DataFrame, pool: DataFrame, weights: DataFrame, *more: Column) -> DataFrame:
    """``pairs`` with, for each of the fields n, w and d, the shared tokens' number and mass (``k_n``, ``i_n``) and both sides'
    (``ak_n``, ``a_n`` and ``bk_n``, ``b_n``), and the columns ``more`` of both sides' records. Token lists are numbers and are made
    once a record. A slice of the source-1 records has as many as may be broadcast: its pairs meet the candidates' lists by
    candidate, and source 1's where they then are, so no list is shuffled for each pair and disk is in proportion to the input
    however many candidates a record has. ``weights``: those of ``blocking.idf``."""
    codes = written(weights.coalesce(2048).select("country", "token", tokens.code(F.col("df")).alias("code")), "codes")
    sizes = few(weights.groupBy("country").agg(F.max("n").alias("size")), "sizes")
    names = more and s1.select(*more).columns
    coded = common.coded(codes, tokens.frequency(F.col("code")))

    def side(d: DataFrame, key: str, p: str) -> DataFrame:
        rows = written_slices(lambda i: weighed(d.where(slice_of("entity_id", SLICES) == i), codes, sizes, coded, *more), SLICES, "token-lists")
        own = [F.col(f"{f}_mass").alias(f"{p}_{f}") for f in "nwd"] + [F.size(f).alias(f"{p}k_{f}") for f in "nwd"]
        return rows.select("country", F.col("entity_id").alias(key), *[F.col(f).alias(f"{p}l_{f}") for f in "nwd"], *own, *[F.col(c).alias(f"{p}_{c}") for c in names])

    pairs, a, b = written(pairs, "pairs"), side(s1, "s1_id", "a"), side(pool, "cand_id", "b")
    records, held = a.agg(F.count("*"), F.sum(F.col("ak_n") + F.col("ak_w") + F.col("ak_d"))).first()
    n = max(1, math.ceil((held or 0) / CODES), math.ceil(records / FEW), math.ceil(pairs.count() / (PAIRS * max(records + b.count(), 1))))

    def part(k: int) -> DataFrame:
        own = slice_of("s1_id", n) == k
        rows = pairs.where(own).join(b, ["country", "cand_id"]).join(F.broadcast(a.where(own)), ["country", "s1_id"]).join(sizes, "country", "left")
        rows = rows.withColumns({f"l_{f}": F.array_intersect(f"al_{f}", f"bl_{f}") for f in "nwd"})
        rows = rows.withColumns({f"i_{f}": tokens.mass(F.col(f"l_{f}"), F.coalesce("size", F.lit(0))) for f in "nwd"} | {f"k_{f}": F.size(f"l_{f}") for f in "nwd"})
        return rows.drop("size", *[f"{p}l_{f}" for p in ("", "a", "b") for f in "nwd"])

    return written_slices(part, n, "overlaps")


def pair_features(cands: DataFrame, s1: DataFrame, pool: DataFrame, weights: DataFrame, strings: bool = True) -> DataFrame:
    """(country, s1_id, cand_id) and the features; ``strings`` False leaves the eleven string similarities out, the plan
    free of Python and the texts out of the pairs."""
    shape = (F.col("chars"), F.col("blank")) if "chars" in s1.columns else (F.length("norm_name").cast("double").alias("chars"), (F.col("norm_addr") == "").alias("blank"))
    rows = overlaps(listwise(cands), s1, pool, weights, *shape)
    if strings:
        for d, key, p in ((s1, "s1_id", "a"), (pool, "cand_id", "b")):
            rows = rows.join(d.select("country", F.col("entity_id").alias(key), *[F.col(c).alias(f"{p}_{c}") for c in ("norm_name", "norm_addr")]), ["country", key])
    d = lambda c: c.cast("double")
    out: dict[str, Column] = {}
    if strings:
        rows = rows.withColumn("_n", similarity.string_similarities("a_norm_name", "b_norm_name"))
        rows = rows.withColumn("_a", similarity.measures(similarity.NAMES[:4] + ("osa",))("a_norm_addr", "b_norm_addr"))
        out |= {f"name_{k}": F.col(f"_n.{k}") for k in ("ratio", "token_sort", "token_set", "partial", "jw", "osa")}
        out |= {f"addr_{k}": F.col(f"_a.{k}") for k in ("ratio", "token_sort", "token_set", "partial", "osa")}

    def jaccard(f: str) -> Column:
        both = F.col(f"k_{f}")
        return tokens.safe_div(d(both), d(F.col(f"ak_{f}") + F.col(f"bk_{f}") - both))

    for part, f in (("name", "n"), ("addr", "w")):
        both = F.col(f"i_{f}")
        out |= {f"{part}_idf_overlap": both, f"{part}_cover_s1": tokens.safe_div(both, F.col(f"a_{f}")), f"{part}_cover_cand": tokens.safe_div(both, F.col(f"b_{f}")), f"{part}_jaccard": jaccard(f)}
    shared, na, nb = F.col("k_d"), F.col("ak_n"), F.col("bk_n")
    out |= {
        "num_shared": d(shared), "num_jaccard": jaccard("d"), "num_any": d(F.when(shared > 0, 1).otherwise(0)),
        "cand_addr_empty": d(F.when(F.col("b_blank"), 1).otherwise(0)), "s1_name_len": F.col("a_chars"), "cand_name_len": F.col("b_chars"), "name_len_diff": F.abs(F.col("a_chars") - F.col("b_chars")),
        "s1_ntok": d(na), "cand_ntok": d(nb), "ntok_diff": d(F.abs(na - nb)), "is_s2": d(F.when(F.startswith("cand_id", F.lit("S2-")), 1).otherwise(0)),
        **{c: F.col(c) for c in FEATURE_NAMES[-6:]},
    }
    return rows.select("country", "s1_id", "cand_id", *[out[c].alias(c) for c in FEATURE_NAMES if c in out])
