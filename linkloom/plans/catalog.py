"""Named queries over the driver's tables, one or more for each operator, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import minhash, normalize, similarity, tokens
from ..operators import assign, blocking, features, metrics, mining, model, tuning
from ..operators.rules import RuleSet
from ..sources import records as files
from ..sources.storage import SLICES, fresh_path, slice_of, written, written_slices
from . import jobs, views
from .views import RULES, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CONFIG = blocking.Config(lsh="md5")


def query(name: str, oracle: str | None = None):
    def put(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return put


def _join(c) -> F.Column:
    return F.array_join(c, " ")


# --- shared plans ---------------------------------------------------------------------------------------


def prepared(spark, sf_dir, source=views.records, texts=True) -> DataFrame:
    """Prepared once and written, as most plans read it several times; ``texts`` False for those that need token lists alone."""
    rows = blocking.prepare(source(spark, sf_dir), RULES).drop("name", "address")
    return written(rows if texts else features.without_texts(rows), "prepared")


def found(spark, sf_dir, source=views.records, capped=True, texts=True, config=CONFIG):
    """(candidates, source 1, pool, weights), all written."""
    s1, pool = views.sides(prepared(spark, sf_dir, source, texts))
    weights = written(blocking.idf(pool, s1), "weights")
    return blocking.candidates_written(s1, pool, RULES, config, capped, weights), s1, pool, weights


def truth_edges(norms: DataFrame) -> DataFrame:
    """Records of equal normal form in source 1 and the pool, as a stand-in for labels: all pairs, for lists of them."""
    same = norms.select("country", "entity_id", F.md5(F.encode(F.concat_ws("|", "norm_name", "norm_addr"), "UTF-8")).alias("h"))
    a, b = views.sides(same)
    return a.select("country", "h", F.col("entity_id").alias("s1_id")).join(b.select("country", "h", F.col("entity_id").alias("cand_id")), ["country", "h"]).select("s1_id", "cand_id")


def _class(norms: DataFrame) -> F.Column:
    return features.same_text(norms)


def hits(cands: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """The candidate pairs of equal normal form: no more rows than there are candidates, however large a class of copies is."""
    of = lambda d, k, h: d.select(F.col("entity_id").alias(k), _class(d).alias(h))
    met = cands.select("s1_id", "cand_id").join(of(s1, "s1_id", "h1"), "s1_id").join(of(pool, "cand_id", "h2"), "cand_id")
    return met.where("h1 = h2").select("s1_id", "cand_id")


def true_sizes(s1: DataFrame, pool: DataFrame) -> DataFrame:
    """(s1_id, n_true): pool records of equal normal form, by counts of classes."""
    n = pool.select("country", _class(pool).alias("h")).groupBy("country", "h").agg(F.count("*").alias("n_true"))
    return s1.select(F.col("entity_id").alias("s1_id"), "country", _class(s1).alias("h")).join(n, ["country", "h"], "left").select("s1_id", F.coalesce("n_true", F.lit(0)).alias("n_true"))


def true_pairs(s1: DataFrame, pool: DataFrame) -> int:
    return int(true_sizes(s1, pool).agg(F.sum("n_true")).first()[0] or 0)


def _norms(spark, sf_dir) -> DataFrame:
    r = views.records(spark, sf_dir)
    return r.select("entity_id", "country", normalize.norm_text(F.col("name")).alias("norm_name"), normalize.norm_text(F.col("address")).alias("norm_addr"))


def truth(spark, sf_dir) -> DataFrame:
    """(s1_id, ids) of every source-1 record."""
    n = written(_norms(spark, sf_dir), "norms")
    ids = truth_edges(n).groupBy("s1_id").agg(F.array_sort(F.collect_set("cand_id")).alias("ids"))
    return files.every_record(n.where(F.startswith("entity_id", F.lit("S1-"))), ids)


def triples(spark, sf_dir) -> DataFrame:
    """(s1_id, cand_id, score): orders against parts, for assignment at size."""
    li = views.table(spark, sf_dir, "lineitem")
    score = F.round(F.col("l_quantity") / 50.0 - F.col("l_discount") + F.col("l_linenumber") / 1000.0, 6)
    rows = li.select(F.concat(F.lit("S1-"), F.col("l_orderkey")).alias("s1_id"), F.concat(F.when(F.col("l_partkey") % 2 == 0, "S2-").otherwise("S3-"), F.col("l_partkey")).alias("cand_id"), score.alias("score"))
    return rows.groupBy("s1_id", "cand_id").agg(F.max("score").alias("score"))


_TRIPLES = """t AS (SELECT s1_id, cand_id, max(score) AS score, substr(cand_id, 1, 2) AS src FROM (SELECT 'S1-' || l_orderkey AS s1_id,
  CASE WHEN l_partkey % 2 = 0 THEN 'S2-' ELSE 'S3-' END || l_partkey AS cand_id, round(l_quantity / 50.0 - l_discount + l_linenumber / 1000.0, 6) AS score FROM lineitem) GROUP BY s1_id, cand_id)"""


# --- sources and sinks ----------------------------------------------------------------------------------


def _tsv(rows: DataFrame) -> str:
    path = fresh_path(rows.sparkSession, "tsv")
    rows.write.csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


@query("src_read_records", "SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, md5(split_part(text, '.', 1)) AS name_md5, md5(substr(text, length(split_part(text, '.', 1)) + 2)) AS address_md5, lang AS country FROM documents WHERE text IS NOT NULL AND lang IN ('en', 'fr')")
def _(spark, sf_dir):
    got = files.read_records(spark, _tsv(views.records(spark, sf_dir).select(*files.RECORD)), ["en", "fr"], multi_line=True)
    md5 = lambda c: F.md5(F.encode(c, "UTF-8")).alias(f"{c}_md5")
    return got.select("entity_id", md5("name"), md5("address"), "country")


@query("src_ground_truth", sql("SELECT id AS s1_id, coalesce(string_agg(cand_id, ' ' ORDER BY cand_id), '') AS ids FROM recs LEFT JOIN edges ON s1_id = id WHERE id LIKE 'S1-%' GROUP BY id", "edges"))
def _(spark, sf_dir):
    lists = truth(spark, sf_dir)
    path = _tsv(lists.select("s1_id", F.array_join("ids", ",").alias("ids")))
    return files.read_ground_truth(spark, path).select("s1_id", _join("ids").alias("ids"))


@query("src_last_wins", "SELECT s1_id, arg_max(v, p) AS ids FROM (SELECT 'S1-' || (doc_id % 50) AS s1_id, doc_id AS p, 'S2-' || doc_id AS v FROM documents) GROUP BY s1_id")
def _(spark, sf_dir):
    """A truth file whose records repeat: the last row of each stands. Files are named in order, as the range partitions are."""
    d = views.table(spark, sf_dir, "documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    path = _tsv(d.select(F.concat(F.lit("S1-"), F.col("doc_id") % 50).alias("s1_id"), F.concat(F.lit("S2-"), "doc_id").alias("ids")))
    return files.load_ground_truth(spark, path).select("s1_id", _join("ids").alias("ids"))


def _catalog(spark, sf_dir, source=views.records) -> files.Catalog:
    """The records as three source files, and the truth."""
    root = fresh_path(spark, "catalog")
    rows = source(spark, sf_dir).select(*files.RECORD)
    put = lambda d, what: d.write.csv(f"{root}/test/test_{what}.tsv", sep="\t", header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    for k in (1, 2, 3):
        put(rows.withColumns({c: F.translate(c, "\n\r", "  ") for c in ("name", "address")}).where(F.startswith("entity_id", F.lit(f"S{k}-"))), f"source{k}")
    norms = written(rows.select("entity_id", "country", normalize.norm_text(F.col("name")).alias("norm_name"), normalize.norm_text(F.col("address")).alias("norm_addr")), "norms")
    ids = truth_edges(norms).groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("cand_id")), ",").alias("ids"))
    put(norms.where(F.startswith("entity_id", F.lit("S1-"))).select(F.col("entity_id").alias("s1_id")).join(ids, "s1_id", "left"), "ground_truth")
    return files.Catalog(root, "test")


@query("src_pool_union", "SELECT 'S' || (p_partkey % 3 + 1) AS source, substr(p_brand, 1, 7) AS country, count(*)::BIGINT AS n, count(DISTINCT p_name)::BIGINT AS names FROM part WHERE p_partkey % 3 > 0 AND substr(p_brand, 1, 7) <> 'Brand#1' GROUP BY 1, 2")
def _(spark, sf_dir):
    """The pool of sources 2 and 3 from their files, of all countries but one."""
    wanted = [r[0] for r in views.goods(spark, sf_dir).select("country").distinct().collect() if r[0] != "Brand#1"]
    pool = _catalog(spark, sf_dir, views.goods).sources(spark, wanted)[1]
    return pool.groupBy(F.substring("entity_id", 1, 2).alias("source"), "country").agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"))


@query("lim_per_country", "SELECT country, id AS entity_id FROM (SELECT id, country, row_number() OVER (PARTITION BY country ORDER BY id) AS r FROM (" + views._GOODS + ") WHERE id LIKE 'S1-%') WHERE r <= 3")
def _(spark, sf_dir):
    return jobs.limited(_catalog(spark, sf_dir, views.goods).sources(spark)[0], 3).select("country", "entity_id")


@query("flt_entity_list", "SELECT 'S1-' || p_partkey AS entity_id, p_name AS name FROM part WHERE p_partkey % 3 = 0 AND p_partkey IN (SELECT s_suppkey FROM supplier)")
def _(spark, sf_dir):
    """Source-1 records that a list of ids names."""
    only = views.table(spark, sf_dir, "supplier").select(F.concat(F.lit("S1-"), "s_suppkey").alias("entity_id"))
    return jobs.listed(_catalog(spark, sf_dir, views.goods).sources(spark)[0], only).select("entity_id", "name")


@query("src_countries", sql("SELECT DISTINCT country FROM recs"))
def _(spark, sf_dir):
    return files.list_countries(views.records(spark, sf_dir))


@query("snk_id_lists", "SELECT 'S1-' || o_custkey AS source1_entity_id, string_agg(DISTINCT 'S2-' || (o_orderkey % 7), ',' ORDER BY 'S2-' || (o_orderkey % 7)) AS matched_entity_ids FROM orders GROUP BY o_custkey")
def _(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders")
    lists = o.groupBy(F.concat(F.lit("S1-"), "o_custkey").alias("id")).agg(F.array_sort(F.collect_list(F.concat(F.lit("S2-"), F.col("o_orderkey") % 7))).alias("ids"))
    path = fresh_path(spark, "lists")
    files.write_id_lists(lists, path, ("source1_entity_id", "matched_entity_ids"))
    return spark.read.csv(path, sep="\t", header=True, quote="")


@query("snk_candidate_lists", sql("SELECT id AS s1_id, coalesce(string_agg(cand_id, ' ' ORDER BY rank), '') AS ids FROM prep LEFT JOIN cand ON s1_id = id WHERE id LIKE 'S1-%' GROUP BY id", "cand"))
def _(spark, sf_dir):
    cands, s1, *_ = found(spark, sf_dir)
    lists = cands.groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "cand_id"))), lambda x: x["cand_id"]).alias("ids"))
    return files.every_record(s1, lists).select("s1_id", _join("ids").alias("ids"))


# --- strings --------------------------------------------------------------------------------------------


@query("str_norm_text", sql("SELECT id AS entity_id, nn AS norm_name, md5(na) AS norm_addr_md5 FROM norms", "norms"))
def _(spark, sf_dir):
    return _norms(spark, sf_dir).select("entity_id", "norm_name", F.md5(F.encode("norm_addr", "UTF-8")).alias("norm_addr_md5"))


@query("str_tokenize", sql(f"SELECT country, token, count(*)::BIGINT AS n FROM (SELECT country, unnest({views.toks('nn')} || {views.toks('na')}) AS token FROM norms) GROUP BY country, token", "norms"))
def _(spark, sf_dir):
    n = _norms(spark, sf_dir).select("country", F.explode(F.concat(normalize.tokenize(F.col("norm_name")), normalize.tokenize(F.col("norm_addr")))).alias("token"))
    return n.groupBy("country", "token").agg(F.count("*").alias("n"))


_TOKENS = f"(SELECT DISTINCT unnest({views.toks('nn')} || {views.toks('na')}) AS token FROM norms)"


def _distinct_tokens(spark, sf_dir):
    n = _norms(spark, sf_dir)
    return n.select(F.explode(F.concat(normalize.tokenize(F.col("norm_name")), normalize.tokenize(F.col("norm_addr")))).alias("token")).distinct()


@query("str_skeleton", sql(rf"SELECT token, {views.skeleton('token')} AS skeleton, round(length(regexp_replace(token, '[^\p{{L}}]', '', 'g'))::DOUBLE / length(token), 6) AS letters, regexp_full_match(token, '\d+') AS number FROM {_TOKENS}", "norms"))
def _(spark, sf_dir):
    t = F.col("token")
    return _distinct_tokens(spark, sf_dir).select("token", normalize.skeletonize_token(t).alias("skeleton"), F.round(normalize.alpha_ratio(t), 6).alias("letters"), normalize.is_number(t).alias("number"))


@query("str_split_numeric", sql(rf"SELECT id AS entity_id, len(list_filter(t, lambda x: NOT regexp_full_match(x, '\d+')))::BIGINT AS n_words, array_to_string(list_filter(t, lambda x: regexp_full_match(x, '\d+')), ' ') AS nums FROM (SELECT id, {views.toks('na')} AS t FROM norms)", "norms"))
def _(spark, sf_dir):
    t = normalize.tokenize(F.col("norm_addr"))
    return _norms(spark, sf_dir).select("entity_id", F.size(normalize.words_of(t)).cast("long").alias("n_words"), _join(normalize.numbers_of(t)).alias("nums"))


#: Texts with letters below and beyond the border, and a mark beyond it that is no letter.
_SCRIPTS = ("दिल्ली", "привет", "中文 abc", "İstanbul", "dash – only", "ﬁne", "")


@query("str_non_latin", "SELECT lang, count(*)::BIGINT AS n, count(*) FILTER (len(list_filter(regexp_extract_all(text, '\\p{L}'), lambda c: unicode(c) >= 2304)) > 0)::BIGINT AS non_latin FROM (SELECT lang, text FROM documents WHERE text IS NOT NULL UNION ALL SELECT 'script ' || (i - 1), t FROM (SELECT unnest([" + ", ".join(f"'{t}'" for t in _SCRIPTS) + f"]) AS t, unnest(range(1, {len(_SCRIPTS) + 1})) AS i)) GROUP BY lang")
def _(spark, sf_dir):
    more = spark.createDataFrame([(f"script {i}", t) for i, t in enumerate(_SCRIPTS)], "lang string, text string")
    d = views.table(spark, sf_dir, "documents").where("text is not null").select("lang", "text").unionByName(more)
    return d.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(normalize.is_non_latin(F.col("text"))).alias("non_latin"))


@query("rule_strip_droppable", sql(f"SELECT id AS entity_id, array_to_string(CASE WHEN len(k) > 0 THEN k ELSE t END, ' ') AS kept FROM (SELECT id, t, list_filter(t, lambda x: NOT list_contains({sorted(RULES.droppable)}, x)) AS k FROM (SELECT id, {views.toks('nn')} AS t FROM norms))", "norms"))
def _(spark, sf_dir):
    return _norms(spark, sf_dir).select("entity_id", _join(tokens.strip_droppable(normalize.tokenize(F.col("norm_name")), RULES.droppable)).alias("kept"))


@query("rule_expand", sql(f"SELECT token, coalesce(token || ' ' || string_agg(alt, ' ' ORDER BY nth), token) AS alternates FROM {_TOKENS} LEFT JOIN alts USING (token) GROUP BY token", "norms", "alts"))
def _(spark, sf_dir):
    return _distinct_tokens(spark, sf_dir).select("token", _join(tokens.expand(F.col("token"), RULES.expansions)).alias("alternates"))


@query("rule_phrases", sql(f"SELECT id AS entity_id, md5(array_to_string({views._phrased(views.toks('na'))}, ' ')) AS phrased_md5 FROM norms", "norms"))
def _(spark, sf_dir):
    return _norms(spark, sf_dir).select("entity_id", F.md5(F.encode(_join(tokens.apply_phrases(normalize.tokenize(F.col("norm_addr")), RULES.phrases)), "UTF-8")).alias("phrased_md5"))


@query("str_prepare", sql("SELECT id AS entity_id, country, array_to_string(names, ' ') AS names, md5(array_to_string(words, ' ')) AS words_md5, array_to_string(nums, ' ') AS nums, CASE WHEN len(names) > 0 THEN array_to_string(list_sort(names), ' ') END AS name_key FROM prep", "prep"))
def _(spark, sf_dir):
    p = blocking.prepare(views.records(spark, sf_dir), RULES)
    return p.select("entity_id", "country", _join("name_toks").alias("names"), F.md5(F.encode(_join("word_toks"), "UTF-8")).alias("words_md5"), _join("num_toks").alias("nums"), "name_key")


@query("str_lsh_bands", sql("SELECT id AS entity_id, array_to_string(bands, ' ') AS bands FROM bands", "bands"))
def _(spark, sf_dir):
    p = blocking.prepare(views.records(spark, sf_dir), RULES).where(F.size("name_toks") > 0)
    return p.select("entity_id", _join(minhash.md5_bands(F.col("name_toks"))).alias("bands"))


_CRC32 = """steps AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS c FROM (SELECT unnest(range(256)) AS n))),
known AS MATERIALIZED (SELECT g, seed, xor(list_reduce([('0x' || substr(h, 2 * i + 1, 2))::BIGINT FOR i IN range(length(h) // 2)], lambda c, b: xor(c >> 8, list_extract(t, 1 + (xor(c, b) & 255))), xor(seed, 4294967295)), 4294967295) AS crc
  FROM (SELECT DISTINCT g, hex(encode(g)) AS h FROM (SELECT unnest(g) AS g FROM grams)), (SELECT unnest(range(1, 9)) AS seed), steps),
lows AS (SELECT id, seed, min(crc) AS h FROM (SELECT id, unnest(g) AS g FROM grams) JOIN known USING (g) GROUP BY id, seed)"""


@query("str_lsh_crc32", sql(", " + _CRC32 + " SELECT a.id AS entity_id, ((a.seed - 1) // 2)::INTEGER AS band, a.h AS h1, b.h AS h2 FROM lows a JOIN lows b ON a.id = b.id AND b.seed = a.seed + 1 WHERE a.seed % 2 = 1", "grams"))
def _(spark, sf_dir):
    p = blocking.prepare(views.records(spark, sf_dir), RULES)
    return p.select("entity_id", F.explode(minhash.crc32_bands(F.col("name_toks"))).alias("b")).select("entity_id", "b.*")


@query("mine_acronyms", "SELECT p_partkey, p_name, len(w) = 2 AND starts_with(w[1], 'b') AND starts_with(w[2], 's') AS bs FROM (SELECT p_partkey, p_name, string_split(lower(p_name), ' ') AS w FROM part)")
def _(spark, sf_dir):
    w = F.split(F.lower("p_name"), " ")
    return views.table(spark, sf_dir, "part").select("p_partkey", "p_name", tokens.is_acronym(F.lit("bs"), w).alias("bs"))


# --- similarities ---------------------------------------------------------------------------------------


@query("sim_strings")
def _(spark, sf_dir):
    cands, s1, pool, _ = found(spark, sf_dir)
    rows = cands.join(s1.select(F.col("entity_id").alias("s1_id"), F.col("norm_name").alias("a")), "s1_id").join(pool.select(F.col("entity_id").alias("cand_id"), F.col("norm_name").alias("b")), "cand_id")
    return rows.select("s1_id", "cand_id", similarity.string_similarities("a", "b").alias("s")).select("s1_id", "cand_id", *[F.round(f"s.{c}", 6).alias(c) for c in ("ratio", "token_sort", "token_set", "partial", "jw", "osa")])


def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence, a row of the table at a time."""
    cell = f"CASE WHEN substr({a}, i[1], 1) = substr({b}, j[1], 1) THEN p[j[1]] + 1 ELSE greatest(p[j[1] + 1], r[j[1]]) END"
    row = f"list_reduce([[k] FOR k IN range(1, length({b}) + 1)], lambda r, j: list_append(r, {cell}), [0::BIGINT])"
    return f"list_reduce([[k] FOR k IN range(1, length({a}) + 1)], lambda p, i: {row}, [0::BIGINT FOR k IN range(length({b}) + 1)])[-1]"


def _indel(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 1.0 ELSE 2.0 * {_lcs(a, b)} / (length({a}) + length({b})) END"


def _osa(a: str, b: str) -> str:
    """Edits with swaps of neighbours; the row before and the one before that, end to end."""
    n = f"(length({b}) + 1)"
    left, up, corner = "r[j[1]]", f"p[{n} + j[1] + 1]", f"p[{n} + j[1]]"
    same = lambda x, y: f"substr({a}, i[1]{x}, 1) = substr({b}, j[1]{y}, 1)"
    swap = f"CASE WHEN i[1] > 1 AND j[1] > 1 AND {same('', ' - 1')} AND {same(' - 1', '')} THEN p[j[1] - 1] + 1 ELSE 1000000 END"
    cell = f"least({up} + 1, {left} + 1, {corner} + CASE WHEN {same('', '')} THEN 0 ELSE 1 END, {swap})"
    row = f"list_reduce([[k] FOR k IN range(1, {n})], lambda r, j: list_append(r, {cell}), [i[1]])"
    return f"list_reduce([[k] FOR k IN range(1, length({a}) + 1)], lambda p, i: p[{n} + 1:] || {row}, [1000000::BIGINT FOR k IN range({n})] || range({n}))[-1]"


_SORTED = lambda x: f"array_to_string(list_sort(list_filter(string_split({x}, ' '), lambda t: t <> '')), ' ')"
_PARTS = "pairs AS MATERIALIZED (SELECT DISTINCT lower(p_name) AS a, lower(p_type) AS b, lower(p_brand || ' ' || p_name) AS c FROM part)"


@query("sim_parts", f"""WITH {_PARTS}, m AS (SELECT a, b, c, {_indel("a", "b")} AS ratio, {_indel(_SORTED("c"), _SORTED("b"))} AS token_sort,
  CASE WHEN length(a) = 0 AND length(b) = 0 THEN 1.0 ELSE 1.0 - ({_osa("a", "b")})::DOUBLE / greatest(length(a), length(b)) END AS osa FROM pairs)
SELECT p_partkey, round(ratio, 6) AS ratio, round(token_sort, 6) AS token_sort, round(osa, 6) AS osa FROM part JOIN m ON a = lower(p_name) AND b = lower(p_type) AND c = lower(p_brand || ' ' || p_name)""")
def _(spark, sf_dir):
    """Names against types, and against brand and name for the measure that sorts words."""
    a, b, c = F.lower("p_name"), F.lower("p_type"), F.lower(F.concat("p_brand", F.lit(" "), "p_name"))
    rows = views.table(spark, sf_dir, "part").select("p_partkey", similarity.measures(("ratio", "osa"))(a, b).alias("s"), similarity.measures(("token_sort",))(c, b).alias("t"))
    return rows.select("p_partkey", F.round("s.ratio", 6).alias("ratio"), F.round("t.token_sort", 6).alias("token_sort"), F.round("s.osa", 6).alias("osa"))


_WINDOWS = f"""sides AS MATERIALIZED (SELECT DISTINCT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l FROM pairs),
cuts AS (SELECT a, b, x, y FROM (SELECT a, b, s AS x, substr(l, greatest(k, 0)::INTEGER + 1, (least(k + length(s), length(l)) - greatest(k, 0))::INTEGER) AS y FROM sides, LATERAL (SELECT unnest(range(1 - length(s), length(l))) AS k))
  UNION ALL SELECT a, b, l, substr(s, greatest(k, 0)::INTEGER + 1, (least(k + length(l), length(s)) - greatest(k, 0))::INTEGER) FROM sides, LATERAL (SELECT unnest(range(1 - length(l), length(s))) AS k) WHERE length(s) = length(l)),
each_cut AS MATERIALIZED (SELECT DISTINCT x, y FROM cuts), best AS (SELECT a, b, max(r) AS partial FROM cuts JOIN (SELECT x, y, {_indel("x", "y")} AS r FROM each_cut) USING (x, y) GROUP BY a, b)"""
_SETS_OF = lambda x: f"list_sort(list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> '')))"
_TOKEN_SETS = f"""z AS (SELECT a, b, array_to_string(list_filter(sa, lambda t: list_contains(sb, t)), ' ') AS both_, array_to_string(list_filter(sa, lambda t: NOT list_contains(sb, t)), ' ') AS oa, array_to_string(list_filter(sb, lambda t: NOT list_contains(sa, t)), ' ') AS ob, len(sa) AS na, len(sb) AS nb
  FROM (SELECT a, b, {_SETS_OF("a")} AS sa, {_SETS_OF("b")} AS sb FROM sides)),
y AS (SELECT *, trim(both_ || ' ' || oa) AS wa, trim(both_ || ' ' || ob) AS wb FROM z),
sets AS (SELECT a, b, CASE WHEN na = 0 OR nb = 0 THEN 0.0 WHEN both_ <> '' AND (oa = '' OR ob = '') THEN 1.0 WHEN both_ = '' THEN {_indel("wa", "wb")} ELSE greatest({_indel("wa", "wb")}, {_indel("both_", "wa")}, {_indel("both_", "wb")}) END AS token_set FROM y)"""


@query("sim_windows_and_sets", f"""WITH pairs AS MATERIALIZED (SELECT DISTINCT lower(p_name) AS a, lower(p_type || ' ' || split_part(p_name, ' ', 1 + p_partkey::INTEGER % 2)) AS b FROM part), {_WINDOWS}, {_TOKEN_SETS}
SELECT p_partkey, round(partial, 6) AS partial, round(token_set, 6) AS token_set FROM part JOIN best ON best.a = lower(p_name) AND best.b = lower(p_type || ' ' || split_part(p_name, ' ', 1 + p_partkey::INTEGER % 2)) JOIN sets ON sets.a = best.a AND sets.b = best.b""")
def _(spark, sf_dir):
    """Names against types that one of the name's words follows."""
    word = F.element_at(F.split("p_name", " "), (1 + F.col("p_partkey") % 2).cast("int"))
    a, b = F.lower("p_name"), F.lower(F.concat("p_type", F.lit(" "), word))
    rows = views.table(spark, sf_dir, "part").select("p_partkey", similarity.measures(("partial", "token_set"))(a, b).alias("s"))
    return rows.select("p_partkey", F.round("s.partial", 6).alias("partial"), F.round("s.token_set", 6).alias("token_set"))


@query("sim_jaro_winkler", "SELECT p_partkey, round(jaro_winkler_similarity(lower(p_name), lower(p_type)), 6) AS jw FROM part")
def _(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select("p_partkey", F.round(similarity.measures(("jw",))(F.lower("p_name"), F.lower("p_type"))["jw"], 6).alias("jw"))


@query("set_jaccard", sql("SELECT c.s1_id, c.cand_id, round(CASE WHEN u = 0 THEN 0.0 ELSE i::DOUBLE / u END, 6) AS name_jaccard FROM (SELECT s1_id, cand_id, len(list_intersect(a.names, b.names)) AS i, len(list_distinct(a.names || b.names)) AS u FROM cand JOIN prep a ON a.id = s1_id JOIN prep b ON b.id = cand_id) c", "cand", "prep"))
def _(spark, sf_dir):
    cands, s1, pool, _ = found(spark, sf_dir)
    rows = cands.join(s1.select(F.col("entity_id").alias("s1_id"), F.col("name_toks").alias("a")), "s1_id").join(pool.select(F.col("entity_id").alias("cand_id"), F.col("name_toks").alias("b")), "cand_id")
    return rows.select("s1_id", "cand_id", F.round(tokens.jaccard(F.col("a"), F.col("b")), 6).alias("name_jaccard"))


# --- blocking -------------------------------------------------------------------------------------------


@query("agg_document_frequency", sql("SELECT country, token, df::BIGINT AS df FROM df WHERE df > 0", "df"))
def _(spark, sf_dir):
    return blocking.document_frequency(views.sides(prepared(spark, sf_dir))[1])


@query("mth_idf", sql("SELECT country, token, df::BIGINT AS df, round(idf, 6) AS idf FROM w", "w"))
def _(spark, sf_dir):
    s1, pool = views.sides(prepared(spark, sf_dir))
    return blocking.idf(pool, s1).select("country", "token", "df", F.round("idf", 6).alias("idf"))


@query("win_rarest_tokens", sql("SELECT id AS entity_id, coalesce(string_agg(token, ' ' ORDER BY r) FILTER (f = 'n'), '') AS names, coalesce(string_agg(token, ' ' ORDER BY r) FILTER (f = 'w'), '') AS words, coalesce(string_agg(token, ' ' ORDER BY r) FILTER (f = 'd'), '') AS nums FROM prep LEFT JOIN rare USING (country, id) GROUP BY id", "rare", "prep"))
def _(spark, sf_dir):
    p = prepared(spark, sf_dir)
    s1, pool = views.sides(p)
    names = lambda c: F.coalesce(_join(F.transform(c, lambda x: x["token"])), F.lit("")).alias(c)
    return blocking.rarest(p, blocking.idf(pool, s1)).select("entity_id", names("names"), names("words"), names("nums"))


@query("rule_expand_probe", sql("SELECT id AS entity_id, string_agg(token, ' ' ORDER BY token) AS words FROM probe_words GROUP BY id", "probe_words"))
def _(spark, sf_dir):
    s1, pool = views.sides(prepared(spark, sf_dir))
    w = written(blocking.idf(pool, s1), "weights")
    got = blocking.expand_words(blocking.rarest(s1, w), w, RULES).where(F.size("words") > 0)
    return got.select("entity_id", _join(F.array_sort(F.transform("words", lambda x: x["token"]))).alias("words"))


def _keys(spark, sf_dir, source=views.records):
    s1, pool = views.sides(prepared(spark, sf_dir, source))
    w = written(blocking.idf(pool, s1), "weights")
    return blocking.keys(blocking.expand_words(blocking.rarest(s1, w), w, RULES), blocking.greatest_idf(w), CONFIG), blocking.keys(blocking.rarest(pool, w), None, CONFIG)


for _fam, _name in enumerate(("name_addr", "num_addr", "name_num", "name_pair", "exact_name", "name_lsh"), 1):

    def _f(spark, sf_dir, fam=_fam):
        return _keys(spark, sf_dir)[0].where(F.col("fam") == fam).select("entity_id", "a", "b", F.round("w", 6).alias("w"))

    query(f"blk_keys_{_name}", sql(f"SELECT id AS entity_id, a, b, round(wt, 6) AS w FROM keys WHERE fam = {_fam} AND id LIKE 'S1-%'", "keys"))(_f)


@query("blk_posting_cap", sql("SELECT country, fam, a, b, count(*)::BIGINT AS n FROM posts GROUP BY country, fam, a, b", "posts", source="goods"))
def _(spark, sf_dir):
    return blocking.postings(_keys(spark, sf_dir, views.goods)[1]).groupBy("country", "fam", "a", "b").agg(F.count("*").alias("n"))


@query("blk_scores", sql("SELECT s1_id, cand_id, round(block_score, 6) AS block_score FROM met", "met", source="goods"))
def _(spark, sf_dir):
    return found(spark, sf_dir, views.goods, False)[0].select("s1_id", "cand_id", F.round("block_score", 6).alias("block_score"))


_TOPK = "SELECT country, s1_id, cand_id, round(block_score, 6) AS block_score, rank::INTEGER AS rank FROM cand"


@query("blk_topk", sql(_TOPK, "cand"))
def _(spark, sf_dir):
    return found(spark, sf_dir)[0].select("country", "s1_id", "cand_id", F.round("block_score", 6).alias("block_score"), "rank")


@query("blk_topk_parts", sql(_TOPK, "cand", source="goods"))
def _(spark, sf_dir):
    return found(spark, sf_dir, views.goods)[0].select("country", "s1_id", "cand_id", F.round("block_score", 6).alias("block_score"), "rank")


_KS = (5, 10, 15, 20, 25, 30, 50)


@query("win_recall_curve", sql(" UNION ALL ".join(f"SELECT {k} AS k, count(*) FILTER (rank < {k})::BIGINT AS found, count(*)::BIGINT AS pairs, CASE WHEN count(*) = 0 THEN 1.0 ELSE round(count(*) FILTER (rank < {k})::DOUBLE / count(*), 6) END AS recall FROM edges LEFT JOIN ranked USING (s1_id, cand_id)" for k in _KS), "edges", "ranked"))
def _(spark, sf_dir):
    raw, s1, pool, _ = found(spark, sf_dir, capped=False)
    top = written(blocking.top_k(raw, max(_KS)), "ranked")
    got = metrics.recall_curve(top, hits(top, s1, pool), _KS, true_pairs(s1, pool))
    return got.select("k", "found", "pairs", F.round("recall", 6).alias("recall"))


@query("agg_candidate_counts", sql("SELECT round(avg(n), 6) AS mean, median(n)::DOUBLE AS median, max(n)::BIGINT AS most FROM (SELECT id, count(cand_id) AS n FROM prep LEFT JOIN met ON s1_id = id WHERE id LIKE 'S1-%' GROUP BY id)", "met"))
def _(spark, sf_dir):
    raw, s1, *_ = found(spark, sf_dir, capped=False)
    return metrics.candidate_counts(raw, s1).select(F.round("mean", 6).alias("mean"), "median", "most")


@query("join_no_candidates", sql("SELECT id AS s1_id FROM prep WHERE id LIKE 'S1-%' AND id NOT IN (SELECT s1_id FROM cand)", "cand"))
def _(spark, sf_dir):
    cands, s1, *_ = found(spark, sf_dir)
    return s1.select(F.col("entity_id").alias("s1_id")).join(cands, "s1_id", "left_anti")


# --- features and model ---------------------------------------------------------------------------------


@query("feat_listwise", sql("SELECT s1_id, cand_id, rank::DOUBLE AS rank, round(block_score / t, 6) AS score_ratio_to_top, round(t - block_score, 6) AS score_gap_to_top, round((block_score - m) / s, 6) + 0.0 AS score_z, g::DOUBLE AS group_size FROM cand JOIN stats USING (s1_id)", "cand", "stats"))
def _(spark, sf_dir):
    got = features.listwise(found(spark, sf_dir)[0])
    return got.select("s1_id", "cand_id", "rank", *[(F.round(c, 6) + 0.0).alias(c) for c in ("score_ratio_to_top", "score_gap_to_top", "score_z")], "group_size")


_PAIR = """SELECT c.s1_id, c.cand_id, round(coalesce(n.mass, 0), 6) AS name_idf_overlap, round(coalesce(n.mass / an.mass, 0), 6) AS name_cover_s1, round(coalesce(n.mass / bn.mass, 0), 6) AS name_cover_cand,
  round(coalesce(x.mass, 0), 6) AS addr_idf_overlap, round(coalesce(x.mass / aw.mass, 0), 6) AS addr_cover_s1, round(coalesce(x.mass / bw.mass, 0), 6) AS addr_cover_cand,
  round(coalesce(x.n::DOUBLE / (aw.n + bw.n - x.n), 0), 6) AS addr_jaccard, coalesce(d.n, 0)::DOUBLE AS num_shared, CASE WHEN coalesce(d.n, 0) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS num_any,
  CASE WHEN b.na = '' THEN 1.0 ELSE 0.0 END::DOUBLE AS cand_addr_empty, length(a.nn)::DOUBLE AS s1_name_len, length(b.nn)::DOUBLE AS cand_name_len, abs(length(a.nn) - length(b.nn))::DOUBLE AS name_len_diff,
  coalesce(an.n, 0)::DOUBLE AS s1_ntok, coalesce(bn.n, 0)::DOUBLE AS cand_ntok, CASE WHEN c.cand_id LIKE 'S2-%' THEN 1.0 ELSE 0.0 END::DOUBLE AS is_s2
FROM cand c JOIN prep a ON a.id = c.s1_id JOIN prep b ON b.id = c.cand_id
  LEFT JOIN shared n ON n.s1_id = c.s1_id AND n.cand_id = c.cand_id AND n.f = 'n' LEFT JOIN shared x ON x.s1_id = c.s1_id AND x.cand_id = c.cand_id AND x.f = 'w' LEFT JOIN shared d ON d.s1_id = c.s1_id AND d.cand_id = c.cand_id AND d.f = 'd'
  LEFT JOIN sums an ON an.id = c.s1_id AND an.f = 'n' LEFT JOIN sums bn ON bn.id = c.cand_id AND bn.f = 'n' LEFT JOIN sums aw ON aw.id = c.s1_id AND aw.f = 'w' LEFT JOIN sums bw ON bw.id = c.cand_id AND bw.f = 'w'"""
_PAIR_COLUMNS = "name_idf_overlap name_cover_s1 name_cover_cand addr_idf_overlap addr_cover_s1 addr_cover_cand addr_jaccard num_shared num_any cand_addr_empty s1_name_len cand_name_len name_len_diff s1_ntok cand_ntok is_s2".split()


@query("feat_pairs", sql(_PAIR, "cand", "prep", "shared", "sums"))
def _(spark, sf_dir):
    got = features.pair_features(*found(spark, sf_dir, texts=False), strings=False)
    return got.select("s1_id", "cand_id", *[F.round(c, 6).alias(c) for c in _PAIR_COLUMNS])


_STRINGS = f"""cp AS MATERIALIZED (SELECT s1_id, cand_id, a.nn AS an, b.nn AS bn, a.na AS aa, b.na AS ba FROM cand JOIN prep a ON a.id = s1_id JOIN prep b ON b.id = cand_id),
pairs AS MATERIALIZED (SELECT an AS a, bn AS b FROM cp UNION SELECT aa, ba FROM cp), {_WINDOWS}, {_TOKEN_SETS},
meas AS MATERIALIZED (SELECT a, b, {_indel("a", "b")} AS ratio, {_indel(_SORTED("a"), _SORTED("b"))} AS token_sort, 1.0 - ({_osa("a", "b")})::DOUBLE / greatest(length(a), length(b)) AS osa, jaro_winkler_similarity(a, b) AS jw FROM pairs),
str AS MATERIALIZED (SELECT a, b, ratio, token_sort, token_set, partial, jw, osa FROM meas JOIN best USING (a, b) JOIN sets USING (a, b))"""
_MATRIX = f"""SELECT p.*, round(coalesce(n.n::DOUBLE / (an.n + bn.n - n.n), 0), 6) AS name_jaccard, round(coalesce(d.n::DOUBLE / (ad.n + bd.n - d.n), 0), 6) AS num_jaccard, abs(p.s1_ntok - p.cand_ntok)::DOUBLE AS ntok_diff,
  {", ".join(f"round(x.{m}, 6) AS name_{m}" for m in similarity.NAMES)}, {", ".join(f"round(y.{m}, 6) AS addr_{m}" for m in (*similarity.NAMES[:4], "osa"))},
  round(c.block_score, 6) AS block_score, c.rank::DOUBLE AS rank, round(c.block_score / t, 6) AS score_ratio_to_top, round(t - c.block_score, 6) AS score_gap_to_top, round((c.block_score - m) / s, 6) + 0.0 AS score_z, g::DOUBLE AS group_size, (e.s1_id IS NOT NULL)::INTEGER AS label
FROM pf p JOIN cand c USING (s1_id, cand_id) JOIN stats USING (s1_id) JOIN cp USING (s1_id, cand_id) JOIN str x ON x.a = an AND x.b = bn JOIN str y ON y.a = aa AND y.b = ba
  LEFT JOIN shared n ON n.s1_id = p.s1_id AND n.cand_id = p.cand_id AND n.f = 'n' LEFT JOIN shared d ON d.s1_id = p.s1_id AND d.cand_id = p.cand_id AND d.f = 'd'
  LEFT JOIN sums an ON an.id = p.s1_id AND an.f = 'n' LEFT JOIN sums bn ON bn.id = p.cand_id AND bn.f = 'n' LEFT JOIN sums ad ON ad.id = p.s1_id AND ad.f = 'd' LEFT JOIN sums bd ON bd.id = p.cand_id AND bd.f = 'd' LEFT JOIN edges e ON e.s1_id = p.s1_id AND e.cand_id = p.cand_id"""


@query("feat_matrix", sql(f", {_STRINGS}, pf AS MATERIALIZED ({_PAIR}) {_MATRIX}", "cand", "prep", "shared", "sums", "stats", "edges", source="goods"))
def _(spark, sf_dir):
    """All 36 features and the label, of the parts' short records."""
    cands, s1, pool, w = found(spark, sf_dir, views.goods)
    rows = model.labelled(features.pair_features(cands, s1, pool, w), hits(cands, s1, pool))
    return rows.select("s1_id", "cand_id", *[(F.round(c, 6) + 0.0).alias(c) for c in features.FEATURE_NAMES], F.col("label").cast("int").alias("label"))


@query("ml_labels", sql("SELECT count(*)::BIGINT AS pairs, count(e.s1_id)::BIGINT AS positives, round(count(e.s1_id)::DOUBLE / count(*), 6) AS rate FROM cand LEFT JOIN edges e USING (s1_id, cand_id)", "cand", "edges"))
def _(spark, sf_dir):
    cands, s1, pool, _ = found(spark, sf_dir)
    got = model.labelled(cands, hits(cands, s1, pool))
    return got.agg(F.count("*").alias("pairs"), F.sum("label").alias("positives"), F.round(F.avg("label"), 6).alias("rate"))


@query("ml_hash_split", "SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT % 100 < 25 AS held_out FROM documents")
def _(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").select("doc_id", model.held_out(F.col("doc_id").cast("string")).alias("held_out"))


_LINEAR = f"""SELECT s1_id, cand_id, round(1 / (1 + exp(-({model.BIAS} + 2.5 * name_cover_s1 + 2.5 * addr_cover_s1 + 1.5 * addr_jaccard + 1.0 * score_ratio_to_top + 0.3 * score_z))), 6) AS score FROM (
  SELECT c.s1_id, c.cand_id, coalesce(n.mass / an.mass, 0) AS name_cover_s1, coalesce(x.mass / aw.mass, 0) AS addr_cover_s1, coalesce(x.n::DOUBLE / (aw.n + bw.n - x.n), 0) AS addr_jaccard, c.block_score / t AS score_ratio_to_top, (c.block_score - m) / s AS score_z
  FROM cand c JOIN stats USING (s1_id) LEFT JOIN shared n ON n.s1_id = c.s1_id AND n.cand_id = c.cand_id AND n.f = 'n' LEFT JOIN shared x ON x.s1_id = c.s1_id AND x.cand_id = c.cand_id AND x.f = 'w'
    LEFT JOIN sums an ON an.id = c.s1_id AND an.f = 'n' LEFT JOIN sums aw ON aw.id = c.s1_id AND aw.f = 'w' LEFT JOIN sums bw ON bw.id = c.cand_id AND bw.f = 'w')"""
_SHORT = {k: model.LINEAR[k] for k in ("name_cover_s1", "addr_cover_s1", "addr_jaccard", "score_ratio_to_top", "score_z")}


def scored(spark, sf_dir):
    """(s1_id, cand_id, score) by the fixed linear scorer, and source 1."""
    cands, s1, pool, w = found(spark, sf_dir, texts=False)
    feats = features.pair_features(cands, s1, pool, w, strings=False)
    return written(feats.select("s1_id", "cand_id", F.round(model.linear_score(_SHORT), 6).alias("score")), "scored"), s1, pool


@query("ml_linear_score", sql(_LINEAR, "cand", "stats", "shared", "sums"))
def _(spark, sf_dir):
    return scored(spark, sf_dir)[0]


@query("ml_gbt_predict")
def _(spark, sf_dir):
    """Boosted trees fitted on three quarters of the records, early-stopped and scored on the rest."""
    cands, s1, pool, w = found(spark, sf_dir, texts=False)
    feats, edges = features.pair_features(cands, s1, pool, w, strings=False), hits(cands, s1, pool)
    own = lambda d, k: d.where(slice_of("s1_id", SLICES) == k)
    rows = written_slices(lambda k: model.labelled(own(feats, k), own(edges, k)).withColumn("val", model.held_out(F.col("s1_id"))), SLICES, "matrix")
    if rows.where("not val").select("label").distinct().count() < 2:
        return rows.where("val").select("s1_id", "cand_id", "label", F.lit(0.0).alias("score"))
    return model.predict(model.train(rows, rounds=10, validation="val"), rows.where("val")).select("s1_id", "cand_id", "label", F.round("score", 6).alias("score"))


# --- assignment and metrics -----------------------------------------------------------------------------


@query("asg_independent", f"WITH {_TRIPLES} SELECT s1_id, cand_id, score FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, src ORDER BY score DESC, s1_id, cand_id) AS k FROM t WHERE score >= 0.3) WHERE k <= CASE src WHEN 'S2' THEN 2 ELSE 1 END")
def _(spark, sf_dir):
    return assign.independent(triples(spark, sf_dir), 0.3, None, {"S2": 2, "S3": 1}).select("s1_id", "cand_id", "score")


@query("asg_one_to_one", f"WITH {_TRIPLES} SELECT s1_id, cand_id, score FROM (SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY score DESC, s1_id, cand_id) AS k FROM t WHERE score >= 0.3) WHERE k = 1")
def _(spark, sf_dir):
    """Caps that never bind, so the best claim on each candidate stands; tests hold binding caps against plain greed."""
    return assign.one_to_one(triples(spark, sf_dir), 0.3, None, {"S2": 50, "S3": 50}).select("s1_id", "cand_id", "score")


@query("asg_capped")
def _(spark, sf_dir):
    """Binding caps, and rescue of records left without a match."""
    t = written(triples(spark, sf_dir), "triples")
    return assign.assign(t, 0.6, t.select("s1_id").distinct(), {"S2": 1, "S3": 1}, True, 0.3).select("s1_id", _join("ids").alias("ids"))


_RIVALS = """rivals AS (SELECT 'S1-' || (s_nationkey + k) % 25 AS s1_id, CASE WHEN s_suppkey % 2 = 0 THEN 'S2-' ELSE 'S3-' END || s_suppkey AS cand_id, round((s_acctbal + 1000) / 12000 - k / 40.0, 6) AS score FROM supplier, (SELECT unnest([0, 1, 2]) AS k))"""
_GREEDY = f"""WITH RECURSIVE {_RIVALS}, c AS MATERIALIZED (SELECT *, substr(cand_id, 1, 2) AS src, row_number() OVER (ORDER BY score DESC, s1_id, cand_id) AS i FROM rivals WHERE score >= 0.3),
g(i, used, held, won) AS (SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[], []::BIGINT[] UNION ALL
  SELECT i, CASE WHEN ok THEN list_append(used, cand_id) ELSE used END, CASE WHEN ok THEN list_append(held, s1_id || src) ELSE held END, CASE WHEN ok THEN list_append(won, i) ELSE won END
  FROM (SELECT c.i, used, held, won, cand_id, s1_id, src, score >= 0.6 AND NOT list_contains(used, cand_id) AND len(list_filter(held, lambda h: h = s1_id || src)) < CASE src WHEN 'S2' THEN 2 ELSE 1 END AS ok FROM g JOIN c ON c.i = g.i + 1)),
first AS MATERIALIZED (SELECT c.* FROM c WHERE list_contains((SELECT won FROM g ORDER BY i DESC LIMIT 1), c.i)),
rest AS MATERIALIZED (SELECT s1_id, cand_id, score, row_number() OVER (ORDER BY score DESC, s1_id, cand_id) AS i FROM c WHERE score < 0.6 AND s1_id NOT IN (SELECT s1_id FROM first) AND cand_id NOT IN (SELECT cand_id FROM first)),
r(i, used, helped, won) AS (SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[], []::BIGINT[] UNION ALL
  SELECT i, CASE WHEN ok THEN list_append(used, cand_id) ELSE used END, CASE WHEN ok THEN list_append(helped, s1_id) ELSE helped END, CASE WHEN ok THEN list_append(won, i) ELSE won END
  FROM (SELECT rest.i, used, helped, won, cand_id, s1_id, NOT list_contains(used, cand_id) AND NOT list_contains(helped, s1_id) AS ok FROM r JOIN rest ON rest.i = r.i + 1)),
both_ AS (SELECT s1_id, cand_id, score FROM first UNION ALL SELECT s1_id, cand_id, score FROM rest WHERE list_contains((SELECT won FROM r ORDER BY i DESC LIMIT 1), rest.i))
SELECT n.s1_id, coalesce(string_agg(cand_id, ' ' ORDER BY score DESC, cand_id), '') AS ids FROM (SELECT DISTINCT s1_id FROM rivals) n LEFT JOIN both_ b ON b.s1_id = n.s1_id GROUP BY n.s1_id"""


def rivals(spark, sf_dir) -> DataFrame:
    """(s1_id, cand_id, score): every supplier wanted by three nations, so caps and exclusiveness bind."""
    s = views.table(spark, sf_dir, "supplier").select("*", F.explode(F.array(*map(F.lit, range(3)))).alias("k"))
    score = F.round((F.col("s_acctbal") + 1000) / 12000 - F.col("k") / F.lit(40.0), 6)
    return s.select(F.concat(F.lit("S1-"), (F.col("s_nationkey") + F.col("k")) % 25).alias("s1_id"), F.concat(F.when(F.col("s_suppkey") % 2 == 0, "S2-").otherwise("S3-"), "s_suppkey").alias("cand_id"), score.alias("score"))


@query("asg_rescue", _GREEDY)
def _(spark, sf_dir):
    """Greed under binding caps, and rescue of records left without a match, step by step in SQL."""
    t = written(rivals(spark, sf_dir), "rivals")
    return assign.assign(t, 0.6, t.select("s1_id").distinct(), {"S2": 2, "S3": 1}, True, 0.3).select("s1_id", _join("ids").alias("ids"))


_SWEEP = f"""WITH {_TRIPLES}, truth AS (SELECT DISTINCT s1_id, cand_id FROM t WHERE score >= 0.7), ent AS (SELECT DISTINCT s1_id FROM t), g AS (SELECT unnest([{", ".join(map(str, tuning.GRID))}]) AS th),
top AS (SELECT * FROM (SELECT t.*, row_number() OVER (PARTITION BY s1_id, src ORDER BY score DESC, s1_id, cand_id) AS k FROM t WHERE score >= 0.05) WHERE k <= CASE src WHEN 'S2' THEN 6 ELSE 7 END),
p AS (SELECT th, s1_id, count(*) AS p, count(u.cand_id) AS tp FROM g JOIN top ON score >= th LEFT JOIN truth u USING (s1_id, cand_id) GROUP BY th, s1_id),
n AS (SELECT s1_id, count(*) AS n FROM truth GROUP BY s1_id),
m AS (SELECT th, coalesce(p, 0) AS p, coalesce(tp, 0) AS tp, coalesce(n, 0) AS n FROM g CROSS JOIN ent LEFT JOIN p USING (th, s1_id) LEFT JOIN n USING (s1_id))
SELECT th::DOUBLE AS threshold, round(avg(CASE WHEN p = 0 AND n = 0 THEN 1.0 WHEN p = 0 OR n = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / p) * (tp / n) / (0.25 * tp / p + tp / n) END), 6) AS macro_f05,
  round(avg(CASE WHEN p > 0 THEN tp / p WHEN n = 0 THEN 1.0 ELSE 0.0 END), 6) AS mean_precision, round(avg(CASE WHEN n > 0 THEN tp / n ELSE 1.0 END), 6) AS mean_recall FROM m GROUP BY th"""


@query("asg_threshold_sweep", _SWEEP)
def _(spark, sf_dir):
    t = triples(spark, sf_dir)
    true = t.groupBy("s1_id").agg(F.collect_set(F.when(F.col("score") >= 0.7, F.col("cand_id"))).alias("ids"))
    return tuning.curve(t, true, exclusive=False).select("threshold", *[F.round(c, 6).alias(c) for c in ("macro_f05", "mean_precision", "mean_recall")])


_SETS = f"""{_TRIPLES}, truth AS (SELECT s1_id, cand_id FROM t WHERE score >= 0.7), pred AS (SELECT s1_id, cand_id FROM t WHERE score * 7 % 1 >= 0.5), ent AS (SELECT DISTINCT s1_id FROM t),
c AS (SELECT s1_id, count(u.s1_id) AS n, count(q.s1_id) AS p, count(CASE WHEN u.s1_id IS NOT NULL AND q.s1_id IS NOT NULL THEN 1 END) AS tp FROM t LEFT JOIN truth u USING (s1_id, cand_id) LEFT JOIN pred q USING (s1_id, cand_id) GROUP BY s1_id),
f AS (SELECT *, CASE WHEN p = 0 AND n = 0 THEN 1.0 WHEN p = 0 OR n = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / p) * (tp / n) / (0.25 * tp / p + tp / n) END AS f05 FROM c)"""


def _sets(spark, sf_dir):
    t = triples(spark, sf_dir)
    lists = t.groupBy("s1_id").agg(F.collect_set(F.when(F.col("score") >= 0.7, F.col("cand_id"))).alias("t"), F.collect_set(F.when(F.pmod(F.col("score") * 7, F.lit(1.0)) >= 0.5, F.col("cand_id"))).alias("p"))
    return lists.where(F.size("p") > 0).select("s1_id", F.col("p").alias("ids")), lists.select("s1_id", F.col("t").alias("ids"))


_SETS = _SETS.replace("score * 7 % 1 >= 0.5", "score * 7 - floor(score * 7) >= 0.5")


@query("met_fbeta", f"WITH {_SETS} SELECT s1_id, round(f05, 6) AS f05 FROM f")
def _(spark, sf_dir):
    got = metrics.compared(*_sets(spark, sf_dir))
    return got.select("s1_id", F.round(metrics.fbeta_half(F.col("tp"), F.col("n_pred"), F.col("n_true")), 6).alias("f05"))


@query("met_matching", f"""WITH {_SETS} SELECT round(avg(f05), 6) AS macro_f05, count(*)::BIGINT AS n_entities, round(avg(CASE WHEN p > 0 THEN tp / p WHEN n = 0 THEN 1.0 ELSE 0.0 END), 6) AS mean_precision, round(avg(CASE WHEN n > 0 THEN tp / n ELSE 1.0 END), 6) AS mean_recall,
  count(*) FILTER (tp = p AND tp = n)::BIGINT AS exact_sets, count(*) FILTER (n = 0)::BIGINT AS singleton_total, count(*) FILTER (n = 0 AND p = 0)::BIGINT AS singleton_correct, sum(p)::BIGINT AS predicted_ids, sum(n)::BIGINT AS true_ids FROM f""")
def _(spark, sf_dir):
    got = metrics.score_matching(*_sets(spark, sf_dir))
    return got.withColumns({c: F.round(c, 6) for c in ("macro_f05", "mean_precision", "mean_recall")})


@query("met_blocking", sql("""SELECT round(CASE WHEN sum(n) = 0 THEN 1.0 ELSE sum(tp) / sum(n) END, 6) AS pair_completeness, round(avg((tp = n)::INT), 6) AS entities_full_recall, round(avg(p), 6) AS avg_candidates, max(p)::BIGINT AS max_candidates, sum(p)::BIGINT AS total_candidates,
  (count(*) * (SELECT sum(n) FROM size))::BIGINT AS search_space, round(sum(p) / (count(*) * (SELECT sum(n) FROM size)), 6) AS reduction_ratio, round(avg(CASE WHEN n = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / n) / (0.25 + tp / n) END), 6) AS ceiling_f05
FROM (SELECT id, count(DISTINCT e.cand_id) AS n, count(DISTINCT c.cand_id) AS p, count(DISTINCT CASE WHEN e.cand_id = c.cand_id THEN e.cand_id END) AS tp FROM prep LEFT JOIN edges e ON e.s1_id = id LEFT JOIN cand c ON c.s1_id = id WHERE id LIKE 'S1-%' GROUP BY id)""", "cand", "edges", "size"))
def _(spark, sf_dir):
    cands, s1, pool, _ = found(spark, sf_dir)
    n = cands.groupBy("s1_id").agg(F.count("*").alias("n_pred")).join(hits(cands, s1, pool).groupBy("s1_id").agg(F.count("*").alias("tp")), "s1_id", "left")
    counts = true_sizes(s1, pool).join(n, "s1_id", "left").na.fill(0, ["n_pred", "tp"])
    got = metrics.blocking_scores(counts, pool.count())
    return got.withColumns({c: F.round(c, 6) for c in ("pair_completeness", "entities_full_recall", "avg_candidates", "reduction_ratio", "ceiling_f05")})


@query("val_rules", "SELECT * FROM (VALUES ('a row for each record', 0::BIGINT), ('no other rows', 0), ('no repeats in a list', 0), ('matches are candidates', 0), ('a candidate matches once', 0)) AS v(rule, violations)")
def _(spark, sf_dir):
    """A whole run of the scorer and assignment, held against the invariants."""
    t, s1, _ = scored(spark, sf_dir)
    ids = s1.select(F.col("entity_id").alias("s1_id"))
    lists = t.groupBy("s1_id").agg(F.collect_list("cand_id").alias("ids"))
    return files.validate(written(assign.assign(t, 0.5, ids), "matches"), lists, s1)


@query("val_violations", """WITH m AS (SELECT 'S1-' || o_custkey AS s1_id, 'S2-' || (o_orderkey % 7) AS c FROM orders), s AS (SELECT 'S1-' || c_custkey AS s1_id FROM customer WHERE c_nationkey < 12), d AS (SELECT DISTINCT s1_id, c FROM m)
SELECT 'a row for each record' AS rule, count(*)::BIGINT AS violations FROM s WHERE s1_id NOT IN (SELECT s1_id FROM m) UNION ALL SELECT 'no other rows', count(DISTINCT s1_id) FROM m WHERE s1_id NOT IN (SELECT s1_id FROM s)
UNION ALL SELECT 'no repeats in a list', count(*) FROM (SELECT s1_id FROM m GROUP BY s1_id HAVING count(DISTINCT c) < count(*)) UNION ALL SELECT 'matches are candidates', count(*) FROM m WHERE c > 'S2-3'
UNION ALL SELECT 'a candidate matches once', count(*) FROM (SELECT c FROM m GROUP BY c HAVING count(*) > 1)""")
def _(spark, sf_dir):
    """The same rules on lists that break them."""
    m = views.table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("S1-"), "o_custkey").alias("s1_id")).agg(F.collect_list(F.concat(F.lit("S2-"), F.col("o_orderkey") % 7)).alias("ids"))
    s1 = views.table(spark, sf_dir, "customer").where("c_nationkey < 12").select(F.concat(F.lit("S1-"), "c_custkey").alias("entity_id"))
    return files.validate(m, m.select("s1_id", F.filter("ids", lambda c: c <= "S2-3").alias("ids")), s1)


@query("agg_run_totals", sql("SELECT count(DISTINCT s1_id)::BIGINT AS records, count(*)::BIGINT AS candidates, round(count(*) / (SELECT count(*) FROM prep WHERE id LIKE 'S1-%'), 6) AS per_record FROM cand", "cand"))
def _(spark, sf_dir):
    cands, s1, *_ = found(spark, sf_dir)
    return cands.agg(F.count_distinct("s1_id").alias("records"), F.count("*").alias("candidates")).withColumn("per_record", F.round(F.col("candidates") / F.lit(s1.count()), 6))


# --- mining and tuning ----------------------------------------------------------------------------------


def _found_pairs(spark, sf_dir):
    """The best candidate of each record stands in for a label, so that the sides differ."""
    r = views.records(spark, sf_dir)
    s1, pool = views.sides(r)
    best = found(spark, sf_dir)[0].where("rank = 0").select("s1_id", "cand_id")
    return mining.pairs(best, s1, pool), s1, best


@query("mine_subst", sql("SELECT least(x[1], y[1]) AS a, greatest(x[1], y[1]) AS b, count(*)::BIGINT AS n FROM diffs WHERE len(x) = 1 AND len(y) = 1 GROUP BY 1, 2", "diffs"))
def _(spark, sf_dir):
    return mining.substitutions(mining.differences(_found_pairs(spark, sf_dir)[0]))


@query("mine_phrases", sql("SELECT single, w1, w2, count(*)::BIGINT AS n FROM (SELECT x[1] AS single, y[1] AS w1, y[2] AS w2 FROM diffs WHERE len(x) = 1 AND len(y) = 2 UNION ALL SELECT y[1], x[1], x[2] FROM diffs WHERE len(y) = 1 AND len(x) = 2) GROUP BY 1, 2, 3", "diffs"))
def _(spark, sf_dir):
    return mining.phrase_counts(mining.differences(_found_pairs(spark, sf_dir)[0]))


@query("mine_droppable", sql("SELECT token, count(*)::BIGINT AS n FROM (SELECT unnest(CASE WHEN len(x) = 0 THEN y ELSE x END) AS token FROM diffs WHERE f = 'name' AND (len(x) = 0) <> (len(y) = 0)) GROUP BY token", "diffs"))
def _(spark, sf_dir):
    return mining.drop_counts(mining.differences(_found_pairs(spark, sf_dir)[0]))


#: DuckDB measures edits in bytes; letters of two bytes that folding leaves become one.
_TWO_BYTES = "ßœæøþðđłı"


def _related_sql(a: str, b: str) -> str:
    inside = lambda x, y: f"(length({x}) <= length({y}) AND regexp_full_match({y}, '.*' || array_to_string(string_split({x}, ''), '.*') || '.*'))"
    one = lambda x: f"translate({x}, '{_TWO_BYTES}', '{'!$%*+<=>@'}')"
    return f"({inside(a, b)} OR {inside(b, a)} OR (abs(length({a}) - length({b})) <= 2 AND least(length({a}), length({b})) >= 4 AND levenshtein({one(a)}, {one(b)}) <= 2))"


@query("mine_related", sql(f"SELECT a, b, {_related_sql('a', 'b')} AS related FROM (SELECT DISTINCT least(p, q) AS a, greatest(p, q) AS b FROM (SELECT unnest(x) AS p, y FROM diffs WHERE f = 'name'), LATERAL (SELECT unnest(y) AS q))", "diffs"))
def _(spark, sf_dir):
    """Every token that one name of a found pair has alone against every one that the other has alone."""
    d = mining.differences(_found_pairs(spark, sf_dir)[0]).where("field = 'name'").select(F.explode("x").alias("p"), "y").select("p", F.explode("y").alias("q"))
    rows = d.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    return rows.select("a", "b", tokens.related(F.col("a"), F.col("b")).alias("related"))


@query("mine_related_substitutions", sql(f"SELECT a, b, n, {_related_sql('a', 'b')} AS related FROM (SELECT least(x[1], y[1]) AS a, greatest(x[1], y[1]) AS b, count(*)::BIGINT AS n FROM diffs WHERE len(x) = 1 AND len(y) = 1 GROUP BY 1, 2)", "diffs"))
def _(spark, sf_dir):
    return mining.related_pairs(mining.substitutions(mining.differences(_found_pairs(spark, sf_dir)[0])))


@query("mine_expansions", sql(rf"""SELECT token, string_agg(alt, ' ' ORDER BY alt) AS alternates FROM (SELECT DISTINCT unnest([a, b]) AS token, unnest([b, a]) AS alt FROM (SELECT least(x[1], y[1]) AS a, greatest(x[1], y[1]) AS b FROM diffs WHERE len(x) = 1 AND len(y) = 1)
  WHERE NOT regexp_full_match(a, '\d+') AND NOT regexp_full_match(b, '\d+') AND {_related_sql("a", "b")}) GROUP BY token""", "diffs"))
def _(spark, sf_dir):
    got = mining.expansion_edges(mining.substitutions(mining.differences(_found_pairs(spark, sf_dir)[0])), 1)
    return got.select("token", _join("alternates").alias("alternates"))


@query("mine_droppable_thresholds", "WITH l AS (SELECT split_part(p_name, ' ', 1) AS token, l_quantity > 40 AS more FROM lineitem JOIN part ON p_partkey = l_partkey), n AS (SELECT token, count(*) AS n FROM l WHERE more GROUP BY token), s AS (SELECT token, count(*) AS seen FROM l WHERE NOT more GROUP BY token) SELECT token FROM n LEFT JOIN s USING (token) WHERE n >= 200 AND n / greatest(coalesce(seen, 0), 1) > 0.25")
def _(spark, sf_dir):
    """Tokens that one side has on top, often enough and often enough among the names that have them."""
    li = views.table(spark, sf_dir, "lineitem").join(views.table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    token = F.substring_index("p_name", " ", 1)
    diffs = li.where("l_quantity > 40").select(F.lit("name").alias("field"), F.array().cast("array<string>").alias("x"), F.array(token).alias("y"))
    seen = li.where("l_quantity <= 40").groupBy(token.alias("token")).agg(F.count("*").alias("seen"))
    return mining.droppable(mining.drop_counts(diffs), seen, 200, 0.25)


_LETTERS = "अआइईउऊएऐओऔकखगघचछजझटठडढतथदध"


@query("mine_translit", f"""WITH t AS (SELECT translate(split_part(p_name, ' ', 1), 'abcdefghijklmnopqrstuvwxyz', '{_LETTERS}') AS token, CASE WHEN l_linenumber % 3 = 0 THEN split_part(p_name, ' ', 1) || 'a' WHEN l_linenumber % 3 = 1 THEN split_part(p_name, ' ', 1) ELSE reverse(split_part(p_name, ' ', 1)) END AS latin FROM lineitem JOIN part ON p_partkey = l_partkey),
c AS (SELECT token, latin, count(*) AS n FROM t GROUP BY token, latin) SELECT token, latin FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY n DESC, latin) AS r FROM c) WHERE r = 1 AND n >= 15""")
def _(spark, sf_dir):
    """The most frequent Latin spelling of each word of another script."""
    li = views.table(spark, sf_dir, "lineitem").join(views.table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    word, k = F.substring_index("p_name", " ", 1), F.col("l_linenumber") % 3
    latin = F.when(k == 0, F.concat(word, F.lit("a"))).when(k == 1, word).otherwise(F.reverse(word))
    found = li.select(F.array(latin).alias("n1"), F.array(F.translate(word, "abcdefghijklmnopqrstuvwxyz", _LETTERS)).alias("n2"), F.lit(True).alias("foreign"))
    return mining.transliterations(found)


@query("mine_expansion_thresholds", rf"""SELECT token, string_agg(alt, ' ' ORDER BY alt) AS alternates FROM (SELECT DISTINCT unnest([a, b]) AS token, unnest([b, a]) AS alt FROM (
  SELECT least(x, y) AS a, greatest(x, y) AS b, count(*) AS n FROM (SELECT split_part(p_name, ' ', 1) AS x, substr(split_part(p_name, ' ', 1), 1, (1 + l_linenumber)::INTEGER) AS y FROM lineitem JOIN part ON p_partkey = l_partkey) WHERE x <> y GROUP BY 1, 2)
  WHERE n >= 40 AND {_related_sql("a", "b")}) GROUP BY token""")
def _(spark, sf_dir):
    """Words and their beginnings that stand for one another 40 times or more."""
    li = views.table(spark, sf_dir, "lineitem").join(views.table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    word = F.substring_index("p_name", " ", 1)
    short = F.substring(word, F.lit(1), (F.col("l_linenumber") + 1).cast("int"))
    diffs = li.where(word != short).select(F.lit("addr").alias("field"), F.array(word).alias("x"), F.array(short).alias("y"))
    return mining.expansion_edges(mining.substitutions(diffs)).select("token", _join("alternates").alias("alternates"))


def _shortlist(spark, sf_dir, source=views.records):
    """(masses of the shortlists of 200 that hold a true pair, the true pairs among them, source 1, pool)."""
    best, s1, pool, w = found(spark, sf_dir, source, texts=False, config=replace(CONFIG, top_k=200))
    met = written(hits(best, s1, pool), "hits")
    return tuning.masses(tuning.judged(best.drop("rank"), met), s1, pool, w), met, s1, pool


def _variants_sql(chars: bool = False) -> str:
    def field(f: str, overlap: str, pen: float) -> str:
        v = {"cover": "i_{0} / b_{0}", "cosine": "i_{0} / sqrt(b_{0} * c_{0})", "dice": "2.0 * i_{0} / (b_{0} + c_{0})"}[overlap].format(f) + (f" / pow(c_{f}, {pen})" if pen else "")
        return f"CASE WHEN i_{f} > 0 AND b_{f} > 0 AND c_{f} > 0 THEN {v} ELSE 0.0 END"

    made = {"keys": "block_score"} | {n: " + ".join([f"{w} * ({field(k, f.overlap, f.penalty)})" for k, w in f.weights.items()] + [f"{f.keys} * block_score"]) for n, f in tuning.FORMULAS.items()}
    if chars:
        made |= {f"keys_csim_{w}": f"block_score + {w} * csim" for w in tuning.BLENDS} | {"csim": "csim"}
    rows = " UNION ALL ".join(f"SELECT '{n}' AS variant, s1_id, cand_id, round({e}, 9) AS score FROM masses" for n, e in made.items())
    own = lambda f, side: f"coalesce((SELECT mass FROM sums q WHERE q.id = s.{side} AND q.f = '{f}'), 0)"
    both = lambda f: f"coalesce((SELECT mass FROM both2 q WHERE q.s1_id = s.s1_id AND q.cand_id = s.cand_id AND q.f = '{f}'), 0)"
    m = ", ".join(f"{both(f)} AS i_{f}, {own(f, 's1_id')} AS b_{f}, {own(f, 'cand_id')} AS c_{f}" for f in "nwd")
    csim = f"""named AS MATERIALIZED (SELECT s1_id, cand_id, array_to_string(list_sort(a.names), ' ') AS x, array_to_string(list_sort(b.names), ' ') AS y FROM short JOIN prep a ON a.id = s1_id JOIN prep b ON b.id = cand_id),
alike AS MATERIALIZED (SELECT x, y, {_indel("x", "y")} AS csim FROM (SELECT DISTINCT x, y FROM named)),""" if chars else ""
    return f"""short AS MATERIALIZED (SELECT * FROM ranked WHERE rank < 200), {csim}
both2 AS MATERIALIZED (SELECT c.s1_id, c.cand_id, x.f, sum(w.idf) AS mass FROM short c JOIN each x ON x.id = c.s1_id JOIN each y ON y.id = c.cand_id AND y.f = x.f AND y.token = x.token JOIN w ON w.country = x.country AND w.token = x.token GROUP BY c.s1_id, c.cand_id, x.f),
masses AS MATERIALIZED (SELECT s.s1_id, s.cand_id, s.block_score, {"csim, " if chars else ""}{m} FROM short s{" JOIN named USING (s1_id, cand_id) JOIN alike USING (x, y)" if chars else ""})
SELECT variant, count(e.s1_id)::BIGINT AS found, (SELECT count(*) FROM edges)::BIGINT AS pairs, round(count(e.s1_id) / greatest((SELECT count(*) FROM edges), 1), 6) AS recall FROM (
  SELECT *, row_number() OVER (PARTITION BY variant, s1_id ORDER BY score DESC, cand_id) AS r FROM ({rows})) v LEFT JOIN edges e ON e.s1_id = v.s1_id AND e.cand_id = v.cand_id AND v.r <= 20 GROUP BY variant"""


@query("tune_variants", sql(", " + _variants_sql(), "ranked", "each", "w", "sums", "edges"))
def _(spark, sf_dir):
    rows, met, s1, pool = _shortlist(spark, sf_dir)
    return tuning.compare(rows, met, 20, pairs=true_pairs(s1, pool), slices=SLICES).withColumn("recall", F.round("recall", 6))


def _blends(spark, sf_dir, source) -> DataFrame:
    rows, met, s1, pool = _shortlist(spark, sf_dir, source)
    got = tuning.compare(tuning.with_char_similarity(rows, s1, pool), met, 20, True, pairs=true_pairs(s1, pool), slices=SLICES)
    return got.withColumn("recall", F.round("recall", 6))


@query("tune_char_blends")
def _(spark, sf_dir):
    """The same with the blends of a fuzzy measure."""
    return _blends(spark, sf_dir, views.records)


@query("tune_char_blends_parts", sql(", " + _variants_sql(True), "ranked", "each", "w", "sums", "edges", "prep", source="goods"))
def _(spark, sf_dir):
    """The blends over the parts' short names, where SQL has the fuzzy measure too."""
    return _blends(spark, sf_dir, views.goods)


@query("lim_sample", "SELECT doc_id FROM documents ORDER BY md5(doc_id || '17'), doc_id::VARCHAR LIMIT 100")
def _(spark, sf_dir):
    rows = views.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"))
    return mining.by_hash(rows, "id", 100).select(F.col("id").cast("long").alias("doc_id"))


@query("rules_roundtrip", "SELECT * FROM (VALUES (7::BIGINT, 4::BIGINT, 2::BIGINT, 0::BIGINT)) AS v(droppable, expansions, phrases, translit)")
def _(spark, sf_dir):
    path = fresh_path(spark, "rules")
    RULES.save(spark, path)
    got = RuleSet.load(spark, path)
    return spark.range(1).select(*[F.lit(len(v)).cast("long").alias(k) for k, v in (("droppable", got.droppable), ("expansions", got.expansions), ("phrases", got.phrases), ("translit", got.translit))])


# --- jobs -----------------------------------------------------------------------------------------------


@query("cli_predict", sql("SELECT id AS s1_id, count(cand_id)::BIGINT AS candidates, 0::BIGINT AS strange, 0::BIGINT AS repeated FROM prep LEFT JOIN cand ON s1_id = id WHERE id LIKE 'S1-%' GROUP BY id", "cand", source="goods"))
def _(spark, sf_dir):
    """The jobs in turn over files: a data set, a model with its threshold, and both output lists, read back and held
    against one another: candidates of each record, matches that are none of them, and matches that it or another has already."""
    catalog, out = _catalog(spark, sf_dir, views.goods), fresh_path(spark, "jobs")
    jobs.make_dataset(spark, catalog, RULES, f"{out}/set", config=CONFIG)
    jobs.train(spark, [f"{out}/set"], f"{out}/trained", rounds=5)
    jobs.predict(spark, catalog, RULES, f"{out}/trained", f"{out}/got", config=CONFIG)
    read = lambda what: spark.read.csv(f"{out}/got/{what}", sep="\t", header=True, quote="").toDF("s1_id", "ids").select("s1_id", F.filter(F.split(F.coalesce("ids", F.lit("")), ","), lambda x: x != "").alias("ids"))
    cands, matches = read("candidate_pairs").withColumnRenamed("ids", "c"), read("matching_results").withColumnRenamed("ids", "m")
    taken = matches.select("s1_id", F.explode("m").alias("x")).groupBy("x").agg(F.count("*").alias("n"), F.min("s1_id").alias("s1_id")).where("n > 1").groupBy("s1_id").agg(F.count("*").alias("twice"))
    strange = F.size(F.array_except("m", "c")).cast("long")
    repeated = F.coalesce("twice", F.lit(0).cast("long")) + F.size("m") - F.size(F.array_distinct("m"))
    return cands.join(matches, "s1_id", "full_outer").join(taken, "s1_id", "left").select("s1_id", F.size("c").cast("long").alias("candidates"), strange.alias("strange"), repeated.cast("long").alias("repeated"))


@query("asg_exclusive_sweep", f"""WITH {_TRIPLES}, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY score DESC, s1_id, cand_id) AS k FROM t WHERE score >= 0.05) WHERE k = 1), g AS (SELECT unnest([{', '.join(map(str, tuning.GRID))}]) AS th),
  c AS (SELECT th, s1_id, count(b.cand_id) AS n, count(CASE WHEN b.score >= th THEN 1 END) AS p FROM g CROSS JOIN (SELECT DISTINCT s1_id FROM t) LEFT JOIN best b USING (s1_id) GROUP BY th, s1_id)
SELECT th::DOUBLE AS threshold, round(avg(CASE WHEN n = 0 THEN 1.0 WHEN p = 0 THEN 0.0 ELSE 1.25 * (p / n) / (0.25 + p / n) END), 6) AS macro_f05 FROM c GROUP BY th""")
def _(spark, sf_dir):
    """A sweep under one-to-one assignment, with the claims that win at the lowest threshold as the truth."""
    t = written(triples(spark, sf_dir), "triples")
    won = written(assign.one_to_one(t, min(tuning.GRID), None, {"S2": 50, "S3": 50}), "won")
    got = tuning.curve(t, files.every_record(t.select(F.col("s1_id").alias("entity_id")).distinct(), won.groupBy("s1_id").agg(F.collect_list("cand_id").alias("ids"))), caps={"S2": 50, "S3": 50})
    return got.select("threshold", F.round("macro_f05", 6).alias("macro_f05"))
