"""Record views over the driver's tables, as frames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import RuleSet

#: Rules for the queries: words of the tables' own prose.
RULES = RuleSet(frozenset({"the", "and", "of", "de", "la", "der", "die"}), {"is": ["was", "are"], "was": ["is"], "est": ["et"], "ist": ["und"]}, {"of the": "ofthe", "to the": "tothe"})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer row groups than there are cores is dealt out to all of them; a larger one is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_id, name, address, country): a document is a record of one of three sources; its first sentence is the
    name and the rest, whole, the address; its language is the country."""
    d = spread(table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text", "lang"))
    name = F.substring_index("text", ".", 1)
    return d.select(
        F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        name.alias("name"), F.substring("text", F.length(name) + 2, F.length("text")).alias("address"), F.coalesce("lang", F.lit("")).alias("country"))


def goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records: few names over many rows, and numbers in the address."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("S"), (F.col("p_partkey") % 3 + 1).cast("string"), F.lit("-"), F.col("p_partkey").cast("string")).alias("entity_id"), F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_brand", "p_type", F.col("p_size").cast("string")).alias("address"), F.substring("p_brand", 1, 7).alias("country"))


def sides(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source 1 and the pool of the others."""
    first = F.startswith("entity_id", F.lit("S1-"))
    return prepared.where(first), prepared.where(~first)


# --- the same in SQL ------------------------------------------------------------------------------------

_PUNCT = " " + "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_PUNCT_SQL = _PUNCT.replace("'", "''")


def norm(x: str) -> str:
    return rf"trim(regexp_replace(lower(translate(strip_accents(regexp_replace({x}, '\s*&\s*', ' and ', 'g')), '{_PUNCT_SQL}', '{' ' * len(_PUNCT)}')), '\s+', ' ', 'g'))"


def toks(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def skeleton(t: str) -> str:
    return rf"(CASE WHEN regexp_full_match({t}, '\d+') OR length(regexp_replace({t}, '[^\p{{L}}]', '', 'g'))::DOUBLE / length({t}) < 0.66 THEN {t} ELSE translate({t}, 'l1j053489672', 'iiioseabggtz') END)"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in sorted(words)) + "]"


_DOCS = """SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS id, split_part(text, '.', 1) AS name,
  substr(text, length(split_part(text, '.', 1)) + 2) AS addr, coalesce(lang, '') AS country FROM documents WHERE text IS NOT NULL"""
_GOODS = """SELECT 'S' || (p_partkey % 3 + 1) || '-' || p_partkey AS id, p_name AS name,
  concat_ws(' ', p_brand, p_type, p_size::VARCHAR) AS addr, substr(p_brand, 1, 7) AS country FROM part"""


def _phrased(t: str) -> str:
    out = f"' ' || array_to_string({t}, '  ') || ' '"
    for k, v in RULES.phrases.items():
        out = f"regexp_replace({out}, ' {k.replace(' ', '  ')} ', ' {v} ', 'g')"
    return toks(out)


SQL = {
    "norms": f"SELECT id, country, {norm('name')} AS nn, {norm('addr')} AS na FROM recs",
    "lists": f"SELECT id, country, nn, na, [{skeleton('t')} FOR t IN {toks('nn')}] AS n0, [{skeleton('t')} FOR t IN {_phrased(toks('na'))}] AS a0 FROM norms",
    "prep": rf"SELECT id, country, nn, na, CASE WHEN len(list_filter(n0, lambda t: NOT list_contains({_list(RULES.droppable)}, t))) > 0 THEN list_filter(n0, lambda t: NOT list_contains({_list(RULES.droppable)}, t)) ELSE n0 END AS names, list_filter(a0, lambda t: NOT regexp_full_match(t, '\d+')) AS words, list_filter(a0, lambda t: regexp_full_match(t, '\d+')) AS nums FROM lists",
    "each": "SELECT DISTINCT country, id, f, token FROM (SELECT country, id, 'n' AS f, unnest(names) AS token FROM prep UNION ALL SELECT country, id, 'w', unnest(words) FROM prep UNION ALL SELECT country, id, 'd', unnest(nums) FROM prep)",
    "df": "SELECT country, token, count(DISTINCT CASE WHEN id NOT LIKE 'S1-%' THEN id END) AS df FROM each GROUP BY country, token",
    "size": "SELECT country, count(*) AS n FROM prep WHERE id NOT LIKE 'S1-%' GROUP BY country",
    "w": "SELECT country, token, df, ln(1.0 + greatest(coalesce(n, 0), 1) / (1.0 + df)) AS idf FROM df LEFT JOIN size USING (country)",
    "top": "SELECT country, max(idf) AS max_idf FROM w GROUP BY country",
    "rare": "SELECT country, id, f, token, df, idf, r FROM (SELECT *, row_number() OVER (PARTITION BY country, id, f ORDER BY CASE WHEN f = 'd' THEN 0 ELSE df END, token) AS r FROM each JOIN w USING (country, token)) WHERE r <= 3",
    "alts": "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{a}', {i})" for k, v in RULES.expansions.items() for i, a in enumerate(sorted(v), 1)) + ") AS x(token, alt, nth)",
    "words3": "SELECT country, id, token, idf FROM rare WHERE f = 'w'",
    "probe_words": """SELECT country, id, token, idf FROM (
      SELECT country, id, token, idf, row_number() OVER (PARTITION BY country, id ORDER BY min(o)) AS r FROM (
        SELECT country, id, token, idf, (0, r, 0) AS o FROM rare WHERE f = 'w' AND id LIKE 'S1-%'
        UNION ALL SELECT x.country, x.id, w.token, w.idf, (1, x.r, alts.nth) FROM rare x JOIN alts USING (token) JOIN w ON w.country = x.country AND w.token = alts.alt WHERE x.f = 'w' AND x.id LIKE 'S1-%')
      GROUP BY country, id, token, idf) WHERE r <= 9""",
    "keys": """SELECT DISTINCT * FROM (
      SELECT country, id, 1 AS fam, n.token AS a, w.token AS b, 3.0 * (n.idf + w.idf) AS wt FROM (SELECT * FROM rare WHERE f = 'n') n JOIN kw w USING (country, id)
      UNION ALL SELECT country, id, 2, d.token, w.token, 3.5 * (d.idf + w.idf) FROM (SELECT * FROM rare WHERE f = 'd') d JOIN kw w USING (country, id)
      UNION ALL SELECT country, id, 3, n.token, d.token, 3.0 * (n.idf + d.idf) FROM (SELECT * FROM rare WHERE f = 'n') n JOIN (SELECT * FROM rare WHERE f = 'd') d USING (country, id)
      UNION ALL SELECT country, id, 4, n.token, m.token, 2.0 * (n.idf + m.idf) FROM (SELECT * FROM rare WHERE f = 'n') n JOIN (SELECT * FROM rare WHERE f = 'n') m USING (country, id) WHERE n.token < m.token
      UNION ALL SELECT country, id, 5, array_to_string(list_sort(names), ' '), '', 4.0 * max_idf FROM prep JOIN top USING (country) WHERE len(names) > 0
      UNION ALL SELECT country, id, 6, unnest(bands), '', 1.2 * max_idf FROM bands JOIN top USING (country))""",
    "kw": "SELECT * FROM probe_words UNION ALL SELECT * FROM words3 WHERE id NOT LIKE 'S1-%'",
    "grams": "SELECT country, id, CASE WHEN length(s) < 3 THEN [s] ELSE [substr(s, i, 3) FOR i IN range(1, length(s) - 1)] END AS g FROM (SELECT country, id, array_to_string(list_sort(list_distinct(names)), ' ') AS s FROM prep WHERE len(names) > 0)",
    "bands": "SELECT country, id, [" + ", ".join(f"'{b}:' || substr(list_min([md5('{2 * b + 1}:' || x) FOR x IN g]), 1, 15) || ':' || substr(list_min([md5('{2 * b + 2}:' || x) FOR x IN g]), 1, 15)" for b in range(4)) + "] AS bands FROM grams",
    "posts": "SELECT country, fam, a, b, id FROM (SELECT *, count(*) OVER (PARTITION BY country, fam, a, b) AS n FROM keys WHERE id NOT LIKE 'S1-%') WHERE n <= 400",
    "met": "SELECT k.country, k.id AS s1_id, p.id AS cand_id, round(sum(k.wt), 9) AS block_score FROM keys k JOIN posts p USING (country, fam, a, b) WHERE k.id LIKE 'S1-%' GROUP BY k.country, k.id, p.id",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY country, s1_id ORDER BY block_score DESC, cand_id) - 1 AS rank FROM met",
    "cand": "SELECT * FROM ranked WHERE rank < 25",
    "same": "SELECT country, id, md5(nn || '|' || na) AS h FROM norms",
    "edges": "SELECT a.id AS s1_id, b.id AS cand_id FROM same a JOIN same b USING (country, h) WHERE a.id LIKE 'S1-%' AND b.id NOT LIKE 'S1-%'",
    "stats": "SELECT s1_id, max(block_score) AS t, avg(block_score) AS m, CASE WHEN stddev_pop(block_score) > 1e-9 THEN stddev_pop(block_score) ELSE 1.0 END AS s, count(*) AS g FROM cand GROUP BY s1_id",
    "sums": "SELECT country, id, f, sum(idf) AS mass, count(*) AS n FROM each JOIN w USING (country, token) GROUP BY country, id, f",
    "shared": "SELECT c.s1_id, c.cand_id, x.f, sum(w.idf) AS mass, count(*) AS n FROM cand c JOIN each x ON x.id = c.s1_id JOIN each y ON y.id = c.cand_id AND y.f = x.f AND y.token = x.token JOIN w ON w.country = x.country AND w.token = x.token GROUP BY c.s1_id, c.cand_id, x.f",
    "best": "SELECT s1_id, cand_id FROM cand WHERE rank = 0",
    "raws": f"SELECT id, {toks('nn')} AS n, {toks('na')} AS a FROM norms",
    "diffs": """SELECT f, list_filter(list_distinct_ordered_p, lambda t: NOT list_contains(q, t)) AS x, list_filter(list_distinct_ordered_q, lambda t: NOT list_contains(p, t)) AS y FROM (
      SELECT *, list_filter(p, lambda t, i: list_position(p, t) = i) AS list_distinct_ordered_p, list_filter(q, lambda t, i: list_position(q, t) = i) AS list_distinct_ordered_q FROM (
        SELECT 'name' AS f, l.n AS p, r.n AS q FROM best JOIN raws l ON l.id = s1_id JOIN raws r ON r.id = cand_id
        UNION ALL SELECT 'addr', l.a, r.a FROM best JOIN raws l ON l.id = s1_id JOIN raws r ON r.id = cand_id)) WHERE len(p) > 0 AND len(q) > 0""",
}
ORDER = "norms lists prep each df size w top rare alts words3 probe_words kw grams bands keys posts met ranked cand same edges stats sums shared best raws diffs".split()
NEEDS = {
    "norms": "", "lists": "norms", "prep": "lists", "each": "prep", "df": "each", "size": "prep", "w": "df size", "top": "w", "rare": "each w", "alts": "", "words3": "rare", "probe_words": "rare alts w", "kw": "probe_words words3",
    "grams": "prep", "bands": "grams", "keys": "rare kw prep top bands", "posts": "keys", "met": "keys posts", "ranked": "met", "cand": "ranked", "same": "norms", "edges": "same", "stats": "cand", "sums": "each w", "shared": "cand each w",
    "best": "cand", "raws": "norms", "diffs": "best raws",
}


def sql(final: str, *names: str, source: str = "docs") -> str:
    """``final`` over the named common table expressions and all that they need; more may follow them after a comma."""
    todo, got = list(names), set()
    while todo:
        n = todo.pop()
        if n not in got:
            got.add(n)
            todo += NEEDS[n].split()
    parts = [f"recs AS ({_DOCS if source == 'docs' else _GOODS})"] + [f"{n} AS MATERIALIZED ({SQL[n]})" for n in ORDER if n in got]
    return "WITH " + ",\n".join(parts) + "\n" + final
