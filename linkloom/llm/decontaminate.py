"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Texts are lower-cased, ASCII punctuation goes, and the five-word shingles of what is left are hashed. An item of fewer
words is one shingle, its whole sequence; documents then have the shingles of that many words as well, so it is found
wherever it stands word by word. Items are
partitioned by the size of their shingle set (powers of two). An item's MinHash sketch is its k least hashes, and k
follows from its partition: with at most u shingles, an item that a document contains to ``least`` misses at most
``u - ceil(least u)`` of them, so of one more least hashes at least one is in the document. The search looks the
documents' shingles up among the sketches; only documents that hit are shingled again and compared with the item's
whole set. No contained item is lost, and the long document's size plays no part.

All of it is DataFrame operations. The sketches are broadcast while they have at most ``BROADCAST_ROWS`` rows;
beyond, the same join is left to Spark's shuffle joins.

Defined cases: null texts and texts without a word (item or document) have no shingle and match nothing; a very short item
is found in every document that has its words in a row, so a one-word item matches all documents with that word;
repeated rows of a document or item are compared each and count once; null ids are kept apart as ids of their own
in the search but name no row of ``contained``; extra columns are ignored, or kept by ``clean``; an empty benchmark
matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WORDS, LEAST = 5, 0.8
BROADCAST_ROWS = 1_000_000
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _words(rows: DataFrame) -> DataFrame:
    """Adds ``w``, the words; rows without one go."""
    plain = F.translate(F.lower("text"), _MARKS, "")
    w = F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    return rows.where("text is not null").withColumn("w", w).where(F.size("w") > 0)


def _runs(n: int) -> Column:
    """The hashes of all runs of n words of ``w``; a descending sequence would not be empty, so none where w is shorter."""
    some = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - (n - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, n)))
    return F.when(F.size("w") >= n, some).otherwise(F.array().cast("array<bigint>"))


def _shingled(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """Adds ``h``, a row for each run of as many words as any of ``sizes``."""
    runs = [_runs(n) for n in sizes] or [F.array().cast("array<bigint>")]
    return _words(rows).select(*rows.columns, F.explode(runs[0] if len(runs) == 1 else F.concat(*runs)).alias("h"))


def item_sketches(items: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """(item, words, size, hashes, set_id, sketch) of each distinct item; ``items``: item_id, text. ``words``: those of a shingle."""
    rows = _words(items.select(F.col("item_id").alias("item"), "text").distinct())
    own = F.when(F.size("w") < words, F.array(F.xxhash64("w"))).otherwise(_runs(words))
    sets = rows.select("item", F.least(F.size("w"), F.lit(words)).alias("words"), F.array_sort(F.array_distinct(own)).alias("hashes"))
    upper = F.pow(F.lit(2.0), F.floor(F.log2(F.size("hashes").cast("double"))) + 1) - 1
    k = (upper - F.ceil(upper * least) + 1).cast("int")
    return sets.select("item", "words", F.size("hashes").alias("size"), "hashes", F.expr("xxhash64(hashes)").alias("set_id"), k.alias("k")).withColumn("sketch", F.slice("hashes", 1, F.least("k", "size")))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast where a count proves it small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def contained(docs: DataFrame, items: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """(doc_id, tag, item_id, n_shared, n_shingles): items that a document contains to ``least`` or more. ``tag`` is
    the text's hash, which tells rows of one id apart."""
    known = common.written(item_sketches(items, words, least), "item-sketches")
    sizes = sorted(r["words"] for r in known.select("words").distinct().collect())  # 1 to ``words``
    rows = docs.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    probe = known.select("item", "set_id", F.explode("sketch").alias("h"))
    hits = _shingled(rows, sizes).select("doc_id", "tag", "h").join(_small(probe), "h").groupBy("doc_id", "tag").agg(F.collect_set("set_id").alias("sets"))
    hits = common.written(hits, "sketch-hits")
    met = _again(rows, hits)
    whole = known.select("item", "set_id", "size", F.explode("hashes").alias("h"))
    shared = _shingled(met, sizes).join(_small(whole), "h").where(F.array_contains("sets", F.col("set_id")))
    exact = shared.groupBy("doc_id", "tag", "item", "set_id", "size").agg(F.count_distinct("h").alias("n"))
    return exact.where(F.col("n") >= F.ceil(F.col("size") * least)).select("doc_id", "tag", F.col("item").alias("item_id"), F.col("n").alias("n_shared"), F.col("size").cast("long").alias("n_shingles"))


def _again(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows that hit, with the sets they may contain."""
    h = hits.select(F.col("doc_id").alias("hd"), F.col("tag").alias("ht"), "sets")
    return rows.join(h, rows["doc_id"].eqNullSafe(h["hd"]) & (rows["tag"] == h["ht"])).select("doc_id", "tag", "sets", "text")


def clean(docs: DataFrame, items: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """The documents that contain no item, all columns as they are."""
    bad = contained(docs.select("doc_id", "text"), items, words, least).select(F.col("doc_id").alias("__d"), F.col("tag").alias("__t")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__d"]) & (F.xxhash64(docs["text"]) == bad["__t"]), "left_anti")


def query(spark, sf_dir):
    """op6: every document and the items it contains."""
    got = contained(common.documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    best = got.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_shared", "n_shingles")).alias("m"))
    return best.select("doc_id", "item_id", F.col("m.n_shared").alias("n_shared"), F.col("m.n_shingles").alias("n_shingles"), F.round(F.col("m.n_shared") / F.col("m.n_shingles"), 6).alias("containment"))


_MARKS_SQL = _MARKS.replace("'", "''")
_WORDS_SQL = rf"list_filter(regexp_split_to_array(translate(lower(text), '{_MARKS_SQL}', ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
ORACLE = f"""
WITH i AS (
  SELECT item_id, w, least(len(w), 5) AS n FROM (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0
), d AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM (SELECT doc_id, {_WORDS_SQL} AS w FROM documents), (SELECT DISTINCT n FROM i))
), b AS (
  SELECT DISTINCT item_id, array_to_string(w[k:k + n - 1], ' ') AS s FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM i)
), n AS (
  SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id
)
SELECT doc_id, item_id, count(*)::BIGINT AS n_shared, n_shingles::BIGINT AS n_shingles, round(count(*) / n_shingles, 6) AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles
HAVING count(*) >= ceil(n_shingles * 0.8)
"""
