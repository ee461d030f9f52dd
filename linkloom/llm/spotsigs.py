"""Document fingerprints by SpotSigs.

A spot is a common function word; its signature is the word and the chain of the next ``CHAIN`` content words (those
that are not common). A document's fingerprint is the set of its signatures, 32 bits each, sorted and written in
base64; two fingerprints are as alike as their sets' Jaccard similarity. A text without a common word takes every word for a spot, and a chain that the text's end cuts short
counts as it is.

``near_classes`` finds all near duplicates: sets are partitioned by length, as the shorter set's share of the longer
bounds the similarity, so a set meets only those of its own partition and the next; within them sets meet by inverted
lists of their rarest signatures, of which two sets alike enough share one. Whatever meets is tested exactly, and links
become classes. Copies with equal fingerprints are one set; the pairs of a group of near copies grow with its square.

Defined cases: null text is empty; a text without words has the empty fingerprint; two empty fingerprints are alike
to 1, an empty and another to 0; equal texts have equal fingerprints; ``fingerprints`` keeps
other columns as they are, but replaces one named ``fingerprint``; elsewhere other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

CHAIN = 2
#: Common function words of English, French, German and Spanish.
COMMON = (
    "a an and are as at be by for from has he in is it of on or that the this to was were will with "
    "au aux avec ce ces dans de des du elle en est et il la le les leur mais ou par pas pour que qui se son sur un une "
    "als auf aus bei das dem den der des die ein eine er es für im in ist mit nicht sich sie und von war zu "
    "al como con de del el en es esta la las lo los no para pero por que se su un una y"
)
_common = None


def _spots() -> np.ndarray:
    global _common
    if _common is None:
        u = np.frombuffer(COMMON.encode(), np.uint8)
        _common = np.unique(common.word_hashes(u, *common.word_spans(u, "alnum")))
    return _common


def signatures(text: str) -> np.ndarray:
    """The sorted set of the text's signatures."""
    u = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    h = common.word_hashes(u, *common.word_spans(u, "alnum"))
    if not len(h):
        return np.zeros(0, np.uint32)
    spots = _spots()
    at = np.minimum(np.searchsorted(spots, h), len(spots) - 1)
    is_spot = spots[at] == h
    if is_spot.any():
        content, spot = np.flatnonzero(~is_spot), np.flatnonzero(is_spot)
        k = np.searchsorted(content, spot)  # the first content word after each spot
    else:
        content, spot = np.arange(len(h)), np.arange(len(h))
        k = spot + 1
    chain = np.concatenate([h[content], np.zeros(CHAIN, np.uint64)])
    sig = h[spot]
    for j in range(CHAIN):
        sig = sig * np.uint64(0xA24BAED4963EE407) + chain[np.minimum(k + j, len(chain) - 1)]
    return np.unique((common.mix64(sig) >> np.uint64(32)).astype(np.uint32))


def written_form(sigs: np.ndarray) -> str:
    return base64.b64encode(sigs.astype("<u4").tobytes()).decode()


def read_form(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 if it is below ``least``, which their lengths may show alone."""
    if not len(a) and not len(b):
        return 1.0
    small, large = sorted((len(a), len(b)))
    if small == 0 or small < least * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    got = both / (small + large - both)
    return got if got >= least else 0.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """Adds ``fingerprint`` to ``docs`` (text among the columns)."""
    common.small_batches(docs.sparkSession)
    made = lambda texts: [pa.array([written_form(signatures(t or "")) for t in texts], pa.string())]
    return common.with_added(docs, F.col("text"), made, "fingerprint string")


# --- near duplicates ------------------------------------------------------------------------------------


def alike(sets: DataFrame, least: float) -> DataFrame:
    """(a, b, likeness): all pairs of ``sets`` (g long, sigs array<long> without repeats) that are alike to ``least``
    (over 0) or more, the shorter first (ties: the lesser g). Empty sets are alike to none."""
    n = F.size("sigs")
    sets = common.written(sets.where(n > 0).select("g", "sigs", n.alias("n")), "spot-sets")
    each = sets.select("g", "n", F.explode("sigs").alias("sig"))
    ranked = each.join(each.groupBy("sig").agg(F.count("*").alias("df")), "sig").groupBy("g", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("s"))
    prefix = (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int")
    step = math.log(1 / least) if least < 1 else math.inf
    part = lambda c: F.floor(c / step + 1e-9).cast("int")
    size = F.log(F.col("n").cast("double"))
    rare = ranked.select("g", "n", F.explode(F.slice("s", 1, F.least(prefix, F.col("n")))).alias("x"), part(size).alias("part"), (part(size + step) if least < 1 else part(size)).alias("last"))
    rare = common.written(rare.select("g", "n", F.col("x.sig").alias("sig"), "part", "last"), "spot-lists")
    short = rare.select("sig", F.col("g").alias("a"), F.col("n").alias("na"), F.explode(F.sequence("part", "last")).alias("part"))
    long = rare.select("sig", F.col("g").alias("b"), F.col("n").alias("nb"), "part")
    met = short.join(long, ["sig", "part"]).where((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    met = met.where(F.col("na") >= F.col("nb") * least - 1e-9).select("a", "b").distinct()
    side = lambda c: sets.select(F.col("g").alias(c), F.col("sigs").alias(f"s{c}"))
    both = F.size(F.array_intersect("sa", "sb"))
    got = met.join(side("a"), "a").join(side("b"), "b").select("a", "b", (both / (F.size("sa") + F.size("sb") - both)).alias("likeness"))
    return got.where(F.col("likeness") >= least)


def near_classes(docs: DataFrame, least: float = 0.6) -> DataFrame:
    """(doc_id, fingerprint, component_id): the least doc_id of all that links of likeness ``least`` or more reach."""
    made = fingerprints(docs.select("doc_id", "text")).select("doc_id", "fingerprint", F.xxhash64("fingerprint").alias("g"))
    made = common.written(made, "spotsigs")

    def run(batches):
        for b in batches:
            sigs = [read_form(x).astype(np.int64) for x in b.column("fingerprint").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("g"), pa.array(sigs, pa.list_(pa.int64()))], ["g", "sigs"])

    groups = made.groupBy("g").agg(F.first("fingerprint").alias("fingerprint"))
    roots = components(alike(groups.mapInArrow(run, "g long, sigs array<long>"), least))
    named = made.join(roots.withColumnRenamed("node", "g"), "g", "left").withColumn("root", F.coalesce("root", "g"))
    return named.join(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("doc_id", "fingerprint", "component_id")


# --- each document and the next ---------------------------------------------------------------------------


def _bucket(c: Column, bounds: list[int], low: int = 1) -> Column:
    """How many bounds are at most ``c``, plus ``low``: a balanced tree of comparisons."""
    if not bounds:
        return F.lit(low)
    k = len(bounds) // 2
    return F.when(c < bounds[k], _bucket(c, bounds[:k], low)).otherwise(_bucket(c, bounds[k + 1 :], low + k + 1))


def with_next(docs: DataFrame) -> DataFrame:
    """(target, tail, doc_id, tie, text), dealt and sorted so that within a target each row's next is its next document,
    by descending doc_id (nulls last; ties by text hash). Ids are cut into ranges; the first row of each range also
    goes, as ``tail``, to the end of the range before it. Only the ranges' bounds and first ids reach the driver."""
    spark = docs.sparkSession
    parts = common.least_tasks(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0]
    bounds = sorted(set(cuts or []))
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(_bucket(F.col("doc_id"), bounds)))
    first = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", F.negative(F.col("tie").cast("decimal(20,0)")).alias("t"))).alias("m"))
    order = sorted(((r["bucket"], r["m"]["doc_id"], int(-r["m"]["t"])) for r in first.collect()), reverse=True)  # a row a range
    before = {b: order[i - 1][0] for i, (b, _, _) in enumerate(order)}
    heads = spark.createDataFrame([(b, i, t, before[b]) for b, i, t in order], "bucket int, head_id long, head_tie long, sends_to int")
    met = rows.join(F.broadcast(heads), "bucket")
    own = F.struct(F.col("bucket").alias("target"), F.lit(False).alias("tail"))
    more = F.struct(F.col("sends_to").alias("target"), F.lit(True).alias("tail"))
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    sent = met.select(F.explode(F.when(is_head, F.array(own, more)).otherwise(F.array(own))).alias("to"), "doc_id", "tie", "text")
    return sent.select("to.target", "to.tail", "doc_id", "tie", "text").repartition(parts, "target").sortWithinPartitions("target", "tail", F.desc_nulls_last("doc_id"), "tie")


def edited(docs: DataFrame) -> DataFrame:
    """Of each document: its fingerprint, that of the text whose second half the next document's start replaces, and the
    likeness to that text's and to the next document's."""
    common.small_batches(docs.sparkSession)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches):
        held = None
        for b in batches:
            out = []
            for target, tail, doc, text in zip(*(b.column(c).to_pylist() for c in ("target", "tail", "doc_id", "text")), strict=True):
                if held is not None and held[0] == target:
                    _, old, mine, sigs = held
                    after = signatures(text)
                    half = len(mine) // 2
                    new = mine[: len(mine) - half] + text[:half]
                    changed = signatures(new)
                    out.append((old, len(mine), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), written_form(sigs), written_form(changed), likeness(sigs, changed), likeness(sigs, after)))
                else:
                    after = signatures(text)
                held = None if tail else (target, doc, text, after)
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next(docs).select("target", "tail", "doc_id", "text").mapInArrow(run, schema)


def query(spark, sf_dir):
    """op5: fingerprints of all documents and of their edited texts."""
    return edited(common.documents(spark, sf_dir).select("doc_id", "text"))
