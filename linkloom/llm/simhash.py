"""Near-duplicate documents by SimHash, with pigeonring filtering.

Fingerprint: blocks of 64 bits, each bit set where over half of the text's word shingles have it set in their hash
(XXH64; further blocks mix it again). Two texts link if their fingerprints differ in at most ``radius`` bits a block,
over all blocks together: 3 of 64 with one block, 132 of 768 with twelve, which is where texts lie whose five-word
shingles are about 0.78 alike.

Search. A block is a ring of 8 segments of 8 bits. If two fingerprints differ in at most ``radius`` bits a block, some
block does, and in it there is a segment i from which every chain of l consecutive segments differs in at most
``floor(radius l / 8)`` bits (the pigeonring principle). With radius 3 the budgets are 0, 0, 1, 1, 1, 2, 2, 3: the segments
i and i + 1 are equal, and of i + 2, i + 3, i + 4 at most one differs: 8 starts times 3 choices give 24 keys of 32 bits
by which all partners meet, so the search with one block is exact. With more blocks the same keys find the pairs that
have such a chain in any block, which isn't all of them: README has the recall by similarity. What meets is held
against the chains' budgets, then against the full Hamming distance.

Only distinct fingerprints are searched, in two steps, so that a key that thousands share costs no square:
1. by each key, every fingerprint meets the key's least one (a star), and links make components;
2. where a key's fingerprints still lie in several components, those outside the key's largest component meet all of
   other components. Pairs inside one component can't change it, so no link is lost.

Defined cases: null text counts as empty; a text without words has fingerprint 0, linked like any other; a text of
fewer words than a shingle is one shingle; repeated rows give repeated result rows; a null doc_id is never a
component's name unless all ids of the component are null; rows of one doc_id and unlike texts are told apart; extra
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

SEGMENTS, WIDTH, RADIUS = 8, 8, 3
#: Of edited copies: differing bits allowed a block, blocks, and how many of them are searched at once.
NEAR, BLOCKS, AT_ONCE = 11, 12, 3
#: Constants by which further fingerprints of a text derive their hashes from the first one's.
_SEEDS = [0] + [(0x9E3779B97F4A7C15 * (2 * k + 1)) & ((1 << 64) - 1) for k in range(1, 64)]


def fingerprint(data: bytes | None, words: int = 3, blocks: int = 1) -> int | list[int]:
    """SimHash of one text, given in UTF-8. ``blocks`` over 1: a list of so many independent ones, the first the same."""
    w = data.lower().split() if data else []
    if not w:
        return 0 if blocks == 1 else [0] * blocks
    grams = map(b" ".join, zip(*(w[k:] for k in range(words)), strict=False)) if len(w) >= words else [b" ".join(w)]
    h = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64)
    seeds, counts = np.array(_SEEDS[1:blocks], np.uint64), np.zeros(64 * blocks, np.int64)
    for at in range(0, len(h), 255):  # as many as a byte counts
        first = h[at : at + 255, None]
        part = np.concatenate([first, common.mix64(first ^ seeds)], axis=1) if blocks > 1 else first
        bits = np.unpackbits(np.ascontiguousarray(part).view(np.uint8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.uint8)
    out = np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64).tolist()
    return out[0] if blocks == 1 else out


def fingerprints(docs: DataFrame, words: int = 3, blocks: int = 1) -> DataFrame:
    """(doc_id, fps array<bigint>) of ``docs``' (doc_id, text); a column ``__tie`` goes along."""
    common.small_batches(docs.sparkSession)
    ids = docs.select("doc_id", *[c for c in docs.columns if c == "__tie"])
    names = ids.columns
    rows = docs.select(*names, F.col("text").cast("binary").alias("data"))

    def run(batches):
        for b in batches:
            fps = [f if blocks > 1 else [f] for f in (fingerprint(x, words, blocks) for x in b.column("data").to_pylist())]
            flat = np.array(fps, np.uint64).reshape(-1).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * blocks), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], lists], [*names, "fps"])

    return rows.mapInArrow(run, common.extended(ids, "fps array<bigint>"))


def ring_keys(fp: F.Column, block: F.Column) -> F.Column:
    """The 24 keys of a fingerprint, each with its block, start and choice in the upper bits."""
    out = []
    for i in range(SEGMENTS):
        turned = fp if i == 0 else F.shiftrightunsigned(fp, WIDTH * i).bitwiseOR(F.shiftleft(fp, 64 - WIDTH * i))
        for k, mask in enumerate((0x00FFFFFFFF, 0xFF00FFFFFF, 0xFFFF00FFFF)):  # two segments, and two of the next three
            tag = F.shiftleft((block * 24 + (i * 3 + k)).cast("long"), 40)
            out.append(turned.bitwiseAND(F.lit(mask).cast("long")).bitwiseOR(tag))
    return F.array(*out)


def _chained(x: F.Column, radius: int) -> F.Column:
    """Whether some start in one block has every chain within its budget; ``x``: the block's differing bits."""
    starts = []
    for i in range(SEGMENTS):
        turned = x if i == 0 else F.shiftrightunsigned(x, WIDTH * i).bitwiseOR(F.shiftleft(x, 64 - WIDTH * i))
        within = [F.bit_count(turned.bitwiseAND(F.lit((1 << WIDTH * n) - 1).cast("long"))) <= radius * n // SEGMENTS for n in range(1, SEGMENTS)]
        starts.append(reduce(lambda p, q: p & q, within) & (F.bit_count(x) <= radius))
    return reduce(lambda p, q: p | q, starts)


def _distance(x: F.Column, y: F.Column, blocks: int) -> F.Column:
    return reduce(lambda p, q: p + q, [F.bit_count(x[k].bitwiseXOR(y[k])) for k in range(blocks)])


def _near(x: F.Column, y: F.Column, blocks: int, radius: int) -> F.Column:
    """Chains first, then the full Hamming check."""
    chained = F.exists(F.zip_with(x, y, lambda p, q: p.bitwiseXOR(q)), lambda d: _chained(d, radius))
    return chained & (_distance(x, y, blocks) <= radius * blocks)


def _held(pairs: DataFrame, groups: DataFrame, blocks: int, radius: int) -> DataFrame:
    """``pairs`` (a, b: two g) with the groups' nodes (na, nb) and whether they are ``near``."""
    at = lambda c: groups.select(F.col("g").alias(c), F.col("fps").alias(f"f{c}"), F.col("node").alias(f"n{c}"))
    met = pairs.join(at("a"), "a").join(at("b"), "b")
    return met.select("a", "b", "na", "nb", _near(F.col("fa"), F.col("fb"), blocks, radius).alias("near"))


def _stars(groups: DataFrame, part: range, blocks: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """For the keys of some blocks: each key's fingerprints against its least one (a, b, na, nb, near), and (key, lo, g) of
    the keys that more than two share. Both are written. Those keys are sent to every task where they are few, instead of shuffling
    all keys a second time."""
    own = F.array(*[F.struct(F.lit(k).alias("block"), F.col("fps")[k].alias("fp")) for k in part])
    keyed = groups.select("g", F.explode(own).alias("o")).select("g", F.explode(ring_keys(F.col("o.fp"), F.col("o.block"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("g").alias("lo"), F.max("g").alias("hi")).where("n > 1")
    shared = common.written(shared, "ring-keys")
    members = common.written(keyed.join(common.few(shared.where("n > 2").select("key", "lo")), "key").where("g != lo"), "ring-members")
    two = shared.where("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    more = members.select(F.col("lo").alias("a"), F.col("g").alias("b"))
    return common.written(_held(two.unionByName(more).distinct(), groups, blocks, radius), "stars"), members


def _across(groups: DataFrame, held: DataFrame, members: DataFrame, roots: DataFrame, blocks: int, radius: int) -> DataFrame:
    """(a, b): links between fingerprints of different components that share a key of more than two. Such a key has one that
    isn't near the key's least one, nor in its component."""
    of = lambda c: roots.select(F.col("node").alias(f"n{c}"), F.col("root").alias(f"r{c}"))
    apart = held.where("not near").join(of("a"), "na", "left").join(of("b"), "nb", "left")
    apart = apart.where(F.coalesce("ra", "na") != F.coalesce("rb", "nb")).select(F.col("a").alias("lo"), F.col("b").alias("g")).distinct()
    mixed = common.written(members.join(apart, ["lo", "g"], "left_semi").select("key").distinct(), "mixed")
    common.release(groups.sparkSession)
    own = members.join(mixed, "key", "left_semi")
    all_ = own.select("key", "g").unionByName(own.select("key", F.col("lo").alias("g")).distinct())
    named = groups.join(roots, "node", "left").select("g", "fps", F.xxhash64(F.coalesce("root", "node")).alias("c"))
    rows = common.written(all_.join(named, "g"), "mixed-keys")
    common.release(groups.sparkSession)
    sizes = rows.groupBy("key", "c").agg(F.count("*").alias("n"))
    rows = rows.join(sizes.groupBy("key").agg(F.max_by("c", "n").alias("major")), "key")
    x = rows.where("c != major").select("key", F.col("g").alias("a"), F.col("c").alias("ca"), F.col("fps").alias("fa"))
    y = rows.select("key", F.col("g").alias("b"), F.col("c").alias("cb"), F.col("fps").alias("fb"), "major")
    once = (F.col("cb") == F.col("major")) | (F.col("a") < F.col("b"))
    near = _distance(F.col("fa"), F.col("fb"), blocks) <= radius * blocks
    met = x.join(y, (x["key"] == y["key"]) & (F.col("ca") != F.col("cb")) & once & near)
    found = _held(met.select("a", "b").distinct(), groups, blocks, radius).where("near")
    return common.written(found.select(F.col("na").alias("a"), F.col("nb").alias("b")), "cross-links")


def _searched(fps: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """The distinct fingerprints (fps, g, node) of (doc_id, __tie, fps), and (node, root) of those that have a link. A
    node is the least of a fingerprint's rows, so a component's root is the least of its rows."""
    radius = RADIUS if blocks == 1 else NEAR
    node = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.col("__tie").alias("tie"))
    g = F.col("fps")[0] if blocks == 1 else F.xxhash64("fps")
    groups = common.written(fps.groupBy("fps").agg(F.min(node).alias("node")).withColumn("g", g), "simhash-groups")
    held, members = [], []
    for at in range(0, blocks, AT_ONCE):
        one, two = _stars(groups, range(at, min(at + AT_ONCE, blocks)), blocks, radius)
        held.append(one), members.append(two)
        common.release(fps.sparkSession)
    held, members = (reduce(DataFrame.unionByName, x) for x in (held, members))
    roots = components(held.where("near").select(F.col("na").alias("a"), F.col("nb").alias("b")))
    more = _across(groups, held, members, roots, blocks, radius)
    if not more.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    return groups, roots


def near_duplicates(docs: DataFrame, words: int = 3, blocks: int = 1) -> DataFrame:
    """(doc_id, fps, component_id): the fingerprints, and the least doc_id of all that links reach."""
    fps = common.written(fingerprints(docs, words, blocks), "simhash")
    groups, roots = _searched(fps.withColumn("__tie", F.xxhash64("fps")), blocks)
    names = groups.join(roots, "node", "left").select("fps", F.coalesce("root.doc_id", "node.doc_id").alias("component_id"))
    return fps.join(names, "fps").select("doc_id", "fps", "component_id")


def one_of_each(docs: DataFrame, words: int = 5, blocks: int = BLOCKS) -> DataFrame:
    """One document of each near-duplicate group stays: the one of least doc_id (of several: the first by hash of all
    columns), so unlike rows of one id all stay. Rows of null doc_id can't be named, so they stay."""
    columns = docs.columns
    rows = docs.withColumn("__tie", F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
    groups, roots = _searched(common.written(fingerprints(rows.select("doc_id", "text", "__tie"), words, blocks), "simhash"), blocks)
    # narrow columns settle it, so the texts move once
    first = groups.select("node").join(roots.where("node != root"), "node", "left_anti").select("node.doc_id", F.col("node.tie").alias("__tie"))
    kept = rows.join(first.where("doc_id is not null"), ["doc_id", "__tie"], "left_semi").dropDuplicates(["doc_id", "__tie"])
    return kept.unionByName(rows.where("doc_id is null")).select(*[F.col(f"`{c}`") for c in columns])


def query(spark, sf_dir):
    """op3: fingerprint and component of every document."""
    got = near_duplicates(common.documents(spark, sf_dir).select("doc_id", "text"))
    return got.select("doc_id", F.lpad(F.lower(F.hex(F.col("fps")[0])), 16, "0").alias("fingerprint"), "component_id")
