"""Packing of documents into sequences by cutting-stock column generation.

A document's tokens are cut into full sequences and a rest. Where rests of over half a sequence can't be packed tightly
(their dual price in the program is above their volume, and the program's bound above the whole volume), those of such a
class are cut once more, after half a sequence. The rests' lengths, in classes of ``STEP`` tokens, make a
histogram (at most ``size / STEP`` classes, whatever the input). On it, a linear program over patterns (how many
pieces of each class share a sequence) is solved by column generation: the revised simplex method keeps the basis,
and an unbounded-knapsack dynamic program prices the next pattern. Patterns are rounded down; what is left of the
histogram, a few pieces a class, goes first-fit decreasing into further patterns. Pieces are ranked inside their
class, and a piece's rank gives its pattern, sequence and slot by arithmetic, with no shuffle; one window over each
sequence gives the offsets.

Ranks are counted by class and hash bucket, so a class that holds a third of all pieces is dealt out. The driver
sees the histogram alone.

Defined cases: null text is an empty document (its end id alone); repeated rows are each packed; a null doc_id is
packed like any other; no rows give no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .encoding import encoder

STEP = 8
#: Padding, as a share of the volume, from which rests of over half a sequence are cut.
LOOSE = 0.005
#: Chunks that a worker remembers: fewer than the encoder's default, as later stages run beside its table.
REMEMBER = 300_000


# --- the plan, on the histogram ------------------------------------------------------------------------


def _patterns(sizes: np.ndarray, value: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: the most value that fits ``room``, and for each item the best pattern that has it
    (a column each). Sizes ascend."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    for w, n in enumerate(np.searchsorted(sizes, np.arange(room + 1), "right").tolist()):
        if n:
            got = best[w - sizes[:n]] + value[:n]
            k = int(got.argmax())
            best[w], pick[w] = (got[k], k) if got[k] > best[w - 1] else (best[w - 1], -2)
    columns = np.zeros((len(sizes), len(sizes)), np.int64)
    for j in range(len(sizes)):
        columns[j, j], w = 1, room - int(sizes[j])
        while w > 0 and pick[w] != -1:
            if pick[w] == -2:
                w -= 1
            else:
                columns[pick[w], j] += 1
                w -= int(sizes[pick[w]])
    return float(best[room]), columns


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, slack: float = 5e-4, pivots: int = 12_000, smooth: float = 0.9) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column generation for min sum(x), A x = demand, sizes ascending: the basis' patterns (a column each), their
    (fractional) numbers and the duals, a price for each size. Pricing is stabilised: it is done at a mix of the basis' duals and the best dual point so
    far, which starts at the volumes. Each pricing yields many patterns, among which simplex pivots go on until none is
    worth more than 1. It ends within ``slack`` of the best lower bound that the dual points have proven. ``pivots``
    bounds the work; any basis is a valid packing."""
    basis = np.diag(room // sizes)
    inverse = np.diag(1 / np.diag(basis))
    x = demand / np.diag(basis)
    centre = sizes / room  # no pattern is worth more than 1 at it
    bound, done, mix = float(centre @ demand), 0, smooth
    while done < pivots and x.sum() > (1 + slack) * bound:
        dual = inverse.sum(0)
        point = mix * centre + (1 - mix) * np.maximum(dual, 0)
        gain, columns = _patterns(sizes, point, room)
        if gain > 0 and (point @ demand) / gain > bound:
            bound, centre = float(point @ demand) / gain, point / gain
        before = done
        for _ in range(columns.shape[1]):
            worth = np.einsum("i,ij->j", inverse.sum(0), columns)
            j = int(worth.argmax())
            if worth[j] <= 1 + 1e-7:
                break
            used = np.flatnonzero(columns[:, j])
            d = (inverse[:, used] * columns[used, j]).sum(1)
            ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
            out = int(ratio.argmin())
            step = ratio[out]
            if not np.isfinite(step):
                break
            basis[:, out] = columns[:, j]
            x = np.maximum(x - step * d, 0)
            x[out] = step
            row = inverse[out] / d[out]
            inverse -= np.outer(d, row)
            inverse[out] = row
            done += 1
        if done == before:  # nothing new at this point: go towards the duals themselves
            if mix == 0:
                break
            mix = mix / 2 if mix > 0.05 else 0.0
        else:
            mix = smooth
    return basis, x, inverse.sum(0)


def halved(histogram: dict[int, int], size: int = 2048) -> set[int]:
    """The classes of over half a sequence whose pieces are to be cut after ``size / 2``, so that all pack tightly."""
    cut: set[int] = set()
    while True:
        now = dict(histogram)
        for c in cut:
            n = now.pop(c)
            for part in (size // 2, c - size // 2):
                now[part] = now.get(part, 0) + n
        now = {c: n for c, n in now.items() if n > 0}
        if not now:
            return cut
        classes = np.array(sorted(now))
        demand = np.array([now[c] for c in classes], float)
        _, x, price = solve(classes // STEP, demand, size // STEP)
        if x.sum() <= (1 + LOOSE) * (classes @ demand) / size:
            return cut
        over = {int(c) for c, p in zip(classes, price, strict=True) if size // 2 < c < size and p > (1 + LOOSE) * c / size}
        if not over:
            return cut
        cut |= over


def plan(histogram: dict[int, int], size: int = 2048) -> list[tuple[int, dict[int, int]]]:
    """Patterns (times used, {class length: pieces}) that hold exactly the histogram's pieces. A class length is a
    multiple of ``STEP`` and an upper bound of its pieces' lengths."""
    left = {c: n for c, n in histogram.items() if n > 0}
    out: list[tuple[int, dict[int, int]]] = []
    if left:
        classes = np.array(sorted(left))
        patterns, x, _ = solve(classes // STEP, np.array([left[c] for c in classes], float), size // STEP)
        for j in np.argsort(-x, kind="stable"):
            own = {int(classes[i]): int(a) for i, a in enumerate(patterns[:, j]) if a}
            times = min([int(x[j] + 1e-6), *(left[c] // a for c, a in own.items())])
            if times > 0:
                out.append((times, own))
                for c, a in own.items():
                    left[c] -= a * times
    bins: list[list] = []  # the rest: first-fit decreasing
    for c in sorted(left, reverse=True):
        for _ in range(left[c]):
            place = next((b for b in bins if b[0] >= c), None)
            if place is None:
                bins.append(place := [size, {}])
            place[0] -= c
            place[1][c] = place[1].get(c, 0) + 1
    return out + [(1, b[1]) for b in bins]


class Slots:
    """Of a plan: the sequence and slot of the k-th piece of a class."""

    def __init__(self, patterns: list[tuple[int, dict[int, int]]]):
        first, self.by = 0, {}
        for times, own in patterns:
            slot = 0
            for c in sorted(own, reverse=True):
                self.by.setdefault(c, []).append((times * own[c], first, own[c], slot))
                slot += own[c]
            first += times
        self.by = {c: np.array(v, np.int64) for c, v in self.by.items()}
        self.ends = {c: np.cumsum(v[:, 0]) for c, v in self.by.items()}

    def place(self, cls: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq, slot = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64)
        for c in np.unique(cls):
            own = np.flatnonzero(cls == c)
            j = np.searchsorted(self.ends[c], rank[own], "right")
            total, first, per, base = self.by[c][j].T
            k = rank[own] - (self.ends[c][j] - total)
            seq[own], slot[own] = first + k // per, base + k % per
        return seq, slot


# --- over the documents ---------------------------------------------------------------------------------


def pieces(docs: DataFrame, tokenizer: str, kind: str = "word", end: int = 1, size: int = 2048) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, halves): each document's full sequences and its rest. ``halves``: of a
    rest of over half a sequence, the crc32 of its first ``size / 2`` ids and of the others, in case it is cut."""
    common.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        made = encoder(tokenizer, kind, REMEMBER)
        for b in batches:
            ids, counts = made.encode(b.column("text").to_pylist(), end)
            cuts = -(-counts // size)
            doc = np.repeat(np.arange(len(counts)), cuts)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * size
            length = np.minimum(size, counts[doc] - start)
            at = (np.cumsum(counts) - counts)[doc] + start
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            half = [[zlib.crc32(raw[4 * a : 4 * a + 2 * size]), zlib.crc32(raw[4 * a + 2 * size : 4 * (a + n)])] if size // 2 < n < size else None for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(counts[doc]), pa.array(half, pa.list_(pa.int64()))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "halves"])

    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, halves array<long>")


def pack(cut: DataFrame, size: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (length at most ``size``; doc_id, start and ids_crc32 rank them). Pieces
    that are cut once more are two rows; ``halves`` goes."""
    spark = cut.sparkSession
    salts = common.least_tasks(spark)
    cls = (F.ceil(F.col("length") / STEP) * STEP).cast("long")
    made = common.written(cut, "pieces")
    histogram = {r["cls"]: r["n"] for r in made.groupBy(cls.alias("cls")).agg(F.count("*").alias("n")).collect()}  # size / STEP rows at most
    over = halved(histogram, size)
    if over:
        part = lambda start, length, crc: F.struct(start.alias("start"), length.cast("long").alias("length"), crc.alias("ids_crc32"))
        whole = F.array(part(F.col("start"), F.col("length"), F.col("ids_crc32")))
        two = F.array(part(F.col("start"), F.lit(size // 2), F.col("halves")[0]), part(F.col("start") + size // 2, F.col("length") - size // 2, F.col("halves")[1]))
        same = [c for c in cut.columns if c not in ("start", "length", "ids_crc32", "halves")]
        split = made.select(*same, F.explode(F.when(cls.isin(*over), two).otherwise(whole)).alias("p")).select(*same, "p.*")
        made = split.select(*[c for c in cut.columns if c != "halves"])
        histogram = {r["cls"]: r["n"] for r in made.groupBy(cls.alias("cls")).agg(F.count("*").alias("n")).collect()}
    else:
        made = made.drop("halves")
    cut = made
    ranked = cut.withColumn("cls", cls).withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = ranked.groupBy("cls", "salt").agg(F.count("*").alias("n"))
    slots = Slots(plan(histogram, size))
    before = Window.partitionBy("cls").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inner = Window.partitionBy("cls", "salt").orderBy("doc_id", "start", "ids_crc32")
    rows = ranked.withColumn("k", F.row_number().over(inner) - 1).join(offsets, ["cls", "salt"]).select(*cut.columns, "cls", (F.col("k") + F.col("before")).alias("rank"))
    sent = spark.sparkContext.broadcast(slots)

    def run(batches):
        for b in batches:
            seq, slot = sent.value.place(b.column("cls").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in b.schema.names if c not in ("cls", "rank")], pa.array(seq), pa.array(slot)], [*[c for c in b.schema.names if c not in ("cls", "rank")], "sequence_id", "slot"])

    placed = rows.mapInArrow(run, common.extended(cut, "sequence_id long, slot long"))
    up_to = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(up_to), F.lit(0)).cast("long")).drop("slot")


def packed(docs: DataFrame, tokenizer: str | None = None, kind: str = "word", end: int = 1, size: int = 2048) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(pieces(docs, tokenizer, kind, end, size), size)


def query(spark, sf_dir):
    """op10: where each piece of each document lies."""
    return packed(common.documents(spark, sf_dir).select("doc_id", "text"))
