"""Substring dedup by relative Lempel-Ziv parsing.

Every run of ``window`` words of a document that also starts in a document of smaller id is a duplicate window;
the words that such windows cover are removed.

1. Index. Each window is anchored at the least-hashed ``SEED``-gram inside it, so equal windows have equal anchors,
   and neighbouring windows share theirs. A reference block holds, for the anchors whose hash falls to it, every
   occurrence with its windows' hashes. Within an Arrow batch, an occurrence that repeats one of a smaller id is
   resolved on the spot and not sent, so a passage that a third of all rows share reaches its block once a batch.
2. Lookup. A block is sorted by anchor and id and streamed: each window points at its first occurrence (document,
   position). Only the windows of the anchor at hand are held.
3. Parse. Each document is factored greedily from left to right: a factor goes on while the pointers go on in the
   same source. Where the pointer changes, the windows at the boundary still carry pointers of their own, so none is
   missed between two factors. Factors are at least ``window`` words long; their union is what is removed.

Windows match by 104 bits of hash: 64 of the anchor and 40 of the window.

Defined cases: null text has no words; texts of fewer words than a window keep all; windows repeated within one
document, or in documents of the same id, don't count; a null doc_id is neither source nor target and keeps its
text; repeated rows are parsed alike, from one set of their pointers; other columns pass
through untouched, but columns named ``n_words``, ``n_removed`` and ``factors`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SEED = 4
BYTES = 5  # of a window's hash


def _anchor(words: np.ndarray, window: int):
    """Of a document's word hashes: each anchor's hash, first window and number of windows, and all windows' hashes."""
    n = len(words) - window + 1
    if n <= 0:
        return None
    grams = common.gram_hashes(words, SEED)
    span = window - SEED + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(1) + np.arange(n)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return grams[at[first]], first, np.diff(np.concatenate([first, [n]])), common.gram_hashes(words, window, 0xA0761D6478BD642F)


def _blobs(hashes: np.ndarray, counts: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :BYTES])
    ends = np.concatenate([[0], np.cumsum(counts) * BYTES]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


def _hash_of(blob: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All windows' hashes in the blobs, and how many each blob has."""
    ends = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1]
    raw = np.frombuffer(blob.buffers()[2], np.uint8)[ends[0] : ends[-1]] if blob.buffers()[2] else np.zeros(0, np.uint8)
    wide = np.zeros((len(raw) // BYTES, 8), np.uint8)
    wide[:, :BYTES] = raw.reshape(-1, BYTES)
    return wide.view(np.uint64).ravel(), np.diff(ends) // BYTES


ROW = "g long, doc long, tag long, at int, n int, src long, pos int, blob binary"


def _index(window: int):
    """Rows of (doc, tag, data) to a row for each anchor. n < 0: resolved here, with its source."""

    def run(batches):
        for b in batches:
            docs, tags = b.column("doc").to_numpy(), b.column("tag").to_numpy()
            g, at, n, row, h = [], [], [], [], []
            for i, data in enumerate(b.column("data").to_pylist()):
                if not data:
                    continue
                u = np.frombuffer(data, np.uint8)
                got = _anchor(common.word_hashes(u, *common.word_spans(u)), window)
                if got:
                    g.append(got[0]), at.append(got[1]), n.append(got[2]), h.append(got[3]), row.append(np.full(len(got[0]), i))
            if not g:
                continue
            g, at, n, row, h = (np.concatenate(x) for x in (g, at, n, row, h))
            # the same anchor with the same windows: one of the least id stands for those of larger ids
            start = np.cumsum(n) - n
            whole = common.mix64(g + np.add.reduceat(common.mix64(h + np.arange(len(h), dtype=np.uint64) - np.repeat(start, n).astype(np.uint64)), start))
            order = np.lexsort((at, docs[row], whole))
            new = np.concatenate([[True], whole[order][1:] != whole[order][:-1]])
            lead = order[new][np.cumsum(new) - 1]
            head = np.empty(len(g), np.int64)
            head[order] = lead
            known = (docs[row] > docs[row[head]]) & (g == g[head]) & (n == n[head])
            size = np.where(known, 0, n)
            keep = np.repeat(~known, n)
            doc = docs[row]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.where(known, common.mix64(doc.astype(np.uint64) + at.astype(np.uint64)), g).view(np.int64)), pa.array(doc), pa.array(tags[row]),
                pa.array(at.astype(np.int32)), pa.array(np.where(known, -n, n).astype(np.int32)),
                pa.array(np.where(known, docs[row[head]], 0)), pa.array(np.where(known, at[head], 0).astype(np.int32)),
                _blobs(h[keep], size)], ["g", "doc", "tag", "at", "n", "src", "pos", "blob"])

    return run


def _lookup(batches):
    """Rows sorted by (g, doc): for each row with duplicate windows, a bit for each and the first one's source."""
    held = None  # windows of the last anchor so far: g, hash, doc, position of the first occurrence
    for b in batches:
        if not b.num_rows:
            continue
        g, doc, tag = (b.column(c).to_numpy().copy() for c in ("g", "doc", "tag"))
        at, n, src, pos = (b.column(c).to_numpy() for c in ("at", "n", "src", "pos"))
        h, size = _hash_of(b.column("blob"))
        row = np.repeat(np.arange(len(g)), size)
        inner = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
        wg, wd, wp = g[row], doc[row], at[row] + inner
        if held is not None and len(held[0]) and len(h) and held[0][0] == wg[0]:
            old = len(held[0])
            wg, wh, wd, wp = (np.concatenate([x, y]) for x, y in zip(held, (wg, h, wd, wp), strict=True))
        else:
            old, wh = 0, h
        mask, from_doc, from_pos = np.zeros(len(g), np.int64), src.copy(), pos.astype(np.int64)
        done = n < 0
        mask[done] = (np.int64(1) << (-n[done]).astype(np.int64)) - 1
        if len(wh):
            order = np.lexsort((wp, wd, wh, wg))
            sg, sh = wg[order], wh[order]
            new = np.concatenate([[True], (sg[1:] != sg[:-1]) | (sh[1:] != sh[:-1])])
            lead = np.empty(len(wh), np.int64)
            lead[order] = order[new][np.cumsum(new) - 1]
            dup = np.flatnonzero(wd > wd[lead])
            dup = dup[dup >= old]
            if len(dup):
                r = row[dup - old]
                np.bitwise_or.at(mask, r, np.int64(1) << inner[dup - old].astype(np.int64))
                back = dup[::-1]  # the row's first duplicate window is written last
                from_doc[row[back - old]], from_pos[row[back - old]] = wd[lead[back]], wp[lead[back]]
            last = order[new]
            last = last[wg[last] == wg[-1]]
            held = tuple(x[last] for x in (wg, wh, wd, wp))
        hit = mask != 0
        if hit.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (doc, tag, at, mask.astype(np.int32), from_doc, from_pos.astype(np.int32))], ["doc", "tag", "at", "mask", "src", "pos"])


def _factors(found: list[dict] | None, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors (start, words, source document, start there) of one document, from its anchors' pointers."""
    point: dict[int, tuple[int, int]] = {}
    for f in found or ():
        first = (f["mask"] & -f["mask"]).bit_length() - 1
        for k in range(first, f["mask"].bit_length()):
            if f["mask"] >> k & 1:
                point.setdefault(f["at"] + k, (f["src"], f["pos"] + k - first))
    out: list[list[int]] = []
    for p in sorted(point):
        src, pos = point[p]
        if out and out[-1][2] == src and out[-1][0] + out[-1][1] - window + 1 == p and out[-1][3] + p - out[-1][0] == pos:
            out[-1][1] += 1
        else:
            out.append([p, window, src, pos])
    return [tuple(x) for x in out]


def dedup(docs: DataFrame, window: int = 13) -> DataFrame:
    """``docs`` with ``text`` cut, and ``n_words``, ``n_removed`` and ``factors`` (start, words, src_doc, src_start;
    positions count words). What stays keeps its own white space; a text nothing is cut from is unchanged."""
    spark = docs.sparkSession
    common.small_batches(spark)
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "factors")]
    rest = [c for c in names if c != "text"]
    base = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("tag"), F.col("text").cast("binary").alias("data"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    anchors = base.where("doc is not null and data is not null").select("doc", "tag", "data").mapInArrow(_index(window), ROW)
    block = Window.partitionBy("g")
    sorted_ = anchors.repartition(common.least_tasks(spark), "g").sortWithinPartitions("g", "doc")
    again = sorted_.withColumn("lo", F.min("doc").over(block)).withColumn("hi", F.max("doc").over(block)).where("lo < hi or n < 0").drop("lo", "hi")
    found = again.mapInArrow(_lookup, "doc long, tag long, at int, mask int, src long, pos int")
    per_doc = found.groupBy("doc", "tag").agg(F.collect_set(F.struct("at", "mask", "src", "pos")).alias("found"))

    def pack(batches):
        for b in batches:
            z = zstandard.ZstdCompressor(level=1)
            k = b.schema.get_field_index("data")
            yield b.set_column(k, "data", pa.array([None if x is None else z.compress(x) for x in b.column(k).to_pylist()], pa.binary()))

    def cut(batches):
        for b in batches:
            z = zstandard.ZstdDecompressor()
            text, words, removed, factors = [], [], [], []
            for data, got in zip(b.column("data").to_pylist(), b.column("found").to_pylist(), strict=True):
                data = None if data is None else z.decompress(data)
                u = np.frombuffer(data or b"", np.uint8)
                start, _ = common.word_spans(u)
                f = _factors(got, window)
                gone = np.zeros(len(start) + 1, np.int32)
                for s, n, *_ in f:
                    gone[s] += 1
                    gone[s + n] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                if f:
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    cutoff = np.concatenate([start, [len(u)]])[edge].tolist()
                    data = b"".join(data[x:y] for x, y in zip([0, *cutoff[1::2]], [*cutoff[::2], len(data)], strict=True))
                text.append(data), words.append(len(start)), removed.append(int(gone.sum())), factors.append([dict(zip(("start", "words", "src_doc", "src_start"), x, strict=True)) for x in f])
            kept = [b.column(c) for c in b.schema.names if c[0] == "c"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(text, pa.binary()), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(factors, pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("src_doc", pa.int64()), ("src_start", pa.int32())])))], [*[c for c in b.schema.names if c[0] == "c"], "data", "n_words", "n_removed", "factors"])

    packed = base.mapInArrow(pack, base.schema)
    joined = packed.join(per_doc, ["doc", "tag"], "left").select(*[f"c{i}" for i in range(len(rest))], "data", "found")
    kept_schema = common.extended(joined.drop("data", "found"), "data binary, n_words long, n_removed long, factors array<struct<start:int,words:int,src_doc:long,src_start:int>>")
    out = joined.mapInArrow(cut, kept_schema)
    at = {c: i for i, c in enumerate(rest)}
    return out.select(*[F.col("data").cast("string").alias(c) if c == "text" else F.col(f"c{at[c]}").alias(c) for c in names], "n_words", "n_removed", "factors")


def cleaned(docs: DataFrame, window: int = 13) -> DataFrame:
    """``docs`` without repeated passages: same columns, ``n_chars`` counted anew where there is one. A document of
    which nothing is left goes; one that never had a word stays."""
    out = dedup(docs, window).where("n_removed = 0 or n_removed < n_words")
    cols = {c: F.col(f"`{c}`") for c in docs.columns}
    if "n_chars" in cols:
        cols["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*[v.alias(c) for c, v in cols.items()])


def query(spark, sf_dir):
    """op4: of every document, how many words go, and the digest of those that stay."""
    got = dedup(common.documents(spark, sf_dir).select("doc_id", "text"))
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return got.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents
), w AS (
  SELECT doc_id, p, md5(array_to_string(ws[p:p + 12], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM d)
), f AS (
  SELECT k, min(doc_id) AS m FROM w GROUP BY k
), gone AS (
  SELECT doc_id, list(DISTINCT q) AS qs
  FROM (SELECT w.doc_id, unnest(range(p, p + 13)) AS q FROM w JOIN f USING (k) WHERE w.doc_id > f.m)
  GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(qs), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN qs IS NULL THEN ws ELSE [ws[i] FOR i IN range(1, len(ws) + 1) IF NOT list_contains(qs, i)] END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""
