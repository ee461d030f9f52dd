"""Language identification by string kernels.

A text is the set of the 1- to 3-grams of its code points, lower-cased, with a blank for whatever is no letter
(blended spectrum, presence only; grams of blanks alone don't count). Grams of any script are hashed to ``IDS`` ids. The
kernel of two texts is the share they have in common, ``|A & B| / sqrt(|A| |B|)``. Landmark texts give the
Nystroem approximation; one-versus-rest kernel ridge regression is solved on it. Documents are scored in
batches: a presence matrix times the landmarks' matrix, then times the coefficients.

The model is fitted on the driver from a bounded sample: at most ``per_lang`` distinct labelled texts of each
language (those with the least text hash), whole texts. Everything else runs over all rows.

Defined cases: a text that is null or has no letter is ``und`` with score 0; repeated rows get one result each;
with no labelled rows every document is ``und``; rows of null ``doc_id`` are kept; other columns are kept as they are, but
columns named ``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

IDS = 1 << 19


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


class KernelModel:
    def __init__(self, langs, columns=None, landmarks=None, coef=None):
        self.langs, self.columns, self.landmarks, self.coef = langs, columns, landmarks, coef

    def score(self, texts: list[str | None], rows: int = 256) -> tuple[list[str], np.ndarray]:
        """Language and score (the winner's share of the positive ridge outputs) of each text."""
        out, best = ["und"] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return out, best
        for at in range(0, len(texts), rows):
            part = texts[at : at + rows]
            x, norm = np.zeros((len(part), self.landmarks.shape[1]), np.float32), np.ones(len(part), np.float32)
            real = np.zeros(len(part), bool)
            for i, t in enumerate(part):
                g = presence(t)
                if len(g):
                    c = self.columns[g]
                    x[i, c[c >= 0]] = 1
                    norm[i], real[i] = np.sqrt(len(g)), True
            f = ((x @ self.landmarks.T) / norm[:, None]) @ self.coef
            p = np.clip(f, 0, None) + 1e-6
            p /= p.sum(1, keepdims=True)
            win = p.argmax(1)
            for i in np.flatnonzero(real):
                out[at + i], best[at + i] = self.langs[win[i]], min(1.0, float(p[i, win[i]]))
        return out, best


_MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def presence(text: str | None) -> np.ndarray:
    """Sorted ids of the 1-, 2- and 3-grams in the text; none if it has no letter."""
    if not text:
        return np.zeros(0, np.int64)
    u = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    u = np.where(letters()[u], u, 0)
    if not u.any():
        return np.zeros(0, np.int64)
    seen = np.zeros(IDS, bool)
    u = np.concatenate([[0], u, [0]]).astype(np.uint64)
    gram, some = u * _MIX[0], u > 0
    for n in (1, 2, 3):
        seen[(common.mix64(gram[some]) >> np.uint64(45)).astype(np.int64)] = True
        if n < 3:
            gram = gram[:-1] + (u[n:] + np.uint64(1)) * _MIX[n]
            some = some[:-1] | (u[n:] > 0)
    return np.flatnonzero(seen)


def fit(sample: list[tuple[str, str]], landmarks_per_lang: int = 32, ridge: float = 1e-3) -> KernelModel:
    """Fit on (text, lang) pairs, in the given order."""
    sets = [(presence(t), lang) for t, lang in sample]
    sets = [(g, lang) for g, lang in sets if len(g)]
    langs = sorted({lang for _, lang in sets})
    if not langs:
        return KernelModel([])
    chosen, taken = [], Counter()
    for g, lang in sets:
        if taken[lang] < landmarks_per_lang:
            taken[lang] += 1
            chosen.append(g)
    columns = np.full(IDS, -1, np.int32)
    used = np.unique(np.concatenate(chosen))
    columns[used] = np.arange(len(used))
    z = np.zeros((len(chosen), len(used)), np.float32)
    for i, g in enumerate(chosen):
        z[i, columns[g]] = 1 / np.sqrt(len(g))
    knm = np.zeros((len(sets), len(chosen)))
    for i, (g, _) in enumerate(sets):
        c = columns[g]
        knm[i] = z[:, c[c >= 0]].sum(1) / np.sqrt(len(g))
    kmm = (z @ z.T).astype(float)
    y = np.array([[lang == k for k in langs] for _, lang in sets], float)
    weight = 1 / y.sum(0)[y.argmax(1)] / len(langs)  # each language counts alike
    left = knm.T @ (knm * weight[:, None]) + ridge * kmm / len(chosen) + 1e-9 * np.eye(len(chosen))
    coef = np.linalg.lstsq(left, knm.T @ (y * weight[:, None]), rcond=None)[0]
    return KernelModel(langs, columns, z, coef.astype(np.float32))


def training_sample(docs: DataFrame, per_lang: int = 300) -> list[tuple[str, str]]:
    """At most ``per_lang`` distinct texts of each language, those of least hash; collected, so bounded by
    ``per_lang`` times the number of languages. ``docs``: text, lang."""
    rows = docs.where("text is not null and lang is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h")).collect()}
    cut = F.lit(0.0)
    for lang, n in counts.items():
        cut = F.when(F.col("lang") == lang, F.lit(min(1.0, 3.0 * per_lang / max(n, 1)))).otherwise(cut)
    near = rows.where((F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))) < cut)
    kept = near.groupBy("lang", "h").agg(F.min("text").alias("text"))
    out, taken = [], Counter()
    for r in kept.sort("h", "lang").toLocalIterator():
        if taken[r["lang"]] < per_lang:
            taken[r["lang"]] += 1
            out.append((r["text"], r["lang"]))
    return out


def identify(docs: DataFrame, train: DataFrame, per_lang: int = 300, landmarks_per_lang: int = 32) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to ``docs``; learns from ``train`` (text, lang)."""
    spark = docs.sparkSession
    common.small_batches(spark)
    model = fit(training_sample(train, per_lang), landmarks_per_lang)
    sent = spark.sparkContext.broadcast(model)

    def run(texts):
        got, score = sent.value.score(texts)
        return pa.array(got, pa.string()), pa.array(score)

    return common.with_added(docs, F.col("text"), run, "lang_pred string, score double")


def accepted(docs: DataFrame, train: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents whose language is told: not ``und`` and a score of ``least`` or more."""
    columns = docs.columns
    keep = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") if c != "text" else F.col("text") for i, c in enumerate(columns)])
    got = identify(keep, train).where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return got.select(*[F.col("text" if c == "text" else f"c{i}").alias(c) for i, c in enumerate(columns)])


def query(spark, sf_dir):
    """op2: every document's language, learnt from the rows that are not held out."""
    docs = common.documents(spark, sf_dir)
    rows = docs.select("doc_id", "text", "lang", (common.fold() == 2).alias("held_out"))
    got = identify(rows.select("doc_id", "held_out", "text"), rows.where("not held_out").select("text", "lang"))
    return got.select("doc_id", "held_out", "lang_pred", "score")
