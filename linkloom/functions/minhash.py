"""MinHash bands of a name's character trigrams.

A seeded crc32 is the plain one xor a constant of the seed and the length, as crc32 is affine; so the seeds need no
hash of their own. ``md5_bands`` is the same scheme on md5 prefixes, which other engines can compute too. They come from an
Arrow UDF: built-in expressions cut and hash each trigram of each name anew for every seed, while a batch of names shares
most of its trigrams.
"""

from __future__ import annotations

import hashlib
import sys
import zlib

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

BANDS, ROWS, GRAM = 4, 2, 3
#: Trigrams whose hashes are gathered at once.
GATHERED = 1 << 17


def grams(tokens: Column) -> Column:
    """Trigrams of the distinct tokens, sorted and joined; a shorter string is its own gram."""
    s = F.array_join(F.array_sort(F.array_distinct(tokens)), " ")
    n = F.length(s)
    return F.when(n < GRAM, F.array(s)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - (GRAM - 1), F.lit(1))), lambda i: F.substring(s, i, F.lit(GRAM))))


def _shift(seed: int, size: int) -> int:
    zeros = bytes(size)
    return zlib.crc32(zeros, seed) ^ zlib.crc32(zeros)


def crc32_bands(tokens: Column) -> Column:
    """array<struct<band,h1,h2>>: for each band the least of two seeded hashes."""
    base = F.transform(grams(tokens), lambda g: F.struct(F.crc32(F.encode(g, "UTF-8")).alias("c"), F.octet_length(g).alias("n")))

    def least(seed):
        table = F.array(*[F.lit(_shift(seed, n)).cast("long") for n in range(1, 4 * GRAM + 1)])
        return F.array_min(F.transform(base, lambda x: x["c"].bitwiseXOR(F.element_at(table, x["n"]))))

    bands = F.array(*[F.struct(F.lit(b).alias("band"), least(2 * b + 1).alias("h1"), least(2 * b + 2).alias("h2")) for b in range(BANDS)])
    return F.when(F.size(tokens) > 0, bands).otherwise(F.array().cast("array<struct<band:int,h1:bigint,h2:bigint>>"))


def _least(texts: list[str]) -> list[np.ndarray]:
    """For each text and each seed the least 60-bit md5 prefix of its trigrams."""
    rows: dict[str, int] = {}
    hashes, out, at, starts = np.empty((1024, BANDS * ROWS), np.int64), [], [], []

    def gather() -> None:
        if starts:
            out.extend(np.minimum.reduceat(hashes[np.array(at)], starts))
            at.clear()
            starts.clear()

    for s in texts:
        starts.append(len(at))
        for g in {s[i : i + GRAM] for i in range(max(len(s) - GRAM + 1, 1))}:
            k = rows.get(g)
            if k is None:
                k = rows[g] = len(rows)
                if k == len(hashes):
                    hashes = np.concatenate([hashes, np.empty_like(hashes)])
                hashes[k] = [int(hashlib.md5(f"{seed}:{g}".encode()).hexdigest()[:15], 16) for seed in range(1, BANDS * ROWS + 1)]
            at.append(k)
        if len(at) > GATHERED:
            gather()
    gather()
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def _md5_bands(text: pd.Series) -> pd.Series:
    known = text.notna()
    rows = (row.tolist() for row in _least(text[known].tolist()))
    made = ([f"{b}:" + ":".join(f"{x:015x}" for x in row[ROWS * b : ROWS * (b + 1)]) for b in range(BANDS)] for row in rows)
    return pd.Series([next(made) if k else [] for k in known], index=text.index, dtype=object)


def md5_bands(tokens: Column) -> Column:
    """array<string>: for each band its number and the least of two seeded hashes."""
    return _md5_bands(F.when(F.size(tokens) > 0, F.array_join(F.array_sort(F.array_distinct(tokens)), " ")))
