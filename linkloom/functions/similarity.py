"""Fuzzy string similarities, those asked for in one Arrow UDF; Spark has only Levenshtein built in.

Conventions on empty strings: ratio, token_sort and partial of two empty ones are 1, Jaro-Winkler and OSA too; token_set
is 0 if either is empty.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

NAMES = ("ratio", "token_sort", "token_set", "partial", "jw", "osa")
#: Bits of windows that are compared at once.
LANES = 1 << 20
#: Length from which the shorter string is combed through the longer.
COMBED = 200


def _masks(s: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(s):
        out[c] = out.get(c, 0) | 1 << i
    return out


def lcs_length(a: str, b: str, masks: dict[str, int] | None = None) -> int:
    """Longest common subsequence, a bit for each character of ``a``."""
    full = (1 << len(a)) - 1
    masks = _masks(a) if masks is None else masks
    v = full
    for c in b:
        u = v & masks.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def indel_ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 2 * lcs_length(a, b) / n if n else 1.0


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best of shared against shared-and-rest of either side, and of the two with their rests."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_x or not only_y):
        return 1.0
    with_x, with_y = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    best = indel_ratio(with_x, with_y)
    return max(best, indel_ratio(both, with_x), indel_ratio(both, with_y)) if both else best


def _best_combed(a: str, b: str) -> float:
    """The same in time linear in the table of ``a`` against ``b`` (Tiskin's semi-local LCS): strands enter at its left and top
    and, a diagonal at a time, two that meet cross where characters match and else only if they have not crossed yet. A
    window's subsequence is its length less the strands that both enter and leave within it."""
    x, y = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32) for s in (a, b))
    x, m, n = x[::-1].copy(), len(a), len(b)
    left, top = np.arange(m, dtype=np.int32), np.arange(m, m + n, dtype=np.int32)
    for d in range(m + n - 1):
        j, k = max(0, d - m + 1), min(n, d + 1)
        h, v, same = left[m - 1 - d + j : m - 1 - d + k], top[j:k], x[m - 1 - d + j : m - 1 - d + k] == y[j:k]
        cross = same | (h > v)
        h[:], v[:] = np.where(cross, v, h), np.where(cross, h, v)
    enters = top.astype(np.int64) - m  # where what leaves at the bottom has entered the top; below 0: at the left
    leaves = np.full(n, n, np.int64)
    own = np.flatnonzero(enters >= 0)
    leaves[enters[own]] = own
    end = np.arange(1, m + n)
    first, last = np.maximum(end - m, 0), np.minimum(end, n)
    come = (end <= n) & (enters[np.minimum(end, n) - 1] >= first)
    gone = (first > 0) & (leaves[np.maximum(first, 1) - 1] < np.minimum(end - 1, n))
    size = last - first
    return float((2 * (size - np.cumsum(come.astype(np.int64) - gone)) / (m + size)).max())


def _best_window(a: str, b: str) -> float:
    """Of ``a`` against the windows of ``b`` that are as long, or cut short at an end. The windows lie side by side in one
    number, a lane of ``a``'s bits and a spare one each, so a step of the subsequence is a step of all of them; lane i's
    window ends at character i."""
    if len(a) > COMBED:
        return _best_combed(a, b)
    masks, n, best = _masks(a), len(a), 0.0
    size = n // 8 + 1
    total, width = len(b) + n - 1, max(1, LANES // (8 * size))
    own = {c: m.to_bytes(size, "little") for c, m in masks.items()}
    none = bytes(size)
    for first in range(0, total, width):
        lanes = min(width, total - first)
        text = b[max(0, first - n + 1) : first + lanes]
        row = none * max(0, n - 1 - first) + b"".join([own.get(c, none) for c in text])
        full = int.from_bytes(((1 << n) - 1).to_bytes(size, "little") * lanes, "little")
        v, step = full, lanes * size
        for j in range(n):
            u = v & int.from_bytes(row[j * size : j * size + step], "little")
            v = ((v + u) | (v - u)) & full
        lcs = n - np.bitwise_count(np.frombuffer(v.to_bytes(step, "little"), np.uint8).reshape(lanes, size)).sum(1, dtype=np.int64)
        end = np.arange(first + 1, first + lanes + 1)
        best = max(best, float((2 * lcs / (n + np.minimum(end, len(b)) - np.maximum(end - n, 0))).max()))
        if best == 1.0:
            break
    return best


def partial_ratio(a: str, b: str) -> float:
    """The shorter string against its best window in the longer, windows at the ends being cut short."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 1.0 if not b else 0.0
    best = _best_window(a, b)
    return max(best, _best_window(b, a)) if len(a) == len(b) and best < 1.0 else best


def jaro_winkler(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    masks, free, hits = _masks(b), (1 << len(b)) - 1, []
    near = (1 << (2 * reach + 1)) - 1
    for i, c in enumerate(a):
        met = masks.get(c, 0) & free & (near << (i - reach) if i >= reach else near >> (reach - i))
        if met:
            free ^= met & -met  # the first that is not used
            hits.append(c)
    m = len(hits)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(hits, (c for j, c in enumerate(b) if not free >> j & 1), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    same = 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return jaro + (0.1 * same * (1 - jaro) if jaro > 0.7 else 0.0)


def osa_distance(a: str, b: str) -> int:
    """Edits and swaps of neighbours, no part edited twice; a bit for each character of ``a`` (Hyyrö 2003)."""
    if not a or not b:
        return max(len(a), len(b))
    masks, full, last = _masks(a), (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, diagonal, before, distance = full, 0, 0, 0, len(a)
    for c in b:
        own = masks.get(c, 0)
        swapped = (((full ^ diagonal) & own) << 1) & before
        diagonal = ((((own & up) + up) ^ up) | own | down | swapped) & full
        right, left = down | (full ^ (diagonal | up)), diagonal & up
        distance += bool(right & last) - bool(left & last)
        right, left = (right << 1 | 1) & full, (left << 1) & full
        up, down, before = left | (full ^ (diagonal | right)), right & diagonal, own
    return distance


def osa_similarity(a: str, b: str) -> float:
    n = max(len(a), len(b))
    return 1 - osa_distance(a, b) / n if n else 1.0


_MEASURES = {"ratio": indel_ratio, "token_sort": token_sort_ratio, "token_set": token_set_ratio, "partial": partial_ratio, "jw": jaro_winkler, "osa": osa_similarity}


def measures(names: tuple[str, ...]):
    """A column function of two strings: a struct of these measures and no others. Each distinct pair of a batch is measured once."""
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])

    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        pairs = list(zip(a.fillna(""), b.fillna(""), strict=True))
        known = {p: tuple(_MEASURES[n](*p) for n in names) for p in set(pairs)}
        return pd.DataFrame([known[p] for p in pairs], columns=list(names))

    return F.pandas_udf(run, schema)


string_similarities = measures(NAMES)
