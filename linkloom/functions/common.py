"""The most frequent tokens, which every task holds, so that only rows of the others are joined with a table of all.

Each of them is in more pool records than any token that is left out. They are most of a text, and few however large the
input is.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

#: Tokens of all countries together that are held at most.
HELD = 1 << 16


def most_frequent(counted: DataFrame, df: Column, *more: str) -> list[tuple]:
    """(country, token, df, more) of the most frequent rows of ``counted``, without those as frequent as one left out."""
    rows = counted.select("country", "token", df.alias("_df"), *more).orderBy(F.desc("_df")).limit(HELD).collect()
    least = rows[-1]["_df"] if len(rows) == HELD else 0
    return [tuple(r) for r in rows if r["_df"] > least]


def thinned(counted: DataFrame, k: int):
    """A column function of the country and a list of tokens: of the held tokens only the ``k`` rarest (ties by spelling), and
    all others. Those are rarer, so the k rarest of the list are among what is left."""
    order: dict[str, list[str]] = {}
    for country, token, _ in sorted(most_frequent(counted, F.col("df")), key=lambda r: (r[2], r[1])):
        order.setdefault(country, []).append(token)

    @F.pandas_udf("array<string>")
    def run(country: pd.Series, tokens: pd.Series) -> pd.Series:
        place = {c: {t: i for i, t in enumerate(known)} for c, known in order.items() if c in set(country)}
        out = []
        for c, own in zip(country, tokens, strict=True):
            at, own = place.get(c, {}), set(() if own is None else own)
            met = sorted(at[t] for t in own if t in at)[:k]
            out.append([t for t in own if t not in at] + [order[c][i] for i in met])
        return pd.Series(out, index=tokens.index, dtype=object)

    return run


def coded(codes: DataFrame, df: Column):
    """A column function of the country and a list of tokens: a struct of ``known``, the held tokens' codes, and ``rest``, the
    other tokens, each once."""
    held: dict[str, dict[str, int]] = {}
    for country, token, _, code in most_frequent(codes, df, "code"):
        held.setdefault(country, {})[token] = code

    @F.pandas_udf("known array<bigint>, rest array<string>")
    def run(country: pd.Series, tokens: pd.Series) -> pd.DataFrame:
        known, rest = [], []
        for c, own in zip(country, tokens, strict=True):
            at, own = held.get(c, {}), set(() if own is None else own)
            known.append([at[t] for t in own if t in at])
            rest.append([t for t in own if t not in at])
        return pd.DataFrame({"known": pd.Series(known, dtype=object), "rest": pd.Series(rest, dtype=object)})

    return run
