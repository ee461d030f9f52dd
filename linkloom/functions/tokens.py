"""Token-list operations driven by rule tables, and predicates on token pairs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import is_non_latin


def _map(table: dict) -> Column:
    pairs = [x for k, v in sorted(table.items()) for x in (F.lit(k), F.array(*map(F.lit, v)) if isinstance(v, list | tuple | set) else F.lit(v))]
    return F.create_map(*pairs)


def transliterate(tokens: Column, table: dict[str, str]) -> Column:
    """Known spellings in other scripts become their Latin ones."""
    if not table:
        return tokens
    known = _map(table)
    return F.transform(tokens, lambda t: F.coalesce(F.when(is_non_latin(t), F.try_element_at(known, t)), t))


def strip_droppable(tokens: Column, droppable) -> Column:
    """Tokens that carry no identity go, unless none would be left."""
    if not droppable:
        return tokens
    gone = F.array(*map(F.lit, sorted(droppable)))
    kept = F.filter(tokens, lambda t: ~F.array_contains(gone, t))
    return F.when(F.size(kept) > 0, kept).otherwise(tokens)


def expand(token: Column, expansions: dict[str, list[str]]) -> Column:
    """The token, then its alternates in order of spelling."""
    if not expansions:
        return F.array(token)
    known = _map({k: sorted(v) for k, v in expansions.items()})
    return F.array_union(F.array(token), F.coalesce(F.try_element_at(known, token), F.array().cast("array<string>")))


def apply_phrases(tokens: Column, phrases: dict[str, str]) -> Column:
    """Known pairs of neighbours become one token, leftmost first, without overlap. The tokens are joined so that each
    has blanks of its own on both sides; one regular expression then marks the pairs from left to right, in time linear
    in the text."""
    if not phrases:
        return tokens
    second: dict[str, list[str]] = {}
    for pair in sorted(phrases):
        a, b = pair.split(" ")
        second.setdefault(a, []).append(b)
    heads = "|".join(f"{re.escape(a)}(?=  (?:{'|'.join(map(re.escape, b))}) )" for a, b in second.items())
    marked = F.regexp_replace(F.concat(F.lit(" "), F.array_join(tokens, "  "), F.lit(" ")), f" ({heads})  (\\S+) ", " \x01$1\x02$2 ")
    known = _map(phrases)
    split = F.filter(F.split(marked, " +"), lambda t: t != "")
    return F.transform(split, lambda t: F.when(F.startswith(t, F.lit("\x01")), F.try_element_at(known, F.translate(t, "\x02\x01", " "))).otherwise(t))


def is_subsequence(short: Column, long: Column) -> Column:
    """All characters of ``short`` occur in ``long`` in that order."""
    left = F.aggregate(F.split(long, ""), short, lambda rest, c: F.when((c != "") & (F.substring(rest, 1, 1) == c), F.substring(rest, 2, 1 << 20)).otherwise(rest))
    return left == ""


def related(a: Column, b: Column) -> Column:
    """Different, and one abbreviates the other or they are two edits apart at most and not short."""
    la, lb = F.length(a), F.length(b)
    shorter, longer = F.when(la <= lb, a).otherwise(b), F.when(la <= lb, b).otherwise(a)
    typo = (F.abs(la - lb) <= 2) & (F.least(la, lb) >= 4) & (F.levenshtein(a, b) <= 2)
    return (a != b) & (is_subsequence(shorter, longer) | typo)


def is_acronym(single: Column, words: Column) -> Column:
    """Each word starts with the token's character at its place."""
    letters = F.filter(F.split(single, ""), lambda c: c != "")
    return (F.size(letters) == F.size(words)) & F.forall(F.zip_with(letters, words, lambda c, w: F.coalesce(F.startswith(w, c), F.lit(False))), lambda x: x)


def only_in(a: Column, b: Column) -> Column:
    """Distinct tokens of ``a`` that ``b`` lacks, in order."""
    return F.array_except(a, b)


def jaccard(a: Column, b: Column) -> Column:
    n = F.size(F.array_union(a, b))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / n)


def safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def idf(df: Column, n: Column) -> Column:
    """The weight of a token that ``df`` of ``n`` pool records have."""
    return F.log(1.0 + F.greatest(n, F.lit(1)) / (1.0 + df))


# --- tokens as numbers: a row of the table of weights above, the token's document frequency below ------------
DF_BITS, ROW_BITS = 27, 26
_DF = (1 << DF_BITS) - 1


def code(df: Column) -> Column:
    """A number of its own for each row of a table of up to 2048 partitions, with ``df``, from which the weight follows.
    Not the same twice: write it before it is used."""
    row = F.monotonically_increasing_id()
    part, at = F.shiftright(row, 33), row.bitwiseAND(F.lit((1 << 33) - 1))
    fits = (part < 1 << (64 - DF_BITS - ROW_BITS)) & (at < 1 << ROW_BITS) & (df < _DF)
    return F.when(fits, F.shiftleft(part, DF_BITS + ROW_BITS).bitwiseOR(F.shiftleft(at, DF_BITS)).bitwiseOR(df)).otherwise(F.raise_error("too many tokens or records for their codes").cast("long"))


def unknown(token: Column) -> Column:
    """The code of a token that has no weight."""
    return F.shiftleft(F.xxhash64(token), DF_BITS).bitwiseOR(F.lit(_DF))


def frequency(code: Column) -> Column:
    """The document frequency in a code."""
    return code.bitwiseAND(F.lit(_DF))


def mass(codes: Column, n: Column) -> Column:
    """Sum of the weights of tokens by their codes, ``n`` pool records being in the country; unknown ones weigh nothing."""
    return F.aggregate(codes, F.lit(0.0), lambda s, c: s + F.when(frequency(c) == _DF, F.lit(0.0)).otherwise(idf(frequency(c), n)))
