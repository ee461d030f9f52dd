"""Text normalisation as column expressions.

Only Unicode folding of non-ASCII text leaves the JVM: Spark has no NFKD, so those rows alone go through an Arrow UDF.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

# --- fixed values: the character classes that define the normal form --------------------------------
#: Look-alike characters and what stands for them.
CONFUSABLE = {"l": "i", "1": "i", "j": "i", "0": "o", "5": "s", "3": "e", "4": "a", "8": "b", "9": "g", "6": "g", "7": "t", "2": "z"}
#: Characters without a width of their own; they go.
INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
#: Punctuation beyond ASCII: dashes, curly quotes, guillemets, bullets, danda.
MORE_PUNCTUATION = "\u2010\u2011\u2012\u2013\u2014\u2015\u2018\u2019\u201c\u201d\u00ab\u00bb\u00b7\u2022\u0964\u0965"
#: Share of letters from which a token counts as a word with look-alikes in it.
LETTER_SHARE = 0.66
# -------------------------------------------------------------------------------------------------------

PUNCTUATION = " " + "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + MORE_PUNCTUATION
_GONE = re.compile(f"[{INVISIBLE}\u0300-\u036f]+")  # with the combining accents


@F.pandas_udf(T.StringType())
def _folded(text: pd.Series) -> pd.Series:
    return text.map(lambda s: _GONE.sub("", unicodedata.normalize("NFKD", s)), na_action="ignore")


def fold_unicode(text: Column) -> Column:
    """Accents, compatibility forms and invisible characters go; other scripts stay. ASCII text skips the UDF: it is
    handed nulls there, which cost next to nothing."""
    foreign = text.rlike(r"[^\x00-\x7F]")
    return F.when(foreign, _folded(F.when(foreign, text))).otherwise(text)


def norm_text(text: Column, ascii_only: bool = False) -> Column:
    """Lower-case words with single spaces; an ampersand reads "and". ``ascii_only`` promises that no folding is due."""
    s = F.regexp_replace(F.coalesce(text, F.lit("")), r"\s*&\s*", " and ")
    s = s if ascii_only else fold_unicode(s)
    return F.trim(F.regexp_replace(F.lower(F.translate(s, PUNCTUATION, " " * len(PUNCTUATION))), r"\s+", " "))


def tokenize(text: Column) -> Column:
    """White-space tokens after punctuation; none for empty text."""
    s = F.translate(F.coalesce(text, F.lit("")), PUNCTUATION, " " * len(PUNCTUATION))
    return F.filter(F.split(s, r"\s+"), lambda t: t != "")


def tokens_of_normal(text: Column) -> Column:
    """``tokenize`` of what ``norm_text`` made, which has no punctuation and single spaces."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def alpha_ratio(token: Column) -> Column:
    n = F.length(token)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(token, r"[^\p{L}]", "")) / n)


def is_number(token: Column) -> Column:
    return token.rlike(r"^\p{Nd}+$")


def skeletonize_token(token: Column) -> Column:
    """Look-alikes collapse in tokens that are mostly letters. Most tokens are nothing but plain letters, which a
    translation shows at a fraction of what the expressions for the others cost."""
    collapsed = F.translate(token, "".join(CONFUSABLE), "".join(CONFUSABLE.values()))
    plain = is_number(token) | (alpha_ratio(token) < LETTER_SHARE)
    return F.when(F.translate(token, "abcdefghijklmnopqrstuvwxyz", "") == "", collapsed).when(plain, token).otherwise(collapsed)


def skeletonize(tokens: Column) -> Column:
    return F.transform(tokens, skeletonize_token)


def words_of(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~is_number(t))


def numbers_of(tokens: Column) -> Column:
    return F.filter(tokens, is_number)


def is_non_latin(text: Column) -> Column:
    """A letter at or beyond U+0900 occurs."""
    return F.coalesce(text, F.lit("")).rlike(r"[\x{0900}-\x{10FFFF}&&[\p{L}]]")


def name_key(tokens: Column) -> Column:
    """All tokens in order of spelling, repeats included; null for none."""
    return F.when(F.size(tokens) > 0, F.array_join(F.array_sort(tokens), " "))
