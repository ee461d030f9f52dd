import pytest
from pyspark.sql import functions as F

from linkloom.functions import minhash, normalize, tokens


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("text", "want"), [
    ("BÍNGAMAN", "bingaman"), ("Harper, Bingaman & Guallpa LLC", "harper bingaman and guallpa llc"), ("A&B", "a and b"), ("", ""), (None, ""), ("  a\t b ", "a b"),
    ("Café — «Noël»", "cafe noel"), ("a‌b", "ab"), ("हिन्दी।", "हिन्दी"),
])
def test_norm_text(spark, text, want):
    assert one(spark, text, normalize.norm_text) == want


@pytest.mark.parametrize(("a", "b"), [("5herman", "sherman"), ("pr0ud", "proud"), ("lndia", "india")])
def test_look_alikes_collapse(spark, a, b):
    assert one(spark, a, normalize.skeletonize_token) == one(spark, b, normalize.skeletonize_token)


@pytest.mark.parametrize("token", ["17th", "6519"])
def test_numbers_survive(spark, token):
    assert one(spark, token, normalize.skeletonize_token) == token


def test_unlike_letters_stay(spark):
    assert one(spark, "quality", normalize.skeletonize_token) != one(spark, "guality", normalize.skeletonize_token)


@pytest.mark.parametrize(("addr", "nums"), [("6519 17RD AVE, PMB 9349, SEATTLE, WA", ["6519", "9349"]), ("MIG #151, SREESAILAM, 38/412", ["151", "38", "412"])])
def test_split_numeric(spark, addr, nums):
    got = one(spark, addr, lambda c: normalize.numbers_of(normalize.tokenize(normalize.norm_text(c))))
    assert got == nums


@pytest.mark.parametrize(("text", "want"), [("हिन्दी", True), ("తెలుగు", True), ("latin é", False), ("", False), (None, False), ("।", False)])
def test_non_latin(spark, text, want):
    assert one(spark, text, normalize.is_non_latin) is want


def test_alpha_ratio(spark):
    assert one(spark, "", normalize.alpha_ratio) == 0
    assert one(spark, "ab12", normalize.alpha_ratio) == 0.5


def test_name_key_keeps_repeats(spark):
    assert one(spark, "b a b", lambda c: normalize.name_key(normalize.tokenize(c))) == "a b b"
    assert one(spark, "", lambda c: normalize.name_key(normalize.tokenize(c))) is None


def test_seeded_crc32_matches_zlib(spark):
    import zlib

    got = one(spark, "sherman café", lambda c: minhash.crc32_bands(F.split(c, " ")))
    s = "café sherman"
    grams = [s[i : i + 3].encode() for i in range(len(s) - 2)]
    want = [(b, min(zlib.crc32(g, 2 * b + 1) for g in grams), min(zlib.crc32(g, 2 * b + 2) for g in grams)) for b in range(4)]
    assert [tuple(r) for r in got] == want
    assert one(spark, "", lambda c: minhash.crc32_bands(normalize.tokenize(c))) == []
    assert len(one(spark, "ab", lambda c: minhash.crc32_bands(normalize.tokenize(c)))) == 4


def test_rule_tables(spark):
    words = lambda f: lambda c: f(normalize.tokenize(c))
    assert one(spark, "acme llc", words(lambda t: tokens.strip_droppable(t, {"llc"}))) == ["acme"]
    assert one(spark, "llc inc", words(lambda t: tokens.strip_droppable(t, {"llc", "inc"}))) == ["llc", "inc"]
    assert one(spark, "st", lambda c: tokens.expand(c, {"st": ["street", "saint"]})) == ["st", "saint", "street"]
    assert one(spark, "x", lambda c: tokens.expand(c, {"st": ["street"]})) == ["x"]
    assert one(spark, "हिन्दी ltd", words(lambda t: tokens.transliterate(t, {"हिन्दी": "hindi", "ltd": "no"}))) == ["hindi", "ltd"]


@pytest.mark.parametrize(("text", "want"), [("new york city", "ny city"), ("new new york", "new ny"), ("a a a", "aa a"), ("a a a a", "aa aa"), ("york new", "york new"), ("", ""), ("new york a a", "ny aa")])
def test_phrases_are_greedy(spark, text, want):
    got = one(spark, text, lambda c: tokens.apply_phrases(normalize.tokenize(c), {"new york": "ny", "a a": "aa"}))
    assert " ".join(got) == want


@pytest.mark.parametrize(("a", "b", "want"), [("dr", "drive", True), ("dr", "ltd", False), ("road", "raod", True), ("llc", "inc", False), ("x", "x", False), ("st", "street", True), ("abcd", "wxyz", False)])
def test_related(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(tokens.related(F.col("a"), F.col("b")).alias("r")).first()["r"] is want


def test_acronyms_and_differences(spark):
    df = spark.createDataFrame([("up", ["uttar", "pradesh"], ["pradesh", "x"])], "s string, m array<string>, n array<string>")
    r = df.select(tokens.is_acronym(F.col("s"), F.col("m")).alias("a"), tokens.only_in(F.col("m"), F.col("n")).alias("d"), tokens.jaccard(F.col("m"), F.col("n")).alias("j"), tokens.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("e")).first()
    assert r["a"] is True and r["d"] == ["uttar"] and r["j"] == pytest.approx(1 / 3) and r["e"] == 0
