from pyspark.sql import functions as F

from samefold.functions import similarity, text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


def test_normalize(spark):
    assert one(spark, "  ABC Ltd.  ", text.normalize_text) == "abc ltd"
    assert one(spark, None, text.normalize_text) == ""
    assert one(spark, "Café_1 राम", text.normalize_text) == "café_1 र म"
    assert one(spark, "राम", lambda c: text.normalize_text(c, marks=True)) == "राम"
    assert one(spark, "see www.x.org now", lambda c: text.normalize_text(c, urls=True)) == "see now"
    assert one(spark, "Café", lambda c: text.normalize_text(c, ascii_only=True)) == "caf"
    assert one(spark, "ＳＴＲＡßＥ_x", text.normalize_name) == "strasse x"


def test_country(spark):
    assert one(spark, " United  States ", text.normalize_country) == "us"
    assert one(spark, "IND", lambda c: text.normalize_country(c, fold=True)) == "india"
    assert one(spark, "NA", text.normalize_country) == "na"


def test_keys(spark):
    assert one(spark, "a b corp", lambda c: text.prefix(c, 5)) == "abcor"
    assert one(spark, "abc", lambda c: text.suffix(c, 4)) == ""
    assert one(spark, "flat 4120 1234567 12", text.first_number) == "4120"
    assert one(spark, "1234567 9", text.first_number) == "9"
    assert one(spark, "٣ and 4 4", text.numbers) == ["٣", "4"]
    assert one(spark, "ab", text.char_grams) == []
    assert one(spark, "a b c d", text.char_grams) == ["abc", "bcd"]
    assert one(spark, "x yy zz", text.tokens) == ["yy", "zz"]
    assert one(spark, "a bbb cccc dd e", lambda c: text.first_tokens(c, 3, 3)) == ["bbb", "cccc"]


def test_similarity():
    assert similarity.ratio("", "") == 100.0
    assert similarity.lcs("abcde", "ace") == 3
    assert similarity.ratio("ab", "cd") == 0.0
    assert similarity.partial_ratio("acme", "the acme corp") == 100.0
    assert similarity.token_sort_ratio("b a", "a b") == 100.0
    assert similarity.token_set_ratio("a b", "a b c") == 100.0
    assert similarity.token_set_ratio("", "a") == 0.0
