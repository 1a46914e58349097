import pytest
from pyspark.sql import functions as F

from ticketloom.functions import text as X
from ticketloom.operators.quality import detect_language

CASES = [
    (None, None),
    ("", ""),
    ("Visit https://a.b/c?d=1 now", "visit now"),
    ("www.x.org!", ""),
    ("mail me: a.b@c.de.", "mail me"),
    ("ERR 0x8004005 v3.2.1", "err 0x8004005 v3 2 1"),
    ("ﬁx ①", "fix 1"),
    ("ＡＢＣ", "abc"),
    ("a b", "a b"),
    ("café naïve", "caf na ve"),
    ("é", ""),
    ("x y@z.w", "x"),
    ("<b>Hi</b>", "b hi b"),
    ("a\u00a0b", "a b"),
    ("see www.x\u2003y", "see y"),
    ("  many   spaces \n\t here ", "many spaces here"),
]


@pytest.mark.parametrize("raw,want", CASES)
def test_clean_text(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(X.clean_text(F.col("t"))).first()[0] == want


def test_strip_html(spark):
    df = spark.createDataFrame([("<b>Hi</b> <a href='http://x.y'>there</a>",)], "t string")
    assert df.select(X.clean_text(F.col("t"), strip_html=True)).first()[0] == "hi there"


def test_combining_mark_composes(spark):
    df = spark.createDataFrame([("é",), ("é",)], "t string")
    assert {r[0] for r in df.select(X.nfkc(F.col("t"))).collect()} == {"é"}


def test_tokens_and_bigrams(spark):
    df = spark.createDataFrame([("A bb ccc bb",), ("",), ("x",)], "t string")
    rows = df.select(X.with_bigrams(X.word_tokens(F.col("t")))).collect()
    assert rows[0][0] == ["bb", "ccc", "bb", "bb ccc", "ccc bb"]
    assert rows[1][0] == [] and rows[2][0] == []


def test_keep_terms_drops_stops_and_short(spark):
    df = spark.createDataFrame([("please the printer is on fire",)], "t string")
    kept = df.select(X.keep_terms(X.whitespace_tokens(F.col("t")), X.DOMAIN_STOP_WORDS)).first()[0]
    assert kept == ["printer", "fire"]


def test_guess_language(spark):
    df = spark.createDataFrame([("the cat and the dog",), ("der Hund und die Katze",), ("zzz",), (None,)], "t string")
    assert [r["detected"] for r in detect_language(df, "t").collect()] == ["en", "de", "unknown", "unknown"]


def test_metric_key(spark):
    assert spark.range(1).select(X.metric_key(F.lit("Retrieval@5"))).first()[0] == "Retrieval_5"
