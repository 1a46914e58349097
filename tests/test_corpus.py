import pytest
from pyspark.sql import functions as F

from ticketloom.operators import corpus as C
from ticketloom.operators import profile as P
from ticketloom.operators import quality as G
from ticketloom.scale import hot_keys, salted_join, scratch_path
from ticketloom.sources import tables as IO


def test_length_limits_are_inclusive(spark):
    df = spark.createDataFrame([(n, "x" * n) for n in (29, 30, 5000, 5001)], "ticket_id long, clean_body string")
    assert sorted(r[0] for r in C.filter_body_length(df).collect()) == [30, 5000]


def test_requests(spark):
    rows = [(1, None), (2, ""), (3, "x"), (4, "x" * 5000), (5, "x" * 5001)]
    df = C.validate_requests(spark.createDataFrame(rows, "ticket_id long, body string"))
    assert {r[0]: r[2] for r in df.collect()} == {1: "missing_body", 2: "empty_body", 3: None, 4: None, 5: "body_too_long"}


def test_optional_columns(spark):
    df = spark.createDataFrame([(1, "body text", "q", "t1")], "ticket_id long, body string, queue string, tag_1 string")
    assert C.filter_language(df).count() == 1
    assert IO.corpus_columns(C.add_length_columns(C.add_clean_columns(df))).columns == [
        "ticket_id", "body", "queue", "tag_1", "clean_body", "body_length",
    ]
    with pytest.raises(ValueError):
        IO.require_columns(df, ["answer"])
    with pytest.raises(ValueError):
        IO.require_aligned(df, df.where("false"), "ticket_id")


def test_lemmas_map_back_to_every_copy(spark):
    texts = ["tickets printing please", "other words", "tickets printing please", "on it", None]
    df = spark.createDataFrame(list(enumerate(texts)), "ticket_id long, clean_body string")
    lemmas = spark.createDataFrame([("tickets", "ticket"), ("printing", "print"), ("words", "word")], "token string, lemma string")
    # A share of 0.3 makes the copied text hot, so it takes the salted way.
    out = C.map_distinct(df, "clean_body", "lemmatized_body", lambda t: C.lemmatize(t, lemmas), hot_share=0.3, hot_rows=0)
    assert [r["lemmatized_body"] for r in out.orderBy("ticket_id").collect()] == ["print", "other word", "print", "", None]


def test_salted_join_is_a_join(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hot = hot_keys(left.groupBy("k").count(), "k", "count", 0.1, least=0)
    assert [r[0] for r in hot.collect()] == [1]
    got = salted_join(left, right, "k", hot, F.col("id"), salts=8)
    assert sorted(map(tuple, got.select("id", "k", "v").collect())) == sorted(map(tuple, left.join(right, "k", "left").select("id", "k", "v").collect()))


def test_nulls_duplicates_conflicts(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), (None, "x"), (None, "x"), ("b", None)]
    df = spark.createDataFrame(rows, "body string, queue string")
    assert {r[0]: r[1] for r in G.null_counts(df).collect()} == {"body": 2, "queue": 1}
    assert G.full_row_duplicates(df).first()["duplicate_rows"] == 2
    assert tuple(G.duplicate_bodies(df).first()) == (6, 2, 4)
    row = G.label_conflicts(df).first()
    assert (row["bodies"], row["conflicting_bodies"], row["single_label_share"]) == (2, 1, 0.0)
    assert C.drop_repeated_bodies(df.withColumn("ticket_id", F.monotonically_increasing_id())).count() == 4


def test_row_digest_keeps_layouts_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "c"), ("", "c")], "x string, y string")
    assert G.full_row_duplicates(df).first()["duplicate_rows"] == 0


def test_entropy_edges(spark):
    one = spark.createDataFrame([("a",)] * 5, "queue string")
    row = P.class_imbalance(one).first()
    assert (row["entropy_nats"], row["balance"]) == (0.0, None)
    even = spark.createDataFrame([("a",), ("b",), ("a",), ("b",)], "queue string")
    assert P.class_imbalance(even).first()["balance"] == 1.0


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(7,)] * 3, "n int")
    rows = P.histogram(df, "n", 100, bins=4).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [3, 0, 0, 0]


def test_csv_roundtrip_keeps_line_breaks_and_quotes(spark):
    rows = [(1, 'say "hi",\nthen\r\nleave'), (2, " padded "), (3, None), (4, "back\\slash")]
    df = spark.createDataFrame(rows, "ticket_id long, body string")
    path = scratch_path(spark, "csv")
    IO.write_csv(df, path)
    assert sorted(map(tuple, IO.read_csv(spark, path, df.schema).collect())) == rows


def test_a_second_build_lemmatises_nothing(spark, monkeypatch):
    from ticketloom.operators import corpus as C
    from ticketloom.scale import scratch_path

    row = lambda i, body: (i, "S", body, "An answer.", "Incident", "IT", "high", "en", "t1")
    long = " with the servers that were failing again in the office"
    columns = "ticket_id long, subject string, body string, answer string, type string, queue string, priority string, language string, tag_1 string"
    table = [row(1, "Printers" + long), row(2, "Printers" + long), row(3, "Laptops" + long)]
    lemmas = lambda _: spark.createDataFrame([("servers", "server"), ("failing", "fail")], "token string, lemma string")
    store, seen = scratch_path(spark, "store"), []
    work = C.lemmatize

    def counted(texts, *args, **options):
        seen.append(texts.count())
        return work(texts, *args, **options)

    monkeypatch.setattr(C, "lemmatize", counted)
    first = C.build_corpus(spark.createDataFrame(table[:2], columns), lemmas, store)
    assert {r["lemmatized_body"] for r in first.collect()} == {"printers server fail office"}
    again = C.build_corpus(spark.createDataFrame(table, columns), lemmas, store)
    assert {r["ticket_id"]: r["lemmatized_body"].split()[0] for r in again.collect()} == {1: "printers", 2: "printers", 3: "laptops"}
    C.build_corpus(spark.createDataFrame(table, columns), lemmas, store)
    assert seen == [1, 1, 0]
    assert again.columns == ["ticket_id", "subject", "body", "answer", "type", "queue", "priority", "tag_1", "clean_body", "clean_answer", "lemmatized_body", "body_length", "answer_length", "clean_answer_length"]
    with pytest.raises(ValueError):
        C.build_corpus(spark.createDataFrame(table, columns).drop("priority"), lemmas, store)
