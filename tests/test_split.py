from pyspark.sql import functions as F

from ticketloom.operators import split as S

SUPPORT = [432, 635, 60, 82, 497, 791, 210, 126, 166, 1218]


def test_split_is_a_partition_with_exact_totals(spark):
    df = spark.range(1003).select(
        F.col("id").alias("ticket_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 17).cast("string")).alias("queue")
    )
    parts = S.stratified_split(df)
    counts = {r[0]: r[1] for r in parts.groupBy("split").count().collect()}
    held = 301  # ceil(0.3 x 1003)
    assert counts == {"train": 1003 - held, "val": held // 2, "test": held - held // 2}
    assert parts.select("ticket_id").distinct().count() == 1003
    sizes = {r["queue"]: r for r in S.split_sizes(df).collect()}
    for r in parts.groupBy("queue").pivot("split", ["train", "val", "test"]).count().na.fill(0).collect():
        want = sizes[r["queue"]]
        assert (r["train"], r["val"], r["test"]) == (want["n_train"], want["n_val"], want["n_test"])


def test_split_follows_key_order_and_repeats(spark):
    df = spark.range(400).select(F.col("id").alias("ticket_id"), F.lit("one").alias("queue"))
    first = {r[0]: r[2] for r in S.stratified_split(df).collect()}
    assert first == {r[0]: r[2] for r in S.stratified_split(df.repartition(7)).collect()}
    keys = {r[0]: r[1] for r in df.select("ticket_id", S.order_key("ticket_id")).collect()}
    ordered = sorted(first, key=lambda i: (keys[i], i))
    assert [first[i] for i in ordered] == ["train"] * 280 + ["val"] * 60 + ["test"] * 60


def test_published_split_sizes(spark):
    # The published test supports come from a corpus of 28,113 rows split 19,679 / 4,217 / 4,217.
    total = 28_113
    scaled = [round(s * total / sum(SUPPORT)) for s in SUPPORT]
    scaled[-1] += total - sum(scaled)
    df = spark.createDataFrame([(f"q{i}", n) for i, n in enumerate(scaled)], "queue string, n int")
    rows = df.select("queue", F.explode(F.sequence(F.lit(1), "n")).alias("x"))
    sums = S.split_sizes(rows).agg(F.sum("n_train"), F.sum("n_val"), F.sum("n_test")).first()
    assert tuple(sums) == (19_679, 4_217, 4_217)


def test_unlabelled_rows_stay_without_split(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, "a"), (5, "a")], "ticket_id long, queue string")
    got = {r["ticket_id"]: r["split"] for r in S.stratified_split(df).collect()}
    assert got[2] is None and len(got) == 5


def test_sample_quotas(spark):
    df = spark.range(1000).select(F.col("id").alias("ticket_id"), F.when(F.col("id") < 700, "big").otherwise("small").alias("queue"))
    got = {r[0]: r[1] for r in S.stratified_sample(df, 250).groupBy("queue").count().collect()}
    assert got == {"big": 175, "small": 75}
    assert S.stratified_sample(df.where("ticket_id < 100"), 250).count() == 100
    assert S.seeded_sample(df, 20).count() == 20
