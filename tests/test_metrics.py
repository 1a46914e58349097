from pyspark.sql import functions as F

from ticketloom.operators import metrics as M
from ticketloom.operators import profile as P

# Published per-class results of the linear SVM: queue, tp, predicted, support, Retrieval@5.
GOLDEN = [
    ("Billing and Payments", 379, 425, 432, 0.9491), ("Customer Service", 441, 633, 635, 0.9008),
    ("General Inquiry", 32, 34, 60, 0.8500), ("Human Resources", 49, 55, 82, 0.7927),
    ("IT Support", 315, 446, 497, 0.8732), ("Product Support", 563, 808, 791, 0.9153),
    ("Returns and Exchanges", 125, 149, 210, 0.8286), ("Sales and Pre-Sales", 71, 80, 126, 0.7698),
    ("Service Outages and Maintenance", 115, 131, 166, 0.8916), ("Technical Support", 998, 1456, 1218, 0.9294),
]


def golden(spark):
    return spark.createDataFrame([g[:4] for g in GOLDEN], "label string, tp long, predicted long, support long")


def test_published_scores(spark):
    row = M.scores_from_counts(golden(spark)).first()
    assert tuple(row) == (0.7323, 0.7417, 0.7323, 0.7311)
    macro = M.per_class_scores(golden(spark)).agg(F.round(F.avg("f1"), 4)).first()[0]
    assert macro == 0.7255
    assert round(sum(g[3] * g[4] for g in GOLDEN) / 4217, 4) == 0.9028


def test_published_imbalance(spark):
    rows = golden(spark).select(F.explode(F.sequence(F.lit(1), F.col("support").cast("int"))).alias("x"), F.col("label").alias("queue"))
    row = P.class_imbalance(rows).first()
    assert row["imbalance_ratio"] == 20.3
    assert (round(row["entropy_nats"], 4), round(row["entropy_bits"], 4)) == (1.9619, 2.8304)
    assert row["severity"] == "severe"


def predictions(spark, rows):
    return spark.createDataFrame(rows, "queue string, predicted_queue string")


def test_unpredicted_and_unknown_labels(spark):
    df = predictions(spark, [("a", "a"), ("a", "c"), ("b", "a")])
    got = {r["label"]: r for r in M.classification_report(df).collect()}
    assert (got["b"]["precision"], got["b"]["support"]) == (0.0, 1)
    assert (got["c"]["recall"], got["c"]["support"]) == (0.0, 0)
    assert got["a"]["precision"] == 0.5 and got["a"]["recall"] == 0.5
    assert got["accuracy"]["f1"] == 0.3333 and got["weighted avg"]["recall"] == 0.3333
    assert got["macro avg"]["f1"] == round(0.5 / 3, 4)
    cells = {(r[0], r[1]): r[2] for r in M.confusion_matrix(df).collect()}
    assert len(cells) == 9 and cells[("a", "c")] == 1 and cells[("c", "a")] == 0


def test_empty_input(spark):
    assert M.weighted_scores(predictions(spark, [])).first()["f1"] is None


def test_best_candidate_takes_the_first_of_equals(spark):
    grid = spark.createDataFrame([("m", 0, 0.7), ("m", 1, 0.71), ("m", 2, 0.71)], "family string, grid_pos int, val_f1 double")
    assert M.best_candidate(grid).first()["grid_pos"] == 1


def test_published_ranking(spark):
    rows = [("Logistic Regression", 0.6973, 0.6909), ("Random Forest", 0.6841, 0.6755), ("Linear SVM", 0.7311, 0.7159)]
    scores = spark.createDataFrame(rows, "model string, f1 double, val_f1 double")
    ranked = M.rank_models(scores).orderBy("place").collect()
    assert [r["model"] for r in ranked] == ["Linear SVM", "Logistic Regression", "Random Forest"]
    assert [r["recommended"] for r in ranked] == [True, False, False]
    assert M.rank_models(scores, "val_f1").where("place = 1").first()["model"] == "Linear SVM"


def test_published_delta(spark):
    base = spark.createDataFrame([("f1", 0.7311)], "metric string, value double")
    other = spark.createDataFrame([("f1", 0.7223)], "metric string, value double")
    row = M.metric_delta(base, other).first()
    assert (row["delta"], row["delta_pct"]) == (-0.0088, -1.2)


def test_every_label_is_listed_once_in_order(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") > 0, F.concat(F.lit("q"), F.col("id") % 20_000)).alias("queue"))
    assert M.label_list(rows) == sorted(f"q{k}" for k in range(20_000))
