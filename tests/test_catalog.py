"""Every query with SQL agrees with it; the others return rows."""

import pytest

from check import compare, database
from ticketloom.operators import models
from ticketloom.plans import catalog

# Whole grids take minutes; here each family has one row of it.
TRAINED = {"train_svm_ovr", "train_forest", "tune_grid", "train_text_logreg"}
ONE_ROW = {
    "random_forest": [{"trees": 3, "leaf": 2, "depth": 5}], "linear_svm": [{"C": 0.5, "class_weight": "balanced"}],
    "logistic_regression": [{"C": 1.0, "class_weight": None}], "tuned_logistic_regression": [{"C": 1.0, "class_weight": None}],
}
ORACLES = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, sf, name):
    db = database(sf)
    assert compare(catalog.queries()[name](spark, sf), db.sql(ORACLES[name])) == ""


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(ORACLES) - TRAINED))
def test_returns_rows(spark, sf, name):
    assert catalog.queries()[name](spark, sf).count() > 0


@pytest.mark.parametrize("name", sorted(TRAINED))
def test_training_queries_answer_every_test_ticket(spark, sf, name, monkeypatch):
    monkeypatch.setattr(models, "GRIDS", ONE_ROW)
    rows = catalog.queries()[name](spark, sf).collect()
    if name == "tune_grid":
        assert sorted((r["model"], r["place"]) for r in rows) in ([("linear_svm", 1), ("logistic_regression", 2)], [("linear_svm", 2), ("logistic_regression", 1)])
        assert all(0.0 <= r["f1"] <= 1.0 and r["params"] for r in rows)
    else:
        answer = next(c for c in rows[0].asDict() if c.startswith("pred_"))
        labels = {r["queue"] for r in rows}
        assert len({r["ticket_id"] for r in rows}) == len(rows) > 0 and all(r[answer] is not None for r in rows)
        assert name == "train_text_logreg" or {r[answer] for r in rows} <= labels


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["accuracy", "precision", "recall", "f1"]
    assert set(e.oracle_sql()) <= set(e.queries())
