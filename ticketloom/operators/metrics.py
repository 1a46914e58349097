"""Classification and retrieval metrics, each from one pass over the predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions.text import metric_key

RETRIEVAL_CUTS = (1, 3, 5, 10)


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def pair_counts(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_class_counts(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """label, tp, predicted, support for every label on either side."""
    none = F.lit(0).cast("long")
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(none)
    side = lambda label, tp, predicted, support: F.struct(
        F.col(label).alias("label"), tp.alias("tp"), predicted.alias("predicted"), support.alias("support")
    )
    sides = F.array(side("truth", hit, none, F.col("n")), side("predicted", none, F.col("n"), none))
    return (
        pair_counts(df, truth, predicted, by)
        .select(*by, F.inline(sides))
        .groupBy(*by, "label")
        .agg(F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("support").alias("support"))
    )


def per_class_scores(counts: DataFrame) -> DataFrame:
    """Unrounded precision, recall and F1 from tp, predicted and support; x/0 is 0."""
    return counts.select(
        "label",
        "tp",
        "predicted",
        "support",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
    )


def _weighted(column: str) -> Column:
    return F.sum(F.col("support") * F.col(column)) / F.sum("support")


def scores_from_counts(counts: DataFrame, digits: int = 4, by: Sequence[str] = ()) -> DataFrame:
    scored = counts.select(
        *by,
        "tp",
        "support",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
    )
    return scored.groupBy(*by).agg(
        F.round(F.sum("tp") / F.sum("support"), digits).alias("accuracy"),
        F.round(_weighted("precision"), digits).alias("precision"),
        F.round(_weighted("recall"), digits).alias("recall"),
        F.round(_weighted("f1"), digits).alias("f1"),
    )


def weighted_scores(
    df: DataFrame, truth: str = "queue", predicted: str = "predicted_queue", digits: int = 4, by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1; one row, or one per ``by`` group."""
    return scores_from_counts(per_class_counts(df, truth, predicted, by), digits, by)


def classification_report(df: DataFrame, truth: str = "queue", predicted: str = "predicted_queue", digits: int = 4) -> DataFrame:
    """A row per label, then accuracy, macro avg and weighted avg."""
    scored = per_class_scores(per_class_counts(df, truth, predicted))
    names = ["precision", "recall", "f1"]
    labels = scored.select(F.col("label").cast("string").alias("label"), *names, "support")
    overall = scored.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.sum("support").alias("support"),
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[_weighted(c).alias(f"weighted_{c}") for c in names],
    )
    def row(title: str, prefix: str) -> Column:
        cells = [F.col("accuracy") if not prefix else F.col(f"{prefix}_{c}") for c in names]
        return F.struct(F.lit(title).alias("label"), *[x.alias(c) for x, c in zip(cells, names)], "support")
    totals = overall.select(
        F.explode(F.array(row("accuracy", ""), row("macro avg", "macro"), row("weighted avg", "weighted"))).alias("r")
    ).select("r.*")
    return labels.unionByName(totals).select("label", *[F.round(c, digits).alias(c) for c in names], "support")


def confusion_matrix(df: DataFrame, truth: str = "queue", predicted: str = "predicted_queue") -> DataFrame:
    """Long form with zeros kept: truth, predicted, n over all pairs of labels.

    The matrix has as many cells as labels squared by definition; it is laid out from the label
    list, not from the rows.
    """
    counts = pair_counts(df, truth, predicted)
    grid = (
        counts.select(F.explode(F.array("truth", "predicted")).alias("label"))
        .agg(F.array_sort(F.collect_set("label")).alias("labels"))
        .select(F.explode("labels").alias("truth"), "labels")
        .select("truth", F.explode("labels").alias("predicted"))
    )
    return grid.join(counts, ["truth", "predicted"], "left").select("truth", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def first_match(
    queries: DataFrame, neighbors: DataFrame, k: int = 10, id_col: str = "ticket_id",
    label_col: str = "queue", neighbor_label: str = "neighbor_queue",
) -> DataFrame:
    """Each query with the rank of its first neighbour of the same label (null: none in k) and its
    best score.  Every retrieval metric below reads this one table."""
    truth = queries.select(F.col(id_col).alias("query_id"), F.col(label_col).alias("_truth"))
    within = neighbors.where(F.col("rank") <= k).select("query_id", "rank", "score", F.col(neighbor_label).alias("_label"))
    return (
        truth.join(within, "query_id", "left")
        .groupBy("query_id", F.col("_truth").alias(label_col))
        .agg(
            F.min(F.when(F.col("_label") == F.col("_truth"), F.col("rank"))).alias("match_rank"),
            F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("top_score"),
        )
    )


def retrieval_at_k(matches: DataFrame, cuts: Sequence[int] = RETRIEVAL_CUTS, digits: int = 4) -> DataFrame:
    """k, hit_rate."""
    hit = lambda k: F.round(F.avg(F.coalesce((F.col("match_rank") <= k).cast("int"), F.lit(0))), digits)
    return matches.agg(*[hit(k).alias(f"at_{k}") for k in cuts]).select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"at_{k}").alias("hit_rate")) for k in cuts])).alias("r")
    ).select("r.*")


def mean_reciprocal_rank(matches: DataFrame, digits: int = 4) -> DataFrame:
    return matches.agg(F.round(F.avg(F.coalesce(1 / F.col("match_rank"), F.lit(0.0))), digits).alias("mrr"))


def mean_top1(matches: DataFrame, digits: int = 4) -> DataFrame:
    """Mean best score, not clamped."""
    return matches.agg(F.round(F.avg("top_score"), digits).alias("mean_top1"))


def retrieval_per_class(matches: DataFrame, k: int = 5, label_col: str = "queue", digits: int = 4) -> DataFrame:
    """Hit rate at k per true label, worst first."""
    hit = F.coalesce((F.col("match_rank") <= k).cast("int"), F.lit(0))
    return (
        matches.groupBy(label_col)
        .agg(F.round(F.avg(hit), digits).alias("hit_rate"), F.count(F.lit(1)).alias("queries"))
        .orderBy("hit_rate", label_col)
    )


def label_list(df: DataFrame, label_col: str = "queue") -> list[str]:
    """Sorted distinct labels.  Every prompt spells all of them out, which bounds a label set."""
    return sorted(r[0] for r in df.where(F.col(label_col).isNotNull()).select(label_col).distinct().collect())


def metric_rows(scores: DataFrame, names: Sequence[str] = ("accuracy", "precision", "recall", "f1"), keep: Sequence[str] = ()) -> DataFrame:
    """Wide metric row(s) to long: metric, value."""
    return scores.unpivot(list(keep), list(names), "metric", "value")


def run_log(
    scores: DataFrame, run_col: str, params: dict[str, Column], names: Sequence[str] = ("accuracy", "precision", "recall", "f1"), digits: int = 4
) -> DataFrame:
    """run, kind, key, value: parameters and metrics of each run as flat text records."""
    entries = [F.struct(F.lit("param").alias("kind"), F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in params.items()]
    entries += [
        F.struct(F.lit("metric").alias("kind"), metric_key(F.lit(n)).alias("key"), F.format_string(f"%.{digits}f", F.col(n)).alias("value"))
        for n in names
    ]
    return scores.select(F.col(run_col).alias("run"), F.inline(F.array(*entries)))


def metric_delta(base: DataFrame, other: DataFrame, digits: int = 4) -> DataFrame:
    """Two long metric tables side by side with absolute and relative difference (percent)."""
    return (
        base.select("metric", F.col("value").alias("base"))
        .join(other.select("metric", F.col("value").alias("other")), "metric")
        .withColumn("delta", F.round(F.col("other") - F.col("base"), digits))
        .withColumn(
            "delta_pct",
            F.when(F.col("base") != 0, F.round(100 * (F.col("other") - F.col("base")) / F.col("base"), 1)),
        )
    )


def rank_models(scores: DataFrame, metric: str = "f1", name_col: str = "model") -> DataFrame:
    """Models in metric order, 1..n, ties by name.  One row per model family reaches the window."""
    order = Window.partitionBy().orderBy(F.desc(metric), F.asc(name_col))
    return scores.withColumn("place", F.row_number().over(order)).withColumn("recommended", F.col("place") == 1)


def best_candidate(grid: DataFrame, family_col: str = "family", metric: str = "val_f1", position: str = "grid_pos") -> DataFrame:
    """Per family the grid row with the largest rounded metric; the earlier one on a tie."""
    order = Window.partitionBy(family_col).orderBy(F.desc(metric), F.asc(position))
    return grid.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") == 1).drop("_rn")
