"""Reproducible stratified splits and samples, with no window over a whole label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.scale import bounded_broadcast
from ticketloom.settings import DEFAULTS

# Hex digits of the order key that name a bucket: 16**4 buckets share out even the largest label.
BUCKET_DIGITS = 4


def order_key(id_col: str, seed: int = DEFAULTS.seed) -> Column:
    """The seeded pseudo-random order every split and sample follows."""
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))


def _share_out(counts: DataFrame, size_col: str, quota: str, out: str) -> DataFrame:
    """Largest-remainder shares of ``quota`` rows over the labels, ties by label.

    ``counts`` has one row per label in column ``_label``, so the unpartitioned windows see only
    the label list.  ``quota`` may use ``total``, the sum of the sizes.
    """
    own = counts.columns
    return (
        counts.selectExpr(*own, f"sum({size_col}) OVER () AS total")
        .selectExpr(*own, "total", f"CAST({quota} AS BIGINT) AS quota")
        .selectExpr(*own, "quota", f"quota * {size_col} / total AS exact")
        .selectExpr(*own, "quota", "floor(exact) AS base", "round(exact - floor(exact), 9) AS rest")
        .selectExpr(
            *own, "base", "quota - sum(base) OVER () AS spare", "row_number() OVER (ORDER BY rest DESC, _label) AS place"
        )
        .selectExpr(*own, f"base + CASE WHEN place <= spare THEN 1 ELSE 0 END AS {out}")
    )


def split_sizes(
    df: DataFrame, label_col: str = "queue", held_out: float = 0.30, test_of_held: float = 0.50
) -> DataFrame:
    """Rows of each label that go to train, val and test; totals are ceil(share x rows) held out,
    then halved with the odd row going to test."""
    counts = df.groupBy(F.col(label_col).alias("_label")).agg(F.count(F.lit(1)).alias("n"))
    train = _share_out(counts, "n", f"total - ceil(round(total * {held_out}D, 9))", "n_train")
    rest = train.selectExpr("*", "n - n_train AS n_held")
    return _share_out(rest, "n_held", f"total - ceil(round(total * {test_of_held}D, 9))", "n_val").selectExpr(
        f"_label AS `{label_col}`", "n", "n_train", "n_val", "n_held - n_val AS n_test"
    )


def _cut_points(
    df: DataFrame, label_col: str, id_col: str, key: Column, cuts: DataFrame
) -> DataFrame:
    """For each row ``(label, cut, at)``, the (key, id) of the label's ``at``-th row in key order.

    Rows are counted per key bucket first.  Only the rows of the one bucket a cut falls into are
    ranked, so no task sees more than 1/65,536 of a label.
    """
    keyed = df.select(label_col, id_col, key.alias("_key")).withColumn(
        "_bucket", F.substring("_key", 1, BUCKET_DIGITS)
    )
    per_bucket = keyed.groupBy(label_col, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(label_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    reached = per_bucket.withColumn("_upto", F.sum("_n").over(running))
    where = (
        reached.join(cuts, label_col)
        .where((F.col("at") > F.col("_upto") - F.col("_n")) & (F.col("at") <= F.col("_upto")))
        .select(label_col, "_bucket", "cut", (F.col("at") - F.col("_upto") + F.col("_n")).alias("_offset"))
    )
    in_bucket = Window.partitionBy(label_col, "_bucket", "cut").orderBy("_key", id_col)
    return (
        keyed.join(bounded_broadcast(where), [label_col, "_bucket"])
        .withColumn("_rn", F.row_number().over(in_bucket))
        .where(F.col("_rn") == F.col("_offset"))
        .select(label_col, "cut", F.struct(F.col("_key").alias("key"), F.col(id_col).alias("id")).alias("mark"))
    )


def stratified_split(
    df: DataFrame,
    label_col: str = "queue",
    id_col: str = "ticket_id",
    held_out: float = 0.30,
    test_of_held: float = 0.50,
    seed: int = DEFAULTS.seed,
) -> DataFrame:
    """Adds ``split`` (train, val, test), stratified by label; rows without a label get null.

    Wide rows are never shuffled: the cut points come from the two narrow columns, and the rows
    are compared with a table of one row per label.
    """
    labelled = df.where(F.col(label_col).isNotNull())
    sizes = split_sizes(labelled, label_col, held_out, test_of_held)
    cuts = sizes.select(
        label_col,
        F.explode(
            F.array(
                F.struct(F.lit("train").alias("cut"), F.col("n_train").alias("at")),
                F.struct(F.lit("val").alias("cut"), (F.col("n_train") + F.col("n_val")).alias("at")),
            )
        ).alias("c"),
    ).select(label_col, "c.*")
    key = order_key(id_col, seed)
    marks = (
        _cut_points(labelled, label_col, id_col, key, cuts)
        .groupBy(label_col)
        .agg(
            F.max(F.when(F.col("cut") == "train", F.col("mark"))).alias("_train"),
            F.max(F.when(F.col("cut") == "val", F.col("mark"))).alias("_val"),
        )
    )
    here = F.struct(key.alias("key"), F.col(id_col).alias("id"))
    return (
        df.join(bounded_broadcast(marks), label_col, "left")
        .withColumn(
            "split",
            F.when(F.col(label_col).isNull(), F.lit(None))
            .when(here <= F.col("_train"), F.lit("train"))
            .when(here <= F.col("_val"), F.lit("val"))
            .otherwise(F.lit("test")),
        )
        .select(*df.columns, "split")
    )


def stratified_sample(
    df: DataFrame,
    n: int = DEFAULTS.eval_sample_size,
    label_col: str = "queue",
    id_col: str = "ticket_id",
    seed: int = DEFAULTS.seed,
) -> DataFrame:
    """min(n, rows) rows with label shares kept: largest-remainder quotas, md5 order inside a label.

    The rank filter has the literal bound ``n``, so every task keeps at most n rows of a label
    before anything is shuffled.
    """
    labelled = df.where(F.col(label_col).isNotNull())
    counts = labelled.groupBy(F.col(label_col).alias("_label")).agg(F.count(F.lit(1)).alias("n"))
    quotas = _share_out(counts, "n", f"least({n}, total)", "_take").select(F.col("_label").alias(label_col), "_take")
    order = Window.partitionBy(label_col).orderBy("_key", id_col)
    picked = (
        labelled.withColumn("_key", order_key(id_col, seed))
        .withColumn("_rn", F.row_number().over(order))
        .where(F.col("_rn") <= n)
    )
    return (
        picked.join(bounded_broadcast(quotas), label_col)
        .where(F.col("_rn") <= F.col("_take"))
        .select(*df.columns)
    )


def seeded_sample(
    df: DataFrame, n: int, id_col: str = "ticket_id", seed: int = DEFAULTS.seed
) -> DataFrame:
    """n rows in seeded order; a top-n, so each task forwards at most n rows."""
    return df.orderBy(order_key(id_col, seed), F.col(id_col)).limit(n)


def split_proportions(df: DataFrame, label_col: str = "queue", split_col: str = "split", digits: int = 3) -> DataFrame:
    """Long form: split, label, rows, share of the split."""
    counts = (
        df.where(F.col(label_col).isNotNull())
        .groupBy(split_col, label_col)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    share = F.col("n") / F.sum("n").over(Window.partitionBy(split_col))
    return counts.withColumn("share", F.round(share, digits))


def split_comparison(df: DataFrame, label_col: str = "queue", split_col: str = "split", digits: int = 3) -> DataFrame:
    """One row per label with the train, val and test shares side by side; absent stays null."""
    return (
        split_proportions(df, label_col, split_col, digits)
        .groupBy(label_col)
        .pivot(split_col, ["train", "val", "test"])
        .agg(F.first("share"))
    )


def fixed_folds(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Train and validation rows with ``fold``: -1 always trains, 0 validates."""
    return df.where(F.col(split_col).isin("train", "val")).withColumn(
        "fold", F.when(F.col(split_col) == "train", -1).otherwise(0)
    )
