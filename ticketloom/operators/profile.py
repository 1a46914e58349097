"""Distributions of labels, lengths, words and tags: the tables behind the usual charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions import text as X
from ticketloom.operators.retrieval import top_k
from ticketloom.sources.tables import columns_with_prefix


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """value, n; null is no value; most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def several_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """field, value, n for several columns in one pass."""
    return (
        df.select(*columns)
        .unpivot([], list(columns), "field", "value")
        .where(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_imbalance(df: DataFrame, label_col: str = "queue") -> DataFrame:
    """Classes, max/min ratio, entropy in nats and bits, balance against a uniform spread, severity."""
    n = F.col("n")
    rows = F.sum("n")
    # H = ln N - (1/N) sum n ln n
    nats = F.log(rows) - F.sum(n * F.log(n)) / rows
    k = F.count(F.lit(1))
    return (
        value_counts(df, label_col)
        .agg(
            k.alias("classes"),
            rows.alias("total"),
            (F.max("n") / F.min("n")).alias("ratio"),
            F.greatest(nats, F.lit(0.0)).alias("nats"),
        )
        .select(
            "classes",
            "total",
            F.round("ratio", 4).alias("imbalance_ratio"),
            F.round("nats", 6).alias("entropy_nats"),
            F.round(F.col("nats") / math.log(2), 6).alias("entropy_bits"),
            F.when(F.col("classes") > 1, F.round(F.col("nats") / F.log(F.col("classes")), 6)).alias("balance"),
            F.when(F.col("ratio") > 10, "severe").when(F.col("ratio") > 3, "moderate").otherwise("mild").alias("severity"),
        )
    )


def class_weights(df: DataFrame, label_col: str = "queue") -> DataFrame:
    """Balanced weight per label: rows / (classes x rows of the label)."""
    everything = Window.partitionBy()
    counts = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    # One row per label reaches the window.
    return counts.withColumn(
        "class_weight", F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))
    )


def describe(df: DataFrame, columns: Sequence[str], digits: int = 1) -> DataFrame:
    """field, count, mean, std, min, p25, p50, p75, max of integer columns such as text lengths.

    Values are counted first, so the exact quantiles are taken over (value, frequency) pairs,
    of which there are no more than different lengths.
    """
    values = (
        df.select(*columns)
        .unpivot([], list(columns), "field", "value")
        .where(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    v, n = F.col("value").cast("double"), F.col("n")
    total = F.sum(n)
    mean = F.sum(v * n) / total
    variance = (F.sum(v * v * n) - F.sum(v * n) * F.sum(v * n) / total) / (total - 1)
    quantile = lambda p: F.percentile(F.col("value"), F.lit(p), n)
    return values.groupBy("field").agg(
        total.alias("count"),
        F.round(mean, digits).alias("mean"),
        F.round(F.when(total > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))), digits).alias("std"),
        F.min(v).alias("min"),
        F.round(quantile(0.25), digits).alias("p25"),
        F.round(quantile(0.50), digits).alias("p50"),
        F.round(quantile(0.75), digits).alias("p75"),
        F.max(v).alias("max"),
    )


def histogram(df: DataFrame, column: str, clip: int, bins: int = 60) -> DataFrame:
    """bin, lo, hi, n over equal-width bins of min(value, clip); the last bin is closed, empty bins
    are listed.

    Values are counted first: at most ``clip + 1`` different lengths are left to bin.
    """
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.least(F.col(column), F.lit(clip)).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The counted values, at most clip + 1 of them, travel as one array next to their range.
    spread = counted.agg(
        F.min("v").alias("_lo"), F.max("v").alias("_hi"), F.collect_list(F.struct("v", "n")).alias("_values")
    ).where(F.col("_lo").isNotNull())
    lo, w = F.col("_lo"), F.col("_w")
    span = F.col("_hi") - lo
    width = F.when(span > 0, span / F.lit(bins)).otherwise(F.lit(1.0 / bins))
    place = F.least(F.floor((F.col("_x.v") - lo) / w), F.lit(bins - 1)).cast("int")
    ranged = spread.select("_lo", width.alias("_w"), "_values")
    filled = (
        ranged.select("_lo", "_w", F.explode("_values").alias("_x"))
        .groupBy(place.alias("bin"))
        .agg(F.sum("_x.n").alias("n"))
    )
    edges = ranged.select("_lo", "_w", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return edges.join(filled, "bin", "left").select(
        "bin",
        F.round(lo + F.col("bin") * w, 6).alias("lo"),
        F.round(lo + (F.col("bin") + 1) * w, 6).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def top_words(
    df: DataFrame, n: int = 10, text_col: str = "lemmatized_body", label_col: str = "queue",
    stop_words: Sequence[str] = (), min_chars: int = 1,
) -> DataFrame:
    """label, place, word, n: the most frequent words per label."""
    tokens = X.whitespace_tokens(F.col(text_col))
    if stop_words or min_chars > 1:
        tokens = X.keep_terms(tokens, list(stop_words) or [""], min_chars)
    counted = df.select(label_col, F.explode(tokens).alias("word")).groupBy(label_col, "word").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counted, n, label_col, [F.desc("n"), F.asc("word")], "place")


def all_tags(df: DataFrame, prefix: str = "tag_") -> DataFrame:
    """One row per filled tag cell."""
    columns = columns_with_prefix(df, prefix)
    return df.select(*columns).unpivot([], columns, "field", "tag").where(F.col("tag").isNotNull()).select("tag")


def tag_frequency(df: DataFrame, n: int | None = 20) -> DataFrame:
    """tag, n over all tag columns, most frequent first."""
    counts = all_tags(df).groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag")
    return counts if n is None else counts.limit(n)


def unique_tags(df: DataFrame) -> DataFrame:
    return all_tags(df).distinct().agg(F.count(F.lit(1)).alias("unique_tags"))


def tag_crosstab(df: DataFrame, top: int = 10, label_col: str = "queue", tag_col: str = "tag_1") -> DataFrame:
    """label, bucket, n: first tag against label, tags outside the overall top under ``other``;
    a missing tag is ``other`` too, and every label has every bucket that occurs."""
    leaders = tag_frequency(df, top).select(F.col("tag").alias("_top"))
    cells = (
        df.where(F.col(label_col).isNotNull())
        .groupBy(label_col, tag_col)
        .agg(F.count(F.lit(1)).alias("n"))
        # The leaders are at most ``top`` rows.
        .join(F.broadcast(leaders), F.col(tag_col) == F.col("_top"), "left")
        .groupBy(label_col, F.coalesce("_top", F.lit("other")).alias("bucket"))
        .agg(F.sum("n").alias("n"))
    )
    # Labels x (top + 1) buckets, laid out from the cells themselves.
    grid = (
        cells.agg(F.collect_set(label_col).alias("labels"), F.collect_set("bucket").alias("buckets"))
        .select(F.explode("labels").alias(label_col), "buckets")
        .select(label_col, F.explode("buckets").alias("bucket"))
    )
    return grid.join(cells, [label_col, "bucket"], "left").select(label_col, "bucket", F.coalesce("n", F.lit(0)).alias("n"))


def pca_2d(
    df: DataFrame, id_col: str = "ticket_id", vec_col: str = "embedding", keep: Sequence[str] = ("queue",)
) -> tuple[DataFrame, list[float]]:
    """Coordinates on the first two principal components and the variance share of each.

    Vectors are centred first; a component's sign makes its largest loading positive.
    """
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.where(F.col(vec_col).isNotNull()).select(id_col, *keep, array_to_vector(F.col(vec_col)).alias("raw"))
    centred = StandardScaler(inputCol="raw", outputCol="centred", withMean=True, withStd=False).fit(rows).transform(rows)
    model = PCA(k=2, inputCol="centred", outputCol="components").fit(centred)
    loadings = model.pc.toArray()
    signs = [1.0 if max(col, key=abs) >= 0 else -1.0 for col in loadings.T]
    coords = vector_to_array("components")
    out = model.transform(centred).select(
        id_col, *keep, (coords[0] * signs[0]).alias("pc1"), (coords[1] * signs[1]).alias("pc2")
    )
    return out, [float(x) for x in model.explainedVariance]
