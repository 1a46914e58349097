"""Quality gates: nulls, duplicates, label noise, answers, vectors.

Whole texts and rows are compared through digests, so what is shuffled per row is 32 bytes, and
every count is aggregated inside the task first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import text as X
from ticketloom.functions import vectors as V
from ticketloom.settings import DEFAULTS


def null_counts(df: DataFrame, only_present: bool = True) -> DataFrame:
    """column, nulls."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counted.unpivot([], df.columns, "column", "nulls")
    return long.where(F.col("nulls") > 0) if only_present else long


def full_row_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier one in every column, null equal to null."""
    per_row = df.select(X.row_digest(df.columns, df.schema).alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def duplicate_bodies(df: DataFrame, text_col: str = "body") -> DataFrame:
    """Null bodies are no value, so they count as duplicates."""
    per_text = df.groupBy(X.text_digest(F.col(text_col)).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("d").alias("distinct_bodies")
    ).withColumn("duplicate_bodies", F.col("total_rows") - F.col("distinct_bodies"))


def labels_per_body(df: DataFrame, text_col: str = "body", label_col: str = "queue") -> DataFrame:
    """body_key, body, labels: how many different labels each body carries."""
    return (
        df.where(F.col(text_col).isNotNull())
        .groupBy(X.text_digest(F.col(text_col)).alias("body_key"), label_col)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("body_key")
        .agg(F.count(label_col).alias("labels"), F.sum("n").alias("copies"))
    )


def label_conflicts(df: DataFrame, text_col: str = "body", label_col: str = "queue") -> DataFrame:
    """Number of bodies filed under more than one label, and the share filed under exactly one."""
    return labels_per_body(df, text_col, label_col).agg(
        F.count(F.lit(1)).alias("bodies"),
        F.count_if(F.col("labels") > 1).alias("conflicting_bodies"),
        F.round(F.avg((F.col("labels") == 1).cast("int")), 4).alias("single_label_share"),
    )


def worst_conflicts(df: DataFrame, n: int = 10, text_col: str = "body", label_col: str = "queue") -> DataFrame:
    """The n bodies under most labels; digest order breaks ties."""
    return (
        labels_per_body(df, text_col, label_col)
        .where(F.col("labels") > 1)
        .select(F.lower(F.hex("body_key")).alias("body_key"), "labels", "copies")
        .orderBy(F.desc("labels"), "body_key")
        .limit(n)
    )


def length_audit(
    df: DataFrame, low: int = DEFAULTS.min_body_chars, high: int = DEFAULTS.max_body_chars,
    short: int = 50, long: int = 3000, column: str = "clean_body",
) -> DataFrame:
    size = F.length(column)
    raw = F.length("body")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(size < low).alias("too_short"),
        F.count_if(size > high).alias("too_long"),
        F.count_if(size.between(low, high)).alias("kept"),
        F.count_if(raw < short).alias("short_bodies"),
        F.count_if(raw > long).alias("long_bodies"),
    )


def answer_frequencies(df: DataFrame, column: str = "clean_answer", lead_chars: int = 100) -> DataFrame:
    """Per distinct answer: copies and its first characters."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(X.text_digest(F.col(column)).alias("answer_key"))
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.first(X.prefix(F.col(column), lead_chars)).alias("answer_start"),
            F.first(F.trim(F.col(column)) == "").alias("empty"),
        )
    )


def answer_quality(df: DataFrame, more_than: int = 5, column: str = "clean_answer") -> DataFrame:
    """Empty answers, and answers that repeat often enough to be templates, as a share of distinct
    answers and of rows."""
    template = F.col("copies") > more_than
    return answer_frequencies(df, column).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("answers"),
        F.coalesce(F.sum(F.when(F.col("empty"), F.col("copies")).otherwise(0)), F.lit(0)).alias("empty_answers"),
        F.count(F.lit(1)).alias("distinct_answers"),
        F.count_if(template).alias("template_answers"),
        F.round(F.avg(template.cast("int")), 4).alias("template_share"),
        F.round(F.sum(F.when(template, F.col("copies")).otherwise(0)) / F.sum("copies"), 4).alias("template_row_share"),
    )


def repeated_answers(df: DataFrame, n: int = 3, column: str = "clean_answer") -> DataFrame:
    return (
        answer_frequencies(df, column)
        .select(F.lower(F.hex("answer_key")).alias("answer_key"), "copies", "answer_start")
        .orderBy(F.desc("copies"), "answer_key")
        .limit(n)
    )


def token_overflow(df: DataFrame, tokens=None, limit: int = DEFAULTS.token_limit, warn_above: float = 0.10) -> DataFrame:
    """Share of texts longer than the encoder reads; ``tokens`` is the token-count column."""
    count = X.token_count(F.col("clean_body")) if tokens is None else tokens
    return df.select((count > limit).cast("int").alias("over")).agg(
        F.count(F.lit(1)).alias("texts"),
        F.coalesce(F.sum("over"), F.lit(0)).alias("over_limit"),
        F.round(F.avg("over"), 4).alias("over_share"),
        (F.avg("over") > warn_above).alias("notable"),
    )


def detect_language(df: DataFrame, text_col: str = "body", out_col: str = "detected") -> DataFrame:
    """Adds the guessed language.

    The words are picked out once per text and leave through a one-row generator, as the four
    counts would otherwise each scan the text again.
    """
    words = df.select("*", F.inline(F.array(F.struct(X.language_words(F.col(text_col)).alias("_words")))))
    return words.withColumn(out_col, X.likeliest_language(F.col("_words"))).drop("_words")


def language_agreement(df: DataFrame, text_col: str = "body", label_col: str = "language") -> DataFrame:
    """How often the guessed language is the stated one.  A sample is a matter for the caller."""
    agree = F.when(F.col("detected") == F.col(label_col), 1).otherwise(0)
    return detect_language(df.select(text_col, label_col), text_col).select(agree.alias("agree")).agg(
        F.count(F.lit(1)).alias("texts"),
        F.sum("agree").alias("agreeing"),
        F.round(F.avg("agree"), 4).alias("agreement"),
    )


def language_mismatches(df: DataFrame, text_col: str = "body", label_col: str = "language", id_col: str = "ticket_id") -> DataFrame:
    guessed = detect_language(df.select(id_col, text_col, label_col), text_col).select(
        id_col, label_col, F.inline(F.array(F.struct("detected")))
    )
    return guessed.where(~F.col("detected").eqNullSafe(F.col(label_col)))


def vector_norms(df: DataFrame, vec_col: str = "embedding", tolerance: float = 1e-3) -> DataFrame:
    """Norm statistics, how many vectors are off unit length and whether all share one dimension."""
    size = V.norm(F.col(vec_col))
    return (
        df.where(F.col(vec_col).isNotNull())
        .select(size.alias("norm"), F.size(vec_col).alias("dim"))
        .agg(
            F.count(F.lit(1)).alias("vectors"),
            F.min("dim").alias("min_dim"),
            F.max("dim").alias("max_dim"),
            F.round(F.min("norm"), 6).alias("min_norm"),
            F.round(F.max("norm"), 6).alias("max_norm"),
            F.round(F.avg("norm"), 6).alias("mean_norm"),
            F.count_if(F.abs(F.col("norm") - 1) > tolerance).alias("off_unit"),
        )
    )
