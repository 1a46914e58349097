"""Text overlap between an answer and its reference: BLEU and ROUGE-L."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions import text as X
from ticketloom.functions.porter import stem
from ticketloom.scale import dealt

MAX_GRAM = 4
SMOOTHING = 0.1
CHARS_PER_WORD = 4  # a low guess: it only sizes tasks


def _grams(tokens: Column, hyp: int, ref: int) -> Column:
    """(n, gram, hyp, ref) for every 1- to 4-gram of the tokens."""

    def of_size(n: int) -> Column:
        starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts,
            lambda i: F.struct(
                F.lit(n).alias("n"),
                F.array_join(F.slice(tokens, i, n), " ").alias("gram"),
                F.lit(hyp).alias("hyp"),
                F.lit(ref).alias("ref"),
            ),
        )

    return F.concat(*[of_size(n) for n in range(1, MAX_GRAM + 1)])


def bleu(df: DataFrame, reference: str = "answer", hypothesis: str = "generated_answer", id_col: str = "ticket_id", digits: int = 4) -> DataFrame:
    """id, bleu: sentence BLEU over lower-case whitespace tokens, up to 4-grams, clipped counts, an
    empty count smoothed to 0.1, brevity penalty.  No common word gives 0; a missing text gives null.

    Pairs are hash-partitioned by id; all counting after that is local.
    """
    chars = df.agg(F.sum(F.length(hypothesis) + F.length(reference))).first()[0] or 0
    tokens = df.where(F.col(reference).isNotNull() & F.col(hypothesis).isNotNull()).select(
        id_col,
        X.whitespace_tokens(F.lower(hypothesis)).alias("_h"),
        X.whitespace_tokens(F.lower(reference)).alias("_r"),
    )
    tokens = dealt(tokens, id_col, MAX_GRAM * chars / CHARS_PER_WORD)
    sized = tokens.select(id_col, "_h", "_r", F.size("_h").alias("_hn"), F.size("_r").alias("_rn"))
    counted = (
        sized.select(id_col, "_hn", "_rn", F.inline(F.concat(_grams(F.col("_h"), 1, 0), _grams(F.col("_r"), 0, 1))))
        .groupBy(id_col, "_hn", "_rn", "n", "gram")
        .agg(F.sum("hyp").alias("h"), F.sum("ref").alias("r"))
        .groupBy(id_col, "_hn", "_rn", "n")
        .agg(F.sum(F.least("h", "r")).alias("num"), F.sum("h").alias("den"))
    )
    precision = F.when(F.col("num") > 0, F.col("num")).otherwise(F.lit(SMOOTHING)) / F.greatest(F.col("den"), F.lit(1))
    per_pair = counted.groupBy(id_col, "_hn", "_rn").agg(
        F.sum(F.log(precision)).alias("logs"),
        F.count(F.lit(1)).alias("sizes"),
        F.max(F.when(F.col("n") == 1, F.col("num"))).alias("common"),
    )
    # A size neither text reaches has no row: its precision is the smoothed 0.1.
    logs = F.col("logs") + (MAX_GRAM - F.col("sizes")) * F.log(F.lit(SMOOTHING))
    penalty = F.when(F.col("_hn") > F.col("_rn"), F.lit(0.0)).otherwise(1 - F.col("_rn") / F.col("_hn"))
    score = F.when((F.col("_hn") == 0) | (F.coalesce("common", F.lit(0)) == 0), F.lit(0.0)).otherwise(
        F.exp(penalty + logs / MAX_GRAM)
    )
    scored = per_pair.select(id_col, F.round(score, digits).alias("bleu"))
    both = F.col(reference).isNotNull() & F.col(hypothesis).isNotNull()
    return df.select(id_col, both.alias("_both")).join(scored, id_col, "left").select(
        id_col, F.when(F.col("_both"), F.coalesce("bleu", F.lit(0.0))).alias("bleu")
    )


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, one machine-word row of the table at a time
    (bit-parallel, Crochemore et al. 2001)."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, token in enumerate(b):
        places[token] = places.get(token, 0) | (1 << i)
    full = (1 << len(b)) - 1
    row = full
    for token in a:
        hit = row & places.get(token, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


def _lcs_column(stemmed: bool):
    @F.pandas_udf(T.LongType())
    def lcs(hyp: pd.Series, ref: pd.Series) -> pd.Series:
        def tokens(words):
            return [stem(w) if len(w) > 3 else w for w in words] if stemmed else list(words)

        return pd.Series(
            [None if h is None or r is None else common_subsequence(tokens(h), tokens(r)) for h, r in zip(hyp, ref)],
            dtype="Int64",
        )

    return lcs


def rouge_l(
    df: DataFrame, reference: str = "answer", hypothesis: str = "generated_answer", id_col: str = "ticket_id",
    stemmed: bool = True, digits: int = 4,
) -> DataFrame:
    """id, lcs, rouge_l: F-measure of the longest common subsequence of [a-z0-9]+ tokens."""
    sized = df.select(
        id_col, X.alnum_tokens(F.col(hypothesis)).alias("_h"), X.alnum_tokens(F.col(reference)).alias("_r")
    ).select(id_col, _lcs_column(stemmed)("_h", "_r").alias("lcs"), F.size("_h").alias("_hn"), F.size("_r").alias("_rn"))
    # 2PR/(P+R) with P = lcs/hyp and R = lcs/ref is 2 lcs / (hyp + ref).
    score = F.when(F.col("lcs").isNull(), F.lit(None)).when(F.col("lcs") > 0, 2 * F.col("lcs") / (F.col("_hn") + F.col("_rn"))).otherwise(F.lit(0.0))
    return sized.select(id_col, "lcs", F.round(score, digits).alias("rouge_l"))


def text_overlap(df: DataFrame, reference: str = "answer", hypothesis: str = "generated_answer", id_col: str = "ticket_id", stemmed: bool = True) -> DataFrame:
    """id, bleu, rouge_l per pair."""
    return bleu(df, reference, hypothesis, id_col).join(rouge_l(df, reference, hypothesis, id_col, stemmed).drop("lcs"), id_col)


def mean_overlap(scores: DataFrame, digits: int = 4) -> DataFrame:
    """Means of the already rounded row scores; null over nothing."""
    return scores.agg(
        F.count("bleu").alias("scored"),
        F.round(F.avg("bleu"), digits).alias("mean_bleu"),
        F.round(F.avg("rouge_l"), digits).alias("mean_rouge_l"),
    )
