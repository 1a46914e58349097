"""From raw tickets to the cleaned corpus."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions import text as X
from ticketloom.scale import bounded_broadcast, hot_keys, materialize, salted_join
from ticketloom.settings import DEFAULTS
from ticketloom.sources.tables import corpus_columns, require_columns


def filter_language(df: DataFrame, language: str = DEFAULTS.language) -> DataFrame:
    """Rows of one language; a table without the column passes through."""
    return df.where(F.col("language") == language) if "language" in df.columns else df


def add_clean_columns(df: DataFrame, strip_html: bool = False) -> DataFrame:
    """clean_body, and clean_answer where there is an answer.

    The columns leave through a one-row generator: Catalyst would otherwise copy the cleaning
    expression into every filter on its result and run it once per use.
    """
    cleaned = [X.clean_text(F.col(c), strip_html).alias(f"clean_{c}") for c in ("body", "answer") if c in df.columns]
    return df.select("*", F.inline(F.array(F.struct(*cleaned))))


def filter_body_length(
    df: DataFrame, low: int = DEFAULTS.min_body_chars, high: int = DEFAULTS.max_body_chars, column: str = "clean_body"
) -> DataFrame:
    """Rows whose text is between ``low`` and ``high`` characters, both included."""
    return df.where(F.length(column).between(low, high))


def add_length_columns(df: DataFrame) -> DataFrame:
    pairs = {"body_length": "body", "answer_length": "answer", "clean_answer_length": "clean_answer"}
    return df.withColumns({out: F.length(src) for out, src in pairs.items() if src in df.columns})


def clean_corpus(df: DataFrame, language: str = DEFAULTS.language, strip_html: bool = False) -> DataFrame:
    """Language filter, cleaning, length filter, length columns, corpus layout."""
    cleaned = add_clean_columns(filter_language(df, language), strip_html)
    return corpus_columns(add_length_columns(filter_body_length(cleaned)))


def map_distinct(
    df: DataFrame,
    text_col: str,
    out_col: str,
    process: Callable[[DataFrame], DataFrame],
    id_col: str = "ticket_id",
    hot_share: float = 0.001,
    hot_rows: int = 10_000,
) -> DataFrame:
    """Work each distinct text once and hand the result back to all its copies.

    ``process`` gets (text_key, ``text_col``) and returns (text_key, ``out_col``).  Texts are
    grouped and joined by a 32-byte digest, counted before the shuffle, and the copies of a text
    that makes up more than ``hot_share`` of the table, and ``hot_rows`` rows, are spread over many tasks on the way back.
    """
    keyed = df.withColumn("text_key", X.text_digest(F.col(text_col)))
    distinct = (
        keyed.where(F.col("text_key").isNotNull())
        .groupBy("text_key")
        .agg(F.first(text_col).alias(text_col), F.count(F.lit(1)).alias("copies"))
    )
    done = process(distinct.select("text_key", text_col)).select("text_key", out_col)
    hot = hot_keys(distinct, "text_key", "copies", hot_share, hot_rows)
    return salted_join(keyed, done, "text_key", hot, F.col(id_col)).select(*df.columns, out_col)


def lemmatize(
    texts: DataFrame,
    lemmas: DataFrame,
    text_col: str = "clean_body",
    out_col: str = "lemmatized_body",
    key: str = "text_key",
    stop_words: Sequence[str] = tuple(X.DOMAIN_STOP_WORDS),
    min_chars: int = 3,
    surface_stop_words: Sequence[str] = (),
) -> DataFrame:
    """Lemma text per row from a (token, lemma) table.

    A token without an entry is its own lemma.  Stop words are looked up by lemma, the length
    limit and ``surface_stop_words`` by the token as written.  A text with nothing left gives the empty string.
    """
    tokens = texts.select(key, F.posexplode(X.whitespace_tokens(F.col(text_col))).alias("pos", "token")).where(
        (F.length("token") >= min_chars) & ~F.col("token").isin(list(surface_stop_words) or [""])
    )
    lemma = F.coalesce("lemma", "token")
    kept = (
        tokens.join(bounded_broadcast(lemmas.select("token", "lemma"), 200_000), "token", "left")
        .where(~lemma.isin(list(stop_words)))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("pos", lemma.alias("lemma")))).alias("found"))
        .select(key, F.array_join(F.col("found.lemma"), " ").alias("_joined"))
    )
    return texts.select(key).join(kept, key, "left").select(key, F.coalesce("_joined", F.lit("")).alias(out_col))


def suffix_lemmas(texts: DataFrame, text_col: str = "clean_body", suffixes: Sequence[str] = ("ing", "ed", "es", "s")) -> DataFrame:
    """A (token, lemma) table from the corpus itself: a word whose suffix-free form is also a word
    of the corpus maps to that form, longest suffix first."""
    words = texts.select(F.explode(X.whitespace_tokens(F.col(text_col))).alias("token")).distinct()
    stripped = F.array(
        *[
            F.struct(F.lit(i).alias("order"), F.expr(f"substring(token, 1, length(token) - {len(s)})").alias("lemma"))
            for i, s in enumerate(suffixes)
        ]
    )
    fits = F.array(*[(F.col("token").endswith(s)) & (F.length("token") - len(s) >= 3) for s in suffixes])
    options = words.select("token", F.explode(F.arrays_zip(stripped.alias("s"), fits.alias("fits"))).alias("o"))
    options = options.where(F.col("o.fits")).select("token", F.col("o.s.order").alias("order"), F.col("o.s.lemma").alias("lemma"))
    known = words.select(F.col("token").alias("lemma"))
    return (
        options.join(known, "lemma")
        .groupBy("token")
        .agg(F.min_by("lemma", "order").alias("lemma"))
    )


def remembered(process: Callable[[DataFrame], DataFrame], store: str, out_col: str = "lemmatized_body") -> Callable[[DataFrame], DataFrame]:
    """``process`` for :func:`map_distinct` that works only texts the table at ``store`` lacks, and adds them to it.

    The table holds (text_key, ``out_col``) and belongs to one way of processing.  An append that runs twice
    leaves a key twice; readers take one.
    """

    def run(texts: DataFrame) -> DataFrame:
        spark = texts.sparkSession
        schema = T.StructType([texts.schema["text_key"], T.StructField(out_col, T.StringType())])
        spark.createDataFrame([], schema).write.mode("append").parquet(store)  # the folder is there from now on
        known = spark.read.schema(schema).parquet(store)
        fresh = texts.join(known.select("text_key"), "text_key", "left_anti")
        process(fresh).select("text_key", out_col).write.mode("append").parquet(store)
        return spark.read.schema(schema).parquet(store).dropDuplicates(["text_key"])

    return run


def build_corpus(
    raw: DataFrame,
    lemmas: Callable[[DataFrame], DataFrame],
    store: str,
    language: str = DEFAULTS.language,
    strip_html: bool = False,
    surface_stop_words: Sequence[str] = tuple(X.GENERAL_STOP_WORDS),
) -> DataFrame:
    """Raw tickets to the corpus in its full layout: filters, cleaning, lengths, lemma text, column order.

    ``lemmas`` makes a (token, lemma) table of the cleaned rows.  Texts already in ``store`` are not lemmatised
    again, so a later run over a grown table works its new texts alone.
    """
    require_columns(raw, ["ticket_id", "body", "answer", "type", "queue", "priority"])
    ready = add_length_columns(filter_body_length(add_clean_columns(filter_language(raw, language), strip_html)))
    ready = materialize(ready, "cleaned-corpus")
    table = materialize(lemmas(ready), "lemmas")
    work = remembered(lambda texts: lemmatize(texts, table, surface_stop_words=surface_stop_words), store)
    return corpus_columns(map_distinct(ready, "clean_body", "lemmatized_body", work))


def subject_weighted_text(subject: Column, body: Column) -> Column:
    """Subject twice, then the body; a missing part counts as empty."""
    s, b = F.coalesce(subject, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(s, F.lit(" "), s, F.lit(" "), b)


def text_column(df: DataFrame) -> Column:
    """``clean_body``, or ``lemmatized_body`` where the table has no such column; never null."""
    for name in ("clean_body", "lemmatized_body"):
        if name in df.columns:
            return F.coalesce(F.col(name), F.lit(""))
    raise ValueError(f"no text column in {df.columns}")


def drop_repeated_bodies(df: DataFrame, text_col: str = "body", id_col: str = "ticket_id") -> DataFrame:
    """Opt-in: one row per distinct text, the one with the smallest id; null texts all stay.

    Only ids and digests are grouped; a text held by a third of all rows is one row per task.
    """
    first = (
        df.select(X.text_digest(F.col(text_col)).alias("_d"), id_col)
        .where(F.col("_d").isNotNull())
        .groupBy("_d")
        .agg(F.min(id_col).alias(id_col))
        .select(id_col)
    )
    kept = df.join(first, id_col, "left_semi")
    return kept.unionByName(df.where(F.col(text_col).isNull()))


def validate_requests(df: DataFrame, limit: int = DEFAULTS.max_request_chars) -> DataFrame:
    """Adds ``reject_reason``: null for a body of 1 to ``limit`` characters."""
    size = F.length("body")
    return df.withColumn(
        "reject_reason",
        F.when(F.col("body").isNull(), "missing_body").when(size < 1, "empty_body").when(size > limit, "body_too_long"),
    )
