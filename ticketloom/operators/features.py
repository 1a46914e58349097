"""TF-IDF in long form, and text vectors.

Documents are hash-partitioned by id once.  Term counts, weights, norms and the final vectors of a
document all stay in its partition; the vocabulary, which is bounded by ``max_features``, is the
only thing sent to every task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions import text as X
from ticketloom.functions import vectors as V
from ticketloom.scale import bounded_broadcast, dealt, materialize, scratch_path
from ticketloom.settings import DEFAULTS

BROADCAST_TERMS = 200_000  # a larger vocabulary is joined, not broadcast
CHARS_PER_WORD = 4  # a low guess: it only sizes tasks


def term_counts(docs: DataFrame, text_col: str, id_col: str = "ticket_id", bigrams: bool = True) -> DataFrame:
    """id, term, tf: words of two or more characters and, optionally, pairs of neighbouring words."""
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    tokens = dealt(
        docs.select(id_col, X.word_tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("_tokens")),
        id_col, chars / CHARS_PER_WORD * (2 if bigrams else 1),
    )
    terms = X.with_bigrams(F.col("_tokens")) if bigrams else F.col("_tokens")
    return (
        tokens.select(id_col, F.explode(terms).alias("term"))
        .groupBy(id_col, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def sublinear(tf: Column) -> Column:
    return 1 + F.log(tf)


def smooth_idf(total: Column, df: Column) -> Column:
    return F.log((1 + total) / (1 + df)) + 1


def vocabulary(
    docs: DataFrame,
    text_col: str,
    id_col: str = "ticket_id",
    bigrams: bool = True,
    min_df: int = DEFAULTS.min_df,
    max_features: int = DEFAULTS.max_features,
    counts: DataFrame | None = None,
) -> DataFrame:
    """term, idx, df, cf, idf of the ``max_features`` most frequent terms in at least ``min_df``
    documents; ties by term, index in term order."""
    total = docs.agg(F.count(F.lit(1))).scalar()
    counted = counts if counts is not None else term_counts(docs, text_col, id_col, bigrams)
    kept = (
        counted.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
        .where(F.col("df") >= min_df)
        .orderBy(F.desc("cf"), "term")
        .limit(max_features)
    )
    # No more than max_features rows reach the one-partition window.
    return kept.select(
        "term",
        (F.row_number().over(Window.partitionBy().orderBy("term")) - 1).alias("idx"),
        "df",
        "cf",
        smooth_idf(total, F.col("df")).alias("idf"),
    )


def stored_counts(docs: DataFrame, text_col: str, keep: Sequence[str] = (), id_col: str = "ticket_id", bigrams: bool = True) -> DataFrame:
    """id, ``keep``, term, tf written once, for vocabularies and vectors of several parts of one corpus."""
    counts = term_counts(docs, text_col, id_col, bigrams)
    return materialize(counts.join(docs.select(id_col, *keep), id_col) if keep else counts, "term-counts")


@dataclass(frozen=True)
class Tfidf:
    """A fitted vocabulary and the text settings it was fitted with."""

    terms: DataFrame
    text_col: str
    id_col: str
    bigrams: bool

    def weights(self, docs: DataFrame, counts: DataFrame | None = None) -> DataFrame:
        """id, term, idx, weight with unit length per document; unknown terms drop out.

        ``counts`` are the documents' stored term counts, where they are there already.
        """
        known = bounded_broadcast(self.terms.select("term", "idx", "idf"), BROADCAST_TERMS)
        counted = counts if counts is not None else term_counts(docs, self.text_col, self.id_col, self.bigrams)
        raw = (
            counted.join(known, "term")
            .select(self.id_col, "term", "idx", (sublinear(F.col("tf")) * F.col("idf")).alias("_w"))
        )
        if counts is not None:
            raw = dealt(raw, self.id_col, counts.count())
        length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(self.id_col)))
        return raw.select(self.id_col, "term", "idx", (F.col("_w") / length).alias("weight"))

    def vectors(self, docs: DataFrame, out_col: str = "features", counts: DataFrame | None = None) -> DataFrame:
        """``docs`` with a sparse ML vector as wide as the vocabulary; a document without known terms has the empty one."""
        entries = (
            self.weights(docs, counts)
            .groupBy(self.id_col)
            .agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("_entries"))
        )
        return sparse_vectors(docs.join(entries, self.id_col, "left"), "_entries", self.terms.count(), out_col)


def fit_tfidf(
    train: DataFrame,
    text_col: str,
    id_col: str = "ticket_id",
    bigrams: bool = True,
    min_df: int = DEFAULTS.min_df,
    max_features: int = DEFAULTS.max_features,
    counts: DataFrame | None = None,
) -> Tfidf:
    """Vocabulary and IDF from the training documents alone, written once for all that use them."""
    terms = materialize(vocabulary(train, text_col, id_col, bigrams, min_df, max_features, counts), "vocabulary")
    return Tfidf(terms, text_col, id_col, bigrams)


def sparse_vectors(df: DataFrame, entries_col: str, size: int, out_col: str) -> DataFrame:
    """Replace an array of (idx, weight) by the ML vector type; null becomes the empty vector.

    The struct behind the vector type is put together by expressions and written; reading it back
    under a schema with the vector type makes it one.  No row passes through Python.
    """
    from pyspark.ml.linalg import VectorUDT

    entries = F.coalesce(F.col(entries_col), F.array().cast("array<struct<idx:int,weight:double>>"))
    packed = F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(size).cast("int").alias("size"),
        F.transform(entries, lambda e: e["idx"].cast("int")).alias("indices"),
        F.transform(entries, lambda e: e["weight"].cast("double")).alias("values"),
    )
    flat = df.withColumn(out_col, packed).drop(entries_col)
    path = scratch_path(df.sparkSession, "vectors")
    flat.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT()) if f.name == out_col else f for f in flat.schema.fields]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def dense_vectors(df: DataFrame, vec_col: str = "embedding", out_col: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(out_col, array_to_vector(F.col(vec_col)))


def hashed_vectors(docs: DataFrame, text_col: str, dim: int = DEFAULTS.embedding_dim, id_col: str = "ticket_id") -> DataFrame:
    """id, embedding: 1 + ln tf of each word, added with a hashed sign to one of ``dim`` hashed
    places, at unit length.  Needs no model, so it is the default encoder."""
    place = lambda h: F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % dim
    sign = lambda h: F.when(F.substring(h, 9, 1) >= "8", 1.0).otherwise(-1.0)
    # Every place is listed once with no word, so that the collected array is dense.
    blanks = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.struct(F.lit(None).cast("string").alias("term"), i.cast("long").alias("at")))
    words = F.transform("_tokens", lambda t: F.struct(t.alias("term"), F.lit(None).cast("long").alias("at")))
    digest = F.md5("term")
    sizes = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(text_col)).alias("chars")).first()
    cells = sizes["n"] * dim + (sizes["chars"] or 0) / CHARS_PER_WORD
    return (
        dealt(docs.select(id_col, X.word_tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("_tokens")), id_col, cells)
        .select(id_col, F.inline(F.concat(words, blanks)))
        .groupBy(id_col, "term", "at")
        .agg(F.count(F.lit(1)).alias("tf"))
        .select(
            id_col,
            F.coalesce("at", place(digest)).alias("at"),
            F.when(F.col("term").isNull(), 0.0).otherwise(sign(digest) * sublinear(F.col("tf"))).alias("x"),
        )
        .groupBy(id_col, "at")
        .agg(F.sum("x").alias("x"))
        .groupBy(id_col)
        .agg(
            F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("_length"),
            F.array_sort(F.collect_list(F.struct("at", "x"))).alias("_cells"),
        )
        .select(
            id_col,
            F.transform(
                "_cells", lambda c: F.when(F.col("_length") > 0, c["x"] / F.col("_length")).otherwise(0.0).cast("float")
            ).alias("embedding"),
        )
    )


Encoder = Callable[[DataFrame, str, str], DataFrame]


def embed(df: DataFrame, text_col: str = "clean_body", encoder: Encoder | None = None, id_col: str = "ticket_id", dim: int = DEFAULTS.embedding_dim) -> DataFrame:
    """``df`` with an ``embedding`` column.

    ``encoder(df, text_col, id_col)`` returns (id, embedding); :func:`model_encoder` makes one from
    a function over a batch of texts.  A row that the encoder leaves out keeps its place, without a vector.
    """
    encode = encoder or (lambda d, t, i: hashed_vectors(d, t, dim, i))
    return df.join(encode(df, text_col, id_col), id_col, "left")


def model_encoder(load: Callable[[], Callable[[list[str]], np.ndarray]]) -> Encoder:
    """Encoder from a model: ``load`` runs once per task, its result maps texts to a matrix."""

    def encode(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
        kind = df.schema[id_col].dataType
        schema = T.StructType([T.StructField(id_col, kind), T.StructField("embedding", T.ArrayType(T.FloatType()))])

        def run(batches):
            model = load()
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                matrix = np.asarray(model(texts), dtype=np.float32).reshape(len(texts), -1)
                sizes = np.linalg.norm(matrix, axis=1, keepdims=True)
                unit = np.divide(matrix, sizes, out=np.zeros_like(matrix), where=sizes > 0)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(unit.ravel()), unit.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column(0), lists.cast(pa.list_(pa.float32()))], [id_col, "embedding"])

        return df.select(id_col, text_col).mapInArrow(run, schema)

    return encode


@dataclass(frozen=True)
class VectorFacts:
    """What a vector table was seen to hold while it was written."""

    rows: int
    missing: int
    widths: tuple[int | None, int | None]
    norms: tuple[float | None, float | None]
    empty: int

    def require_unit(self, tolerance: float = 1e-3) -> None:
        """Inner products are cosines only between unit vectors; the zero vector of an empty text may stay."""
        low, high = self.norms
        if low is not None and (low < 1 - tolerance or high > 1 + tolerance or low != low or high != high):
            raise ValueError(f"vectors are not of unit length: norms {low:.4f} to {high:.4f}")
        if self.widths[0] != self.widths[1]:
            raise ValueError(f"vectors differ in length: {self.widths[0]} to {self.widths[1]}")

    def require_complete(self) -> None:
        """Every ticket has its vector."""
        if self.missing:
            raise ValueError(f"{self.missing} of {self.rows} tickets have no vector")


def store_vectors(df: DataFrame, name: str, vec_col: str = "embedding") -> tuple[DataFrame, VectorFacts]:
    """``df`` written to the shared folder and read back, with facts observed by that one write: no pass of their own."""
    size = V.norm(F.col(vec_col))
    filled = F.when(size != 0, size)
    seen = Observation(f"{name}-facts")
    width = F.size(vec_col)
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(vec_col).isNull()).alias("missing"),
        F.min(F.when(width >= 0, width)).alias("narrow"), F.max(F.when(width >= 0, width)).alias("wide"),
        F.min(filled).alias("low"), F.max(filled).alias("high"), F.count_if(size == 0).alias("empty"),
    )
    stored = materialize(observed, name)
    got = seen.get
    return stored, VectorFacts(got["rows"], got["missing"], (got["narrow"], got["wide"]), (got["low"], got["high"]), got["empty"])


def unit_length(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    return df.withColumn(vec_col, V.l2_normalize(F.col(vec_col)))
