"""Small tables with everything that is awkward, and plain counterparts of the operators."""

import random

import pyarrow as pa

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


LONG = "x" * 70_000 + " " + prose(99, 3_000) + "\n" + "ab" * 9_000
AWKWARD = [
    (1, prose(1, 80)), (2, prose(1, 80)), (3, None), (4, ""), (5, "   \n\t "), (6, LONG), (7, prose(7, 3)), (8, "é è́ x ́y \x00 日本 語 😀😀 İstanbul"),
    (9, prose(1, 80)), (9, prose(1, 80)), (10, prose(10, 60)), (10, prose(11, 60)), (None, prose(12, 40)), (None, None), (11, "a b　c <|endoftext|> d"),
    (12, prose(1, 78) + " omega psi"), (13, "!!! ??? ..."), (14, "1 2 3"),
]


def docs(spark, rows=AWKWARD, clash=True):
    """A documents table; its other columns have names that operators use inside."""
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    if clash:
        from pyspark.sql import functions as F

        for name in ("row", "node", "label", "n", "start", "block", "score", "spans", "x", "grp", "_bad", "_gone", "lang"):
            df = df.withColumn(name, F.lit(name))
    return df


def labels(spark, column, rows):
    return spark.createDataFrame([(i, y) for i, y in rows], f"doc_id long, {column} int")


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)


def arrow(texts):
    return pa.array(texts, pa.string())
