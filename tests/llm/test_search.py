"""Top-k search, phrases and near terms against plain loops."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ticketloom.llm import positional_index, segment_search

from .helpers import AWKWARD, docs, prose, rows

NAN, INF = float("nan"), float("inf")


def _plain_top(table, k):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in table if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda q, c: max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, c, strict=True))))
    out = []
    for i, q in good:
        if i % 20 == 0:
            scores = sorted((-score(q, c), j) for j, c in good if j != i and len(c) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def test_top_k_equals_all_scores(spark):
    rng = np.random.default_rng(2)
    table = [(i, rng.normal(0, 0.2, 13).tolist()) for i in range(150)]
    table += [(200 + i, table[3][1]) for i in range(40)]  # ties
    table += [(20, table[20][1]), (300, None), (320, [0.1, None] + [0.0] * 11), (340, [NAN] * 13), (360, [INF] * 13), (380, [0.5, 0.5]), (381, [0.25, -0.1]), (400, []), (None, table[0][1]), (420, [1e30] * 13)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>").withColumnRenamed("label", "label")
    for options in ({}, {"slice_rows": 30, "group_rows": 4, "seed_rows": 25}, {"seed_rows": 1}):
        assert rows(segment_search.top_k(df, every=20, k=20, **options), "query_id", "rank", "vec_id", "score") == _plain_top(table, 20)
    assert segment_search.top_k(df.limit(0)).count() == 0


def test_large_components_are_neither_dropped_nor_rounded(spark):
    rng = np.random.default_rng(5)
    table = [(i, rng.normal(0, 0.2, 6).tolist()) for i in range(60)]
    table += [(100 + i, (rng.normal(0, 1, 6) * 10.0 ** rng.integers(4, 12, 6)).tolist()) for i in range(60)]  # scores on both sides of 64 bits
    table += [(200, [1e300, -1e300, 1.0, 0.0, 0.0, 0.0]), (220, [0.0] * 6), (240, [-3e5] * 6), (241, [3e5] * 6), (242, [3e5] * 5 + [3e5 + 1 / 64]), (20, [4e5] * 6), (20, [1.0, 300000.0]), (21, [1.0, 2.0]), (40, [2.0, 1.0])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    for options in ({}, {"slice_rows": 30, "group_rows": 4, "seed_rows": 25}):
        assert rows(segment_search.top_k(df, every=20, k=9, **options), "query_id", "rank", "vec_id", "score") == _plain_top(table, 9)


def test_bounds_hold_on_every_level():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-90, 90, (40, 67)), rng.integers(-90, 90, (50, 67))
    scores = a @ b.T
    before = None
    for s in segment_search.segment_counts(67):
        bound = segment_search.statistics(a, s) @ segment_search.statistics(b, s).T
        assert (bound >= scores - 1e-6).all()
        assert before is None or bound.mean() < before
        before = bound.mean()


WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _plain_hits(text, items, window):
    words, hit, which = _words(text), set(), set()
    for item, item_text in items:
        asked = _words(item_text)
        for at in range(max(1, len(asked) - window + 1) if asked else 0):
            run = asked[at : at + window]
            for p in range(len(words) - len(run) + 1):
                if words[p : p + len(run)] == run:
                    hit.update(range(p, p + len(run)))
                    which |= {str(item)} if item is not None else set()
    return len(words), len(hit), len(which), hashlib.sha256(",".join(sorted(which)).encode()).hexdigest(), bool(hit)


def test_contamination_equals_a_plain_search(spark):
    items = [(1, prose(1, 80)), (2, prose(10, 25)), (3, None), (4, ""), (5, "alpha beta"), (30, prose(1, 30)), (None, prose(11, 20)), (7, "alpha " * 12), (2, prose(7, 3))]
    table = AWKWARD + [(50, "alpha " * 30 + "end"), (51, "-".join(["ALPHA"] * 11)), (52, prose(1, 9)), (53, "alpha. BETA! " + prose(10, 24))]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS block")
    want = sorted(((i, *_plain_hits(t, items, 10)) for i, t in table), key=repr)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert rows(positional_index.contamination(docs(spark, table), benchmark), *columns) == want
    # Small blocks and several passes over the benchmark change nothing.
    index = positional_index.build_index(docs(spark, table), block_bytes=500)
    many, one = (rows(positional_index.matches(index, benchmark, item_bytes=b).selectExpr("block", "nth", "array_sort(items) AS items"), "block", "nth", "items") for b in (150, 1 << 20))
    assert many == one and many
    kept = positional_index.without_contaminated(docs(spark, table), benchmark)
    bad = {w[0] for w in want if w[5]}
    assert rows(kept, "doc_id") == sorted(((i,) for i, _ in table if i not in bad), key=repr) and kept.columns == docs(spark, table).columns
    assert positional_index.contamination(docs(spark, []), benchmark).count() == 0
    assert not [r for r in positional_index.contamination(docs(spark), benchmark.limit(0)).collect() if r["contaminated"]]


def test_phrases_and_near_terms_of_a_block():
    rng = random.Random(8)
    text = " ".join(rng.choice("abcdefgh") for _ in range(300))
    words = text.split()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc_id", "text"])
    import pyspark

    class Here:
        partitionId = staticmethod(lambda: 0)

    held, pyspark.TaskContext.get = pyspark.TaskContext.get, staticmethod(lambda: Here)
    try:
        row = next(positional_index._index_job(1 << 20)(iter([batch])))
    finally:
        pyspark.TaskContext.get = held
    phrases = positional_index.Phrases(pa.table({"item_id": [1, 2], "text": ["a b c", "h g"]}), 2)
    block = positional_index.BlockPostings({"places": row.column("places")[0].as_py(), "counts": row.column("counts")[0].as_py(), "terms": row.column("terms")[0].values}, phrases.vocabulary)
    which, begin = positional_index.find_phrases(block, phrases)
    runs = [[phrases.vocabulary[c].as_py().decode() for c in r] for r in phrases.codes.tolist()]
    assert sorted(zip(which.tolist(), begin.tolist(), strict=True)) == [(p, k) for p, r in enumerate(runs) for k in range(len(words) - 1) if words[k : k + 2] == r]
    which, low, high = positional_index.find_near(block, phrases, terms=2, slop=3, base=np.array([0]))
    for p, a, b in zip(which.tolist(), low.tolist(), high.tolist(), strict=True):
        assert {words[a], words[b]} == set(runs[p]) and b - a <= 3
    for p, r in enumerate(runs):
        rare = min(r, key=words.count)
        other = next(x for x in r if x != rare)
        places = [k for k, w in enumerate(words) if w == rare and other in words[max(0, k - 3) : k + 4]]
        assert sum(which == p) == len(places)


def test_near_terms_stay_inside_a_document(spark):
    # Document 2's "rare" is nearer to the end of document 1's "other" than to its own, but only its own counts.
    table = [(1, "x y other"), (2, "rare f other g"), (3, "h rare"), (4, "other i"), (5, ""), (6, "rare a b c d e other")]
    benchmark = spark.createDataFrame([(7, "rare other")], "item_id long, text string")
    index = positional_index.build_index(docs(spark, table).coalesce(1))
    ids = index.select("block", F.posexplode("doc_ids").alias("nth", "doc_id"))
    found = positional_index.matches(index, benchmark, near=(2, 3)).join(ids, ["block", "nth"])
    assert [(r["doc_id"], [tuple(s) for s in r["spans"]], r["items"]) for r in found.collect()] == [(2, [(0, 3)], [7])]


def test_blocks_are_written_and_asked_a_few_at_a_time(spark):
    """However large a task's input, neither a row group nor a batch is as large as all its blocks."""
    texts = spark.range(0, 120, 1, 1).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40_000)), lambda i: F.concat(F.lit("w"), (i * 7919 + F.col("id") * 104729).cast("string"))), " ").alias("text"))
    index = positional_index.build_index(texts)
    blocks = index.count()
    assert blocks > 4 * positional_index.GROUP_ROWS
    groups = [m.row_group(g).num_rows for f in index.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for g in range(m.num_row_groups)]
    assert sum(groups) == blocks and max(groups) <= positional_index.GROUP_ROWS

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    held = index.coalesce(1).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in held) == blocks and max(r["size"] for r in held) < 16 << 20
    near_end = spark.createDataFrame([(1, " ".join(f"w{i * 7919 + 119 * 104729}" for i in range(39_990, 40_001)))], "item_id long, text string")
    hit = positional_index.contamination(texts, near_end).where("contaminated").collect()
    assert [(r["doc_id"], r["n_hit"], r["n_items"]) for r in hit] == [(119, 11, 1)]
