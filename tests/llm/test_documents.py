"""Near duplicates, personal data, the queries and the pipeline."""

import hashlib
import random
import re

import pytest
from check import compare, database
from pyspark.sql import functions as F

from ticketloom.llm import catalog, personal_data, shingle_join

from .helpers import AWKWARD, WORDS, docs, prose, rows


def _set(text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _plain_components(table):
    sets = [_set(t) for _, t in table]
    label = list(range(len(table)))
    for a in range(len(table)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(table, label, strict=True):
        least[x] = i if least.get(x) is None else min(least[x], i if i is not None else least[x])
    return sorted(((i, len(s), least[x] if s else i) for (i, _), s, x in zip(table, sets, label, strict=True)), key=repr)


def _near(seed, base, changes):
    rng = random.Random(seed)
    words = base.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_components_equal_all_pairs(spark, monkeypatch):
    passage = prose(500, 55)
    table = list(AWKWARD)
    for g in range(6):
        base = prose(600 + g, 90)
        table += [(1000 * (g + 1) + k, _near(g * 100 + k, base, k % 6)) for k in range(25)]
    table += [(8000 + k, passage + " " + prose(700 + k, 8 + k)) for k in range(20)]
    table += [(9000, "a b c d"), (9001, "A  b\tc d"), (9002, "one"), (9003, "ONE"), (9004, "a b c e")]
    want = _plain_components(table)
    assert rows(shingle_join.near_duplicates(docs(spark, table)), "doc_id", "n_shingles", "component_id") == want
    # Several ranges of hashes, and shares of frequent shingles, change nothing.
    monkeypatch.setattr(shingle_join, "RANGE_BYTES", 4000)
    monkeypatch.setattr(shingle_join, "CELL_NODES", 3)
    assert rows(shingle_join.near_duplicates(docs(spark, table)), "doc_id", "n_shingles", "component_id") == want
    kept = shingle_join.keep_one(docs(spark, table))
    assert rows(kept, "doc_id") == sorted(((i,) for i, _, c in want if i == c or i is None), key=repr) and kept.columns == docs(spark).columns


def test_one_row_of_each_component_stays(spark):
    a, b, c = prose(810, 60), prose(811, 60), prose(812, 60)
    table = [(1, a), (2, a), (2, b), (5, c), (5, c), (None, c + " psi"), (None, prose(813, 60)), (None, prose(813, 60)), (None, None), (7, ""), (7, ""), (8, None)]
    kept = shingle_join.keep_one(docs(spark, table))
    want = [(1, a), (2, b), (5, c), (None, prose(813, 60)), (None, None), (7, ""), (7, ""), (8, None)]
    assert rows(kept, "doc_id", "text") == sorted(want, key=repr) and kept.columns == docs(spark).columns
    assert shingle_join.keep_one(docs(spark, [])).count() == 0


def test_payload_does_not_grow_with_the_ranges(monkeypatch):
    import pyarrow as pa
    import pyspark

    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda cls: type("Here", (), {"partitionId": lambda self: 0})()))

    nodes = pa.RecordBatch.from_arrays([pa.array([k.to_bytes(16, "big") for k in range(300)]), pa.array([prose(k, 200) for k in range(300)])], ["node", "text"])
    one, many = (sum(b.column("payload").nbytes - 4 * b.num_rows for b in shingle_join._pack_job(parts)(iter([nodes]))) for parts in (10, 1000))
    assert abs(many - one) < 0.1 * one


def test_nothing_to_join(spark):
    assert shingle_join.near_duplicates(docs(spark, [])).count() == 0
    assert rows(shingle_join.near_duplicates(docs(spark, [(1, None), (2, "")])), "doc_id", "n_shingles", "component_id") == [(1, 0, 1), (2, 0, 2)]


def test_suffix_bound_is_an_upper_bound():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 80, rng.integers(0, 50))) for _ in range(2))
        assert len(np.intersect1d(a, b)) <= shingle_join.suffix_bound(a, b) <= min(len(a), len(b))


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, value):
    figures = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(figures))]
        return 13 <= len(figures) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(figures) <= 15


def _plain_spans(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if _valid(k, m[0])]


TRICKY = [
    "a@b.c_d@e.f x@y z@@q.r .a@b..c me@x.y.", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4 1.2.3 999999999999.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 41111111111111111 1 2",
    "+1 (017) 555-7713 +49-30-123456789012345 +1 2 ++12345678901 + 1 +1(((((((((", "é😀 x@y.de 日本1.1.1.1本 4111111111111111", "7" * 3000, "a" * 5000 + "@b.c", "1 " * 400, "1.1." * 300, "@" * 50, "4111111111111111" * 3,
]


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(6)
    table = AWKWARD + [(100 + k, t) for k, t in enumerate(TRICKY)] + [(200 + k, "".join(rng.choice("0123456789 .-+@a()é") for _ in range(200))) for k in range(150)]
    got = {(r["doc_id"], r["base_sha256"], r["spans"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in personal_data.digest(personal_data.find(docs(spark, table), min_seeds=10**6)).collect()}
    for doc_id, text in table:
        spans = _plain_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert (doc_id, hashlib.sha256(joined.encode()).hexdigest(), joined, *(sum(s[0] == k for s in spans) for k in PLAIN)) in got


def test_contexts_discover_unseen_identifiers(spark):
    table = [(k, f"{prose(k, 5)} reach me on +1 (555) 010-{1000 + k} {prose(k + 50, 4)}") for k in range(12)]
    table += [(50, "please reach me on (555) 019-7777."), (51, "reach me on 555-0199-22 now"), (52, "version of 555-0199-22 now")]
    found = {r["doc_id"]: r["spans"] for r in personal_data.digest(personal_data.find(docs(spark, table))).collect()}
    assert found[51] == "phone:12:23" and found[52] == "" and all(found[k].count(":") == 2 for k in range(12))
    shown = {r["doc_id"]: r["text"] for r in personal_data.masked(docs(spark, table)).collect()}
    assert shown[51] == "reach me on [phone] now" and shown[52] == table[-1][1] and "[phone]" in shown[0] and "555" not in shown[0]
    assert personal_data.masked(docs(spark)).columns == docs(spark).columns
    assert personal_data.digest(personal_data.find(docs(spark, []))).count() == 0


def test_a_found_identifier_leads_to_another_context(spark):
    table = [(k, f"{prose(k, 4)} call +1 (555) 010-{1000 + k} {prose(k + 40, 3)}") for k in range(20)]
    for k in range(4):  # no seed stands behind "dial"; what "call" reveals does
        table += [(100 + k, f"call 555-0199-{100 + k} soon"), (110 + k, f"dial 555-0199-{100 + k} soon")]
    table += [(200, "dial 555-7777-123 now"), (201, "room 555-7777-124 now")]
    spans = lambda rounds: {r["doc_id"]: r["spans"] for r in personal_data.digest(personal_data.find(docs(spark, table), rounds=rounds)).collect()}
    first, last = spans(1), spans(3)
    assert first[100] == "phone:5:17" and first[200] == ""
    assert last[110] == last[200] == "phone:5:" + str(5 + len("555-0199-100")) and last[201] == ""


def test_a_context_of_order_numbers_is_no_pattern(spark):
    table = [(k, f"see ref user{k}@mail.com") for k in range(4)] + [(10 + k, f"see ref {70000 + k}") for k in range(8)]
    found = {r["doc_id"]: r["spans"] for r in personal_data.digest(personal_data.find(docs(spark, table))).collect()}
    assert all(found[10 + k] == "" for k in range(8)) and found[0].startswith("email:8:")
    scored = personal_data.pattern_scores(personal_data.scan(docs(spark, table)))
    assert {(r["pattern"], r["known"], round(r["confidence"], 6)) for r in scored.collect()} == {("ref", 4, 0.333333), ("see ref", 4, 0.333333)}


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_agrees_with_sql(spark, sf, name):
    assert compare(catalog.queries()[name](spark, sf), database(sf).sql(catalog.oracle_sql()[name])) == ""


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_gives_a_row_for_every_document(spark, sf, name):
    out = catalog.queries()[name](spark, sf)
    wanted = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").distinct().count()
    assert out.select("doc_id").distinct().count() == wanted


def test_pipeline(spark, sf):
    import corpus_pipeline

    given = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    kept = [r[0] for r in out.select("doc_id").distinct().collect()]
    assert 0 < len(kept) < given.count()
    copies = given.groupBy("text").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1")
    gone = {r[0] for r in given.join(copies, "text").where("doc_id <> first").select("doc_id").collect()}
    assert gone and not gone & set(kept)
    assert len(corpus_pipeline.STAGES) == 5 and WORDS
