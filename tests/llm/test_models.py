"""Toxicity and quality: the parts against plain forms, the whole by held-out rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ticketloom.llm import quality_ranking, toxicity
from ticketloom.llm.learning import logistic

from .helpers import AWKWARD, docs, labels, prose, rows

INSULTS = ["idiot", "moron", "scumbag"]


@pytest.fixture(scope="module")
def model():
    text = ["the idiot and the moron met a scumbag in the good green garden and then stood there alone " * 30]
    batch = pa.RecordBatch.from_arrays([pa.array(text)], ["text"])
    out = next(toxicity._trigram_job()(iter([batch])))
    counts = np.zeros(toxicity.LETTERS**3, np.int64)
    counts[out.column("gram").to_numpy()] = out.column("n").to_numpy()
    return toxicity.LetterModel(counts)


@pytest.mark.parametrize("written", ["1d10t", "id!ot", "iiiidiooot", "i.d.i.o.t", "!d!0t", "IDIOT!!", "idiot###", "i-d-i-0-t", "idi*ot", "idiot"])
def test_deobfuscation(model, written):
    assert toxicity.restore(written, model) == "idiot"


@pytest.mark.parametrize("written", ["good", "green", "garden", "Good,", "été", "2024", "+1", "...", ""])
def test_plain_words_stay(model, written):
    want = {"Good,": "good", "2024": "", "+1": "", "...": ""}.get(written, written)
    assert toxicity.restore(written, model) == want


def test_viterbi_is_the_cheapest_path(model):
    import itertools

    def price(letters, arcs):
        a = b = 0
        total = 0.0
        for letter, cost in arcs:
            total += cost
            if letter:
                c = toxicity._class_of(letter)
                total += model.table[a][b][c]
                a, b = b, c
        return total + model.table[a][b][0]

    for token in ("m0r0n", "sc+m", "aaa1", "i_d1"):
        before, arcs = "", []
        for ch in token:
            arcs.append(toxicity._arcs(ch, before))
            before = ch
        best = min(price(None, path) for path in itertools.product(*arcs))
        word = toxicity.viterbi(token, model)
        assert any(abs(price(None, p) - best) < 1e-9 and "".join(x for x, _ in p) == word for p in itertools.product(*arcs))


def test_spaced_letters_are_one_token_besides():
    codes, words, owner = toxicity.tokens(pa.array(["you i d i o t yes", "a b"]))
    assert b"idiot" in words and owner.tolist() == sorted(owner.tolist())
    assert [words[c] for c, o in zip(codes, owner, strict=True) if o == 1] == [b"a", b" b"]


@pytest.mark.parametrize("written", ["iddiot", "idiiot", "IDDIOTT"])
def test_doubled_letters_are_restored(model, written):
    assert toxicity.restore(written, model) == "idiot"


@pytest.mark.parametrize("text", ["you met a s c u m b a g there", "s c u m b a g i d i o t", "a i d i o t m o r o n", "scumbag,idiot", "the\u00a0idiot\there", "the\tidiot", "i\u00a0d\u00a0i\u00a0o\u00a0t", "\u3000idiot\u2003x"])
def test_words_behind_any_border_are_looked_up(model, text):
    _, words, _ = toxicity.tokens(pa.array([text]))
    found = {w for token in words for w in toxicity.readings(token.decode(), model)}
    assert found & {"scumbag", "idiot", "moron"} >= {w for w in ("scumbag", "idiot", "moron") if w in "".join(text.split())}


def test_a_letter_of_two_bytes_is_one_character():
    _, words, _ = toxicity.tokens(pa.array(["c r é t i n"]))
    assert "crétin".encode() in words


def _fold(i, parts):
    return zlib.crc32(str(i).encode()) % parts


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(1)
    table, truth = [], []
    disguise = {"idiot": ["1d10t", "i.d.i.o.t", "idioooot", "i d i o t"], "moron": ["m0r0n", "m o r o n"], "scumbag": ["$cumbag"]}
    for i in range(600):
        words = prose(1000 + i, 40).split()
        if i % 4 == 0:
            for _ in range(3):
                w = rng.choice(INSULTS)
                words.insert(rng.randrange(len(words)), rng.choice(disguise[w]) if i % 8 == 0 else w)
        table.append((i, " ".join(words)))
        truth.append((i, int(i % 4 == 0)))
    extra = [(10_000 + k, t) for k, (_, t) in enumerate(AWKWARD)]
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs(spark, table + extra), labels(spark, "toxic", truth + [(5, 1), (7, None), (None, 1)])).collect()}
    assert len(got) == len(table) + len(extra) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    assert all(r["held_out"] == (_fold(i, 3) == 1) for i, r in got.items())
    held = [(got[i]["predicted"], y) for i, y in truth if _fold(i, 3) == 1]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    assert [i for i, _ in extra if got[i]["predicted"]] == []


def test_models_without_labels_and_tables(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert {r["score"] for r in toxicity.toxicity(docs(spark), none).collect()} == {0.0}
    assert {round(r["score"], 9) for r in quality_ranking.quality_scores(docs(spark), none).collect()} == {0.3}
    assert toxicity.toxicity(docs(spark, []), none).count() == quality_ranking.quality_scores(docs(spark, []), none).count() == 0


def test_logistic_finds_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.logistic(size=500) > 0).astype(float)
    w = logistic(x, y, ridge=1e-3)
    assert np.abs(x.T @ (1 / (1 + np.exp(-x @ w)) - y) / 500 + 1e-3 * w).max() < 1e-6


def test_features_are_plain_shares():
    texts = ["AB cd, cd | x1\ncd", "", None, "a a a a"]
    x = dict(zip(quality_ranking.FEATURES, quality_ranking.features(pa.array(texts)).T, strict=True))
    assert x["bars"].tolist() == [1 / 17, 0, 0, 0] and x["upper"][0] == pytest.approx(2 / 9)
    assert x["distinct_words"].tolist()[3] == pytest.approx(1 / 4)
    assert x["log_words"].tolist() == pytest.approx(np.log1p([6, 0, 0, 4]).tolist()) and x["digits"][0] == pytest.approx(1 / 17)
    assert all(np.isfinite(v).all() for v in x.values())


def test_quality_on_held_out_rows(spark):
    table, truth = [], []
    for i in range(500):
        bad = i % 5 == 0
        text = prose(i, 60)
        if bad:
            text = text.replace(" ", " | ") if i % 10 else (text[:20] + " ") * 30
        table.append((i, text))
        truth.append((i, int(not bad)))
    got = quality_ranking.quality_scores(docs(spark, table + [(900, None), (901, "")]), labels(spark, "quality", truth + [(3, 0)])).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (_fold(r["doc_id"], 5) == 0) for r in got)
    held = [(by_id[i]["predicted"], y) for i, y in truth if _fold(i, 5) == 0]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    kept = quality_ranking.keep_good(docs(spark, table), labels(spark, "quality", truth))
    assert kept.columns == docs(spark).columns
    assert {r[0] for r in rows(kept, "doc_id")} == {i for i, _ in table if by_id[i]["predicted"]} or kept.count() >= 390


def test_trimming_is_linear_and_takes_marks_alone():
    import random
    import re

    from ticketloom.llm import toxicity

    plain = re.compile(r"^([^\w])\1{2,}|^[^\w@$+|!€£¡§]+|([^\w])\2{2,}[^\w]*$|[^\w@$+]+$")
    rng = random.Random(3)
    for _ in range(20_000):
        token = "".join(rng.choice("ab_1!!@$+.,.€") for _ in range(rng.randrange(9)))
        assert toxicity.trimmed(token) == plain.sub("", token), token
    for sign in "!@$+|.,€_-":
        long = "a" + sign * 50_000 + "b"
        assert toxicity.trimmed(long) == long and toxicity.trimmed(sign * 50_000) in ("", sign * 50_000)
