import math
from collections import Counter

import pytest

from ticketloom.functions.porter import stem
from ticketloom.operators import overlap as O

PAIRS = [
    ("the cat sat on the mat", "the cat sat on the mat"),
    ("alpha beta", "gamma delta"),
    ("a b c d e f g", "a b"),
    ("a b c", "a b c d e f"),
    ("a b c d", ""),
    ("", ""),
    ("x y z w v", "v w z y x"),
    ("the the the the", "the"),
    ("Hello THERE you", "hello there You too"),
    ("... !!!", "..."),
    ("one two three four five six", "one two four five six seven eight"),
]


def plain_bleu(ref, hyp):
    r, h = ref.lower().split(), hyp.lower().split()
    logs = 0.0
    for n in range(1, 5):
        hc = Counter(tuple(h[i:i + n]) for i in range(len(h) - n + 1))
        rc = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
        num, den = sum(min(c, rc[g]) for g, c in hc.items()), max(1, sum(hc.values()))
        if n == 1 and num == 0:
            return 0.0
        logs += math.log((num or 0.1) / den)
    penalty = 0.0 if len(h) > len(r) else 1 - len(r) / len(h)
    return round(math.exp(penalty + logs / 4), 4)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = row[:]
        for j, y in enumerate(b):
            row[j + 1] = prev[j] + 1 if x == y else max(prev[j + 1], row[j])
    return row[-1]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame([(i, r, h) for i, (r, h) in enumerate(PAIRS)] + [(99, "x", None)], "ticket_id long, answer string, generated_answer string")
    return {r["ticket_id"]: r for r in O.text_overlap(df, stemmed=False).collect()}


@pytest.mark.parametrize("i", range(len(PAIRS)))
def test_bleu_and_rouge(scored, i):
    import re

    ref, hyp = PAIRS[i]
    assert scored[i]["bleu"] == plain_bleu(ref, hyp)
    a, b = re.findall("[a-z0-9]+", hyp.lower()), re.findall("[a-z0-9]+", ref.lower())
    lcs = plain_lcs(a, b)
    assert scored[i]["rouge_l"] == (round(2 * lcs / (len(a) + len(b)), 4) if lcs else 0.0)


def test_missing_text_has_no_score(scored):
    assert scored[99]["bleu"] is None and scored[99]["rouge_l"] is None


def test_long_subsequence():
    import random

    rng = random.Random(1)
    a, b = ([rng.choice("abcdef") for _ in range(n)] for n in (300, 217))
    assert O.common_subsequence(a, b) == plain_lcs(a, b)


# Examples of the published algorithm and of the usual extensions.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "falling": "fall", "hissing": "hiss", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "valenci": "valenc",
    "digitizer": "digit", "radicalli": "radic", "vietnamization": "vietnam", "operator": "oper", "feudalism": "feudal",
    "hopefulness": "hope", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "electrical": "electr",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "adjustable": "adjust", "replacement": "replac",
    "adoption": "adopt", "communism": "commun", "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "dying": "die", "enjoy": "enjoy", "spied": "spi", "died": "die",
}


@pytest.mark.parametrize("word,want", STEMS.items())
def test_stems(word, want):
    assert stem(word) == want


def test_stemming_matches_inflections(spark):
    df = spark.createDataFrame([(1, "printers failing", "printer failed")], "ticket_id long, answer string, generated_answer string")
    assert O.rouge_l(df, stemmed=True).first()["rouge_l"] == 1.0
    assert O.rouge_l(df, stemmed=False).first()["rouge_l"] == 0.0


def test_stemmer_in_sql_agrees():
    import random

    import duckdb

    from ticketloom.functions import porter
    from ticketloom.plans.stem_sql import stems

    rng = random.Random(3)
    ends = [s for s, _ in porter.STEP_2 + porter.STEP_3] + porter.STEP_4 + ["", "s", "ies", "sses", "ied", "eed", "ed", "ing", "y", "e", "ll", "logi", "alli", "ationalli"]
    words = set(porter.IRREGULAR) | {"yyyy", "hopping", "filing", "falling", "sky", "agreed", "a1b2", "2024"}
    for _ in range(6000):
        words.add("".join(rng.choice("aeioubcdlstzwxy0") for _ in range(rng.randrange(0, 6))) + rng.choice(ends) + rng.choice(["", "", rng.choice(ends)]))
    words = sorted(w for w in words if w and "yyyyyyy" not in w)
    db = duckdb.connect()
    db.execute("CREATE TABLE words AS SELECT unnest(?) AS w", [words])
    got = dict(db.execute(f"WITH {stems('words')} SELECT w, x FROM stems").fetchall())
    assert got == {w: porter.stem(w) if len(w) > 3 else w for w in words}
