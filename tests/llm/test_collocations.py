"""Phrases against a loop over all n-grams."""

import re
from collections import Counter, defaultdict

import pytest

from ticketloom.llm import collocations as C

from .helpers import AWKWARD, prose, rows

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _plain(table, longest, least, keep):
    count, total = Counter(), Counter()
    for lang, text in table:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", _fold(text)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            count.update((lang, *words[i : i + m]) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    found = {p: a for p, a in count.items() if len(p) > 2 and a >= least}
    inside = {(p[0], *p[i:j], a) for p, a in found.items() for i in range(1, len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) - 1}
    by_lang = defaultdict(list)
    for p, a in found.items():
        if (*p, a) in inside:
            continue
        lang, words = p[0], p[1:]
        cuts = [(count[lang, *words[:k]], count[lang, *words[k:]], k) for k in range(1, len(words))]
        score, _, l, r = min((1000 * a * total[lang] // (l * r), k, l, r) for l, r, k in cuts)
        by_lang[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, total[lang], -s) for lang, best in by_lang.items() for k, (s, a, p, l, r) in enumerate(sorted(best)[:keep]))


def _table(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1L AS n", "'x' AS word", "'y' AS w1", "2L AS pair")


CASES = [(lang, prose(k, 120)) for k in range(25) for lang in ("en", None, "und", "é")]
CASES += [("en", t) for _, t in AWKWARD] + [("", "a b c a b c. A B C! a\tb\tc;a b  c:a b c?a b c\x0ba b c\x0ca b c\ra b c\r\na b c"), (None, None), ("zh", " x y " * 40), ("zh", "x y " * 40), ("fr", "É é É é É é É é É é")]


@pytest.mark.parametrize("held_pairs", [1 << 22, 0])
@pytest.mark.parametrize("longest, least, keep", [(5, 4, 50), (3, 2, 7), (2, 9, 10_000)])
def test_phrases_equal_a_loop_over_all_ngrams(spark, held_pairs, longest, least, keep):
    got = C.collocations(_table(spark, CASES), longest, least, keep, held_pairs)
    assert rows(got, *COLUMNS) == sorted(_plain(CASES, longest, least, keep), key=repr)


def test_nothing_gives_nothing(spark):
    for table in ([], [("en", None), (None, ""), ("en", " .\n!?")]):
        assert C.collocations(_table(spark, table), min_count=1).collect() == []


def test_products_beyond_64_bits_are_exact(spark):
    a, n, l, r = 9 * 10**9 + 1, 10**12 + 7, 10**10 + 19, 9 * 10**9 + 7
    df = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    assert df.select(C._cut_score(df.a, df.n, df.l, df.r)).first()[0] == 1000 * a * n // (l * r)


def test_a_phrase_of_many_repeats_in_one_text(spark):
    got = rows(C.collocations(_table(spark, [("en", "na " * 60_000 + "!" * 50_000 + " " * 200_000 + "x")]), keep=3), *COLUMNS)
    assert [r[:4] for r in got] == [("en", 1, "na na", 59_999), ("en", 2, "na na na", 59_998), ("en", 3, "na na na na", 59_997)]
