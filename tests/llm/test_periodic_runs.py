"""Periodic runs against trying every period at every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ticketloom.llm import periodic_runs as R

from .helpers import AWKWARD, docs, prose, rows


def _plain(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        t = 0
        while t + q < len(words):
            s = t
            while t + q < len(words) and words[t] == words[t + q]:
                t += 1
            if t > s and t - s + q >= max(6, 4 * q):
                found.setdefault((s, t - s + q), q)
            t += 1 if t == s else 0
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _some_words(rng):
    kind, signs = rng.randrange(4), rng.choice([1, 2, 2, 3, 50])
    if kind == 0:
        return [rng.randrange(signs) for _ in range(rng.randrange(80))]
    if kind == 1:  # repeated units side by side
        out = []
        for _ in range(rng.randrange(6)):
            unit = [0] * rng.randrange(20) * rng.randrange(2) + [rng.randrange(signs) for _ in range(rng.randrange(1, 25))]
            out += unit * rng.randrange(1, 8) + unit[: rng.randrange(len(unit) + 1)]
        return out
    if kind == 2:  # a unit that is itself nearly periodic, begun anywhere
        unit = ([0] * rng.randrange(1, 30) + [1] * rng.randrange(1, 4)) * rng.randrange(1, 4) + [rng.randrange(4)]
        at = rng.randrange(len(unit))
        unit = unit[at:] + unit[:at]
        return [7] * rng.randrange(5) + unit * rng.randrange(1, 9) + unit[: rng.randrange(len(unit) + 1)]
    a, b = [0], [0, 1]
    for _ in range(rng.randrange(1, 9)):
        a, b = b, b + a
    return (b * rng.randrange(1, 6))[:600]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_every_period_at_every_place(seed):
    rng = random.Random(seed)
    for _ in range(30):
        held = [_some_words(rng) for _ in range(rng.randrange(1, 30))]
        offsets = np.cumsum([0] + [len(w) for w in held])
        got = R.runs(np.array(sum(held, []), np.int64), offsets)
        assert [tuple(r) for r in got.tolist()] == [(d, *r) for d, w in enumerate(held) for r in _plain(w)]


def test_long_documents():
    rng = np.random.default_rng(4)
    for words, want in ((np.zeros(200_000, np.int64), (0, 200_000, 1)), (np.tile(rng.integers(0, 900, 30_011), 5)[:140_000], (0, 140_000, 30_011))):
        assert R.runs(words, np.array([0, len(words)])).tolist() == [[0, *want]]


def test_wavelet_tree():
    rng = np.random.default_rng(1)
    values = rng.permutation(500)
    tree = R.WaveletTree(values)
    lo = rng.integers(0, 480, 200)
    hi = lo + rng.integers(1, 20, 200)
    bound = rng.integers(0, 1200, 200)
    assert tree.below(lo, hi, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(lo, hi, bound, strict=True)]
    k = rng.integers(0, 100, 200) % (hi - lo)
    assert tree.smallest(lo, hi, k).tolist() == [int(np.sort(values[a:b])[j]) for a, b, j in zip(lo, hi, k, strict=True)]


def _words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def _collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


LOOPS = [(20, "la " * 9), (21, "x " + "a b " * 4 + "a\tb\nc"), (22, "b " * 5), (23, "É É É É É É É"), (24, "a b c " * 3 + "a b"), (25, "a b c " * 4 + "!" * 50_000 + " " * 200_000 + "z"), (None, "c d " * 8), (26, "a" + "!" * 50_000 + "b"), (27, " ".join(["a"] * 7 + ["b"] + ["a"] * 7))]


def test_documents(spark):
    table = AWKWARD + LOOPS
    want = [(i, len(w := _words(t)), (r := _plain(w)), _collapsed(w, r)) for i, t in table]
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in R.find_runs(docs(spark, table)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert R.find_runs(docs(spark, [])).count() == 0 and R.digest(R.find_runs(docs(spark, []))).count() == 0


def _tail(doc_id, text):
    words = _words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_digest_columns(spark):
    table = AWKWARD + LOOPS + [(k, prose(k, k % 70)) for k in range(100, 500)]
    want = []
    for i, t in table:
        words = _tail(i, t)
        found = _plain(words)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join("%d,%d,%d\n" % r for r in found)), sha(_collapsed(words, found))))
    got = R.digest(R.find_runs(R.periodic_tails(docs(spark, table))))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows(got, *got.columns) == sorted(want, key=repr)
    assert sum(r[1] for r in want) > 15
