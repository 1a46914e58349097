"""The linear grouping scheme: every piece once, no sequence too long, about as few as the total allows."""

import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ticketloom.llm import grouped_packing as G

from .helpers import AWKWARD, docs


def _check(lengths, room, bins, offsets):
    by_bin = defaultdict(list)
    for n, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        by_bin[b].append((o, n))
    for held in by_bin.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= room
    return len(by_bin)


def test_cut():
    assert G.cut(5, 4) == [(0, 1), (1, 4)] and G.cut(8, 4) == [(0, 4), (4, 4)] and G.cut(4, 4) == [(0, 4)] and G.cut(1, 4) == [(0, 1)]


def test_classes_are_equal_and_round_up():
    lengths = np.sort(np.random.default_rng(2).integers(100, 1000, 1001))[::-1]
    kind, sizes = G.rounded_up(lengths, 20)
    assert (sizes[kind] >= lengths).all() and (np.diff(sizes) < 0).all() and np.bincount(kind).max() <= 51 * 2
    assert G.rounded_up(np.array([7, 7, 7]), 32)[1].tolist() == [7]


def test_configurations_meet_the_best_fractional_solution():
    sizes, demand = np.array([7, 5, 3]), np.array([40.0, 60.0, 90.0])
    shapes, used = G.configurations(sizes, demand, 16)
    assert (shapes @ sizes <= 16).all() and np.allclose(used @ shapes, demand)
    # Of all maximal fillings no dual bound allows half a sequence less: 7 + 3 + 3 + 3, 5 + 5 + 3 + 3, 7 + 5 + 3.
    least = max(sum(w * d for w, d in zip(worth, demand, strict=True)) for worth in product(np.linspace(0, 1, 41), repeat=3) if all(np.dot(worth, c) <= 1 + 1e-9 for c in product(range(3), range(4), range(6)) if np.dot(c, sizes) <= 16))
    assert used.sum() <= least + 0.75


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 500, 20_000])
def test_few_sequences(n):
    rng = np.random.default_rng(n)
    for lengths in (rng.integers(1, 1025, n), np.full(n, 1024), np.full(n, 400), np.full(n, 513), rng.choice([600, 424, 3], n), rng.integers(300, 360, n)):
        bins, offsets = G.pack_lengths(lengths, 1024)
        got = _check(lengths, 1024, bins, offsets)
        assert (bins.max(initial=-1) + 1) == got
        if n:
            best_fit = len(set(G._best_fit(lengths, [], 1024)[0]))
            assert got <= best_fit + max(2, best_fit // 200)
    thirds = np.concatenate((np.full(3 * 300, 340), np.full(300, 511), np.full(300, 513)))
    assert len(set(G.pack_lengths(thirds, 1024)[0].tolist())) == 600


def test_pieces_cover_every_document(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    got = G.pack(docs(spark), path, end_id=2, room=128, classes=8, group_pieces=100).collect()
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    lengths = np.array([r["length"] for r in got])
    _check(lengths, 128, np.array([r["sequence_id"] for r in got]), np.array([r["offset"] for r in got]))
    assert len(by_sequence) <= -(-int(lengths.sum()) // 128) * 1.05 + 3
    want = defaultdict(int)
    for doc_id, text in AWKWARD:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        for k, (start, n) in enumerate(G.cut(len(ids), 128)):
            want[doc_id, k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
    have = defaultdict(int)
    for r in got:
        have[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
    assert have == want
    assert G.pack(docs(spark, []), path).count() == 0
    assert [(r["length"], r["offset"]) for r in G.pack(docs(spark, [(1, None)]), path).collect()] == [(1, 0)]


def test_signs_and_blanks_without_end(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    text = "a" + "!" * 50_000 + "b" + " " * 200_000 + "c"
    got = G.pack(docs(spark, [(1, text)]), path).agg({"length": "sum"}).first()[0]
    assert got == len(plain.encode(text, add_special_tokens=False).ids) + 1
