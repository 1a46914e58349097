"""Token counts, token-id files and packing against the tokenizer libraries."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ticketloom.llm import arrays, packing, rans, token_counts

from .helpers import AWKWARD, arrow, docs, rows

SPECIAL = ["a  b\t\n c  d　 e <|endoftext|> x<|endoftext|>\n\ny 'S it's I'M  don't", " ▁ a▁ b ▁▁ c▁▁", "a" * 3000 + " abc" * 50 + "ab" * 700, "\x00 a\x00b </s> <s>", " " * 40, "x\x1c y \x85 z", "Ünï ÀÉ ß×÷ naïve,façade.42"]
TEXTS = [t for _, t in AWKWARD] + SPECIAL


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_give_the_librarys_ids(name):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    ids, begins = arrays.ChunkEncoder(path).encode(arrow(TEXTS))
    for k, text in enumerate(TEXTS):
        assert ids[begins[k] : begins[k + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids
    assert np.array_equal(arrays.ChunkEncoder(path).count(arrow(TEXTS)), np.bincount(ids))
    small = arrays.ChunkEncoder(path, held=20)  # chunks are dropped and come back
    for _ in range(2):
        assert [small.encode(arrow([t]))[0].tolist() for t in TEXTS] == [plain.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_slices_keep_every_row():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([arrow(TEXTS)], ["text"])
    parts = list(arrays.slices([batch], limit=100))
    assert len(parts) > 3 and sum((p.column(0).to_pylist() for p in parts), []) == TEXTS


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    plain = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.token_counts(docs(spark), path, limit=50)
    want = sorted(((i, len((t or "").encode()), (n := len(plain.encode(t or ""))), n > 50) for i, t in AWKWARD), key=repr)
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.Counter(path).count(arrow(SPECIAL)).tolist() == [len(plain.encode(t)) for t in SPECIAL]
    assert token_counts.token_counts(docs(spark, []), path).count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(3)
    ids = rng.zipf(1.3, 300_000).clip(max=50_000).astype(np.uint32)
    table = rans.Table(rans.frequencies(np.bincount(ids, minlength=50_257)))
    assert int(table.freq.sum()) == rans.TOTAL
    for n in (0, 1, 63, 64, 1000, rans.LANES * rans.MARK_STEPS, rans.LANES * rans.MARK_STEPS + 1, len(ids)):
        assert np.array_equal(rans.decode(rans.encode(ids[:n], table), table), ids[:n])
    one = rans.Table(rans.frequencies(np.array([0, 9])))
    assert rans.decode(rans.encode(np.ones(500, np.uint32), one), one).tolist() == [1] * 500
    payload = bytearray(rans.encode(ids[:1000], table))
    payload[200] ^= 1
    with pytest.raises(ValueError):
        rans.decode(bytes(payload), table)


def test_every_symbol_gets_a_place():
    counts = np.ones(50_257, np.int64)
    counts[7] = 10**12
    freq = rans.frequencies(counts)
    assert int(freq.sum()) == rans.TOTAL and freq.min() == 1


def test_files_hold_the_ids_in_order(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    got = sorted(rans.round_trip(docs(spark), path, end_id=0).collect(), key=lambda r: r["start"])
    order = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (doc_id, text) in zip(got, order, strict=True):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert rans.round_trip(docs(spark, []), path).count() == 0


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 1025, 400)
    bins, offsets = packing.first_fit_decreasing(lengths, 2048)
    used: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        at = next((b for b, n in enumerate(used) if n + lengths[i] <= 2048), len(used))
        used += [0] * (at == len(used))
        assert (bins[i], offsets[i]) == (at, used[at])
        used[at] += lengths[i]
    assert len(used) * 2048 <= lengths.sum() * 1.02


def test_pieces_cover_every_document_and_fill_sequences(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    got = packing.pack(docs(spark), path, end_id=1, room=256, largest=128, group_pieces=40).collect()
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    want = defaultdict(int)
    for doc_id, text in AWKWARD:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        for start, n in packing.cut(len(ids), 256, 128):
            want[doc_id, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes()), len(ids)] += 1
    have = defaultdict(int)
    for r in got:
        have[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
    assert have == want
    assert packing.pack(docs(spark, []), path).count() == 0
