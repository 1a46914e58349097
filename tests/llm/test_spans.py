"""Repeated sentence spans against a plain loop."""

from ticketloom.llm import sentence_spans as S

from .helpers import AWKWARD, docs, prose, rows


def _plain(table):
    seen, out = {}, []
    for i, text in sorted(table, key=lambda r: (r[0] is not None, r[0] or 0)):
        held = S.sentences(text or "")
        words = [s.lower().split() for s in held]
        bad = set()
        for k in range(len(held) - 2):
            key = tuple(w for s in words[k : k + 3] for w in s)
            if len(key) >= 8:
                if key in seen:
                    bad |= {k, k + 1, k + 2}
                seen[key] = True
        out.append((i, len(held), len(bad), "".join(s for k, s in enumerate(held) if k not in bad)))
    return sorted(out, key=repr)


def test_sentences_join_to_the_text():
    for _, text in AWKWARD:
        assert "".join(S.sentences(text or "")) == (text or "")
    assert S.sentences("One two. Three!  Four\nfive") == ["One two. ", "Three!  ", "Four\n", "five"]


def test_repeats_equal_a_plain_loop(spark):
    passage = ". ".join(prose(900 + k, 9).replace(".", "") for k in range(6)) + ". "
    table = [(i, t) for i, t in AWKWARD if i is not None and (i, t) != (9, AWKWARD[8][1]) and i != 10]
    table += [(100 + k, prose(50 + k, 30) + "\n" + (passage.upper() if k % 2 else passage) + prose(80 + k, 30)) for k in range(12)]
    assert rows(S.without_repeats(docs(spark, table)), "doc_id", "n_sentences", "n_removed", "text") == _plain(table)
    assert S.without_repeats(docs(spark)).count() == len(AWKWARD)
    assert S.without_repeats(docs(spark, [])).count() == 0


def _shared(first, later, n=50):
    """Runs of ``n`` words of the first text that the later one still holds."""
    a, b = first.lower().split(), later.lower().split()
    held = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)}
    return sum(tuple(a[k : k + n]) in held for k in range(len(a) - n + 1))


def _sentences(seed, n, ends):
    """``n`` words that are like no others, with a full stop behind those in ``ends``."""
    return " ".join(f"w{seed}x{k}" + ("." if k in ends else "") for k in range(n))


def test_passages_with_few_sentence_ends_go(spark):
    table, n = [], 0
    for size in (50, 63, 80):
        for ends in range(5):
            for shift in (0, 5):  # with 5 the ends lie anywhere, and no border is that of a sentence
                passage = _sentences(f"p{n}", size, {(k + 1) * size // (ends + 1) - shift for k in range(ends)})
                table += [(2 * n, f"{_sentences(f'a{n}', 40, {9})} {passage} {_sentences(f'b{n}', 40, {20})}"), (2 * n + 1, f"{_sentences(f'c{n}', 40, {20})}\n" * (not shift) + _sentences(f"d{n}", 30, ()) + f" {passage.upper()} {_sentences(f'e{n}', 40, {9})}")]
                n += 1
    got = {r["doc_id"]: r["text"] for r in S.without_repeats(docs(spark, table)).collect()}
    for i, text in table:
        if i % 2 == 0:
            assert got[i] == text
        else:
            assert _shared(dict(table)[i - 1], text) and not _shared(dict(table)[i - 1], got[i]), text
            assert {w for w in text.split() if w[0] in "cde"} <= set(got[i].split())  # nothing else goes


def test_short_copies_and_single_long_sentences_go(spark):
    lone, short = _sentences("s", 25, {24}), "Eight words are enough for a whole text"
    table = [(1, short), (2, short.upper()), (3, f"{_sentences('f', 9, {8})} {lone} {_sentences('g', 9, {8})}"), (4, f"{_sentences('h', 9, {8})} {lone} {_sentences('i', 9, {8})}"), (5, "too short"), (6, "too short")]
    table += [(7, " ".join(["again"] * 60)), (8, f"{short} and more")]
    got = {r["doc_id"]: (r["n_sentences"], r["n_removed"], r["text"]) for r in S.without_repeats(docs(spark, table)).collect()}
    assert got[1][2] == short and got[2] == (1, 1, "")
    assert got[3][2] == table[2][1] and got[4] == (3, 1, f"{_sentences('h', 9, {8})} {_sentences('i', 9, {8})}")
    assert got[5][2] == got[6][2] == "too short" and got[8][2] == f"{short} and more"
    assert len(got[7][2].split()) >= S.WINDOW  # the first occurrence stays whole


def test_row_numbers_hold_when_the_input_is_split_anew(spark, tmp_path, monkeypatch):
    path, key = str(tmp_path / "docs"), "spark.sql.files.maxPartitionBytes"
    table = [(k, f"{_sentences(f'j{k}', 40, {9, 20, 39})} {_sentences('k', 60, {19, 39, 59})}") for k in range(40)]
    docs(spark, table).repartition(4).write.parquet(path)
    before, write = spark.conf.get(key), S.materialize

    def then_split(df, name):
        out = write(df, name)
        if name == "repeated-spans":
            spark.conf.set(key, "2000")
        return out

    monkeypatch.setattr(S, "materialize", then_split)
    try:
        got = {r["doc_id"]: r["text"] for r in S.without_repeats(spark.read.parquet(path)).collect()}
    finally:
        spark.conf.set(key, before)
    assert got == {k: t if k == 0 else _sentences(f"j{k}", 40, {9, 20, 39}) + " " for k, t in table}


def test_long_runs_of_blanks_and_signs(spark):
    words = _sentences("q", 60, {9, 20, 39})
    table = [(1, words), (2, f"{' ' * 200_000}{words}\n{' ' * 200_000}x{'!' * 50_000}y"), (3, words + " " * 200_000)]
    got = {r["doc_id"]: r["text"] for r in S.without_repeats(docs(spark, table)).collect()}
    assert got[1] == words and got[3] == "" and got[2].split() == ["x" + "!" * 50_000 + "y"]


def test_marks_hold_every_key_and_few_others(spark):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    keys = [*rng.integers(-(2**62), 2**62, 3000).tolist(), 0, -1, 32767, 32768, (1 << 26) - 1, 1 << 26]
    from ticketloom.llm import marks as M

    held = M.marks(spark.createDataFrame([(k,) for k in keys], "k long"), "k")
    batch = pa.RecordBatch.from_arrays([pa.array(keys + rng.integers(-(2**62), 2**62, 3000).tolist())], ["k"])
    near = {k % (1 << 26) for k in keys}
    for wanted in (True, False):
        got = next(M.marked_job("k", held, wanted)(iter([batch]))).column("k").to_pylist()
        assert got == [k for k in batch.column("k").to_pylist() if (k % (1 << 26) in near) == wanted]
