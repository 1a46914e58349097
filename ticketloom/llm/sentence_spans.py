"""Substring dedup by sliding sentence spans.

A sentence ends behind ``.``, ``!`` or ``?`` and white space, or at a line feed.  Hashed (case and white
space folded) are every run of ``run`` consecutive sentences with ``min_words`` words or more, every
shorter run with ``WINDOW`` words or more, a whole text of fewer sentences with ``min_words`` words or more,
and, for passages whose borders are not those of sentences, windows of ``WINDOW`` words: of any
``WINDOW + 1`` neighbouring windows the one with the least hash, so that two places which share
``2 * WINDOW`` words share a hashed window.

Spans are joined over all documents.  A sentence that any repeated run but its first occurrence
covers goes, and of the other words that repeated windows cover, stretches of ``min_words`` or more.  The first occurrence has the smallest (doc_id, row, place), so the kept copy is the
same for every span.  Of a shared passage up to ``WINDOW - 1`` words at either border may stay.

A null or empty text has no sentence.  Rows may repeat: all but the first lose their repeated spans.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.arrays import ArrowJob, slices, tidy
from ticketloom.llm.marks import marked_job, marks
from ticketloom.llm.tables import materialize, texts
from ticketloom.scale import hot_keys, salted_join

RUN, MIN_WORDS, WINDOW = 3, 8, 25
# A place is a sentence's or, of a window, a word's number, and above it the sentences in the run, 0 for a window.
KIND = 1 << 28
SPANS = "doc_id long, row long, place int, span long"
WHOLE = 8  # seed of a whole text's hash; a run's is its sentences


def sentences(text: str) -> list[str]:
    """The sentences of a text with the white space behind them; joined they are the text."""
    ends = [m.end() for m in re.finditer(r"(?:[.!?](?=\s)|\n)\s*", text)]
    cuts = [0, *ends] if not ends or ends[-1] < len(text) else [0, *ends[:-1]]
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True) if a < b]


@functools.cache
def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, base, np.uint64))))


def _room(n: int) -> int:
    return 1 << max(10, (n - 1).bit_length())


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE, WORD_BASE = 0xD1342543DE82EF95, 0xA0761D6478BD642F


def _hashes(values: np.ndarray, base: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes, modulo 2 ** 64, of runs of values, mixed."""
    n = _room(len(values) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * _powers(base, n)[: len(values)], dtype=np.uint64)))
    return _mixed((sums[ends] - sums[begins]) * _powers(pow(base, -1, 1 << 64), n)[begins])


def _extreme(values: np.ndarray, size: int, of: np.ufunc) -> np.ndarray:
    """The least or largest of each ``size`` neighbouring values."""
    held = 1
    while 2 * held <= size:
        values = of(values[:-held], values[held:])
        held *= 2
    return of(values[: len(values) - (size - held)], values[size - held :])


def windows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word number and 64-bit hash of the windows chosen among all of ``WINDOW`` words."""
    if len(words) < 2 * WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(" ".join(words).encode(errors="replace"), np.uint8)
    blanks = np.flatnonzero(data == 32)
    each = _hashes(BYTES[data], BASE, np.append(0, blanks + 1), np.append(blanks, len(data)))
    at = np.arange(len(words) - WINDOW + 1)
    found = _hashes(each, WORD_BASE, at, at + WINDOW)
    least = _extreme(found, WINDOW + 1, np.minimum)
    edge = np.zeros(WINDOW, np.uint64)
    chosen = np.flatnonzero(_extreme(np.concatenate((edge, least, edge)), WINDOW + 1, np.maximum) == found)
    return chosen, found[chosen].view(np.int64)


def spans(text: str, run: int = RUN, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """(place, 64-bit hash) of each run of sentences and each chosen window of words."""
    words = [s.lower().split() for s in sentences(text)]
    out = []

    def add(k: int, n: int, least: int, seed: int) -> None:
        if sum(map(len, words[k : k + n])) >= least:
            held = " ".join([w for s in words[k : k + n] for w in s])
            out.append((n * KIND + k, xxhash.xxh3_64_intdigest(held.encode(errors="replace"), seed) - (1 << 63)))

    for n in range(1, run + 1):
        for k in range(len(words) - n + 1):
            add(k, n, min_words if n == run else WINDOW, n)
    if 0 < len(words) < run:
        add(0, len(words), min_words, WHOLE)
    places, found = windows([w for s in words for w in s])
    out.extend(zip(places.tolist(), found.tolist(), strict=True))
    return out


def _words_with_blanks(sentence: str) -> list[str]:
    """The words with the white space behind them, the first also with what is before it; none if there is no word."""
    begins = [m.start() for m in re.finditer(r"\S+", sentence)]
    return [sentence[a:b] for a, b in zip([0, *begins[1:]], [*begins[1:], len(sentence)], strict=True)] if begins else []


def without(text: str, places: list[int], min_words: int = MIN_WORDS) -> tuple[int, int, str]:
    """The number of sentences, that of sentences wholly gone, and the text without the repeated spans."""
    held = sentences(text)
    bad = {p % KIND + j for p in places for j in range(p // KIND)}
    starts = [p for p in places if p < KIND]
    if not starts:
        return len(held), len(bad), "".join(s for k, s in enumerate(held) if k not in bad) if bad else text
    pieces = [_words_with_blanks(s) for s in held]
    owner = np.repeat(np.arange(len(held)), [len(p) for p in pieces])
    gone = np.zeros(len(owner), bool)
    for p in starts:
        gone[p : p + WINDOW] = True
    gone &= ~np.isin(owner, list(bad))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])))).tolist()
    for x, y in zip(edges[::2], edges[1::2], strict=True):
        gone[x:y] = y - x >= min_words
    left = np.bincount(owner[~gone], minlength=len(held))
    bad |= {k for k, n in enumerate(left.tolist()) if pieces[k] and not n}
    first = np.searchsorted(owner, np.arange(len(held))).tolist()
    kept = ["".join(w for j, w in enumerate(ws, first[k]) if not gone[j]) if ws else held[k] for k, ws in enumerate(pieces) if k not in bad]
    return len(held), len(bad), "".join(kept)


def _spans_job(run: int, min_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def job(batches):
        for rows in slices(batches, limit=2 << 20):
            out = [(i, r, k, h) for i, r, t in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "row", "text")), strict=True) for k, h in spans(t, run, min_words)]
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)], ["doc_id", "row", "place", "span"])

    return job


def _drop_job(min_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def job(batches):
        for rows in slices(batches, limit=4 << 20):
            done = [without(t, p or [], min_words) for t, p in zip(rows.column("text").to_pylist(), rows.column("places").to_pylist(), strict=True)]
            columns = [pa.array([d[j] for d in done], k) for j, k in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *columns], ["doc_id", "n_sentences", "n_removed", "text"])

    return job


def without_repeats(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_sentences, n_removed, text`` of every row, the text without its repeated spans.

    Texts are hashed once; the spans are written.  Counting them shuffles their hashes alone.  A bitmap of
    fixed size then drops, before the join, the spans that do not repeat and, at the end, the texts that
    lose nothing; what it lets through by chance falls out in the joins.  A span with many occurrences is
    joined in several tasks.
    """
    # Written once: the two jobs below must see the same row numbers, however the input is split or dealt then.
    rows = materialize(texts(docs).withColumn("row", F.monotonically_increasing_id()), "span-rows")
    every = materialize(rows.mapInArrow(tidy(_spans_job(run, min_words)), SPANS), "spans")
    counted = materialize(every.groupBy("span").agg(F.count("*").alias("n")).where("n > 1"), "span-counts")
    again = materialize(every.mapInArrow(marked_job("span", marks(counted, "span")), SPANS), "again-spans")
    at = F.struct("doc_id", "row", "place")
    first = again.groupBy("span").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").select("span", "first")
    again = salted_join(again, first, "span", hot_keys(counted, "span", "n"), F.col("row"), how="inner").where(~at.eqNullSafe(F.col("first")))
    # A window that overlaps its own first occurrence would cut into the copy that stays.
    again = again.where((F.col("place") >= KIND) | (F.col("row") != F.col("first.row")) | (F.col("place") >= F.col("first.place") + WINDOW))
    places = materialize(again.groupBy("row").agg(F.collect_set("place").alias("places")), "repeated-spans")
    held, whole = marks(places, "row"), "doc_id long, n_sentences long, n_removed long, text string"
    same = rows.mapInArrow(marked_job("row", held, wanted=False), rows.schema).withColumn("places", F.lit(None).cast("array<int>"))
    # A merge join at every size: a broadcast that stops fitting would change the plan as tables grow.
    changed = rows.mapInArrow(marked_job("row", held), rows.schema).join(places.hint("merge"), "row", "left")
    columns = ["doc_id", "text", "places"]
    return same.select(columns).unionByName(changed.select(columns)).mapInArrow(tidy(_drop_job(min_words)), whole)
