"""Phrases whose words come together more often than chance, by marginalising the longest windows.

Each word begins one window: up to ``longest`` words of its piece, the rest padded.  Only these
windows are counted; ROLLUP over their columns then sums them to every shorter prefix, and since
each occurrence of a phrase begins exactly one window, the prefix sums are the counts of all phrases.

A phrase of at least ``min_count`` occurrences has no rarer pair of neighbours in it.  Pairs are
therefore counted first, as 64-bit hashes, and a window ends before the first pair that is too rare:
nothing that could still be reported is lost, and what a hash collision lets through falls out with
the exact counts.  The frequent hashes go to every task while they are at most ``HELD_PAIRS``;
beyond that windows keep their full length and meet the frequent pairs in a join.

Letters A-Z are folded; a piece ends at ``. , ; : ! ?`` or a line end; words are what blanks and tabs
part.  A null text is empty, a null language is ``und``; repeated rows count each time; an empty table
gives no phrase.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.arrays import ArrowJob, binaries, distinct, gather, listed, slices, tidy, utf8
from ticketloom.llm.tables import materialize, small_batches

LONGEST = 5
MIN_COUNT = 100
HELD_PAIRS = 1 << 22  # 8 bytes each
SLICE = 2 << 20

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
KIND = np.zeros(256, np.uint8)  # 1 parts words, 2 parts pieces
KIND[[9, 32]] = 1
KIND[[*b".,;:!?", *range(10, 14)]] = 2
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


class Words:
    """The words of a run of rows: their codes, values and hashes, and which are followed by another in their piece."""

    def __init__(self, rows: pa.RecordBatch):
        data, offsets = utf8(rows.column("text"))
        kind = KIND[data]
        ends_text = np.zeros(len(data) + 1, bool)
        ends_text[offsets] = True
        in_word = kind == 0
        begins = np.flatnonzero(in_word & np.concatenate(([True], ~in_word[:-1] | ends_text[1:-1])))
        stops = np.flatnonzero(in_word & np.concatenate((~in_word[1:] | ends_text[1:-1], [True]))) + 1 if len(data) else begins
        lengths = stops - begins
        self.codes, self.values = distinct(binaries(FOLD[gather(data, begins, lengths)], np.concatenate(([0], np.cumsum(lengths)))))
        self.codes = self.codes.astype(np.int64)
        piece = np.cumsum(kind == 2)[begins] if len(begins) else begins
        row = np.searchsorted(offsets, begins, side="right") - 1
        self.followed = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
        langs = rows.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]

    def pair_hashes(self) -> np.ndarray:
        """For each followed word the hash of its language, itself and the next word."""
        words = np.array([xxhash.xxh3_64_intdigest(w) for w in listed(self.values)], np.uint64)
        langs = np.array([xxhash.xxh3_64_intdigest(x, seed=1) for x in self.langs], np.uint64)
        at = np.flatnonzero(self.followed)
        h = (words[self.codes[at]] ^ langs[self.lang[at]]) * MIX[0]
        h = (h ^ (h >> np.uint64(29))) + words[self.codes[at + 1]]
        h *= MIX[1]
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _count_job() -> ArrowJob:
    """(lang, word, null, n), (lang, "", null, all words) and ("", null, pair, n) of each slice."""

    def run(batches):
        for rows in slices(batches, limit=SLICE):
            w = Words(rows)
            if not len(w.codes):
                continue
            size = len(w.values)
            word, n = _counted(w.lang * size + w.codes)
            lang, total = _counted(w.lang)
            pair, times = _counted(w.pair_hashes())
            named = pa.array(w.langs, pa.string())
            k, rest = len(word) + len(lang), len(pair)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([named.take(pa.array(np.concatenate((word // size, lang)))), pa.array([""] * rest, pa.string())]),
                    pa.concat_arrays([w.values.cast(pa.large_string()).take(pa.array(word % size)).cast(pa.string()), pa.array([""] * len(lang), pa.string()), pa.nulls(rest, pa.string())]),
                    pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(pair)]),
                    pa.array(np.concatenate((n, total, times)).astype(np.int64)),
                ],
                ["lang", "word", "pair", "n"],
            )

    return run


def _window_job(longest: int, frequent: np.ndarray | None) -> ArrowJob:
    """The windows of two words or more of each slice and how often they occur, with the hash of their first pair.

    With ``frequent``, ascending hashes, a window ends before the first pair not among them.
    """

    def run(batches):
        for rows in slices(batches, limit=SLICE):
            w = Words(rows)
            if not w.followed.any():
                continue
            hashes = np.zeros(len(w.followed), np.int64)
            hashes[w.followed] = w.pair_hashes()
            goes_on = w.followed
            if frequent is not None:
                at = np.searchsorted(frequent, hashes)
                goes_on = goes_on & (at < len(frequent))
                goes_on[goes_on] = frequent[at[goes_on]] == hashes[goes_on]
            goes_on = np.concatenate((goes_on, np.zeros(longest, bool)))
            begins = np.flatnonzero(goes_on)
            if not len(begins):
                continue
            size = len(w.values) + 1  # code 0 pads
            codes = np.concatenate((w.codes + 1, np.zeros(longest, np.int64)))
            columns, open_ = [codes[begins]], np.ones(len(begins), bool)
            _, group = np.unique(w.lang[begins] * size + columns[0], return_inverse=True)
            for k in range(1, longest):
                open_ &= goes_on[begins + k - 1]
                columns.append(np.where(open_, codes[begins + k], 0))
                _, first, group, n = np.unique(group * size + columns[k], return_index=True, return_inverse=True, return_counts=True)
            values = pa.concat_arrays([pa.array([""], pa.string()), w.values.cast(pa.large_string()).cast(pa.string())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(w.langs, pa.string()).take(pa.array(w.lang[begins[first]]))]
                + [values.take(pa.array(c[first])) for c in columns]
                + [pa.array(hashes[begins[first]]), pa.array(n.astype(np.int64))],
                ["lang", *[f"w{k + 1}" for k in range(longest)], "pair", "n"],
            )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def phrase_counts(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, held_pairs: int = HELD_PAIRS) -> tuple[DataFrame, DataFrame]:
    """``lang, words, n`` of all phrases of 1 to ``longest`` words with ``min_count`` occurrences or more, and ``lang, n`` of all words."""
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    spark, held = docs.sparkSession, _texts(docs)
    seen = held.mapInArrow(tidy(_count_job()), "lang string, word string, pair long, n long")
    # One shuffle counts words and pairs; rare ones go at once, so the written table is small.
    seen = seen.groupBy("lang", "word", "pair").agg(F.sum("n").alias("n")).where((F.col("n") >= min_count) | (F.col("word") == ""))
    seen = materialize(seen, "words-and-pairs")
    pairs = seen.where("pair IS NOT NULL").select("pair")
    columns = [f"w{k + 1}" for k in range(longest)]
    schema = ", ".join(["lang string", *[f"{c} string" for c in columns], "pair long", "n long"])
    frequent = pairs.limit(held_pairs + 1).toArrow().column("pair").to_numpy()
    fits = len(frequent) <= held_pairs
    windows = held.mapInArrow(tidy(_window_job(longest, np.sort(frequent) if fits else None)), schema)
    windows = windows.groupBy("pair", "lang", *columns).agg(F.sum("n").alias("n"))  # the pair follows from the rest
    if not fits:
        windows = windows.join(pairs, "pair", "left_semi")
    sums = windows.rollup("lang", *columns).agg(F.sum("n").alias("n"), F.grouping_id().alias("_rolled"))
    words, found = F.array(*columns), F.lit(None).cast("array<string>")
    for k in range(2, longest + 1):  # a prefix of k words leaves longest - k columns rolled up, and has no padding in it
        found = F.when((F.col("_rolled") == (1 << (longest - k)) - 1) & (F.col(f"w{k}") != ""), F.slice(words, 1, k)).otherwise(found)
    phrases = sums.where(F.col("n") >= min_count).select("lang", found.alias("words"), "n").where("words IS NOT NULL")
    single = seen.where("word <> ''").select("lang", F.array("word").alias("words"), "n")
    return materialize(single.unionByName(phrases), "phrases"), seen.where("word = ''").select("lang", "n")


def _cut_score(a: Column, n: Column, l: Column, r: Column) -> Column:
    """floor(1000 a n / (l r)) on whole numbers of up to 38 digits."""
    whole = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * a.cast("decimal(15,0)") * whole(n), whole(l) * whole(r))


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, keep: int = 2000, held_pairs: int = HELD_PAIRS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``keep`` best phrases.

    The cut after k words that scores least counts, of equals the first.  A phrase that lies inside
    a longer one of the same count is left out.
    """
    counted, totals = phrase_counts(docs, longest, min_count, held_pairs)
    many = counted.where(F.size("words") > 1)
    part = lambda words: F.concat_ws(" ", words)
    cuts = many.select("lang", part("words").alias("phrase"), F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.slice("words", F.lit(1), F.col("k"))).alias("first"), part(F.slice("words", F.col("k") + 1, F.size("words"))).alias("rest"))
    known = counted.select("lang", part("words").alias("part"), F.col("n").alias("times"))
    left = known.select("lang", F.col("part").alias("first"), F.col("times").alias("l"))
    right = known.select("lang", F.col("part").alias("rest"), F.col("times").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    best = F.min(F.struct(_cut_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("best")
    scored = scored.groupBy("lang", "phrase", "a", "n").agg(best)
    inner = many.where(F.size("words") > 2).select("lang", "n", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size"))
    inner = inner.select("lang", "n", "words", "size", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("at"))
    inner = inner.select("lang", part(F.slice("words", F.col("at"), F.col("size"))).alias("phrase"), F.col("n").alias("a")).distinct()
    free = scored.join(inner, ["lang", "phrase", "a"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))
