"""Periodic runs of words, by internal pattern matching.

A run is a longest stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal)
that is at least ``max(6, 4 q)`` words long.  Documents are worked many at a time, side by side in one array:

1. Prefix doubling sorts the suffixes of every document and names, level by level, all blocks of ``2^k``
   words; a name is where the block's interval of the suffix array begins.  Only suffixes that still share
   a name are sorted on, and only as far as a run of that document could ask.
2. Every aligned block of ``B = 2^k`` words that is not alone in its interval asks a wavelet tree over the
   suffix array for its next occurrences (range successor) at most ``(4 B - 2) / 3`` words away.  A run of period ``q``
   holds, besides its last ``q`` words, ``3 q`` words or more and so an aligned block of the largest ``B``
   with ``2 B - 1 <= 3 q``: the block occurs again ``q`` words on, which is within that window.
3. Occurrences in the window are arithmetic progressions.  If their difference exceeds ``B / 3`` they are three at most,
   and each distance is a candidate period.  Else they come in clusters whose difference ``p`` is the
   block's own period.  A multiple of ``p`` within one cluster is no smallest period; and a run shifts a whole cluster
   onto the next, so ``q`` is the distance of the two first or of the two last places of neighbouring clusters (were
   both cut off by the run's ends, all of it would have period ``p``).
4. Each candidate period of a document is checked word by word, which gives the runs' exact ends; of equal
   stretches the smallest period counts.

Words are split at space and tab to carriage return.  A null text is empty and has no run; rows may
repeat and share ids, each is its own document; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.arrays import ArrowJob, binaries, distinct, gather, slices, tidy, utf8
from ticketloom.llm.tables import texts

EXPONENT = 4
LEAST = 6
SLICE = 2 << 20
CHECKED = 1 << 22  # words compared at a time
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class WaveletTree:
    """Whole numbers in a fixed order: how many of a range are below a bound, and a range's k-th smallest."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate((np.zeros(1, np.int32), np.cumsum(low, dtype=np.int32))))
            values = np.concatenate((values[low], values[~low]))

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each range ``lo:hi`` are less than its bound; bounds of ``2^bits`` and more count all."""
        lo, hi = lo.astype(np.int64), hi.astype(np.int64)
        count, beyond = np.zeros(len(lo), np.int64), np.where(bound >> self.bits > 0, hi - lo, -1)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1), strict=True):
            a, b, total = zeros[lo], zeros[hi], zeros[-1]
            one = (bound >> bit) & 1 == 1
            count += np.where(one, b - a, 0)
            lo, hi = np.where(one, total + lo - a, a), np.where(one, total + hi - b, b)
        return np.where(beyond >= 0, beyond, count)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value of each range, from 0."""
        lo, hi, k = lo.astype(np.int64), hi.astype(np.int64), k.astype(np.int64)
        value = np.zeros(len(lo), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1), strict=True):
            a, b, total = zeros[lo], zeros[hi], zeros[-1]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            value |= one.astype(np.int64) << bit
            lo, hi = np.where(one, total + lo - a, a), np.where(one, total + hi - b, b)
        return value


def _named_blocks(words: np.ndarray, doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array, and for each block length the aligned blocks that occur again: length, place, interval.

    ``doc`` is each word's document, ``begin`` and ``end`` its document's borders.  Suffixes are sorted
    document by document, so an interval lies in one.
    """
    n = len(words)
    # The longest block a document may have to ask with: 2 B - 1 <= 3 q and 4 q <= its words.
    furthest = (3 * (end - begin) // EXPONENT + 1) // 2
    order = np.lexsort((words, doc))
    new = np.concatenate(([True], (words[order[1:]] != words[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])))
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    name = np.empty(n, np.int64)
    name[order] = head
    size = np.bincount(head, minlength=n)
    found, width = [], 1
    within = np.arange(n) - begin
    while True:
        at = np.flatnonzero((size[name[order]] > 1) & (furthest[order] >= 2 * width))
        if not len(at):
            return order, found
        # A group has all its places here or none: it lies in one document.
        suffix = order[at]
        after = suffix + width
        after = np.where(after < end[suffix], name[np.minimum(after, n - 1)], -1)
        key = name[suffix] * (n + 1) + after + 1
        turn = np.argsort(key, kind="stable")
        suffix, key = suffix[turn], key[turn]
        order[at] = suffix
        new = np.concatenate(([True], key[1:] != key[:-1]))
        head = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        name[suffix] = head
        size[at] = 0
        size += np.bincount(head, minlength=n)
        width *= 2
        block = np.sort(suffix[(size[head] > 1) & (within[suffix] % width == 0) & (suffix + width <= end[suffix])])
        if len(block):
            found.append((width, block, name[block], name[block] + size[name[block]]))


def _from_clusters(order: np.ndarray, width: int, block: np.ndarray, lo: np.ndarray, hi: np.ndarray, difference: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For blocks whose own period is short the distances of the first and of the last places of their cluster and the next."""
    n = len(order)
    names, first, which = np.unique(lo, return_index=True, return_inverse=True)
    counts = hi[first] - names
    owner = np.repeat(np.arange(len(names)), counts)
    key = np.sort(owner * n + gather(order, names, counts))
    place, owner = key % n, key // n
    starts = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (np.diff(place) > difference[first][owner[1:]]))))
    stops = np.append(starts[1:], len(key)) - 1
    mine = np.searchsorted(starts, np.searchsorted(key, which * n + block), side="right") - 1
    follows = mine + 1 < len(starts)
    follows[follows] = owner[starts[mine[follows] + 1]] == which[follows]
    mine, block = mine[follows], block[follows]
    gaps = np.concatenate((place[starts[mine + 1]] - place[starts[mine]], place[stops[mine + 1]] - place[stops[mine]]))
    near = (gaps > 0) & (gaps <= (4 * width - 2) // 3)
    return np.concatenate((block, block))[near], gaps[near]


def candidate_periods(words: np.ndarray, doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, period) pairs among which are all of runs."""
    order, levels = _named_blocks(words, doc, begin, end)
    where, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if levels:
        tree = WaveletTree(order - begin[order])  # places within the document; an interval lies in one
    for width, block, lo, hi in levels:
        limit, own = (4 * width - 2) // 3, block - begin[block]
        rank = tree.below(lo, hi, own + 1)
        some = rank < hi - lo
        block, lo, hi, own, rank = block[some], lo[some], hi[some], own[some], rank[some]
        gap = tree.smallest(lo, hi, rank) - own
        some = gap <= limit
        block, lo, hi, own, rank, gap = block[some], lo[some], hi[some], own[some], rank[some], gap[some]
        where.append(block)
        periods.append(gap)
        more = np.flatnonzero(rank + 1 < hi - lo)
        second = np.full(len(block), limit + 1)
        second[more] = tree.smallest(lo[more], hi[more], rank[more] + 1) - own[more]
        difference = np.where(second <= limit, np.minimum(gap, second - gap), gap)
        short = 3 * difference <= width
        if short.any():
            a, b = _from_clusters(order, width, block[short], lo[short], hi[short], difference[short])
            where.append(a)
            periods.append(b)
        wide = ~short & (second <= limit)
        where.append(block[wide])
        periods.append(second[wide])
        third = np.flatnonzero(wide & (rank + 2 < hi - lo))
        last = tree.smallest(lo[third], hi[third], rank[third] + 2) - own[third]
        where.append(block[third][last <= limit])
        periods.append(last[last <= limit])
    both = np.unique(doc[np.concatenate(where)] << 32 | np.concatenate(periods))
    return both >> 32, both & 0xFFFFFFFF


def _stretches(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, owner: np.ndarray, period: np.ndarray) -> np.ndarray:
    """(document, start, length, period) of the longest stretches with these periods that are long enough."""
    out = [np.zeros((0, 4), np.int64)]
    compared = sizes[owner] - period
    done = np.cumsum(compared)
    a = 0
    while a < len(owner):
        b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + CHECKED, side="right")))
        d, q, m = owner[a:b], period[a:b], compared[a:b]
        ends = np.cumsum(m)
        pair = np.repeat(np.arange(b - a), m)
        at = np.arange(int(ends[-1])) + np.repeat(starts[d] - (ends - m), m)
        same = words[at] == words[at + q[pair]]
        border = np.zeros(len(same) + 1, bool)
        border[ends - m] = True
        border[-1] = True
        opens = np.flatnonzero(same & (border[:-1] | np.concatenate(([True], ~same[:-1]))))
        closes = np.flatnonzero(same & (border[1:] | np.concatenate((~same[1:], [True])))) + 1
        pair = pair[opens]
        length = closes - opens + q[pair]
        long = length >= np.maximum(LEAST, EXPONENT * q[pair])
        out.append(np.column_stack((d[pair], opens - (ends - m)[pair], length, q[pair]))[long])
        a = b
    return np.concatenate(out)


def runs(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(document, start, length, period) of all runs, by document, start and period; document ``d`` has the words ``offsets[d]:offsets[d + 1]``."""
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    if not len(doc):
        return np.zeros((0, 4), np.int64)
    found = _stretches(words, offsets[:-1], sizes, *candidate_periods(words, doc, offsets[:-1][doc], offsets[1:][doc]))
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    first = np.concatenate(([True], (found[1:, :3] != found[:-1, :3]).any(axis=1)))[: len(found)]
    found = found[first]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _split(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, where words begin and end, and each text's first word."""
    data, offsets = utf8(column)
    solid = ~BLANK[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(solid & (border[:-1] | np.concatenate(([True], ~solid[:-1]))[: len(data)]))
    stops = np.flatnonzero(solid & (border[1:] | np.concatenate((~solid[1:], [True]))[: len(data)])) + 1
    return data, starts, stops, np.searchsorted(starts, offsets)


def _joined(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, keep: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    begins = np.concatenate(([0], np.cumsum(keep)))[offsets]
    starts, lengths = starts[keep], (stops - starts)[keep]
    room = lengths + 1
    last = begins[1:][np.diff(begins) > 0] - 1
    room[last] -= 1
    ends = np.concatenate(([0], np.cumsum(room)))
    out = np.full(int(ends[-1]), 32, np.uint8)
    out[np.arange(int(lengths.sum())) + np.repeat(ends[:-1] - (np.cumsum(lengths) - lengths), lengths)] = gather(data, starts, lengths)
    return binaries(out, ends[begins]).cast(pa.large_string()).cast(pa.string())


def _runs_job() -> ArrowJob:
    def run(batches):
        for rows in slices(batches, limit=SLICE):
            data, starts, stops, offsets = _split(rows.column("text"))
            lengths = stops - starts
            codes, _ = distinct(binaries(gather(data, starts, lengths), np.concatenate(([0], np.cumsum(lengths)))))
            found = runs(codes.astype(np.int64), offsets)
            doc, start, length, period = found.T
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, offsets[doc] + start + period, 1)
            np.add.at(change, offsets[doc] + start + length, -1)
            collapsed = _joined(data, starts, stops, np.cumsum(change)[:-1] == 0, offsets)
            held = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
            listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(rows.num_rows + 1)), pa.int32()), held)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), listed, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    ``runs`` lists start (word number from 0), length and period, by start and period; ``collapsed`` is the text's words
    without those that a run repeats: what it holds after its first period.
    """
    return texts(docs).mapInArrow(tidy(_runs_job()), RUNS)


def periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where one text in ten repeats itself from some word on.

    With ``h`` the crc32 of the id as text, ``g = h / 10`` and ``n`` words: if ``h % 10 = 0`` and ``n > 0``, the words from
    ``a = g % n`` on become the ``p = 1 + (n - a) / (3 + g % 8)`` words there, over and over.  A null id leaves its text alone.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = texts(docs).withColumn("_g", F.when(h % 10 == 0, F.floor(h / 10)))
    split = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # A generator keeps the split apart, so that no later expression repeats it for each word.
    chosen = chosen.select("doc_id", "text", "_g", F.explode(F.array(F.when(F.col("_g").isNotNull(), split))).alias("_w"))
    chosen = chosen.withColumn("_a", F.when(F.size("_w") > 0, F.col("_g") % F.size("_w")))
    chosen = chosen.withColumn("_p", 1 + F.floor((F.size("_w") - F.col("_a")) / (3 + F.col("_g") % 8)))
    at = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p")))
    tail = F.array_join(F.transform(F.sequence(F.lit(0), F.size("_w") - 1), lambda i: F.get("_w", at(i).cast("int"))), " ")
    return chosen.select("doc_id", F.when(F.col("_a").isNotNull(), tail).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256`` of what :func:`find_runs` gives.

    The run shown has the greatest length / period, of equals the first.
    """
    more = lambda best, r: F.when(best["start"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(F.transform("runs", line), "\n"), F.lit("\n"))).otherwise("")
    shown = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.aggregate("runs", none, more).alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    return shown.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli, "runs_sha256", "collapsed_sha256")
