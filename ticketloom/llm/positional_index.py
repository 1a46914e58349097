"""A positional inverted index in blocks of documents, asked for phrases and for near terms.

A block's row holds its documents' ids and word counts, its distinct terms and, term by term, the
ascending places of each: ``BLOCK`` names the columns.  Places count the words of the block's
documents in turn, with one place left free behind each document, so no run of places reaches into
the next document.  Blocks are independent: an executor that is lost costs the blocks it held.

A phrase is found from its rarest term in the block: that term's places, moved back by its offset
in the phrase, are met with the other terms' moved places, rarest first, until none are left or all
terms agree.  Phrases of a block are worked on together, in runs of bounded size.

Words: A-Z in lower case, digits and everything beyond ASCII; null and empty texts have none.  Rows
may repeat; each has a row of its own in every result.  A benchmark row without words asks nothing;
one without an id marks words as hit but is not listed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.arrays import binaries, distinct, gather, slices, tidy, utf8
from ticketloom.llm.tables import materialize, short_batches, texts, without_ids

BLOCK = "block long, doc_ids array<long>, n_words array<long>, terms array<binary>, counts binary, places binary"
FOUND = "block long, nth int, spans array<struct<begin:long,end:long>>, items array<long>"
WORD = np.ones(256, bool)
WORD[:0x30] = WORD[0x3A:0x61] = WORD[0x7B:0x80] = False
BLOCK_BYTES = 1 << 20  # of text in one block, whose row is about as large
GROUP_ROWS = 8  # blocks in a Parquet row group: a reader and a writer hold a whole one
RUN = 1 << 19  # candidate places worked on at once
ITEM_BYTES = 8 << 20  # of benchmark text asked in one pass


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a string column and how many each text has."""
    data, offsets = utf8(column)
    data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
    inside = np.concatenate((WORD[data], [False]))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][inside[offsets[:-1]]]
    first[heads] = True
    starts = np.flatnonzero(first)
    # The bytes of words alone, one word after the other.
    kept = np.cumsum(inside)
    ends = np.concatenate((kept[starts] - 1, [kept[-1]])) if len(starts) else np.zeros(1, np.int64)
    return binaries(data[inside[:-1]], ends), np.diff(np.searchsorted(starts, offsets))


def _index_job(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for rows in slices(batches, limit=limit):
            words, n_words = words_of(rows.column("text"))
            codes, terms = distinct(words)
            # One free place behind each document.
            places = np.arange(len(codes)) + np.repeat(np.arange(len(n_words)), n_words)
            order = np.argsort(codes, kind="stable")
            counts = np.bincount(codes, minlength=len(terms)) if len(codes) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([n_words.tolist()], pa.list_(pa.int64())),
                 pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms.cast(pa.binary())),
                 pa.array([counts.astype("<u4").tobytes()], pa.binary()), pa.array([places[order].astype("<u4").tobytes()], pa.binary())],
                ["block", "doc_ids", "n_words", "terms", "counts", "places"],
            )
            block += 1

    return run


def build_index(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index of every word of all documents, written to the shared folder; no shuffle.

    Spark hands over whole row groups, and batches of so many rows that blocks would make them as
    large as a task's input: both are kept to some blocks.
    """
    short_batches(docs.sparkSession)
    blocks = texts(docs).mapInArrow(tidy(_index_job(block_bytes)), BLOCK)
    return materialize(blocks, "positions", **{"parquet.block.row.count.limit": GROUP_ROWS})


class Phrases:
    """Phrases to ask: vocabulary codes in a matrix, padded with -1, and the items they come from."""

    def __init__(self, items: pa.Table, window: int):
        words, n_words = words_of(items.column("text").combine_chunks() if items.num_rows else pa.array([], pa.string()))
        codes, vocabulary = distinct(words)
        self.vocabulary, self.window = vocabulary, window
        begins = np.cumsum(n_words) - n_words
        asked: dict[bytes, list[int]] = {}
        rows = []
        for item, begin, n in zip(items.column("item_id").to_pylist(), begins.tolist(), n_words.tolist(), strict=True):
            for at in range(begin, begin + max(n - window, 0) + 1 if n else begin):
                code = codes[at : at + min(window, n)]
                key = code.tobytes()
                if key not in asked:
                    asked[key] = []
                    rows.append(np.pad(code, (0, window - len(code)), constant_values=-1))
                if item is not None:
                    asked[key].append(item)
        self.codes = np.array(rows, np.int64).reshape(len(rows), window)
        self.lengths = (self.codes >= 0).sum(1)
        self.items = [sorted(set(v)) for v in asked.values()]


class BlockPostings:
    """One block's posting lists, by the codes of a set of phrases."""

    def __init__(self, row: dict, vocabulary: pa.Array):
        self.places = np.frombuffer(row["places"], "<u4").astype(np.int64)
        counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        at = pc.index_in(row["terms"].cast(vocabulary.type), value_set=vocabulary)
        known = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
        code = pc.drop_null(at).to_numpy()
        begins = np.cumsum(counts) - counts
        self.count = np.zeros(len(vocabulary) + 1, np.int64)  # the last stands for padding
        self.begin, self.term = np.zeros_like(self.count), np.zeros_like(self.count)
        self.count[code], self.begin[code], self.term[code] = counts[known], begins[known], known
        # Ascending by term and place: one search answers for many (term, place).
        self.keys = (np.repeat(np.arange(len(counts)), counts) << 32) | self.places

    def holds(self, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        want = (self.term[codes] << 32) | places
        at = np.searchsorted(self.keys, want)
        return (places >= 0) & (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == want)


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring rows whose sizes add up to ``RUN`` or a little more."""
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + RUN, side="right")))
        yield begin, end
        begin = end


def find_phrases(block: BlockPostings, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, place of its first word) of every occurrence in the block."""
    none = np.zeros(0, np.int64)
    if not len(phrases.codes) or not len(block.keys):
        return none, none
    counts = block.count[phrases.codes]
    padding = phrases.codes < 0
    open_ = np.flatnonzero(((counts > 0) | padding).all(1))
    counts = np.where(padding, np.iinfo(np.int64).max, counts)[open_]
    order = np.argsort(counts, axis=1, kind="stable")
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rarest = counts[np.arange(len(open_)), order[:, 0]] if len(open_) else none
    for a, b in _runs(rarest):
        rows, turn = open_[a:b], order[a:b]
        code = phrases.codes[rows, turn[:, 0]]
        start = gather(block.places, block.begin[code], rarest[a:b]) - np.repeat(turn[:, 0], rarest[a:b])
        nth = np.repeat(np.arange(b - a), rarest[a:b])
        keep = start >= 0
        start, nth = start[keep], nth[keep]
        for k in range(1, phrases.window):
            offset = turn[nth, k]
            code = phrases.codes[rows[nth], offset]
            keep = (code < 0) | block.holds(code, start + offset)
            start, nth = start[keep], nth[keep]
        found.append((rows[nth], start))
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (none, none)


def find_near(block: BlockPostings, phrases: Phrases, terms: int, slop: int, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, first, last place) where its rarest ``terms`` distinct terms lie within ``slop`` words of the rarest one.

    ``base`` is the place of each document's first word; only postings of the same document count as near.
    """
    out: list[tuple[int, int, int]] = []
    for p, row in enumerate(phrases.codes):
        codes = np.unique(row[row >= 0])
        codes = codes[np.argsort(block.count[codes], kind="stable")][:terms]
        if not len(codes) or not block.count[codes].all():
            continue
        lists = [block.places[block.begin[c] : block.begin[c] + block.count[c]] for c in codes]
        low = high = lists[0]
        doc = np.searchsorted(base, lists[0], side="right")
        begin, end = base[doc - 1], np.append(base, 1 << 40)[doc]
        keep = np.ones(len(low), bool)
        for other in lists[1:]:
            at = np.searchsorted(other, lists[0])
            before = other[np.maximum(at - 1, 0)]
            after = other[np.minimum(at, len(other) - 1)]
            left = np.where((at > 0) & (before >= begin), lists[0] - before, 1 << 40)
            right = np.where((at < len(other)) & (after < end), after - lists[0], 1 << 40)
            nearest = np.where(left <= right, before, after)
            keep &= np.minimum(left, right) <= slop
            low, high = np.minimum(low, nearest), np.maximum(high, nearest)
        out += [(p, a, b) for a, b in zip(low[keep].tolist(), high[keep].tolist(), strict=True)]
    found = np.array(out, np.int64).reshape(len(out), 3)
    return found[:, 0], found[:, 1], found[:, 2]


def _ask_job(phrases: Phrases, near: tuple[int, int] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in ("block", "n_words", "counts", "places")}
                block = BlockPostings(row | {"terms": batch.column("terms")[r].values}, phrases.vocabulary)
                n_words = np.array(row["n_words"], np.int64)
                base = np.cumsum(n_words + 1) - (n_words + 1)
                if near:
                    which, begin, last = find_near(block, phrases, *near, base)
                    end = last + 1
                else:
                    which, begin = find_phrases(block, phrases)
                    end = begin + phrases.lengths[which]
                doc = np.searchsorted(base, begin, side="right") - 1
                inside = end <= base[doc] + n_words[doc] if len(doc) else np.zeros(0, bool)
                which, begin, end, doc = which[inside], begin[inside], end[inside], doc[inside]
                order = np.lexsort((begin, doc))
                which, begin, end, doc = which[order], begin[order] - base[doc[order]], end[order] - base[doc[order]], doc[order]
                heads = np.flatnonzero(np.diff(doc, prepend=-1))
                cols: list[list] = [[], [], [], []]
                for a, b in zip(heads, np.append(heads, len(doc))[1:], strict=True):
                    spans: list[dict] = []
                    for x, y in zip(begin[a:b].tolist(), end[a:b].tolist(), strict=True):
                        if spans and x <= spans[-1]["end"]:
                            spans[-1]["end"] = max(y, spans[-1]["end"])
                        else:
                            spans.append({"begin": x, "end": y})
                    items = sorted({i for p in np.unique(which[a:b]).tolist() for i in phrases.items[p]})
                    for c, v in zip(cols, (row["block"], int(doc[a]), spans, items), strict=True):
                        c.append(v)
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["block", "nth", "spans", "items"])

    return run


def matches(index: DataFrame, benchmark: DataFrame, window: int = 10, near: tuple[int, int] | None = None, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``block, nth, spans, items`` for each document with an occurrence; ``spans`` are word ranges.

    Without ``near``: runs of ``window`` words of an item (all its words, if fewer).  With
    ``near = (terms, slop)``: the rarest terms of such a run close together.  The benchmark is asked
    in passes of about ``item_bytes`` of text, each of which reaches the driver and all tasks.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(2 * size / item_bytes)) if size > item_bytes else 1
    found = None
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k) if passes > 1 else items
        one = index.mapInArrow(tidy(_ask_job(Phrases(part.toArrow(), window), near)), FOUND)
        found = one if found is None else found.unionByName(one)
    return found.groupBy("block", "nth").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document.

    ``n_hit`` counts the words inside any occurrence; ``items_sha256`` is over the ids of the items
    that occur, sorted as strings and joined by commas.
    """
    index = build_index(docs)
    found = matches(index, benchmark, window)
    every = index.select("block", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("nth", "d")).select("block", "nth", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").alias("n_words"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    covered = F.aggregate(
        F.array_sort("spans"), start,
        lambda acc, s: F.struct((acc.n + F.greatest(F.lit(0), s.end - F.greatest(s.begin, acc.upto))).alias("n"), F.greatest(acc.upto, s.end).alias("upto")),
        lambda acc: acc.n,
    )
    listed = F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<long>")), lambda i: i.cast("string")))
    n_hit = F.coalesce(F.when(F.col("spans").isNotNull(), covered), F.lit(0))
    return every.join(found, ["block", "nth"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` that hold no run of ``window`` benchmark words, all columns kept.

    Every row of a contaminated id goes; among rows without an id, all go if one is contaminated.
    """
    index = build_index(docs)
    hit = index.select("block", F.posexplode("doc_ids").alias("nth", "doc_id")).join(matches(index, benchmark, window).select("block", "nth"), ["block", "nth"], "left_semi")
    return without_ids(docs, hit)
