"""Token counts by rank-synchronous merging of ragged arrays.

All distinct pre-tokens of a run of texts lie in one array of symbols.  Each round finds every
pre-token's lowest-ranked pair of neighbours, merges the leftmost such pair of each pre-token at
once and packs the arrays again; pre-tokens without a pair that merges leave.  What survives is counted.

The vocabulary is a byte-pair model of sentencepiece with byte fallback.  No piece of it has a
space mark behind another character, so no merge reaches across the start of a run of spaces, and
the counts of the pre-tokens add up to the count of the text.

Null and empty texts have no bytes and no tokens; each row gives one row, whatever repeats.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.arrays import binaries, chunk_cuts, distinct, listed, slices, utf8
from ticketloom.llm.tables import texts

NEVER = np.int64(1) << 40
LONG = 512  # symbols; a longer pre-token is merged by a queue, since rounds would cost its square


class PairRanks:
    """Pieces of the vocabulary as numbers, and which two make which third.

    Symbols are piece ids; a character without a piece is ``-1 - k`` where ``k`` is its count of bytes.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError(f"{path} is no byte-pair model with byte fallback, a space in front and texts left as they are")
        pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == p.Type.Value("NORMAL")}
        if any(p.type in (p.Type.Value("USER_DEFINED"), p.Type.Value("UNUSED")) for p in proto.pieces) or any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path} has pieces that may join words")
        self.letters = {p: i for p, i in pieces.items() if len(p) == 1}
        # The best score goes first; equal scores are one rank, and the leftmost pair wins.
        scores = np.array([p.score for p in proto.pieces])
        self.rank = np.searchsorted(np.unique(-scores), -scores).astype(np.int64)
        size = len(proto.pieces)
        pairs = {}
        for piece, made in pieces.items():
            for cut in range(1, len(piece)):
                a, b = pieces.get(piece[:cut]), pieces.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * size + b] = made
        self.size = size
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys], np.int64)
        # Left pieces index their run of keys, so a look-up is a short search.
        self.pairs = pairs
        self.slots = 1 << 22
        self.table = np.full(self.slots, -1, np.int64)
        self._fill()
        self.alphabet = np.zeros(0x110000, np.int32)
        code = np.arange(0x110000)
        self.alphabet[:] = -1 - (1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
        for letter, i in self.letters.items():
            self.alphabet[ord(letter)] = i
        self.alphabet[32] = self.alphabet[0x2581]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * 0x9E3779B1) >> 13) & (self.slots - 1)

    def _fill(self) -> None:
        """Open addressing: each round seats the keys whose slot is still free."""
        left, probe = np.arange(len(self.keys)), 0
        while len(left):
            slot = (self._slot(self.keys[left]) + probe) & (self.slots - 1)
            free = self.table[slot] < 0
            first = np.zeros(len(left), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            seat = free & first
            self.table[slot[seat]] = left[seat]
            left, probe = left[~seat], probe + 1
        self.probes = probe

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, -1 for none."""
        keys = np.where((a >= 0) & (b >= 0), a * self.size + b, -1)
        out, open_, probe = np.full(len(keys), -1, np.int64), np.flatnonzero(keys >= 0), 0
        while len(open_) and probe < self.probes:
            seat = self.table[(self._slot(keys[open_]) + probe) & (self.slots - 1)]
            found = (seat >= 0) & (self.keys[seat] == keys[open_])
            out[open_[found]] = self.made[seat[found]]
            open_, probe = open_[(seat >= 0) & ~found], probe + 1
        return out


def _by_queue(symbols: list[int], ranks: PairRanks) -> int:
    """Survivors of one long sequence: a queue of pairs by rank and place, n log n."""
    n = len(symbols)
    left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
    queue: list[tuple[int, int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        a, b = symbols[i], symbols[j]
        made = ranks.pairs.get(a * ranks.size + b, -1) if a >= 0 and b >= 0 else -1
        if made >= 0:
            heapq.heappush(queue, (int(ranks.rank[made]), i, j, a, b))

    for i in range(n - 1):
        offer(i, i + 1)
    while queue:
        _, i, j, a, b = heapq.heappop(queue)
        if not (alive[i] and alive[j] and right[i] == j and symbols[i] == a and symbols[j] == b):
            continue
        symbols[i], alive[j], right[i] = ranks.pairs[a * ranks.size + b], False, right[j]
        if right[j] >= 0:
            left[right[j]] = i
            offer(i, right[j])
        if left[i] >= 0:
            offer(left[i], i)
    return sum(1 if s >= 0 else -1 - s for s, on in zip(symbols, alive, strict=True) if on)


def count_survivors(words: list[str], ranks: PairRanks) -> np.ndarray:
    """Tokens of each pre-token."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = ranks.alphabet[codes].astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    out = np.zeros(len(words), np.int64)
    for w in np.flatnonzero(lengths > LONG):
        out[w] = _by_queue(symbols[starts[w] : starts[w] + lengths[w]].tolist(), ranks)
    owner = np.repeat(np.arange(len(words)), lengths)
    keep = (lengths <= LONG)[owner]
    symbols, owner = symbols[keep], owner[keep]
    # The pair that begins at each symbol; a sequence's last symbol begins none.
    made = np.full(len(symbols), -1, np.int64)
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    made[inner] = ranks.merged(symbols[inner], symbols[inner + 1])
    while len(symbols):
        cost = np.where(made >= 0, ranks.rank[made], NEVER)
        heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        sizes = np.diff(np.concatenate((heads, [len(symbols)])))
        least = np.minimum.reduceat(cost, heads)
        going = least < NEVER
        # Sequences without a pair left are done: their symbols are tokens.
        done = np.repeat(~going, sizes)
        ended = symbols[done]
        np.add.at(out, owner[done], np.where(ended >= 0, 1, -1 - ended))
        if not going.any():
            break
        hits = np.flatnonzero((cost == np.repeat(least, sizes)) & ~done)
        first = hits[np.concatenate(([True], owner[hits][1:] != owner[hits][:-1]))]
        symbols[first] = made[first]
        stay = ~done
        stay[first + 1] = False
        place = np.cumsum(stay) - 1
        symbols, owner, made = symbols[stay], owner[stay], made[stay]
        at = place[first]
        redo = np.concatenate((at, at[at > 0] - 1))
        made[redo] = -1
        redo = redo[redo + 1 < len(symbols)]
        redo = redo[owner[redo] == owner[redo + 1]]
        made[redo] = ranks.merged(symbols[redo], symbols[redo + 1])
    return out


class Counter:
    """Counts whole texts; a pre-token that comes again is looked up."""

    def __init__(self, path: str, held: int = 800_000):
        self.ranks, self.held, self.known = PairRanks(path), held, {}

    def count(self, column: pa.Array) -> np.ndarray:
        filled = pc.fill_null(column, "")
        full = pc.binary_length(filled).to_numpy(zero_copy_only=False) > 0
        # The model writes spaces as their mark and puts one before each text that is not empty.
        plain = pc.replace_substring(filled, "▁", " ")
        data, offsets = utf8(pc.if_else(pa.array(full), pc.binary_join_element_wise(" ", plain, ""), plain))
        cuts = chunk_cuts(data, offsets, newline=False)
        codes, values = distinct(binaries(data, cuts))
        words = listed(values)
        if len(self.known) > self.held:
            self.known = {}
        new = [w for w in words if w not in self.known]
        self.known.update(zip(new, count_survivors([w.decode() for w in new], self.ranks).tolist(), strict=True))
        each = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[codes]
        ends = np.concatenate(([0], np.cumsum(each)))
        return np.diff(ends[np.searchsorted(cuts, offsets)])


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def _job(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for rows in slices(batches):
            n_bytes = pc.cast(pc.binary_length(rows.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), n_bytes, pa.array(counter(path).count(rows.column("text")), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text; one pass, no shuffle.

    ``path``: a sentencepiece byte-pair model, at the same place on every executor.
    """
    counted = texts(docs).mapInArrow(_job(path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
