"""Texts of Arrow batches as flat byte and id arrays."""

from __future__ import annotations

import ctypes
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20
ArrowJob = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return freed memory to the system.  A Python worker outlives its task, and what its allocators keep counts for the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def map_large() -> None:
    """Let arrays of a megabyte and more be mapped on their own, so that they go back to the system when freed."""
    tune = getattr(ctypes.CDLL(None), "mallopt", None)
    if tune:
        tune(-3, 1 << 20)  # M_MMAP_THRESHOLD; once set it no longer moves


def tidy(job: ArrowJob) -> ArrowJob:
    """A job for ``mapInArrow`` that gives freed memory back when its partition is done."""

    def run(batches):
        map_large()
        try:
            yield from job(batches)
        finally:
            give_back()

    return run


def tidy_group(job: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A job for ``applyInArrow`` that gives freed memory back when its group is done."""

    def run(table: pa.Table) -> pa.Table:
        map_large()
        try:
            return job(table)
        finally:
            give_back()

    return run


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text begins; null counts as empty."""
    wide = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Byte strings between neighbouring offsets, without a copy."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    )


def distinct(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each value its place among the distinct ones, and those."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def listed(values: pa.Array) -> list[bytes]:
    """The byte strings of a ``large_binary`` array as Python objects."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1].tolist()
    held = values.buffers()[2]
    held = held.to_pybytes() if held is not None else b""
    return [held[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + length]`` one after the other."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(lengths)
    return flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


def chunk_cuts(data: np.ndarray, offsets: np.ndarray, newline: bool = True) -> np.ndarray:
    """Ascending cuts, each text's ends among them: before each run of blanks that follows no blank.

    Blanks are the space and, with ``newline``, the line feed.  A run that follows any other white
    space is not cut off, so a cut never falls inside a run of white space.
    """
    blank = data == 32
    if newline:
        blank |= data == 10
    at = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    last = data[at - 1]
    keep = (last > 32) & (last != 127)
    high = np.flatnonzero(last >= 0x80)
    before = data[at[high] - 2]
    # UTF-8 of the white space beyond ASCII: C2 85, C2 A0, E1 9A 80, E2 80 xx, E2 81 9F, E3 80 80
    keep[high] = ~((before == 0x80) | (before == 0x81) | (before == 0x9A) | ((before == 0xC2) & np.isin(last[high], (0x85, 0xA0))))
    mark = np.zeros(len(data) + 1, bool)
    mark[at[keep]] = True
    mark[offsets] = True
    return np.flatnonzero(mark)


LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
MARK = np.zeros(256, bool)  # ASCII beyond letters and white space
MARK[33:127] = ~LETTER[33:127]


def word_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The cuts of :func:`chunk_cuts` and one between a letter of Latin-1 and an ASCII mark or digit."""
    cuts = chunk_cuts(data, offsets)
    mark = MARK[data]
    at = np.flatnonzero(mark[1:] & ~mark[:-1]) + 1
    last = data[at - 1]
    keep = LETTER[last]
    high = np.flatnonzero(last >= 0x80)
    keep[high] = (data[at[high] - 2] == 0xC3) & (last[high] != 0x97) & (last[high] != 0xB7)
    both = np.zeros(len(data) + 1, bool)
    both[cuts] = True
    both[at[keep]] = True
    return np.flatnonzero(both)


def _byte_letters() -> dict[int, str]:
    """The usual printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


class ChunkEncoder:
    """Token ids of whole texts; a chunk that comes again is encoded once.

    Both JSON vocabularies split texts into pre-tokens first, and each cut used here is a border of
    pre-tokens, so joining the chunks' ids gives the ids of the text.  A chunk that is one run of
    Latin-1 letters (and one space before it) is one pre-token: it goes to the model directly.
    ``lower`` says that the vocabulary folds case and drops white space.  Twice ``held`` chunks are kept at most: those
    since the last turn, and those of the turn before, from which frequent ones come back.
    """

    PLAIN = re.compile("[ \n]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")

    def __init__(self, path: str, held: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lower = "Lowercase" in str(self.tokenizer.normalizer)
        self.held = held
        self._forget()
        self.before = ({}, array("I"), array("q", [0]))

    def _forget(self) -> None:
        self.place, self.flat, self.ends = {}, array("I"), array("q", [0])

    def _learn(self, words: list[bytes]) -> None:
        model, rest, place = self.tokenizer.model, [], self.place
        known, flat, ends = self.before
        for w in words:
            if w in known:  # what came again since the last turn stays
                k = known[w]
                self.flat.extend(flat[ends[k] : ends[k + 1]])
                place[w] = len(self.ends) - 1
                self.ends.append(len(self.flat))
                continue
            letters = w.lstrip(b" \n") if self.lower else w[w[:1] == b" " :]
            if letters.isalpha():  # ASCII letters stand for themselves
                plain = letters.decode().lower() if self.lower else ("\u0120" if len(letters) < len(w) else "") + letters.decode()
            else:
                text = w.decode()
                if not self.PLAIN.fullmatch(text) or (text[0] == "\n" and not self.lower):
                    rest.append(w)
                    continue
                plain = "".join(map(BYTE_LETTERS.__getitem__, (text.strip().lower() if self.lower else text).encode()))
            self.flat.extend([t.id for t in model.tokenize(plain)])
            place[w] = len(self.ends) - 1
            self.ends.append(len(self.flat))
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
        for w, e in zip(rest, encoded, strict=True):
            self.flat.extend(e.ids)
            place[w] = len(self.ends) - 1
            self.ends.append(len(self.flat))

    def _places(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each chunk its code; for each code where its ids are held; the cuts and the texts' offsets."""
        data, offsets = utf8(column)
        if np.any((data[:-1] == 60) & (data[1:] == 124)):  # "<|" may begin a special string: leave those whole
            cuts = chunk_cuts(data, offsets)
        else:
            cuts = word_cuts(data, offsets)
            if self.lower:
                data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
        codes, values = distinct(binaries(data, cuts))
        words = listed(values)
        if len(self.place) > self.held:
            self.before = (self.place, self.flat, self.ends)
            self._forget()
        self._learn([w for w in words if w not in self.place])
        return codes, np.fromiter(map(self.place.__getitem__, words), np.int64, len(words)), cuts, offsets

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of a string column and where each text's ids begin."""
        codes, place, cuts, offsets = self._places(column)
        known, ends = place[codes], np.frombuffer(self.ends, np.int64)
        starts, lengths = ends[known], ends[known + 1] - ends[known]
        ids = gather(np.frombuffer(self.flat, np.uint32), starts, lengths).copy()
        begins = np.concatenate(([0], np.cumsum(lengths)))
        return ids, begins[np.searchsorted(cuts, offsets)]

    def count(self, column: pa.Array) -> np.ndarray:
        """How often each id occurs in a string column."""
        codes, place, _, _ = self._places(column)
        ends = np.frombuffer(self.ends, np.int64)
        starts, lengths = ends[place], ends[place + 1] - ends[place]
        times = np.repeat(np.bincount(codes, minlength=len(place)), lengths)
        return np.bincount(gather(np.frombuffer(self.flat, np.uint32), starts, lengths), times).astype(np.int64)


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
