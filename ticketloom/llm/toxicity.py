"""Toxicity by noisy-channel deobfuscation.

A written token is the output of a channel that replaces letters by look-alikes, repeats them,
sets signs between them or spaces them out.  The letters it may stand for form a lattice; a Viterbi
search finds the cheapest path under the channel's costs and a trigram model of letters counted
over all documents.  Restored words are looked up in a lexicon learned from labelled documents (words
and beginnings of words that toxic documents use significantly more), and a logistic score of the
share and the weight of such words is a document's toxicity.

A token of letters without a doubled one has one path, itself; one with a doubled letter is read as written
besides.  Tokens end at any white space.  Tokens of digits or signs alone are no words.  A token over ``PART``
characters is restored in parts of that length.  Three or more single characters in a row are read as one
spaced-out word besides, and as the words into which the letter model divides them; a token with signs inside
also as the words between those signs that may be borders.  Every such word is looked up.

A null or empty text has no words and gets the score of a document without toxic words.  Rows may
repeat.  Without labels of both classes every score is 0.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.arrays import binaries, distinct, listed, slices, utf8
from ticketloom.llm.learning import TRAIN_ROWS, bounded_sample, labelled, logistic, sigmoid
from ticketloom.llm.tables import fold, materialize, texts

CUT = 0.7
# Look-alikes of letters.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¡": "i", "§": "s",
}
SWAP, DROP_SIGN, DROP_DIGIT, DROP_REPEAT = 1.0, 1.0, 6.0, 1.0
LETTERS = 28  # border, a to z, any other letter
PART = 64
PREFIXES = range(3, 9)
MIN_DOCS, MIN_Z, LARGEST_WEIGHT = 3, 4.0, 8.0
# Signs that may begin and end a word, as they look like letters.
BEGINS, ENDS = frozenset("@$+|!€£¡§"), frozenset("@$+")
DOUBLED = re.compile(r"(.)\1")
SPACED = "\x1f"  # before the characters of a spaced-out run that may be several words


def _classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte: letters of either case are one, a byte that begins a letter beyond ASCII another."""
    low = data | 32
    out = np.where((low >= 97) & (low <= 122) & (data < 128), low - 96, 0)
    return np.where(data >= 0xC0, 27, out)


def _trigram_job() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        total = np.zeros(LETTERS**3, np.int64)
        for rows in slices(batches):
            data, offsets = utf8(rows.column("text"))
            mark = np.zeros(len(data) + len(offsets), bool)
            mark[offsets + np.arange(len(offsets))] = True  # a border before and behind each text
            spread = np.zeros(len(mark), np.int64)
            spread[~mark] = _classes(data)
            keep = np.ones(len(mark), bool)
            keep[~mark] = (data & 0xC0) != 0x80
            c = spread[keep]
            c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))] if len(c) else c  # one border between words
            if len(c) > 2:
                total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS**3)
                second = np.flatnonzero(c[:-1] == 0)  # a word's first letter has two borders before it
                total += np.bincount(c[second + 1], minlength=LETTERS**3)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit], pa.int64())], ["gram", "n"])

    return run


class LetterModel:
    """Costs, -log P(letter | two letters before), of trigram counts, backed off to shorter contexts."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(LETTERS, LETTERS, LETTERS).astype(np.float64)
        one = tri.sum((0, 1)) + 1.0
        one /= one.sum()
        pair = tri.sum(0)
        two = (pair + 5.0 * one) / (pair.sum(1, keepdims=True) + 5.0)
        three = (tri + 5.0 * two[None]) / (tri.sum(2, keepdims=True) + 5.0)
        self.cost = -np.log(three)
        self.table = self.cost.tolist()


def letter_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over all documents; at most ``LETTERS ** 3`` rows reach the driver."""
    seen = texts(docs).select("text").mapInArrow(_trigram_job(), "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(LETTERS**3, np.int64)
    counts[seen.column("gram").to_numpy()] = seen.column("n").to_numpy()
    return counts


def _class_of(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else 27


def _arcs(ch: str, before: str) -> list[tuple[str, float]]:
    """What a written character may stand for: letters, or "" for nothing, each with the channel's cost."""
    if ch.isalpha():
        return [(ch, 0.0), ("", DROP_REPEAT)] if ch == before else [(ch, 0.0)]
    out = [(x, SWAP) for x in LOOK_ALIKES.get(ch, "")]
    out.append(("", DROP_DIGIT if ch.isdigit() else DROP_SIGN if not out else DROP_SIGN + 2.0))
    return out


def viterbi(token: str, model: LetterModel, borders: str = "") -> str:
    """The cheapest letters for a written token (lower case).

    With ``borders`` a space stands where a word ends: "signs" lets a sign be a border, "all" puts one before any character.
    """
    cost = model.table
    layer = {(0, 0): (0.0, "", None)}  # last two classes: cost, letter, way back
    before = ""
    for ch in token:
        following: dict[tuple[int, int], tuple] = {}
        if borders == "all":
            layer = _with_border(layer, cost)
        arcs = _arcs(ch, before)
        if borders == "signs" and not ch.isalnum():
            arcs.append((" ", DROP_SIGN))
        for letter, price in arcs:
            for state, way in layer.items():
                if letter == " ":
                    new, total = (0, 0), way[0] + price + (cost[state[0]][state[1]][0] if state[1] else 0.0)
                elif letter:
                    c = _class_of(letter)
                    new, total = (state[1], c), way[0] + price + cost[state[0]][state[1]][c]
                else:
                    new, total = state, way[0] + price
                held = following.get(new)
                if held is None or total < held[0]:
                    following[new] = (total, letter, way)
        layer, before = following, ch
    way = min(((way[0] + cost[state[0]][state[1]][0], way) for state, way in layer.items()), key=lambda x: x[0])[1]
    out = []
    while way is not None:
        out.append(way[1])
        way = way[2]
    return "".join(reversed(out))


def _with_border(layer: dict[tuple[int, int], tuple], cost: list) -> dict[tuple[int, int], tuple]:
    """The layer and its cheapest way to end a word here."""
    ends = [(way[0] + cost[a][b][0], " ", way) for (a, b), way in layer.items() if b]
    best = min(ends, key=lambda x: x[0], default=None)
    held = layer.get((0, 0))
    return layer | {(0, 0): best} if best and (held is None or best[0] < held[0]) else layer


def _sign(c: str) -> bool:
    return not c.isalnum() and c != "_"


def trimmed(token: str) -> str:
    """The token without the marks around it: at either end three or more of one sign, or signs that are no letters."""
    n, begin = len(token), 0
    if n and _sign(token[0]):
        begin = n - len(token.lstrip(token[0]))
        if begin < 3:
            begin = next((k for k, c in enumerate(token) if not _sign(c) or c in BEGINS), n)
    end = n
    while end > begin and _sign(token[end - 1]):
        end -= 1
    cut = n
    while cut > end and token[cut - 1] not in ENDS:
        cut -= 1
    return token[begin : next((k for k in range(end, min(cut, n - 2)) if token[k] == token[k + 1] == token[k + 2]), cut)]


def restore(token: str, model: LetterModel) -> str:
    """The word a written token stands for; "" if it is none."""
    token = token.strip().lower()
    if token.isalpha() and not DOUBLED.search(token):
        return token
    core = trimmed(token)
    if core.isalpha() and not DOUBLED.search(core):
        return core
    if not any(c.isalpha() for c in core):
        return ""
    return "".join(viterbi(core[a : a + PART], model) for a in range(0, len(core), PART))


def readings(token: str, model: LetterModel) -> list[str]:
    """All words to look up for a written token, each once."""
    if token.startswith(SPACED):
        return list(dict.fromkeys(viterbi(token[1:].lower(), model, "all").split()))
    low = token.strip().lower()
    core = low if low.isalpha() else trimmed(low)
    out = [restore(token, model)]
    if core.isalpha():
        out.append(core)
    elif out[0] and any(not c.isalnum() for c in core):
        out.extend(w for a in range(0, len(core), PART) for w in viterbi(core[a : a + PART], model, "signs").split())
    return list(dict.fromkeys(w for w in out if w))


def parts_of(word: str) -> list[str]:
    """The word and its beginnings; a beginning has a mark behind it.  A single letter is no evidence."""
    if len(word) < 2:
        return []
    return [word] + [word[:k] + "*" for k in PREFIXES if k < len(word)]


def _white(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 belong to white space."""
    out = ((data >= 9) & (data <= 13)) | ((data >= 28) & (data <= 32))
    if len(data) > 1 and data.max() >= 0xC2:
        a, b = data[:-1], data[1:]
        at = np.flatnonzero((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
        out[at] = out[at + 1] = True
        a, b, c = data[:-2], data[1:-1], data[2:]
        wide = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        wide |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        at = np.flatnonzero(wide)
        out[at] = out[at + 1] = out[at + 2] = True
    return out


def tokens(column: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Codes and distinct values of the white-space tokens of all texts, and each token's text."""
    data, offsets = utf8(column)
    white = _white(data)
    mark = np.zeros(len(data) + 1, bool)
    mark[1:-1] = white[1:] & ~white[:-1]
    mark[offsets] = True
    cuts = np.flatnonzero(mark)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(cuts, offsets)))
    solid = ~white & ((data & 0xC0) != 0x80)  # characters, not bytes
    before = np.concatenate(([0], np.cumsum(solid)))
    widths = np.diff(before[cuts])
    codes, values = distinct(binaries(data, cuts))
    words = listed(values)
    # Runs of three or more tokens of one character within a text are two more tokens: glued, and marked to be divided.
    single = np.flatnonzero(widths == 1)
    if len(single) > 2:
        starts = np.flatnonzero(np.concatenate(([True], (np.diff(single) != 1) | (owner[single][1:] != owner[single][:-1]))))
        ends = np.append(starts[1:], len(single))
        more_codes, more_owner = [], []
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b - a > 2:
                run = single[a:b]
                held = slice(cuts[run[0]], cuts[run[-1] + 1])
                glued = data[held][~white[held]].tobytes()
                words += [glued, SPACED.encode() + glued]
                more_codes += [len(words) - 2, len(words) - 1]
                more_owner += [owner[run[0]]] * 2
        if more_codes:
            codes, owner = np.concatenate((codes, more_codes)), np.concatenate((owner, more_owner))
            order = np.argsort(owner, kind="stable")
            codes, owner = codes[order], owner[order]
    return codes, words, owner


def _evidence_job(counts: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over a task's documents: how many of each label hold a part, and its summed share of words."""

    def run(batches):
        model = LetterModel(counts)
        known: dict[bytes, set[str]] = {}
        sums: dict[str, list[float]] = defaultdict(lambda: [0, 0, 0.0, 0.0])
        for batch in batches:
            if len(known) > 200_000:
                known.clear()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                codes, words, _ = tokens(pa.array([text]))
                seen = np.bincount(codes, minlength=len(words)).tolist()
                share: dict[str, float] = defaultdict(float)
                for word, n in zip(words, seen, strict=True):
                    if word not in known:
                        known[word] = {p for w in readings(word.decode(errors="replace"), model) for p in parts_of(w)}
                    for part in known[word]:
                        share[part] += n / len(codes)
                for part, s in share.items():
                    held = sums[part]
                    held[label] += 1
                    held[2 + label] += s
        rows = [(k, *v) for k, v in sums.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["part", "clean_docs", "toxic_docs", "clean_share", "toxic_share"])

    return run


def lexicon(taught: DataFrame, counts: np.ndarray, clean: int, toxic: int) -> dict[str, float]:
    """Weights of all parts that toxic documents hold significantly more.

    The documents that teach are bounded, and a part needs ``MIN_DOCS`` of the toxic ones, so the
    lexicon does not grow with the table.
    """
    seen = taught.select("text", "label").mapInArrow(_evidence_job(counts), "part string, clean_docs long, toxic_docs long, clean_share double, toxic_share double")
    sums = seen.groupBy("part").agg(*(F.sum(c).alias(c) for c in ("clean_docs", "toxic_docs", "clean_share", "toxic_share"))).where((F.col("toxic_docs") >= MIN_DOCS) & (F.col("part") != ""))
    rate = (F.col("clean_docs") + F.col("toxic_docs") + 1) / (clean + toxic + 2)
    z = (F.col("toxic_docs") / toxic - F.col("clean_docs") / clean) / F.sqrt(rate * (1 - rate) * (1 / clean + 1 / toxic))
    weight = F.log((F.col("toxic_share") / toxic + 1e-6) / (F.col("clean_share") / clean + 1e-6))
    strong = sums.select("part", z.alias("z"), weight.alias("weight")).where((F.col("z") >= MIN_Z) & (F.col("weight") > 1.0)).orderBy("part").select("part", "weight")
    rows = strong.toArrow()
    return dict(zip(rows.column("part").to_pylist(), np.minimum(rows.column("weight").to_numpy(), LARGEST_WEIGHT).tolist(), strict=True))


class Scorer:
    """Evidence of whole texts; the weight of a token that comes again is looked up."""

    def __init__(self, words: dict[str, float], counts: np.ndarray, held: int = 600_000):
        self.words, self.model, self.held, self.known = words, LetterModel(counts), held, {}

    def weight(self, token: bytes) -> float:
        return max((self.words.get(p, 0.0) for w in readings(token.decode(errors="replace"), self.model) for p in parts_of(w)), default=0.0)

    def evidence(self, column: pa.Array) -> np.ndarray:
        """For each text the mean weight of its words, a concave form of it, and the weight of its distinct toxic words."""
        codes, words, owner = tokens(column)
        if len(self.known) > self.held:
            self.known = {}
        for w in words:
            if w not in self.known:
                self.known[w] = self.weight(w)
        weights = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
        n = len(column)
        total = np.maximum(np.bincount(owner, minlength=n), 1)
        mean = np.bincount(owner, weights[codes], minlength=n) / total
        hit = np.flatnonzero(weights[codes] > 0)
        pairs = np.unique(owner[hit].astype(np.int64) << 32 | codes[hit])
        kinds = np.bincount(pairs >> 32, weights[pairs & 0xFFFFFFFF], minlength=n)
        return np.column_stack((np.ones(n), mean, np.sqrt(mean), np.log1p(kinds), np.minimum(mean * 20, 1.0)))


_scorers: dict[str, Scorer] = {}


def _evidence_of(key: str, words: dict[str, float], counts: np.ndarray) -> Scorer:
    if key not in _scorers:
        _scorers.clear()  # the last query's model is not used again
        _scorers[key] = Scorer(words, counts)
    return _scorers[key]


def _score_job(key: str, words: dict[str, float], counts: np.ndarray, fitted: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        scorer = _evidence_of(key, words, counts)
        for rows in slices(batches, limit=2 << 20):
            x = scorer.evidence(rows.column("text"))
            if fitted is None:
                packed = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), packed], ["doc_id", "x"])
            else:
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sigmoid(x @ fitted))], ["doc_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, held_out_parts: int = 3, held_out_part: int = 1, cut: float = CUT, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text.

    Labels teach only where crc32 of the id modulo ``held_out_parts`` is not ``held_out_part``, and
    at most ``train_rows`` of them: three quarters the lexicon, the rest the logistic score.  The
    letter model counts all documents.
    """
    held_out = F.coalesce(fold("doc_id", held_out_parts) == held_out_part, F.lit(False))
    rows = texts(docs)
    chosen = bounded_sample(labelled(labels, "toxic").where(fold("doc_id", held_out_parts) != held_out_part), train_rows).toArrow()
    sample = docs.sparkSession.createDataFrame(chosen, "doc_id long, label int")  # bounded by train_rows
    known = rows.join(F.broadcast(sample), "doc_id").groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"), F.min("label").alias("label"), F.max("label").alias("_most"))
    # Equal texts teach once, under their least id, and not at all if their labels disagree.
    known = known.where("label = _most").drop("_most")
    known = materialize(known.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(4))).drop("digest"), "toxic-sample")
    sizes = {r["label"]: r["n"] for r in known.where("part > 0").groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return rows.select("doc_id", held_out.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    counts = letter_counts(docs)
    words = lexicon(known.where("part > 0"), counts, sizes[0], sizes[1])
    key = f"{docs.sparkSession.sparkContext.applicationId}-{id(counts)}-{hash(frozenset(words.items()))}"
    seen = known.mapInArrow(_score_job(key, words, counts, None), "doc_id long, x array<double>").join(known.select("doc_id", "label", "part"), "doc_id").toArrow()
    x = np.array(seen.column("x").to_pylist())
    y, part = seen.column("label").to_numpy().astype(float), seen.column("part").to_numpy()
    fresh = part == 0
    if len(set(y[fresh].tolist())) < 2 or y[fresh].sum() < 20:  # too few toxic documents beside the lexicon's own
        fresh = np.ones(len(y), bool)
    fitted = logistic(x[fresh], y[fresh], ridge=1e-4)
    scored = rows.mapInArrow(_score_job(key, words, counts, fitted), "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
