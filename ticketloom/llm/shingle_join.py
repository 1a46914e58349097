"""N-gram Jaccard join with rare-first prefixes, and the components of its links.

Equal texts are one node.  A node's set holds 64-bit hashes of its distinct runs of five words; while they are counted, the
range a hash lies in and its 40 lower bits stand for it, 48 bits of both and the count in the join.  Two
nodes link when 100 * intersection >= 75 * union.  Any two that do share a shingle among the first
``n - ceil(3 n / 4) + 1`` of each set, in any one order of all shingles; here rare ones come first.

1. Each task packs the shingles of a chunk of nodes into one binary row for each range of hashes;
   a range's rows meet in one task, which counts in how many nodes a shingle occurs.  Only those in
   two nodes or more go back to the chunk.  A shingle of one node comes first in the order and links nothing,
   so a node whose prefix is made of such shingles is done: no link can reach it.
2. For the others the prefix is joined on its shingles.  Every shingle's nodes are first compared with
   a few of their own, those with the fewest shingles alone (ties by hash), as they are nearest to all; then only nodes that no link has joined yet meet each other,
   a frequent shingle in several tasks.  Pairs pass the length, the positional and the suffix filter, and
   each is verified once, on its shared shingles.
3. Components come from least-label propagation with pointer jumping, written in every round.

A group of many near copies thus costs its size times a few picks, not its square; a link
inside a component is not looked for again, which changes no component.

Words: A-Z in lower case, split at white space (space, tab to carriage return); fewer than five
are one shingle.  A null or empty text and one without words has none, and links with nothing.  Rows may repeat
and share ids: each row is its own document, and equal texts are linked.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.arrays import binaries, distinct, gather, listed, slices, tidy, tidy_group, utf8
from ticketloom.llm.marks import marked_job, marks
from ticketloom.llm.tables import materialize, texts

WORDS = 5
PERCENT = 75
CHUNK_BYTES = 8 << 20
CHUNK_NODES = 1 << 16
RANGE_BYTES = 4 << 20  # of text for each range of hashes
PICKS = 4
CELL_NODES = 4096
BEFORE = 32  # a prefix row carries the shingles before it if no more than these
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
PACKED = "part long, chunk long, kind int, payload binary"
NODE = "node binary, n long, unique long, grams binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def _word_hashes(values: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values), np.uint64, len(values))


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of all texts, and how many words each text has."""
    data, offsets = utf8(column)
    data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
    inside = np.concatenate((~BLANK[data], [False]))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][inside[offsets[:-1]]]
    first[heads] = True
    starts = np.flatnonzero(first)
    kept = np.cumsum(inside)
    ends = np.concatenate((kept[starts] - 1, [kept[-1]])) if len(starts) else np.zeros(1, np.int64)
    codes, values = distinct(binaries(data[inside[:-1]], ends))
    hashes = _word_hashes(listed(values))
    return (hashes[codes] if len(codes) else np.zeros(0, np.uint64)), np.diff(np.searchsorted(starts, offsets))


def shingles(column: pa.Array, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, text by text in ascending order, and each text's text number."""
    hashes, n = words(column)
    owner = np.repeat(np.arange(len(n)), n)
    total = len(hashes)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begin = np.cumsum(n) - n
    place = np.arange(total) - begin[owner]
    left = n[owner] - place
    # A run starts at each word that has four more behind it, and at the first word of a short text.
    start = np.flatnonzero((left >= width) | ((place == 0) & (n[owner] < width)))
    length = np.minimum(left[start], width)
    out = np.full(len(start), np.uint64(0x9E3779B97F4A7C15)) + length.astype(np.uint64)
    for k in range(width):
        more = k < length
        out[more] = _mix(out[more] * np.uint64(0x100000001B3) ^ hashes[start[more] + k])
    who = owner[start]
    order = np.lexsort((out, who))
    out, who = out[order], who[order]
    new = np.concatenate(([True], (out[1:] != out[:-1]) | (who[1:] != who[:-1])))
    return out[new], who[new]


def _pack_job(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chunks of nodes as one row for each range of hashes (kind 1) and one with the nodes themselves (kind 0)."""

    def run(batches):
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for rows in (s.slice(k, CHUNK_NODES) for s in slices(batches, limit=CHUNK_BYTES) for k in range(0, s.num_rows, CHUNK_NODES)):
            grams, who = shingles(rows.column("text"))
            n = np.bincount(who, minlength=rows.num_rows).astype("<u4")
            nodes = b"".join(rows.column("node").to_pylist())
            # The range is the upper half of the hash; 40 lower bits tell its shingles apart.
            part = ((grams >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)
            order = np.argsort(part, kind="stable")
            grams, who, part = grams[order], who[order], part[order].astype(np.int64)
            edges = np.searchsorted(part, np.arange(parts + 1))
            out = [(chunk % parts, chunk, 0, n.tobytes() + nodes)]
            for p in np.flatnonzero(np.diff(edges)).tolist():
                a, b = edges[p], edges[p + 1]
                low = grams[a:b]
                # Nodes ascend within a range: each is told by its distance from the one before, in two bytes at most.
                gaps = np.diff(who[a:b], prepend=0)
                wide = int(gaps.max() > 255)
                out.append((p, chunk, 1, bytes([wide]) + gaps.astype("<u2" if wide else "u1").tobytes() + (low & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + ((low >> np.uint64(32)) & np.uint64(0xFF)).astype("u1").tobytes()))
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["part", "chunk", "kind", "payload"])
            chunk += 1

    return run


def _count_range(table: pa.Table) -> pa.Table:
    """Counts the shingles of a range and gives those of two nodes or more back to their chunks."""
    kinds = table.column("kind").to_pylist()
    payloads, chunks = table.column("payload").to_pylist(), table.column("chunk").to_pylist()
    out = [(chunks[k], 0, p) for k, p in enumerate(payloads) if kinds[k] == 0]
    keys, owners, sources = [], [], []
    for k, p in enumerate(payloads):
        if kinds[k] == 0:
            continue
        size = 1 + p[0]  # bytes of a gap
        m = (len(p) - 1) // (5 + size)
        at = 1 + size * m
        low = np.frombuffer(p, "<u4", m, at).astype(np.uint64)
        keys.append(low | (np.frombuffer(p, "u1", m, at + 4 * m).astype(np.uint64) << np.uint64(32)))
        owners.append(np.cumsum(np.frombuffer(p, "<u2" if size == 2 else "u1", m, 1), dtype=np.uint32))
        sources.append(np.full(m, k, np.uint32))
    if keys:
        key, owner, source = np.concatenate(keys), np.concatenate(owners), np.concatenate(sources)
        order = np.argsort(key, kind="stable")
        key, owner, source = key[order], owner[order], source[order]
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        df = np.diff(np.append(heads, len(key)))
        shared = np.repeat(df > 1, df)
        # The order of all shingles: how many nodes hold it, then the hash; the range is part of the hash.
        rank = (np.minimum(np.repeat(df, df)[shared], 0xFFFF).astype(np.uint64) << np.uint64(48)) | key[shared]
        owner, source = owner[shared], source[shared]
        order = np.argsort(source, kind="stable")
        rank, owner, source = rank[order], owner[order], source[order]
        edges = np.searchsorted(source, np.arange(len(payloads) + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[k], edges[k + 1]
            out.append((chunks[k], 1, np.int64(table.column("part")[0].as_py()).tobytes() + owner[a:b].astype("<u4").tobytes() + rank[a:b].astype("<u8").tobytes()))
    columns = zip(*out, strict=True) if out else [[]] * 3
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["chunk", "kind", "payload"])


def _assemble(parts: int) -> Callable[[pa.Table], pa.Table]:
    """A chunk's nodes; those that may have a link with their shared shingles, in order, as 64-bit ranks."""

    def run(table: pa.Table) -> pa.Table:
        sizes = nodes = None
        owners, ranks = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint64)]
        for kind, p in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True):
            if kind == 0:
                rows = len(p) // 20
                sizes, nodes = np.frombuffer(p, "<u4", rows).astype(np.int64), p[4 * rows :]
            else:
                m = (len(p) - 8) // 12
                part = np.uint64(np.frombuffer(p, "<i8", 1)[0])
                owners.append(np.frombuffer(p, "<u4", m, 8))
                rank = np.frombuffer(p, "<u8", m, 8 + 4 * m)
                # Two ranges may hold the same lower bits: the range is mixed in, below the count.
                low = _mix((rank & np.uint64((1 << 40) - 1)) | (part << np.uint64(40))) & np.uint64((1 << 48) - 1)
                ranks.append((rank & ~np.uint64((1 << 48) - 1)) | low)
        owner, rank = np.concatenate(owners), np.concatenate(ranks)
        order = np.lexsort((rank, owner))
        owner, rank = owner[order], rank[order]
        edges = np.searchsorted(owner, np.arange(len(sizes) + 1))
        shared = np.diff(edges)
        unique = sizes - shared
        open_ = ((prefix_length(sizes) > unique) & (sizes > 0)).tolist()
        return pa.table(
            [pa.array([nodes[16 * k : 16 * k + 16] for k in range(len(sizes))], pa.binary()), pa.array(sizes), pa.array(unique),
             pa.array([rank[edges[k] : edges[k + 1]].astype("<u8").tobytes() if o else None for k, o in enumerate(open_)], pa.binary())],
            ["node", "n", "unique", "grams"],
        )

    return run


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (PERCENT * n + 99) // 100 + 1


def needed_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least intersection of linked sets of these sizes."""
    return (PERCENT * (a + b) + 99 + PERCENT) // (100 + PERCENT)


def suffix_bound(a: np.ndarray, b: np.ndarray, depth: int = 3) -> int:
    """At most so many shingles are in both ascending arrays: halves around a middle one can only meet their own side."""
    if not depth or not len(a) or not len(b):
        return min(len(a), len(b))
    mid = b[len(b) // 2]
    k = int(np.searchsorted(a, mid))
    hit = int(k < len(a) and a[k] == mid)
    return suffix_bound(a[:k], b[: len(b) // 2], depth - 1) + hit + suffix_bound(a[k + hit :], b[len(b) // 2 + 1 :], depth - 1)


def _verify_job() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            keep = []
            columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "grams_a", "grams_b")]
            for k, (n_a, n_b, a, b) in enumerate(zip(*columns, strict=True)):
                a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                need = (PERCENT * (n_a + n_b) + 99 + PERCENT) // (100 + PERCENT)
                if min(len(a), len(b)) < need or suffix_bound(a, b) < need:
                    continue
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                if 100 * both >= PERCENT * (n_a + n_b - both):
                    keep.append(k)
            took = batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
            yield took

    return run


def shared_sets(nodes: DataFrame, text_bytes: int) -> DataFrame:
    """``node, n, unique, grams`` of every node: its size, how many shingles it has alone, the ranks of the
    others in ascending order; ``grams`` is null where no link is possible."""
    parts = max(1, math.ceil(text_bytes / RANGE_BYTES))
    packed = nodes.mapInArrow(tidy(_pack_job(parts)), PACKED)
    counted = packed.groupBy("part").applyInArrow(tidy_group(_count_range), "chunk long, kind int, payload binary")
    return counted.groupBy("chunk").applyInArrow(tidy_group(_assemble(parts)), NODE)


def _prefix_job() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            n, unique = batch.column("n").to_numpy(), batch.column("unique").to_numpy()
            take = prefix_length(n) - unique
            grams = [np.frombuffer(g, "<i8") for g in batch.column("grams").to_pylist()]
            take = np.minimum(take, [len(g) for g in grams]) if len(grams) else take
            row = np.repeat(np.arange(len(n)), take)
            within = np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take)
            flat = np.concatenate([g[:t] for g, t in zip(grams, take, strict=True)]) if len(grams) else np.zeros(0, np.int64)
            near = within <= BEFORE
            sizes = np.where(near, within, 0)
            before = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(gather(flat, np.arange(len(row)) - within, sizes), pa.int64()), mask=pa.array(~near))
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat, pa.int64()), batch.column("node").take(pa.array(row)), pa.array(n[row]), pa.array(unique[row]), pa.array(within), before],
                ["gram", "node", "n", "unique", "at", "before"],
            )

    return run


def _passes(x: str, y: str, first: bool = False):
    """The length and the positional filter on the columns of two prefix rows that share a shingle.

    With ``first`` only the first shingle that both prefixes share counts, where the rows tell which it is:
    nothing before it is shared, and the pair comes once.
    """
    n_x, n_y, at_x, at_y, own_x, own_y = (F.col(c) for c in (f"{x}.n", f"{y}.n", f"{x}.at", f"{y}.at", f"{x}.unique", f"{y}.unique"))
    size = (100 * F.least(n_x, n_y)) >= PERCENT * F.greatest(n_x, n_y)
    need = F.floor((PERCENT * (n_x + n_y) + 99 + PERCENT) / (100 + PERCENT))
    # Shared shingles before this one are before it in both; shingles of one node are not shared.
    after = F.least(n_x - own_x - at_x, n_y - own_y - at_y)
    if not first:
        return size & (F.least(at_x, at_y) + after >= need)
    known = F.col(f"{x}.before").isNotNull() & F.col(f"{y}.before").isNotNull()
    tight = F.when(after >= need, ~F.arrays_overlap(f"{x}.before", f"{y}.before")).otherwise(False)
    return size & F.when(known, tight).otherwise(F.least(at_x, at_y) + after >= need)


def _verified(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Those pairs ``a, b`` of nodes that link."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "grams_a", "grams_b")
    return materialize(both.mapInArrow(tidy(_verify_job()), "a binary, b binary"), name)


def components(edges: DataFrame, name: str = "labels") -> DataFrame:
    """``node, label`` of every node of the edges ``a, b``: the least node of its component.

    Each round a node takes the least label of its neighbours, then its label's own label.  Labels are
    written in every round; at most one row for each node is compared to see whether any changed.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), name)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # The node that gave its name may have moved on itself.
        roots = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = hooked.join(roots, "label", "left").select("node", F.coalesce(F.least("label", "root"), "label").alias("label"), "old")
        following = materialize(jumped, name)
        if following.where("label <> old").isEmpty():
            return following.select("node", "label")
        labels = following.select("node", "label")


def linked_nodes(sets: DataFrame) -> DataFrame:
    """``node, label`` of the nodes that have a link."""
    prefixes = materialize(sets.mapInArrow(tidy(_prefix_job()), "gram long, node binary, n long, unique long, at long, before array<long>"), "prefixes")
    # A shingle in the prefix of a single node joins nothing.
    wide = prefixes.groupBy("gram").agg(F.count("*").alias("nodes")).where("nodes > 1")
    prefixes = materialize(prefixes.join(wide, "gram"), "shared-prefixes")
    turn = F.pmod(F.xxhash64("gram"), F.lit(PICKS))
    pick = prefixes.groupBy("gram").agg(F.min_by(F.struct("node", "n", "unique", "at"), F.struct("unique", F.xxhash64("node", turn))).alias("p")).select("gram", "p.*")
    met = prefixes.alias("x").join(pick.alias("y"), "gram").where((F.col("x.node") != F.col("y.node")) & _passes("x", "y"))
    met_pairs = materialize(met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "picked-pairs")
    links = _verified(met_pairs, sets, "picked-links")
    labels = components(links)
    # Shingles whose nodes are not all in one component yet; a node without a link is its own.
    named = materialize(prefixes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "named-prefixes")
    held = named.groupBy("gram", "label").agg(F.count("*").alias("k"))
    apart = held.groupBy("gram").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.sum("k").alias("held"), F.count("*").alias("labels")).where("labels > 1")
    rest = named.join(apart.select("gram", "main", F.ceil(F.col("held") / CELL_NODES).cast("int").alias("cells")), "gram")
    # Nodes beside the shingle's main component meet all others; of a frequent shingle, in several cells.
    few = rest.where("label <> main").withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    every = rest.withColumn("cell", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int"))
    pairs = few.alias("x").join(every.alias("y"), (F.col("x.gram") == F.col("y.gram")) & (F.col("x.cell") == F.col("y.cell")) & (F.col("x.label") != F.col("y.label")) & _passes("x", "y", first=True))
    pairs = pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct().join(met_pairs, ["a", "b"], "left_anti")
    return components(links.unionByName(_verified(pairs, sets, "open-links")), "final-labels")


def _named(docs: DataFrame) -> DataFrame:
    """``node, doc_id, n, label`` of every row: its text's digest, its shingles, and its component's least node."""
    rows = texts(docs).withColumn("node", F.unhex(F.md5("text")))
    # Copies are put together before texts move; a text moves once.
    nodes = rows.groupBy("node").agg(F.any_value("text").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sized = materialize(shared_sets(nodes, size), "shared-sets")
    labels = linked_nodes(sized.where("grams IS NOT NULL"))
    return rows.select("doc_id", "node").join(sized.select("node", "n"), "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; ``component_id`` is the smallest id reachable by links."""
    named = _named(docs)
    # Ids of a component: reduced by label first, as one component may hold a third of all rows.
    least = named.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "label", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, that of its smallest id (null last), then of its least text digest; all columns kept.

    Rows are told apart by id and text, so a text whose id another text shares is judged by itself.  Of rows
    that agree in both, any one stays.  Rows without words stay as they are.
    """
    named = materialize(_named(docs), "named-rows").where("n > 0")
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")
    kept = named.groupBy("label").agg(F.min(key).alias("kept"))
    each = named.groupBy("label", "doc_id", "node").agg(F.count("*").alias("rows")).join(kept, "label").withColumn("stays", key == F.col("kept"))
    each = materialize(each.where("NOT stays OR rows > 1").select("doc_id", "node", "stays"), "duplicate-rows")
    each = each.select(F.xxhash64("doc_id", "node").alias("key"), "doc_id", "node", "stays")
    # Only rows whose key may be there are joined; the others, most of the texts, do not move.
    mine = {c: f"{c}_{uuid.uuid4().hex}" for c in ("key", "doc_id", "node", "stays")}
    each = each.toDF(*mine.values())
    own, node = docs["doc_id"].cast("long"), F.unhex(F.md5(docs["text"].cast("string")))
    keyed = docs.withColumns({mine["key"]: F.xxhash64(own, node)})
    held = marks(each, mine["key"])
    far = keyed.mapInArrow(marked_job(mine["key"], held, wanted=False), keyed.schema)
    near = keyed.mapInArrow(marked_job(mine["key"], held), keyed.schema)
    here = near["doc_id"].cast("long").eqNullSafe(each[mine["doc_id"]]) & (F.unhex(F.md5(near["text"].cast("string"))) == each[mine["node"]])
    out = far.unionByName(near.join(each, here, "left_anti"))
    if not each.where(mine["stays"]).isEmpty():
        same = near.join(each.where(mine["stays"]), here, "left_semi")
        out = out.unionByName(same.withColumn(mine["node"], F.md5("text")).dropDuplicates(["doc_id", mine["node"]]).drop(mine["node"]))
    return out.drop(mine["key"])
