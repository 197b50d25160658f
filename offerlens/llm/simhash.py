"""Near-duplicates by SimHash, found with a Gray-order hierarchical index.

A fingerprint has 64 bits; two are linked if at most ``distance`` bits differ. The index is a forest. Each tree
fixes some of ``parts`` equal slices of the bits as the masked pattern of its uppermost nodes: all choices of
``parts - distance`` slices, so two linked fingerprints share the uppermost node of at least one tree. Within a tree
the fingerprints are sorted by Gray rank with the fixed bits in front, which keeps similar ones together. Runs of
``FAN`` neighbours are nodes, runs of ``FAN`` nodes their parents; a node stores the bits all its members share (mask
and pattern). Two nodes are compared top down: bits that both share, and that their parents did not, add their
differences to those counted so far, and whole pairs of groups are pruned once the sum passes ``distance``. At the
leaves the sum is the exact distance.

Spark sorts the forest by range, so an uppermost node of any size is cut between tasks and into blocks of at most
``BLOCK``. Blocks of one uppermost node meet in pairs that the masked patterns do not rule out. A task returns a
spanning forest of the links it finds, never the links themselves, so a group of near copies yields as many rows as
it has members.

Defined results: null and empty texts have the fingerprint zero and are linked like any other. A text with fewer
words than a shingle is one shingle. Equal fingerprints are one class. Null ids take part; ``component_id`` is the
smallest id that is not null, null if there is none. Repeated rows are returned as often as they are given, extra
columns are ignored, an empty table gives no rows. Texts of any length are hashed whole, in pieces of bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import components, keyed, store

#: words of a shingle, and the seed of its hash
WORDS, SEED = 4, 42
#: children of a node, members of a block, rows of sorted fingerprints and pairs of nodes held at once
FAN, BLOCK, SHEET, PAIRS = 16, 4096, 65_536, 262_144
#: fingerprints an uppermost node is planned to have at most; more bits are fixed where it would have more
NODE = 256
#: shingles hashed at once
PIECE = 65_536
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes) -> int:
    """The 64 bits that are set in over half of the hashes of the text's shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    stop = np.cumsum([len(w) + 1 for w in words]) - 1
    start = np.r_[0, stop[:-1] + 1]
    line, n = b" ".join(words), len(words) - WORDS + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        upto = min(at + PIECE, n)
        cuts = zip(start[at:upto].tolist(), stop[at + WORDS - 1 : upto + WORDS - 1].tolist())
        h = np.array(list(map(xxhash.xxh64_intdigest, [line[i:j] for i, j in cuts], repeat(SEED))), np.uint64)
        for byte, column in enumerate(h.view(np.uint8).reshape(-1, 8).T):
            ones[8 * byte : 8 * byte + 8] += np.bincount(column, minlength=256) @ _BITS
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        bits = np.array([fingerprint(t.as_py() or b"") for t in texts], np.uint64).view(np.int64)
        yield pa.record_batch(
            [batch.column("row"), batch.column("doc_id"), pa.array(bits, pa.int64())], names=["row", "doc_id", "bits"]
        )


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def gray_code(ranks: np.ndarray) -> np.ndarray:
    return ranks ^ (ranks >> np.uint64(1))


def slices(parts: int) -> list[tuple[int, int]]:
    """``parts`` slices (lowest bit, width) of the 64 bits, as equal as can be."""
    edges = [64 * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def trees(parts: int, distance: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Per tree: the slices in the order in which they are read from the top, and the number of fixed bits."""
    cut = slices(parts)
    out = []
    for front in combinations(range(parts), parts - distance):
        order = [cut[i] for i in (*front, *(i for i in range(parts) if i not in front))]
        out.append((order, sum(cut[i][1] for i in front)))
    return out


def n_parts(n: int, distance: int) -> int:
    """The fewest slices with which an uppermost node has at most ``NODE`` of ``n`` evenly spread fingerprints."""
    parts = distance + 1
    while parts < 12 and n >> min(bits for _, bits in trees(parts, distance)) > NODE:
        parts += 1
    return parts


def reordered(codes: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros_like(codes)
    for low, width in order:
        out = (out << np.uint64(width)) | ((codes >> np.uint64(low)) & np.uint64((1 << width) - 1))
    return out


def restored(codes: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    out, rest = np.zeros_like(codes), codes.copy()
    for low, width in reversed(order):
        out |= (rest & np.uint64((1 << width) - 1)) << np.uint64(low)
        rest >>= np.uint64(width)
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers as signed ones of the same order."""
    return (x ^ np.uint64(1 << 63)).view(np.int64)


def _unsigned(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def _placed(parts: int, distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("bits").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i, (order, _) in enumerate(trees(parts, distance)):
                rank = _signed(gray_rank(reordered(codes, order)))
                yield pa.record_batch([pa.array(np.full(len(rank), i, np.int32)), pa.array(rank)], names=["tree", "rank"])

    return run


class Index:
    """Nodes over sorted codes: level 0 has the codes, the last level one node for each run that starts in ``heads``."""

    def __init__(self, codes: np.ndarray, heads: np.ndarray):
        self.first = [np.arange(len(codes) + 1)]  # children of node i of a level: first[i] to first[i + 1] one below
        self.mask, self.pattern = [np.full(len(codes), _ALL)], [codes]
        low, high, run = codes, codes, heads
        while True:
            size = len(low)
            place = np.arange(size) - np.repeat(run, np.diff(np.r_[run, size]))
            start = np.flatnonzero(place % FAN == 0)
            low, high = np.bitwise_and.reduceat(low, start), np.bitwise_or.reduceat(high, start)
            self.first.append(np.r_[start, size])
            self.mask.append(~(low ^ high))
            self.pattern.append(low)
            if len(start) == len(run):
                return
            run = np.searchsorted(start, run)

    @property
    def tops(self) -> np.ndarray:
        return np.arange(len(self.pattern[-1]))


def _met(one: Index, two: Index, level: int, a, b, sum_, distance: int, labels=None):
    """Leaf pairs (i, j) under the node pairs (a, b) that differ in at most ``distance`` bits; ``sum_`` are the
    differences counted so far. Yields bounded arrays. Where ``one is two`` every pair comes once."""
    stack = [(level, a, b, sum_)]
    while stack:
        level, a, b, sum_ = stack.pop()
        if level == 0:
            yield a, b
            continue
        f, g = one.first[level], two.first[level]
        na, nb = f[a + 1] - f[a], g[b + 1] - g[b]
        total = np.cumsum(na * nb)
        if len(a) > 1 and total[-1] > PAIRS:
            cut = max(1, int(np.searchsorted(total, PAIRS)))
            stack.append((level, a[cut:], b[cut:], sum_[cut:]))
            a, b, sum_, na, nb, total = a[:cut], b[:cut], sum_[:cut], na[:cut], nb[:cut], total[:cut]
        each = np.repeat(np.arange(len(a)), na * nb)
        nth = np.arange(total[-1]) - (total - na * nb)[each]
        i, j = f[a][each] + nth // nb[each], g[b][each] + nth % nb[each]
        if one is two:
            keep = (a[each] != b[each]) | ((i < j) if level == 1 else (i <= j))
            i, j, each = i[keep], j[keep], each[keep]
        if level == 1 and labels is not None:
            open_ = labels[0][i] != labels[1][j]
            i, j, each = i[open_], j[open_], each[open_]
        known = one.mask[level][a[each]] & two.mask[level][b[each]]
        fresh = one.mask[level - 1][i] & two.mask[level - 1][j] & ~known
        now = sum_[each] + np.bitwise_count((one.pattern[level - 1][i] ^ two.pattern[level - 1][j]) & fresh)
        keep = now <= distance
        if keep.any():
            stack.append((level - 1, i[keep], j[keep], now[keep]))


def _united(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of i and j; a label is the smallest member."""
    a, b = labels[i], labels[j]
    while True:
        differ = a != b
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up
        a, b = labels[a], labels[b]


def _within(codes: np.ndarray, heads: np.ndarray, distance: int) -> np.ndarray:
    """Component label (smallest index) of each code, by links within the runs that start at ``heads``."""
    labels = np.arange(len(codes))
    index = Index(codes, heads)
    top, level = index.tops, len(index.first) - 1
    sum_ = np.zeros(len(top), np.int64)
    for i, j in _met(index, index, level, top, top, sum_, distance, (labels, labels)):
        _united(labels, i, j)
    return labels


_FOUND = "x long, y long, tree int, node long, block long, mask long, pattern long, members binary"


def _rows(x=(), y=(), blocks=()) -> pa.RecordBatch:
    """Links, then blocks (tree, node, first rank, mask, pattern, members)."""
    n, m = len(x), len(blocks)
    cols = list(zip(*blocks)) or [()] * 6
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    ends = [pa.concat_arrays([pa.array(np.asarray(e, np.int64)), pa.nulls(m, pa.int64())]) for e in (x, y)]
    rest = [pa.concat_arrays([pa.nulls(n, k), pa.array(c, k)]) for c, k in zip(cols, kinds)]
    return pa.record_batch(ends + rest, names=["x", "y", "tree", "node", "block", "mask", "pattern", "members"])


def _blocks(parts: int, distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by (tree, rank): a spanning forest of the links within each block, and those blocks whose
        uppermost node may go on in another block."""
        forest = trees(parts, distance)
        fixed = np.array([bits for _, bits in forest], np.uint64)

        def linked(tree, rank, whole):
            """``whole``: per row, whether its node lies entirely in these rows."""
            node = rank >> (np.uint64(64) - fixed[tree])
            new = np.r_[True, (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])]
            run_at = np.flatnonzero(new)
            place = np.arange(len(rank)) - np.repeat(run_at, np.diff(np.r_[run_at, len(rank)]))
            heads = np.flatnonzero(place % BLOCK == 0)
            codes = gray_code(rank)
            labels = _within(codes, heads, distance)
            bound = np.r_[heads, len(rank)]
            sizes = np.diff(np.r_[run_at, len(rank)])
            out = []
            big = np.repeat(sizes > BLOCK, sizes)
            for k in np.flatnonzero(~whole[heads] | big[heads]):
                part = codes[bound[k] : bound[k + 1]]
                low, high = np.bitwise_and.reduce(part), np.bitwise_or.reduce(part)
                as_long = np.array([node[heads[k]], rank[heads[k]], ~(low ^ high), low]).view(np.int64).tolist()
                out.append((int(tree[heads[k]]), *as_long, part.tobytes()))
            one = np.flatnonzero(labels != np.arange(len(labels)))
            x, y = np.empty((2, len(one)), np.uint64)
            for t in np.unique(tree[one]):
                at = tree[one] == t
                x[at] = restored(codes[one[at]], forest[t][0])
                y[at] = restored(codes[labels[one[at]]], forest[t][0])
            return _rows(x.view(np.int64), y.view(np.int64), out)

        tree, rank = np.empty(0, np.int32), np.empty(0, np.uint64)
        edge = None  # the first node of the task, and any node cut at a sheet's end, may go on elsewhere

        def sheet(tree, rank, last):
            nonlocal edge
            node = rank >> (np.uint64(64) - fixed[tree])
            if edge is None:
                edge = (tree[0], node[0])
            open_ = (tree == edge[0]) & (node == edge[1])
            cut = len(rank)
            if not last:
                tail = np.flatnonzero((tree != tree[-1]) | (node != node[-1]))
                at = int(tail[-1]) + 1 if len(tail) else 0
                if cut - at < SHEET:
                    cut = at
                else:
                    edge = (tree[-1], node[-1])
                    open_[at:] = True
            else:
                open_ |= (tree == tree[-1]) & (node == node[-1])
            return (linked(tree[:cut], rank[:cut], ~open_[:cut]) if cut else None), tree[cut:], rank[cut:]

        for batch in batches:
            tree = np.r_[tree, batch.column("tree").to_numpy(zero_copy_only=False)]
            rank = np.r_[rank, _unsigned(batch.column("rank").to_numpy(zero_copy_only=False))]
            if len(rank) >= SHEET:
                out, tree, rank = sheet(tree, rank, False)
                if out is not None:
                    yield out
        if len(rank):
            yield sheet(tree, rank, True)[0]

    return run


def _across(parts: int, distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A spanning forest of the links between two blocks."""
        forest = trees(parts, distance)
        for batch in batches:
            for t, one, two in zip(batch.column("tree").to_pylist(), batch.column("one"), batch.column("two")):
                left, right = (np.frombuffer(m.as_py(), np.uint64) for m in (one, two))
                a, b = Index(left, np.zeros(1, np.int64)), Index(right, np.zeros(1, np.int64))
                labels = np.arange(len(left) + len(right))
                views = labels[: len(left)], labels[len(left) :]
                # the lower tree is entered through a chain of its single top node
                level = max(len(a.first), len(b.first)) - 1
                for index in (a, b):
                    while len(index.first) - 1 < level:
                        index.first.append(np.array([0, 1]))
                        index.mask.append(index.mask[-1])
                        index.pattern.append(index.pattern[-1])
                shared = a.mask[-1] & b.mask[-1]
                start = np.bitwise_count((a.pattern[-1] ^ b.pattern[-1]) & shared).astype(np.int64)
                top = np.zeros(1, np.int64)
                for i, j in _met(a, b, level, top, top, start, distance, views):
                    _united(labels, i, len(left) + j)
                codes = restored(np.r_[left, right], forest[t][0]).view(np.int64)
                found = np.flatnonzero(labels != np.arange(len(labels)))
                yield pa.record_batch([pa.array(codes[found]), pa.array(codes[labels[found]])], names=["x", "y"])

    return run


def linked_fingerprints(bits: DataFrame, distance: int = 4, parts: int | None = None) -> DataFrame:
    """``(x, y)``: links between distinct fingerprints ``bits (bits long)`` that connect all that are within
    ``distance`` bits of each other, directly or through others."""
    parts = parts or n_parts(bits.count(), distance)
    placed = bits.mapInArrow(_placed(parts, distance), "tree int, rank long")
    sorted_ = placed.repartitionByRange("tree", "rank").sortWithinPartitions("tree", "rank")
    found = store(sorted_.mapInArrow(_blocks(parts, distance), _FOUND), "forest")
    blocks = found.where("block is not null")
    # bits that both blocks share in every member rule pairs out before members move
    keys = store(blocks.select("tree", "node", "block", "mask", "pattern"), "blocks")
    one, two = keys.alias("one"), keys.alias("two")
    apart = F.expr("bit_count((one.pattern ^ two.pattern) & one.mask & two.mask)")
    pairs = one.join(
        two, F.expr("one.tree = two.tree and one.node = two.node and one.block < two.block") & (apart <= distance)
    ).select("one.tree", F.col("one.block").alias("a"), F.col("two.block").alias("b"))
    with_one = pairs.join(blocks.select("tree", F.col("block").alias("a"), F.col("members").alias("one")), ["tree", "a"])
    both = with_one.join(blocks.select("tree", F.col("block").alias("b"), F.col("members").alias("two")), ["tree", "b"])
    between = both.select("tree", "one", "two").mapInArrow(_across(parts, distance), "x long, y long")
    return store(found.where("x is not null").select("x", "y").union(between), "links")


def near_duplicates(documents: DataFrame, distance: int = 4, parts: int | None = None) -> DataFrame:
    """``(row, doc_id, bits, fingerprint, component_id, kept)``: one row per document.

    ``component_id`` is the smallest doc_id that links reach, the document's own included; the first row with it is
    kept. Classes that hold over a thousandth of all rows are joined by broadcast: there are at most a thousand."""
    docs = store(keyed(documents).mapInArrow(_fingerprints, "row long, doc_id long, bits long"), "bits")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), F.col("row").alias("at"))
    classes = store(docs.groupBy("bits").agg(F.min(order).alias("head"), F.count("*").alias("n")), "classes")
    links = linked_fingerprints(classes.select("bits"), distance, parts)
    heads = classes
    if not links.isEmpty():
        label = components(links).select(F.col("v").alias("bits"), "label")
        member = store(
            classes.join(label, "bits", "left").select("bits", "head", "n", F.coalesce("label", "bits").alias("label")),
            "members",
        )
        least = member.groupBy("label").agg(F.min("head").alias("first"))
        heads = member.join(least, "label").select("bits", F.col("first").alias("head"), "n")
    heads = store(heads, "heads")
    many = F.col("n") > docs.count() // 1000
    hot = F.broadcast(heads.where(many).select("bits", F.col("head").alias("hot")))
    rest = heads.where(~many).select("bits", "head")
    known = docs.join(hot, "bits", "left")
    out = known.where("hot is not null").select("row", "doc_id", "bits", F.col("hot").alias("head"))
    out = out.unionByName(known.where("hot is null").drop("hot").join(rest, "bits").select("row", "doc_id", "bits", "head"))
    return out.select(
        "row",
        "doc_id",
        "bits",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.col("head.doc").alias("component_id"),
        (F.col("head.at") == F.col("row")).alias("kept"),
    )
