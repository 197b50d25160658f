"""Removal of repeated passages by external induced sorting of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. As in induced sorting, only
sampled suffixes are sorted by comparison and all others are induced from them:

1. *Sample.* A suffix is sampled where the hash of its first ``SEED`` bytes is the smallest of some ``LENGTH``-byte
   window, the first of equals. Every window so belongs to one sampled suffix in it, equal windows to equal places
   in it, about one suffix in 80 is sampled, and the choice depends on the window's bytes alone.
2. *Discard.* Sampled suffixes whose seed occurs once have no equal window and end here, as unique names end a
   recursion. Texts without others are finished.
3. *Sort.* The rest is pushed, with the bytes around it, into Spark's sort, keyed by suffix: the disk-backed
   priority queue that spills what memory cannot hold and pops tuples in order. Equal seeds meet in one partition.
4. *Induce.* From the popped order and the common prefixes of neighbours, order and common prefixes of the suffixes
   one byte to the left follow: a stable sort by that byte, and one more than the range minimum of what was between.
   Repeated for every byte to the left, this visits every suffix of the windows; neighbours with ``LENGTH`` bytes in
   common are repeats.

Hot seeds: a task first merges equal surroundings, so copies of a document are sent once per task. A seed that
still has more than ``HOT`` different surroundings is not brought together: its suffixes recurse. Every ``RANGE``-th
byte to their left starts a suffix with a seed of ``LENGTH - RANGE + 1`` bytes, tasks merge those with equal
surroundings, and a range sort deals them out, so one seed may spread over many partitions. Where such a seed is hot
itself, or lies at the edge of a partition, the recursion ends with suffixes whose seed is the whole window: equal
ones are neighbours in sorted order, and what lies at partitions' edges, two windows of each, is settled by counting.

Tuples are small against the texts; texts are shuffled once, and those with a repeated seed once more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import keyed, store

LENGTH, SEED = 200, 40
_SEEDS = LENGTH - SEED + 1
#: windows that are sampled at once
SEGMENT = 200_000
#: surroundings of one seed that may meet in a partition; bytes from one suffix of a hot seed's recursion to the next
HOT, RANGE = 1024, 16
_LONGER = LENGTH - RANGE + 1
#: tuples whose ranges are merged together
_MERGED_TUPLES = 500
#: rows that are induced together, and bytes of surroundings that a task merges
ROWS, MERGED = 20_000, 8_000_000
_PER_TASK = 1 << 40
_MASK = np.uint64((1 << 20) - 1)
_B = 0x9E3779B97F4A7C15
#: no UTF-8 text has this byte
_NONE = 0xFF


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Sampler:
    """Sampled suffixes of texts: ``(at, first, last, seed)``, where windows ``first`` to ``last`` belong to the
    suffix ``at`` and ``seed`` is the hash of its first bytes."""

    def __init__(self):
        n = SEGMENT + LENGTH
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.r_[np.uint64(1), np.full(n, _B, np.uint64)])
            self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(_B, -1, 1 << 64), np.uint64)])

    def __call__(self, text: bytes) -> tuple[np.ndarray, ...]:
        whole = np.frombuffer(text, np.uint8)
        windows = len(whole) - LENGTH + 1
        parts = []
        for start in range(0, max(windows, 0), SEGMENT):
            n = min(SEGMENT, windows - start)
            data = whole[start : start + n + LENGTH - 1].astype(np.uint64) + np.uint64(1)
            sums = np.r_[np.uint64(0), np.cumsum(data * self.power[: len(data)])]
            m = len(data) - SEED + 1
            seeds = _mixed((sums[SEED:] - sums[:m]) * self.inverse[:m])
            least = (seeds & ~_MASK) | np.arange(m, dtype=np.uint64)
            width = 1
            while 2 * width <= _SEEDS:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < _SEEDS:
                least = np.minimum(least[: n], least[_SEEDS - width : _SEEDS - width + n])
            at = (least[:n] & _MASK).astype(np.int64)
            head = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            last = np.r_[head[1:], n] - 1
            parts.append((at[head] + start, head + start, last + start, seeds[at[head]].view(np.int64)))
        if not parts:
            return tuple(np.empty(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(p) for p in zip(*parts))


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sampler = Sampler()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        rows = batch.column("row").to_pylist()
        for start in range(0, batch.num_rows, 200):
            found = [sampler(t.as_py() or b"") for t in texts.slice(start, 200)]
            row = np.repeat(rows[start : start + 200], [len(f[0]) for f in found])
            at, first, last, seed = (np.concatenate(c) for c in zip(*found))
            yield pa.record_batch(
                [pa.array(seed), pa.array(row.astype(np.int64)), pa.array(at.astype(np.int32)),
                 pa.array((at - first).astype(np.int16)), pa.array((at - last).astype(np.int16))],
                names=["seed", "row", "at", "far", "near"],
            )


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished rows for texts without a repeated seed; the others keep their text."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        open_ = batch.column("samples").is_valid()
        sha, size = [], []
        for text, more in zip(texts, open_.to_pylist()):
            text = text.as_py() or b""
            size.append(len(text))
            sha.append(None if more else hashlib.sha256(text).hexdigest())
        kept = pc.if_else(open_, texts, pa.scalar(None, pa.binary()))
        yield pa.record_batch(
            [batch.column("row"), batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(sha, pa.string()), kept,
             batch.column("samples")],
            names=["row", "doc_id", "n_bytes", "sha", "text", "samples"],
        )


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of texts and their samples, the distinct surroundings of a bounded dictionary and the places each stands at."""
    first = TaskContext.get().partitionId() * _PER_TASK
    place = pa.list_(pa.struct([("row", pa.int64()), ("at", pa.int32())]))
    schema = pa.schema(
        [("slot", pa.int64()), ("seed", pa.int64()), ("left", pa.binary()), ("right", pa.binary()), ("far", pa.int16()),
         ("near", pa.int16()), ("places", place)]
    )
    slots: dict[tuple, list] = {}
    held = 0

    def sent() -> pa.RecordBatch:
        cols = [range(first, first + len(slots)), *zip(*slots), slots.values()]
        return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)

    for batch in batches:
        for row, text, samples in zip(
            batch.column("row").to_pylist(), batch.column("text"), batch.column("samples").to_pylist()
        ):
            text = text.as_py()
            for s in sorted(samples, key=lambda s: s["at"]):
                at, far, near = s["at"], s["far"], s["near"]
                right = text[at : at + LENGTH - near].ljust(LENGTH, bytes([_NONE]))
                key = (s["seed"], text[at - far : at], right, far, near)
                places = slots.get(key)
                if places is None:
                    places = slots[key] = []
                    held += 2 * LENGTH + 300
                places.append({"row": row, "at": at})
                held += 250
                if held > MERGED:
                    yield sent()
                    first += len(slots)
                    slots, held = {}, 0
    if slots:
        yield sent()


_CONTEXT = (
    "slot long, seed long, left binary, right binary, far short, near short, places array<struct<row: long, at: int>>"
)


def induced(left: np.ndarray, right: np.ndarray, far: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes in sorted order, the smallest and largest distance to the left at which a window that belongs
    to them equals another one; -1 where none does.

    ``right[i]`` has the suffix's first ``LENGTH`` bytes, ``left[i, j]`` the byte ``j + 1`` to its left."""
    n = len(right)
    low, high = np.full(n, -1), np.full(n, -1)
    differ = right[1:] != right[:-1]
    common = np.where(differ.any(1), differ.argmax(1), LENGTH) if n > 1 else np.empty(0, np.int64)
    order = np.arange(n)
    # common[i]: bytes that the suffixes order[i - 1] and order[i] share, LENGTH at most
    common = np.r_[0, common].astype(np.uint8)
    for distance in range(int(far.max(initial=-1)) + 1):
        if distance:
            stays = far[order] >= distance
            if not stays.all():
                # dropping a suffix leaves the smaller of the prefixes on its two sides
                kept = np.flatnonzero(stays)
                if not len(kept):
                    break
                common = np.minimum.reduceat(common[: kept[-1] + 1], np.r_[0, kept[:-1] + 1])
                common[0] = 0
                order = order[kept]
            byte = left[order, distance - 1]
            sorted_ = np.argsort(byte, kind="stable")
            same = byte[sorted_[1:]] == byte[sorted_[:-1]]
            least = _range_minima(common, sorted_[:-1][same] + 1, sorted_[1:][same])
            common = np.zeros(len(order), np.uint8)
            common[1:][same] = np.minimum(least, LENGTH - 1) + 1
            order = order[sorted_]
        full = common >= LENGTH
        repeats = full | np.r_[full[1:], False]
        mine = order[repeats]
        mine = mine[near[mine] <= distance]
        low[mine] = np.where(low[mine] < 0, distance, low[mine])
        high[mine] = distance
    return low, high


def _range_minima(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Minima of ``values[start : stop + 1]``, ``start <= stop``, by doubling."""
    out = np.empty(len(start), values.dtype)
    level = np.log2(stop - start + 1).astype(np.int64)
    table, width = values, 1
    for k in range(int(level.max(initial=-1)) + 1):
        mine = level == k
        out[mine] = np.minimum(table[start[mine]], table[stop[mine] - width + 1])
        table = np.minimum(table[:-width], table[width:]) if len(table) > width else table
        width *= 2
    return out


def _bytes_matrix(rows: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(r.ljust(width, bytes([_NONE])) for r in rows), np.uint8).reshape(len(rows), width)


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pops tuples sorted by (shard, right) and induces them, some thousand at a time, never parting a shard: equal
    windows are in one shard, and between shards common prefixes are only underrated."""
    held: list[tuple] = []

    def done(rows: list[tuple]) -> pa.RecordBatch:
        slot, left, right, far, near, _ = zip(*rows)
        far, near = np.array(far, np.int64), np.array(near, np.int64)
        low, high = induced(
            _bytes_matrix([x[::-1] for x in left], max(1, int(far.max()))), _bytes_matrix(list(right), LENGTH), far, near
        )
        found = low >= 0
        return pa.record_batch(
            [pa.array(np.array(slot, np.int64)[found]), pa.array(low[found]), pa.array(high[found])],
            names=["slot", "low", "high"],
        )

    for batch in batches:
        held += zip(*(batch.column(c).to_pylist() for c in ("slot", "left", "right", "far", "near", "shard")))
        if len(held) >= ROWS:
            cut = len(held) - 1
            while cut > 0 and held[cut][5] == held[cut - 1][5]:
                cut -= 1
            if cut:
                yield done(held[:cut])
                held = held[cut:]
    if held:
        yield done(held)


_RANGES = "slots array<long>, lead long, base int, near int, left binary, right binary"
_ENDS = "slot long, low long, high long, window binary"
_ENDS_ARROW = pa.schema([("slot", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("window", pa.binary())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _ENDS_ARROW)], schema=_ENDS_ARROW)


def _longer_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of hot tuples, the suffixes that start ``base`` bytes to their left with the windows up to the next ``base``;
    equal ones of some tuples are merged and list their slots."""
    schema = pa.schema(
        [("slots", pa.list_(pa.int64())), ("lead", pa.int64()), ("base", pa.int32()), ("near", pa.int32()),
         ("left", pa.binary()), ("right", pa.binary())]
    )
    for whole in batches:
        for start in range(0, whole.num_rows, _MERGED_TUPLES):
            batch = whole.slice(start, _MERGED_TUPLES)
            merged: dict[tuple, list[int]] = {}
            columns = (batch.column(c).to_pylist() for c in ("slot", "left", "right", "far", "near"))
            for slot, left, right, far, near in zip(*columns):
                around = left + right
                for base in range(near // RANGE * RANGE, far + 1, RANGE):
                    at = far - base
                    key = base, max(near - base, 0), around[max(at - RANGE + 1, 0) : at], around[at : at + LENGTH]
                    merged.setdefault(key, []).append(slot)
            slots = list(merged.values())
            cols = [slots, [s[0] for s in slots], *zip(*merged)] if merged else [()] * 6
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


class _Hot:
    """Pops suffixes with longer seeds in sorted order; ``rows`` gathers what is known of their windows.

    Neighbours that agree in everything repeat in all their windows, and one of them goes on as a witness without a
    slot. The others of a seed are induced together, or their windows are sent one by one."""

    def __init__(self):
        self.rows: list[tuple] = []
        #: [right, left, near, base, slot]: different suffixes of the seed at hand, and of finished seeds
        self.run: list[list] = []
        self.ready: list[list] = []
        self.edge, self.hot = True, False

    def push(self, slots: list[int], base: int, near: int, left: bytes, right: bytes) -> None:
        if self.run and right[:_LONGER] != self.run[-1][0][:_LONGER]:
            self.finish(self.edge)
            self.edge = False
        equal = self.run[-1] if self.run and self.run[-1][:2] == [right, left] else None
        if equal is None:
            self.run.append([right, left, near, base, slots[0] if len(slots) == 1 else None])
        elif equal[4] is not None:
            self.rows.append((equal[4], equal[3] + near, equal[3] + len(left), None))
            equal[4] = None
        if equal is not None or len(slots) > 1:
            self.rows += [(slot, base + near, base + len(left), None) for slot in slots]
        self.hot = self.hot or len(self.run) > HOT
        if self.hot:
            # the last one may have equals yet to come
            self.send(self.run[:-1])
            self.run = self.run[-1:]

    def finish(self, edge: bool) -> None:
        """The seed at hand is complete in this partition; at its edge it may go on in another."""
        if edge or self.hot:
            self.send(self.run)
        elif len(self.run) > 1:
            self.ready += self.run
        self.run, self.hot = [], False
        if len(self.ready) >= ROWS:
            self.induce()

    def send(self, suffixes: list[list]) -> None:
        for right, left, near, base, slot in suffixes:
            around, far = left + right, len(left)
            for d in range(near, far + 1):
                self.rows.append((slot, base + d, base + d, around[far - d : far - d + LENGTH]))

    def induce(self) -> None:
        if not self.ready:
            return
        right, left, near, base, slot = zip(*self.ready)
        far = np.array([len(x) for x in left], np.int64)
        low, high = induced(
            _bytes_matrix([x[::-1] for x in left], max(1, int(far.max()))), _bytes_matrix(list(right), LENGTH), far,
            np.array(near, np.int64),
        )
        self.rows += [
            (slot[i], base[i] + int(low[i]), base[i] + int(high[i]), None)
            for i in np.flatnonzero(low >= 0).tolist()
            if slot[i] is not None
        ]
        self.ready = []


def _induce_longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(slot, low, high)`` of windows that are settled, and with ``window`` those that are not."""
    hot = _Hot()
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("slots", "base", "near", "left", "right"))):
            hot.push(*row)
            if len(hot.rows) >= ROWS:
                yield _ends(hot.rows)
                hot.rows = []
    hot.finish(True)
    hot.induce()
    if hot.rows:
        yield _ends(hot.rows)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows in sorted order, those with an equal neighbour, and with ``window`` one row for the first and the
    last window of the partition: its slot if it has no equal here, else none."""
    rows: list[tuple] = []
    key, n, held, edge = None, 0, None, True
    for batch in batches:
        for slot, at, window in zip(*(batch.column(c).to_pylist() for c in ("slot", "low", "window"))):
            if window != key:
                if n and edge:
                    rows.append((*(held if n == 1 else (None, 0, 0)), key))
                    edge = False
                key, n, held = window, 0, (slot, at, at)
            elif n == 1 and held[0] is not None:
                rows.append((*held, None))
            n += 1
            if n > 1 and slot is not None:
                rows.append((slot, at, at, None))
        if len(rows) >= ROWS:
            yield _ends(rows)
            rows = []
    if n:
        rows.append((*(held if n == 1 else (None, 0, 0)), key))
    if rows:
        yield _ends(rows)


def _sorted_and_induced(tuples: DataFrame) -> DataFrame:
    """``(slot, low, high)`` of tuples that are sharded by ``shard``."""
    queue = tuples.select("shard", "slot", "left", "right", "far", "near").repartition("shard")
    found = queue.sortWithinPartitions("shard", "right").mapInArrow(_induce, "slot long, low long, high long")
    return store(found, "found")


def _hot(hot: DataFrame) -> DataFrame:
    """``(slot, low, high)`` of surroundings of hot seeds, by recursion with longer seeds."""
    longer = hot.mapInArrow(_longer_seeds, _RANGES)
    order = ["right", "left", "lead"]
    longer = longer.repartitionByRange(*order).sortWithinPartitions(*order)
    longer = store(longer.mapInArrow(_induce_longer, _ENDS), "longer", "zstd")
    windows = longer.where("window IS NOT NULL").repartitionByRange("window", "slot")
    windows = store(windows.sortWithinPartitions("window", "slot").mapInArrow(_neighbours, _ENDS), "windows", "zstd")
    edges = windows.where("window IS NOT NULL").groupBy("window").agg(F.collect_list(F.struct("slot", "low", "high")).alias("rows"))
    edges = edges.where(F.size("rows") > 1).select(F.inline("rows")).where("slot IS NOT NULL")
    settled = [t.where("window IS NULL").select("slot", "low", "high") for t in (longer, windows)]
    every = settled[0].unionByName(settled[1]).unionByName(edges)
    return every.groupBy("slot").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def repeated_spans(documents: DataFrame) -> DataFrame:
    """``(row, doc_id, n_bytes, spans, kept_sha256)``: one row per document.

    ``spans`` are the maximal runs ``(start, stop)`` of UTF-8 bytes of the whole text that a string of ``LENGTH``
    bytes covers which also starts anywhere else, in the same document too; ``kept_sha256`` is the digest of the
    other bytes. A null text counts as empty; texts of fewer than ``LENGTH`` bytes and an empty table have none.
    Repeated rows are rows of their own and repeat each other; ids may be null; other columns are not looked at."""
    docs = keyed(documents)
    samples = store(docs.select("row", "text").mapInArrow(_sample, "seed long, row long, at int, far short, near short"), "samples", "zstd")
    seeds = store(samples.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"), "seeds")
    mine = samples.join(seeds, "seed").groupBy("row").agg(F.collect_list(F.struct("at", "seed", "far", "near")).alias("samples"))
    split = docs.join(mine, "row", "left").mapInArrow(
        _split,
        "row long, doc_id long, n_bytes long, sha string, text binary, "
        "samples array<struct<at: int, seed: long, far: short, near: short>>",
    )
    split = store(split, "split", "zstd")
    open_ = split.where("samples IS NOT NULL").select("row", "text", "samples")
    tuples = store(open_.mapInArrow(_surroundings, _CONTEXT), "tuples", "zstd")
    hot_seeds = tuples.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("seed")
    hot_seeds = store(hot_seeds, "hot-seeds")
    found = _sorted_and_induced(tuples.join(hot_seeds, "seed", "left_anti").withColumnRenamed("seed", "shard"))
    if not hot_seeds.isEmpty():
        found = found.unionByName(_hot(store(tuples.join(hot_seeds, "seed").drop("places"), "hot", "zstd")))
    # surroundings met twice in a dictionary repeat in all their windows
    places = tuples.select("slot", "far", "near", (F.size("places") > 1).alias("repeats"), F.inline("places"))
    # all windows of a suffix have its seed in common, so what they cover is one run
    spans = places.join(found, "slot", "left").where("repeats OR low IS NOT NULL").select(
        "row",
        F.struct(
            (F.col("at") - F.when(F.col("repeats"), F.col("far")).otherwise(F.col("high"))).alias("start"),
            (F.col("at") + LENGTH - F.when(F.col("repeats"), F.col("near")).otherwise(F.col("low"))).alias("stop"),
        ).alias("run"),
    )
    spans = spans.groupBy("row").agg(F.sort_array(F.collect_list("run")).alias("runs"))
    left = split.where("samples IS NOT NULL").select("row", "doc_id", "text").join(spans, "row", "left")
    kept = left.mapInArrow(_kept, _KEPT)
    clean = split.where("samples IS NULL").select(
        "row", "doc_id", "n_bytes", F.array().cast("array<struct<start: long, stop: long>>").alias("spans"), F.col("sha").alias("kept_sha256")
    )
    return clean.unionByName(kept)


_KEPT = "row long, doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept_sha256 string"


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without its spans."""
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        sizes, all_spans, digests = [], [], []
        for text, runs in zip(batch.column("text"), batch.column("runs").to_pylist()):
            text = text.as_py()
            spans: list[list[int]] = []
            for run in runs or ():
                if spans and run["start"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], run["stop"])
                else:
                    spans.append([run["start"], run["stop"]])
            sizes.append(len(text))
            all_spans.append([{"start": a, "stop": b} for a, b in spans])
            digests.append(hashlib.sha256(kept_bytes(text, spans)).hexdigest())
        yield pa.record_batch(
            [batch.column("row"), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(all_spans, kind), pa.array(digests)],
            names=["row", "doc_id", "n_bytes", "spans", "kept_sha256"],
        )
