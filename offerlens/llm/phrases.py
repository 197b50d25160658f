"""Phrase collocations by Toivonen's method.

A phrase can only be frequent if the phrase without its last word and the one without its first word are. So:

1. Texts are read once and written as chunks: a list of words, and the line of their numbers. Words are counted.
2. A sample of the documents proposes phrases: those that reach a lowered threshold there.
3. A full pass counts, over all documents, every proposed phrase and every phrase of the negative border, that is
   every other phrase both of whose shorter parts are proposed. The border is never listed: an occurrence is in it if
   both shorter parts are in the filter of proposed phrases.
4. Where a border phrase turns out to be frequent, phrases around it may have been missed. A further full pass counts
   those whose shorter parts are both known to be frequent by now and that no pass has counted yet, and so on until
   a pass finds no new phrase that could be part of a longer one.
5. A last pass counts what is frequent by its words.

Steps 2 to 4 know a phrase by a key of 44 bits, a hash, which moves and adds up cheaply: two phrases of one key can
only make a phrase seem more frequent than it is. Step 5 names phrases exactly, so phrases and counts are those of all
documents, whatever sample and hashes are. Filters are Bloom filters of a fixed size (``FILTER`` bits, 8 MB): a false
member only makes a pass count more. Partial counts are added within each task, so a frequent phrase moves once for
each task and no key is hot. Keys move sorted, as differences to the key before, in rows of up to ``RUN`` keys of one
range; a task adds up a range of at most ``RANGE`` keys or so at a time. A corpus with too many keys for that moves
them one by one instead, with the same result.

What a task holds does not depend on how much it reads: a chunk is looked at ``PIECE`` words at a time, a key and its
count wait in one number of 64 bits in a table of ``RANGE`` numbers, phrases by their words leave ``NAMED`` at a time,
and chunks are stored in row groups of ``GROUP`` bytes, as a reader holds a whole one.

Defined results: null and empty texts have no words; a null language counts as ``und``; null ids, repeated rows and
extra columns do not matter, as every row counts; an empty table gives no rows. A language without a candidate
has no rows. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm.common import pick, store

#: fixed values: characters that end a piece; A to Z become small letters
_MARKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _MARKS, bytes(range(97, 123)) + b"\n" * len(_MARKS))
#: bits of a filter; its blocks have ``2**17`` bits, so one block travels as one row of 16 KB
FILTER, BLOCK = 1 << 26, 1 << 17
#: words of a chunk, and of a chunk of the sample; words looked at together, unless nothing ends a piece
CHUNK, PIECE = 1_000_000, 1 << 18
#: bytes of a row group of chunks
GROUP = 1 << 24
#: a hash decides whether a document is in the sample
SAMPLE = 8
#: standard deviations by which a phrase of the least frequency may fall short in the sample
SLACK = 2.5
#: bits of a key, keys in a row, keys added up at once (also those a task holds), ranges at most
BITS, RUN, RANGE, RANGES = 44, 4096, 1 << 21, 1 << 14
#: the other bits of a number that holds a key and a count; phrases by their words that a task holds; rows sent at once
COUNT, NAMED, ROWS = np.uint64(64 - BITS), 1 << 19, 1024
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PHRASE = "lang string, phrase string, words int, n long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def longer_hash(shorter: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of their first words and of their last word."""
    return _mixed(shorter * _ODD + word)


def key(h: np.ndarray, words: int) -> np.ndarray:
    """What a phrase is known by: 41 bits of its hash, and the number of its words in the lowest three bits."""
    return h >> np.uint64(64 - BITS) & ~np.uint64(7) | np.uint64(words)


def word_hash(word: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(word, seed)


def lang_seed(lang: str) -> int:
    return xxhash.xxh32_intdigest(lang.encode())


class Filter:
    """A set of hashes; members are always found, others hardly ever."""

    def __init__(self, blocks: dict[int, bytes]):
        self.blocks = blocks
        self.table = None

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        at = ((h >> np.uint64(3)) % np.uint64(FILTER // BLOCK)).astype(np.int64) * (BLOCK // 8)
        for bit in probes(h):
            out &= (self._bytes()[at + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1 > 0
        return out

    def _bytes(self) -> np.ndarray:
        if self.table is None:
            self.table = np.zeros(FILTER // 8, np.uint8)
            for i, bits in self.blocks.items():
                self.table[i * BLOCK // 8 : (i + 1) * BLOCK // 8] = np.frombuffer(bits, np.uint8)
        return self.table

    def __reduce__(self):
        """Compressed, block by block; a task that reads it holds the table alone."""
        return _unpacked_filter, ({i: pa.compress(b, "zstd", asbytes=True) for i, b in self.blocks.items()},)


def _unpacked_filter(blocks: dict[int, bytes]) -> Filter:
    out = Filter({})
    table = out._bytes()
    for i, bits in blocks.items():
        raw = pa.decompress(bits, BLOCK // 8, "zstd")
        table[i * BLOCK // 8 : (i + 1) * BLOCK // 8] = np.frombuffer(raw, np.uint8)
    return out


def probes(h: np.ndarray) -> list[np.ndarray]:
    """Three bits of its block for each key."""
    return [((h >> np.uint64(s)) % np.uint64(BLOCK)).astype(np.int64) for s in (12, 19, 27)]


def _filter_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by block: each block's bits, one block at a time."""
    block, bits = None, np.zeros(BLOCK // 8, np.uint8)

    def made():
        return pa.record_batch([pa.array([block], pa.int32()), pa.array([bits.tobytes()])], names=["block", "bits"])

    for batch in batches:
        h = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
        at = batch.column("block").to_numpy(zero_copy_only=False)
        for start, stop in _runs(at):
            if at[start] != block:
                if block is not None:
                    yield made()
                block, bits = int(at[start]), np.zeros(BLOCK // 8, np.uint8)
            for bit in probes(h[start:stop]):
                np.bitwise_or.at(bits, bit >> 3, (1 << (bit & 7)).astype(np.uint8))
    if block is not None:
        yield made()


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    if not len(values):
        return []
    cut = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]).tolist()
    return list(zip(cut, cut[1:]))


def filter_of(hashes: DataFrame) -> Filter:
    """The filter of the keys ``hashes (h long)``; it has ``FILTER`` bits, however many members there are."""
    block = F.shiftrightunsigned("h", 3).bitwiseAND(FILTER // BLOCK - 1)
    placed = hashes.withColumn("block", block.cast("int"))
    sorted_ = placed.repartition("block").sortWithinPartitions("block")
    rows = sorted_.select("block", "h").mapInArrow(_filter_blocks, "block int, bits binary")
    return Filter({r.block: bytes(r.bits) for r in rows.collect()})


class Names(dict):
    """Numbers of one language's words; new words are appended to the chunk's list."""

    def __init__(self, chunk: Chunk, lang: str):
        self.chunk, self.lang = chunk, len(chunk.langs)
        chunk.langs.append(lang)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.chunk.words)
        self.chunk.words.append(word)
        self.chunk.lang.append(self.lang)
        return number


class Chunk:
    """Some documents as one line of word numbers; 0 stands between pieces. Words of two languages differ."""

    def __init__(self):
        self.langs, self.words, self.lang = [], [b""], [0]
        self.names: dict[str, Names] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        names = self.names.get(lang)
        if names is None:
            names = self.names[lang] = Names(self, lang)
        number, out = names.__getitem__, [0]
        for piece in text.translate(_FOLD).split(b"\n"):
            words = piece.split()
            if words:
                out += map(number, words)
                out.append(0)
        if len(out) > 1:
            self.parts.append(np.array(out, np.uint32))
            self.size += len(out)

    def row(self, sampled: bool) -> pa.RecordBatch:
        lang, line = (np.asarray(x, np.uint32).tobytes() for x in (self.lang, np.concatenate(self.parts)))
        columns = [
            pa.array([sampled]), pa.array([self.size]), pa.array([self.langs], pa.list_(pa.string())),
            pa.array([self.words], pa.list_(pa.binary())), pa.array([lang]), pa.array([line]),
        ]
        return pa.record_batch(columns, names=["sampled", "size", "langs", "words", "lang", "line"])


_CHUNK = "sampled boolean, size long, langs array<string>, words array<binary>, lang binary, line binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the sample come in chunks of their own."""
    open_ = {False: Chunk(), True: Chunk()}
    for batch in batches:
        langs, sampled = batch.column("lang").to_pylist(), batch.column("sampled").to_pylist()
        for lang, some, text in zip(langs, sampled, batch.column("text").cast(pa.binary())):
            text = text.as_py()
            if text:
                open_[some].add(lang, text)
                if open_[some].size >= CHUNK:
                    yield open_[some].row(some)
                    open_[some] = Chunk()
    for some, chunk in open_.items():
        if chunk.size:
            yield chunk.row(some)


class Line:
    """A chunk that was read back."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        self.langs = batch.column("langs")[at].values
        self.words = batch.column("words")[at].values
        lang, self.line = (np.frombuffer(batch.column(c)[at].as_buffer(), np.uint32) for c in ("lang", "line"))
        self.lang = lang.astype(np.int64)
        seeds = [lang_seed(x) for x in self.langs.to_pylist()]
        hashes = [word_hash(w, seeds[i]) for w, i in zip(self.words.to_pylist(), self.lang.tolist())]
        self.hashes = np.array(hashes, np.uint64)
        self.flags = None

    def pieces(self) -> Iterator[Line]:
        """The line in parts of about ``PIECE`` words, each with the counts of its own words; no phrase crosses them."""
        line, ends = self.line, np.flatnonzero(self.line == 0)
        at = np.searchsorted(ends, np.arange(PIECE, len(line), PIECE))
        cuts = [0, *np.unique(ends[at[at < len(ends)]]).tolist(), len(line)]
        for start, stop in zip(cuts, cuts[1:]):
            self.line = line[start:stop].astype(np.int64)
            self.count = np.bincount(self.line, minlength=len(self.words))
            self.count[0] = 0
            yield self

    def levels(self, most: int, usable):
        """Per length from 2: the shorter phrase and the last word of each distinct phrase (numbers of the level
        before, and of words), its key and its count. ``usable(words, keys, shorter, rest)`` tells which phrases may
        be parts of longer ones; ``shorter`` and ``rest`` number the phrases without the last and the first word."""
        ok = usable(1, key(self.hashes, 1), None, None)
        ok[0] = False
        name, hashes = self.line, self.hashes
        for words in range(2, most + 1):
            # the two shorter phrases start at i and i + 1
            both = np.flatnonzero(ok[name[:-1]] & ok[name[1:]])
            if not len(both):
                return
            last = self.line[both + words - 1]
            pair, at, count = np.unique(name[both] << 32 | last, return_inverse=True, return_counts=True)
            shorter, last = pair >> 32, pair & 0xFFFFFFFF
            rest = np.zeros(len(pair), np.int64)
            rest[at] = name[both + 1]
            hashes = longer_hash(hashes[shorter], self.hashes[last])
            keys = key(hashes, words)
            part = usable(words, keys, shorter, rest)
            yield words, shorter, last, keys, count
            # numbers of this level; the last one stands for all other places
            following = np.full(len(self.line) - words + 1, len(pair))
            following[both] = at
            name, ok = following, np.r_[part, False]
            hashes = np.r_[hashes, np.uint64(0)]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[Line]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield from Line(batch, at).pieces()


def added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[start], np.add.reduceat(n, start)


def numbers(keys: np.ndarray, n: np.ndarray) -> Iterator[np.ndarray]:
    """A key and its count in one number, which sorts by key; a count that needs more bits takes several numbers."""
    while len(keys):
        some = np.minimum(n, 1 << int(COUNT))
        yield keys << COUNT | (some - 1).astype(np.uint64)
        left = n > some
        keys, n = keys[left], (n - some)[left]


def summed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``added``, of ``numbers``, which are sorted in place."""
    x.sort()
    keys = x >> COUNT
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    keys = keys[start]
    x &= np.uint64((1 << int(COUNT)) - 1)
    return keys, np.add.reduceat(x, start).astype(np.int64) + np.diff(start, append=len(x))


def planes(x: np.ndarray) -> bytes:
    """Numbers without the bytes that are zero in all of them, all lowest bytes first, compressed."""
    width = max(1, -(-int(x.max()).bit_length() // 8))
    raw = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + pa.compress(raw, "zstd", asbytes=True)


def unplaned(packed: bytes, size: int) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    raw = pa.decompress(packed[1:], packed[0] * size, "zstd", asbytes=True)
    out[:, : packed[0]] = np.frombuffer(raw, np.uint8).reshape(-1, size).T
    return out.reshape(-1).view("<u8").astype(np.uint64)


_RUNS = "part int, size int, keys binary, n binary"


def n_ranges(words: int) -> int:
    return 1 << max(6, (8 * words // RANGE).bit_length())


def _part(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (keys >> np.uint64(BITS - ranges.bit_length() + 1)).astype(np.int64)


def _moved(counted, ranges: int):
    """``counted`` gives (keys, counts) of a task's rows; added up, they leave in rows of one range each."""

    def packed(held):
        keys, n = summed(held)
        part = _part(keys, ranges)
        cuts = [c for a, b in _runs(part) for c in range(a, b, RUN)] + [len(keys)]
        spans = [(a, b) for a, b in zip(cuts, cuts[1:])]
        for at in range(0, len(spans), ROWS):
            rows = [
                (int(part[a]), b - a, planes(np.diff(keys[a:b], prepend=np.uint64(0))), planes(n[a:b]))
                for a, b in spans[at : at + ROWS]
            ]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.record_batch(columns, names=["part", "size", "keys", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = np.empty(RANGE, np.uint64), 0
        for keys, n in counted(batches):
            for new in numbers(keys, n):
                while len(new):
                    some = new[: RANGE - size]
                    held[size : size + len(some)] = some
                    size, new = size + len(some), new[len(some) :]
                    if size == RANGE:
                        yield from packed(held)
                        size = 0
        if size:
            yield from packed(held[:size])

    return run


def _single(counted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in counted(batches):
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    return run


def _enough(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by range: keys whose counts reach ``least``, one range at a time."""
        part, held, size = None, [], 0

        def kept():
            keys, n = added(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            return pa.record_batch([pa.array(keys[n >= least].view(np.int64))], names=["h"])

        for batch in batches:
            for at, m, keys, n in zip(*(batch.column(c) for c in ("part", "size", "keys", "n"))):
                at, m = at.as_py(), m.as_py()
                if at != part and held:
                    yield kept()
                    held, size = [], 0
                part = at
                held.append((np.cumsum(unplaned(keys.as_py(), m)), unplaned(n.as_py(), m).astype(np.int64)))
                size += m
                if size >= 2 * RANGE:  # equal keys of many tasks shrink
                    held = [added(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))]
                    size = len(held[0][0])
        if held:
            yield kept()

    return run


def reached(chunks: DataFrame, counted, least: int, words: int) -> DataFrame:
    """``(h)``: keys whose counts over all chunks, of ``words`` words, reach ``least``."""
    ranges = n_ranges(words)
    if ranges > RANGES:
        rows = chunks.mapInArrow(_single(counted), "h long, n long")
        return rows.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h")
    rows = chunks.mapInArrow(_moved(counted, ranges), _RUNS)
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(_enough(least), "h long")


def _words(batches: Iterator[pa.RecordBatch]):
    for line in _lines(batches):
        some = np.flatnonzero(line.count)
        yield key(line.hashes[some], 1), line.count[some]


def _sampled(words: Filter, most: int):
    def run(batches: Iterator[pa.RecordBatch]):
        """Phrases of at least two words, all of them frequent."""
        for line in _lines(batches):
            every = lambda k, h, *_: words.has(h) if k == 1 else np.ones(len(h), bool)
            for _, _, _, keys, count in line.levels(most, every):
                yield keys, count

    return run


def _counts(most: int, now: Filter, before: list[Filter]):
    """Counts of the phrases whose shorter parts are in ``now``, without those that a pass with one of the filters
    ``before`` has counted."""

    def run(batches: Iterator[pa.RecordBatch]):
        for line in _lines(batches):
            flags: list[np.ndarray] = []  # per filter, now first: which phrases of the level may be parts
            counted = np.zeros(0, bool)

            def usable(k, h, shorter, rest):
                nonlocal flags, counted
                if k == 1:
                    if line.flags is None:  # the same for all parts of a line
                        line.flags = [f.has(h) for f in (now, *before)]
                        for f in line.flags:
                            f[0] = False
                    flags = line.flags
                else:
                    both = [np.r_[f, False][shorter] & np.r_[f, False][rest] for f in flags]
                    counted = np.logical_or.reduce([np.zeros(len(h), bool), *both[1:]])
                    flags = [b & f.has(h) for b, f in zip(both, (now, *before))]
                return flags[0].copy()

            for _, _, _, keys, count in line.levels(most, usable):
                yield keys[~counted], count[~counted]

    return run


def _named(most: int, frequent: Filter):
    """Counts, by their words, of the phrases in ``frequent``, and of all words of a language under the empty phrase."""

    def rows(batches):
        for line in _lines(batches):
            word_lang = pa.array(line.lang)
            total = np.bincount(line.lang, weights=line.count, minlength=len(line.langs)).astype(np.int64)
            yield _phrases(line.langs, pa.array([""] * len(line.langs)), 0, np.zeros(len(total), np.uint64), total)
            keys = key(line.hashes, 1)
            some = np.flatnonzero(frequent.has(keys) & (line.count > 0))
            at = pa.array(some)
            yield _phrases(line.langs.take(word_lang.take(at)), line.words.take(at), 1, keys[some], line.count[some])
            texts, lang = line.words, word_lang
            kept = None

            def usable(k, h, *_):
                nonlocal kept
                kept = frequent.has(h)
                return kept.copy()

            for k, shorter, last, keys, count in line.levels(most, usable):
                texts = pc.binary_join_element_wise(texts.take(pa.array(shorter)), line.words.take(pa.array(last)), b" ")
                lang = lang.take(pa.array(shorter))
                at = pa.array(np.flatnonzero(kept))
                yield _phrases(line.langs.take(lang.take(at)), texts.take(at), k, keys[kept], count[kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Added up within a task."""
        held, size = [], 0
        for part in rows(batches):
            held.append(part)
            size += part.num_rows
            if size >= NAMED:
                held = [_added_phrases(held)]
                size = held[0].num_rows
                if size >= NAMED // 2:
                    yield held[0]
                    held, size = [], 0
        if held:
            yield _added_phrases(held)

    return run


_NAMES = ["lang", "phrase", "words"]


def _phrases(lang: pa.Array, phrase: pa.Array, words: int, keys: np.ndarray, n: np.ndarray) -> pa.Table:
    numbers = [pa.array(np.full(len(n), words, np.int32)), pa.array(keys), pa.array(n.astype(np.int64))]
    return pa.table([lang, phrase.cast(pa.string()), *numbers], names=[*_NAMES, "key", "n"])


def _added_phrases(parts: list[pa.Table]) -> pa.Table:
    """Rows of equal words, added up; where the tables have keys, with those."""
    some = [("key", "min")] if "key" in parts[0].column_names else []
    out = pa.concat_tables(parts).group_by(_NAMES, use_threads=False).aggregate([*some, ("n", "sum")])
    return out.rename_columns([*_NAMES, *[c for c, _ in some], "n"])


def _single_phrases(counted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in counted(batches):
            yield from table.drop_columns("key").to_batches()

    return run


_SPAN = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])


def _moved_phrases(counted, ranges: int):
    """As ``_moved``: phrases leave in rows of one range of keys, compressed, without their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in counted(batches):
            table = table.sort_by("key").combine_chunks()
            part = _part(table.column("key").to_numpy(), ranges)
            spans = [(c, min(c + RUN, b)) for a, b in _runs(part) for c in range(a, b, RUN)]
            whole = table.select(_SPAN.names).to_batches()[0]
            for at in range(0, len(spans), ROWS):
                some = spans[at : at + ROWS]
                raw = [whole.slice(a, b - a).serialize() for a, b in some]
                columns = [
                    pa.array([int(part[a]) for a, _ in some], pa.int32()), pa.array([x.size for x in raw], pa.int32()),
                    pa.array([pa.compress(x, "zstd", asbytes=True) for x in raw], pa.binary()),
                ]
                yield pa.record_batch(columns, names=["part", "size", "phrases"])

    return run


def _enough_phrases(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by range: phrases whose counts reach ``least``, and the numbers of all words."""
        part, held = None, []

        def kept():
            table = _added_phrases(held)
            some = pc.or_(pc.greater_equal(table.column("n"), least), pc.equal(table.column("words"), 0))
            return table.filter(some).to_batches()

        for batch in batches:
            for at, size, packed in zip(*(batch.column(c) for c in ("part", "size", "phrases"))):
                at, size = at.as_py(), size.as_py()
                if at != part and held:
                    yield from kept()
                    held = []
                part = at
                raw = pa.decompress(packed.as_buffer(), size, "zstd")
                held.append(pa.Table.from_batches([pa.ipc.read_record_batch(raw, _SPAN)]))
                if len(held) >= 64:  # equal phrases of many tasks shrink
                    held = [_added_phrases(held)]
        if held:
            yield from kept()

    return run


def named(chunks: DataFrame, most: int, frequent: Filter, support: int, words: int) -> DataFrame:
    """The phrases of the filter by their words; as in ``reached``, many keys move one by one."""
    counted, ranges = _named(most, frequent), n_ranges(words)
    if ranges > RANGES:
        rows = chunks.mapInArrow(_single_phrases(counted), _PHRASE)
        total = rows.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
        return total.where((F.col("n") >= support) | (F.col("words") == 0))
    rows = chunks.mapInArrow(_moved_phrases(counted, ranges), "part int, size int, phrases binary")
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(_enough_phrases(support), _PHRASE)


def _missed(filter_: Filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(~filter_.has(h)))

    return run


def frequent_phrases(
    documents: DataFrame, support: int = 100, most: int = 5, sample: int = SAMPLE, trace: list | None = None
) -> DataFrame:
    """``(lang, phrase, words, n)``: every phrase of up to ``most`` words that occurs ``support`` times or more, and the
    number of all words of a language under the empty phrase. One document in ``sample`` proposes phrases. ``trace``
    receives the number of new phrases of each pass."""
    if not 2 <= most <= 7:
        raise ValueError("phrases have two to seven words")
    docs = documents.select(
        (F.pmod(F.xxhash64(F.monotonically_increasing_id(), "text"), F.lit(sample)) == 0).alias("sampled"),
        F.coalesce(pick(documents, "lang", "string"), F.lit("und")).alias("lang"),
        pick(documents, "text", "string"),
    )
    groups = {"parquet.block.size": GROUP, "parquet.page.size.row.check.min": 1}
    chunks = store(docs.mapInArrow(_chunks, _CHUNK), "chunks", "zstd", groups)
    size = chunks.agg(F.sum("size")).first()[0] or 0
    words = store(reached(chunks, _words, support, size), "words")
    mean = support / sample
    lowered = max(2, int(mean - SLACK * sqrt(mean)))
    some = reached(chunks.where("sampled"), _sampled(filter_of(words), most), lowered, size)
    filters = [filter_of(words.union(some))]
    found = words
    while True:
        new = store(reached(chunks, _counts(most, filters[-1], filters[:-1]), support, size), "phrases")
        if trace is not None:
            trace.append(new.count())
        # a phrase of the greatest length is no part of anything longer
        parts = new.where(F.col("h").bitwiseAND(7) < most)
        if len(filters) == 1:  # phrases around those that the sample proposed are counted already
            parts = parts.mapInArrow(_missed(filters[0]), "h long")
        done = parts.isEmpty()
        found = found.union(new)
        frequent = filter_of(found)
        if done:
            break
        # counted before: by the sample's filter, or by that of the pass before, which has all earlier phrases
        filters = [*filters[:1], *filters[1:][-1:], frequent]
    return named(chunks, most, frequent, support, size)


def collocations(
    documents: DataFrame, support: int = 100, most: int = 5, top: int = 2000, sample: int = SAMPLE
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases of 2 to ``most`` words.

    A phrase of count ``a`` is cut into two parts of counts ``l`` and ``r``; its score is ``floor(1000 a n / (l r))``
    at the cut where that is lowest, the first of equals. A phrase is dropped if a longer one holds all of its
    occurrences. Decimals of 38 digits hold ``1000 a n`` exactly for any corpus below ``10**17`` words."""
    found = store(frequent_phrases(documents, support, most, sample), "frequent")
    wide = "decimal(19,0)"
    whole = found.where("words = 0").select("lang", F.col("n").alias("total"))
    if whole.count() <= 10_000:
        whole = F.broadcast(whole)
    parts = found.where("words > 0").select("lang", "phrase", "words", "n")
    word_list = F.split("phrase", " ", -1)
    longer = found.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), word_list.alias("w"))

    def joined(at, size):
        return F.array_join(F.slice("w", at, size), " ")

    # a phrase that lies in a longer one of equal count lies in one that is one word longer, too
    around = longer.where("words > 2").select(
        "lang",
        F.explode(F.array(joined(F.lit(1), F.col("words") - 1), joined(F.lit(2), F.col("words") - 1))).alias("phrase"),
        F.col("a").alias("held"),
    )
    open_ = (
        longer.select("lang", "phrase", "words", "a", "w", F.lit(0).cast("long").alias("held"))
        .unionByName(around.select("lang", "phrase", F.lit(None).cast("int").alias("words"),
                                   F.lit(None).cast("long").alias("a"), F.lit(None).cast("array<string>").alias("w"), "held"))
        .groupBy("lang", "phrase")
        .agg(F.max("words").alias("words"), F.max("a").alias("a"), F.max("w").alias("w"), F.max("held").alias("held"))
        .where("held < a")
    )
    cuts = open_.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        joined(F.lit(1), F.col("k")).alias("first"),
        joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
    )

    def counts(name, value):
        return parts.select("lang", F.col("phrase").alias(name), F.col("n").alias(value))

    scored = (
        cuts.join(counts("first", "l"), ["lang", "first"])
        .join(counts("rest", "r"), ["lang", "rest"])
        .join(whole, "lang")
        .withColumn("above", F.lit(1000).cast("decimal(4,0)") * F.col("a").cast(wide) * F.col("total").cast(wide))
        .withColumn("score", F.expr(f"above div (cast(l as {wide}) * cast(r as {wide}))"))
    )
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", F.col("total").alias("n"), "a")).alias("b")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("b.a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")
