"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by taking, at each place, the longest prefix that the model's compiled character map knows,
and the original byte at which every normalised byte began is kept. Byte-pair merges then run on the normalised
text, and each piece is projected to the span of original bytes it came from.

Merges never join two characters whose bigram is in no piece of the vocabulary. Cutting a text at such places
gives the same pieces, so each distinct cut is merged once per task and looked up afterwards.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from offerlens.llm.common import keyed

SPACE = "▁"
#: segments that a task remembers
SEGMENTS = 300_000
#: rows of an output batch, and characters after which a batch is sent earlier
ROWS, CHARS = 256, 4_000_000
_ENCODED = "row long, doc_id long, ids array<int>, starts array<int>, n_bytes int, decoded string"


def _each_byte(error: UnicodeError):
    return "�" * (error.end - error.start), error.end


codecs.register_error("each-byte", _each_byte)


#: bits of a symbol's number
BITS = 20
MASK = (1 << BITS) - 1
NONE = 1 << 62
#: words merged at once, and characters of the texts whose words are learnt together
LEARNT, AHEAD = 20_000, 1_000_000


class CharMap:
    """A compiled character map: a double-array trie of prefixes, and their replacements."""

    def __init__(self, compiled: bytes):
        self.units, self.texts = (), b""
        if compiled:
            (size,) = struct.unpack_from("<I", compiled)
            self.units = struct.unpack_from(f"<{size // 4}I", compiled, 4)
            self.texts = compiled[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of ``text[at:]``."""
        found = None
        node = self._offset(self.units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.texts[start : self.texts.index(b"\0", start)]
        return found

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The mapped text, and for each of its bytes (and its end) the original byte it began at."""
        if not self.units:
            return text, np.arange(len(text) + 1)
        out, source, at = bytearray(), [], 0
        while at < len(text):
            found = self.longest(text, at)
            if found:
                out += found[1]
                source += [at] * len(found[1])
                at += found[0]
            else:
                n = 1 + sum(text[at] >= lead for lead in (0xC0, 0xE0, 0xF0))
                out += text[at : at + n]
                source += range(at, at + n)
                at += n
        return bytes(out), np.array([*source, len(text)])


class Pieces:
    """A byte-pair model with byte fallback, read from the bytes of its file.

    Models with user-defined or unused pieces, or that drop or suffix white space, are refused."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        norm = spec.normalizer_spec
        kinds = {p.type for p in spec.pieces}
        if (
            spec.trainer_spec.model_type != 2
            or kinds - {1, 2, 3, 6}
            or 6 not in kinds
            or norm.remove_extra_whitespaces
            or not norm.escape_whitespaces
            or spec.trainer_spec.treat_whitespace_as_suffix
        ):
            raise ValueError("only byte-pair models with byte fallback that keep white space")
        self.map = CharMap(norm.precompiled_charsmap)
        self.dummy = norm.add_dummy_prefix
        self.eos = spec.trainer_spec.eos_id
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == 1}
        self.scores = {p.piece: p.score for p in spec.pieces if p.type == 1}
        self.byte = [0] * 256
        self.surface = [b""] * len(spec.pieces)
        self.control = {i for i, p in enumerate(spec.pieces) if p.type == 3}
        for i, p in enumerate(spec.pieces):
            if p.type == 6:
                value = int(p.piece[3:5], 16)
                self.byte[value], self.surface[i] = i, bytes([value])
            elif p.type == 1:
                self.surface[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == 2:
                self.surface[i] = spec.trainer_spec.unk_surface.encode()
        self.starts_space = {i for p, i in self.ids.items() if p.startswith(SPACE)}
        self.joins = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has white space after other characters")
        #: bytes of the original that a piece spans where a space became the space symbol
        self.bytes = np.array([len(s) for s in self.surface], np.int64)
        #: bytes of the normalised text that a piece spans
        self.normal_bytes = self.bytes.copy()
        for p, i in self.ids.items():
            self.normal_bytes[i] = len(p.encode())
        for i in self.control:
            self.bytes[i] = self.normal_bytes[i] = 0
        self.seen: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self._number_merges()

    def _number_merges(self) -> None:
        """Symbols (pieces, and characters within pieces) as numbers, and what two of them merge to: the rank of its
        score, best first, above its number."""
        chars = {c for p in self.ids for c in p}
        self.symbols = {**self.ids, **{c: len(self.surface) + i for i, c in enumerate(sorted(chars - set(self.ids)))}}
        self.chars = {c: self.symbols[c] for c in chars}
        self.final = [[i] for i in range(len(self.surface))]
        self.final += [[self.byte[b] for b in c.encode()] for c in sorted(chars - set(self.ids))]
        rank = {score: i for i, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.merges: dict[int, int] = {}
        alike: dict[int, int] = {}
        for p, i in self.ids.items():
            merged = rank[self.scores[p]] << BITS | i
            alike[merged >> BITS] = alike.get(merged >> BITS, 0) + 1
            for at in range(1, len(p)):
                left, right = self.symbols.get(p[:at]), self.symbols.get(p[at:])
                if left is not None and right is not None:
                    self.merges[left << BITS | right] = merged
        #: merges whose score another piece has as well
        self.tied = {m for m in self.merges.values() if alike[m >> BITS] > 1}

        known = sorted(self.merges)
        self.pairs = np.array(known, np.int64)
        self.made = np.array([self.merges[k] for k in known], np.int64)
        self.char_table = np.full(0x110000, -1, np.int64)
        for c, i in self.chars.items():
            self.char_table[ord(c)] = i

    def _merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What symbols merge to, ``NONE`` where they do not; -1 is no symbol."""
        pair = left << BITS | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (right >= 0), self.made[at], NONE)

    def learn(self, words: list[str]) -> None:
        """Remember the ids of many short words at once: all of them take their best merge, round by round."""
        if not words:
            return
        words = [SPACE + w for w in words]
        codes = self.char_table[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        size = np.array([len(w) for w in words])
        start = np.cumsum(size) - size
        fine = np.minimum.reduceat(codes, start) >= 0
        tied = np.array(sorted(self.tied), np.int64)
        for low, high in ((0, 5), (5, 8), (8, 12), (12, 20), (20, 32)):
            some = np.flatnonzero(fine & (size > low) & (size <= high))
            if not len(some):
                continue
            place = start[some][:, None] + np.arange(high + 1)
            inside = np.arange(high + 1) < size[some][:, None]
            parts = np.where(inside, codes[np.minimum(place, len(codes) - 1)], -1)
            open_, now, unsure = some, parts, []
            merge = self._merge_of(now[:, :-1], now[:, 1:])
            while len(open_):
                row, at = np.arange(len(open_)), merge.argmin(1)
                best = merge[row, at]
                alike = np.isin(best, tied)
                unsure += open_[alike].tolist()
                go = (best != NONE) & ~alike
                done = ~go & ~alike
                self._remember([words[i] for i in open_[done].tolist()], now[done])
                open_, now, merge, at, best = open_[go], now[go], merge[go], at[go], best[go]
                if not len(open_):
                    break
                row, made = row[: len(open_)], best & MASK
                now[row, at] = made
                columns = np.arange(high)
                now[:, 1:-1] = np.take_along_axis(now, columns[1:] + (columns[1:] > at[:, None]), 1)
                now[:, -1] = -1
                merge[:, :-1] = np.take_along_axis(merge, columns[:-1] + (columns[:-1] > at[:, None]), 1)
                merge[:, -1] = NONE
                left = np.maximum(at - 1, 0)
                merge[row, at] = self._merge_of(made, now[row, at + 1])
                merge[row, left] = np.where(at > 0, self._merge_of(now[row, left], made), merge[row, left])
            for i in unsure:
                self._word(words[i][1:])

    def _remember(self, words: list[str], symbols: np.ndarray) -> None:
        """The ids of words that are merged: their symbols, or the bytes of a character that is no piece."""
        ids = symbols[symbols >= 0].astype(np.int32).tobytes()
        stop = 4 * np.cumsum((symbols >= 0).sum(1))
        odd = (symbols >= len(self.surface)).any(1).tolist()
        start = 0
        for i, (word, end) in enumerate(zip(words, stop.tolist())):
            self.words[word[1:]] = ids[start:end]
            if odd[i]:
                parts = [x for s in symbols[i].tolist() if s >= 0 for x in self.final[s]]
                self.words[word[1:]] = np.array(parts, np.int32).tobytes()
            start = end

    def learn_texts(self, texts: list[str]) -> None:
        """``learn`` the words of some texts that are not known yet."""
        new = set().union(*(t.split(" ") for t in texts)).difference(self.words)
        if len(self.words) + len(new) > SEGMENTS:
            self.words.clear()
            new = set().union(*(t.split(" ") for t in texts))
        new = [w for w in new if 0 < len(w) < 32 and SPACE not in w]
        for at in range(0, len(new), LEARNT):
            self.learn(new[at : at + LEARNT])

    def _merged(self, text: str) -> list[int]:
        """Byte-pair merges by best score, leftmost first."""
        parts: list[str] = list(text)
        if len(parts) > 48:
            return self._merged_long(parts)
        score, none = self.scores.get, -np.inf
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > none:
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = score(parts[at] + parts[at + 1], none)
        return self._numbered(parts)

    def _numbered(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for part in parts:
            if part:
                known = self.ids.get(part)
                out.extend([known] if known is not None else [self.byte[b] for b in part.encode()])
        return out

    def _merged_long(self, parts: list[str]) -> list[int]:
        """The same with a queue, in time that grows little faster than the text."""
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        scores, queue = self.scores, []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (score := scores.get(both := parts[i] + parts[j])) is not None:
                heapq.heappush(queue, (-score, i, j, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if not parts[i] or not parts[j] or right[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return self._numbered(parts)

    def _segment(self, text: str) -> bytes:
        """Ids, 32 bits each, of a run of spaces and what follows it, cut where no piece joins."""
        cuts = [0, *(i for i in range(1, len(text)) if text[i - 1 : i + 1] not in self.joins), len(text)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            part = text[a:b]
            ids = self.seen.get(part)
            if ids is None:
                ids = np.array(self._merged(part), np.int32).tobytes()
                if len(part) < 64:
                    if len(self.seen) >= SEGMENTS // 2:
                        self.seen.clear()
                    self.seen[part] = ids
            out.append(ids)
        return b"".join(out)

    def _word(self, word: str) -> bytes:
        ids = self._segment(SPACE + word)
        if len(word) < 64:
            if len(self.words) >= SEGMENTS:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids with the end id, and the original byte at which each begins (a piece ends where the next begins;
        the space put before the text is empty). An empty text has the end id only."""
        raw = text.encode()
        if not raw:
            return np.array([self.eos], np.int32), np.zeros(1, np.int64)
        end = np.int32(self.eos).tobytes()
        plain = not self.map.units and SPACE not in text
        if plain and self.dummy and text[0] != " " and text[-1] != " " and "  " not in text:
            words = text.split(" ")
            found = list(map(self.words.get, words))
            if None in found:
                found = [self._word(w) if f is None else f for w, f in zip(words, found)]
        else:
            mapped = raw if plain else self.map.normalise(raw)[0]
            spaced = (SPACE if self.dummy else "") + mapped.decode().replace(" ", SPACE)
            found = list(map(self._segment, re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", spaced)))
        ids = np.frombuffer(b"".join([*found, end]), np.int32)
        if plain:
            width = self.bytes[ids]
            starts = np.cumsum(width) - width
            return ids, np.maximum(starts - 1, 0) if self.dummy else starts
        mapped, source = self.map.normalise(raw)
        # a space becomes the three bytes of the space symbol
        wide = np.where(np.frombuffer(mapped, np.uint8) == 32, 3, 1)
        source = np.r_[[0] * (3 if self.dummy else 0), np.repeat(source[:-1], wide), source[-1]]
        return ids, source[np.cumsum(self.normal_bytes[ids]) - self.normal_bytes[ids]]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; control ids are nothing, and an invalid byte is U+FFFD."""
        first = next((i for i in ids if i not in self.control), None)
        data = b"".join(map(self.surface.__getitem__, ids))  # control ids have no surface
        if self.dummy and first in self.starts_space:
            data = data[1:]
        return data.decode("utf-8", "each-byte")


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    """Record batches of a bounded number of rows and of a bounded weight."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += weight(row)
        if len(held) >= ROWS or total >= CHARS:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def encode(documents: DataFrame, model: bytes) -> DataFrame:
    """``(row, doc_id, ids, starts, n_bytes, decoded)``: one row per document, of its whole text; a null text counts
    as empty. Piece ``i`` spans the original UTF-8 bytes from ``starts[i]`` to ``starts[i + 1]`` or ``n_bytes``;
    ``decoded`` is the text that the ids decode to."""
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32())),
         ("n_bytes", pa.int32()), ("decoded", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)

        def ahead():
            held, size = [], 0
            for batch in batches:
                texts = batch.column("text")
                for row, doc, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), texts):
                    held.append((row, doc, text.as_py() or ""))
                    size += len(held[-1][2])
                    if size >= AHEAD:
                        yield held
                        held, size = [], 0
            yield held

        def rows():
            for held in ahead():
                if held and not pieces.map.units:
                    pieces.learn_texts([text for _, _, text in held])
                for row, doc, text in held:
                    ids, starts = pieces.encode(text)
                    size = len(text.encode())
                    yield row, doc, ids, starts.astype(np.int32), size, pieces.decode(ids.tolist())

        try:
            yield from _batches(rows(), schema, lambda r: 8 * len(r[2]) + r[4])
        finally:  # the worker lives on
            pieces.words.clear()
            pieces.seen.clear()

    return keyed(documents).mapInArrow(run, _ENCODED)


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``(row, doc_id, ids, decoded)``: the texts of ids that are stored already."""
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)

        def rows():
            for batch in batches:
                for row, doc, ids in zip(
                    batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids")
                ):
                    values = ids.values.to_numpy()
                    yield row, doc, values, pieces.decode(values.tolist())

        yield from _batches(rows(), schema, lambda r: 4 * len(r[2]) + len(r[3]))

    columns = encoded.select("row", "doc_id", "ids")
    return columns.mapInArrow(run, "row long, doc_id long, ids array<int>, decoded string")
