"""Token counts by finite-state transducers.

The tokenizer file is compiled to a word transducer: five states and six character classes, whose transitions
say where a word begins. A batch of texts is cut into chunks of ``CHUNK`` characters; each chunk gives a map from
every state it may be entered in to the state it is left in, the maps of all chunks compose by a parallel prefix
scan, and so every chunk can be read from its true state at once, however long a text is.

The arc that ends a word carries the number of tokens that byte-pair merges give the word; such arcs are compiled
on demand and remembered. A text's count is the sum of its arcs, taken from a prefix sum over the batch.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from offerlens.llm.common import keyed

#: characters of a chunk, and of a batch that is scanned at once
CHUNK, BATCH = 64, 2_000_000
#: words whose arcs a task remembers
ARCS = 200_000
# character classes; CUT2 and CUT3 are apostrophes that begin a contraction of two or three characters
SPACE, LETTER, DIGIT, OTHER, CUT2, CUT3 = range(6)
# states: between words, in letters, in other characters, one or two characters before a contraction's end
FREE, LETTERS, OTHERS, ONE, TWO = range(5)
_NEXT = np.array(
    [
        # SPACE DIGIT.. by class:  SPACE, LETTER, DIGIT, OTHER, CUT2, CUT3
        [FREE, LETTERS, FREE, OTHERS, ONE, TWO],
        [FREE, LETTERS, FREE, OTHERS, ONE, TWO],
        [FREE, LETTERS, FREE, OTHERS, OTHERS, OTHERS],
        [FREE, FREE, FREE, FREE, FREE, FREE],
        [ONE, ONE, ONE, ONE, ONE, ONE],
    ],
    np.uint8,
)
_BEGINS = np.array(
    [
        [0, 1, 1, 1, 1, 1],
        [0, 0, 1, 1, 1, 1],
        [0, 1, 1, 0, 0, 0],
        [0, 0, 0, 0, 0, 0],
        [0, 0, 0, 0, 0, 0],
    ],
    bool,
)
# fixed values: the pattern of the word splitter that this transducer compiles, and its contractions
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"[\t-\r\x85\p{Z}]+")):
        for found in regex.finditer(pattern, every):
            codes = np.frombuffer(found.group().encode("utf-32-le"), np.uint32)
            out[codes] = kind
    return out


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is printable Latin-1, else the next free
    one from 256 on."""
    out, free = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            out.append(chr(byte))
        else:
            out.append(chr(free))
            free += 1
    return out


def entry_states(kinds: np.ndarray) -> np.ndarray:
    """The state each chunk (row of ``kinds``) is entered in, if the first is entered between words."""
    n, width = kinds.shape
    maps = np.tile(np.arange(len(_NEXT), dtype=np.uint8), (n, 1))
    for i in range(width):
        maps = _NEXT[maps, kinds[:, i, None]]
    # prefix scan: after step d a row holds the composition of its 2 d last chunks
    step = 1
    while step < n:
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], 1)
        step *= 2
    return np.r_[np.uint8(FREE), maps[:-1, FREE]]


class Counter:
    """Counts for a tokenizer file of this kind: byte-level pairs with word ends, lower case, white space dropped."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model = spec["model"]
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if (
            model["type"] != "BPE"
            or model["end_of_word_suffix"] != "</w>"
            or steps != ["NFC", "Replace", "Lowercase"]
            or split["pattern"]["Regex"] != PATTERN
        ):
            raise ValueError("this file compiles to another transducer")
        self.rank = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.symbol = byte_symbols()
        self.kind = classes()
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.arcs: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Tokens of one word: pairs are merged by lowest rank, leftmost first."""
        parts = [self.symbol[b] for b in word.encode()]
        parts[-1] += "</w>"
        rank = self.rank
        if len(parts) > 300:
            return self._long_word(parts)
        while len(parts) > 1:
            best, at = None, 0
            last = parts[0]
            for i, part in enumerate(parts[1:]):
                r = rank.get((last, part))
                if r is not None and (best is None or r < best):
                    best, at = r, i
                last = part
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return len(parts)

    def _long_word(self, parts: list[str]) -> int:
        """The same with a queue."""
        import heapq

        n = left_over = len(parts)
        left, right, queue = list(range(-1, n - 1)), list(range(1, n + 1)), []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (r := self.rank.get((parts[i], parts[j]))) is not None:
                heapq.heappush(queue, (r, i, j, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, a, b = heapq.heappop(queue)
            if parts[i] != a or parts[j] != b or right[i] != j:
                continue
            parts[i], parts[j] = a + b, ""
            left_over -= 1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return left_over

    def normalised(self, text: str) -> str:
        # each character alone is lower-cased: no final sigma; two letters are newer than Python's tables
        text = unicodedata.normalize("NFC", text)
        for upper, lower in (("Σ", "σ"), ("\ua7cb", "\u0264"), ("\ua7dc", "\u019b")):
            text = text.replace(upper, lower)
        return text.lower()

    def counts(self, texts: list[str]) -> np.ndarray:
        """Token counts of whole texts, scanned together."""
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = self.special.split(text) if self.special and "<|" in text else [text]
            extra[i] = len(pieces) - 1
            for piece in pieces:
                parts.append(self.normalised(piece))
                owner.append(i)
        joined = " ".join(parts) + " "
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kind[codes]
        for at in np.flatnonzero(codes[:-1] == 39):
            after = joined[at : at + 3]
            if after[:2] in CONTRACTIONS:
                kinds[at] = CUT2
            elif after in CONTRACTIONS:
                kinds[at] = CUT3
        n = -(-len(kinds) // CHUNK)
        padded = np.full(n * CHUNK, SPACE, np.uint8)
        padded[: len(kinds)] = kinds
        padded = padded.reshape(n, CHUNK)
        state = entry_states(padded)
        begins = np.empty(padded.shape, bool)
        for i in range(CHUNK):
            begins[:, i] = _BEGINS[state, padded[:, i]]
            state = _NEXT[state, padded[:, i]]
        begins = begins.reshape(-1)[: len(kinds)]
        starts = np.flatnonzero(begins)
        # a word ends where the next begins or at a space
        stops = np.flatnonzero(begins | (kinds == SPACE))
        ends = np.r_[stops, len(kinds)][np.searchsorted(stops, starts, "right")]
        arcs = self.arcs
        weight = np.zeros(len(starts) + 1, np.int64)
        emitted = []
        for a, b in zip(starts.tolist(), ends.tolist()):
            word = joined[a:b]
            n_tokens = arcs.get(word)
            if n_tokens is None:
                n_tokens = self.word(word)
                if len(word) < 64:
                    if len(arcs) >= ARCS:
                        arcs.clear()
                    arcs[word] = n_tokens
            emitted.append(n_tokens)
        weight[1:] = np.cumsum(emitted, dtype=np.int64) if emitted else 0
        bounds = np.cumsum([0, *(len(p) + 1 for p in parts)])
        per_part = np.diff(weight[np.searchsorted(starts, bounds)])
        return extra + np.bincount(owner, per_part, len(texts)).astype(np.int64)


def token_counts(documents: DataFrame, file: bytes) -> DataFrame:
    """``(row, doc_id, n_bytes, n_tokens)``: one row per document, of its whole text; a null text counts as empty
    and has no tokens. Special strings inside a text are one token each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(file)
        for batch in batches:
            texts = batch.column("text")
            at = 0
            while at < batch.num_rows:
                held, size, start = [], 0, at
                while at < batch.num_rows and (not held or size < BATCH):
                    held.append(texts[at].as_py() or "")
                    size += len(held[-1])
                    at += 1
                counts = counter.counts(held)
                n_bytes = [len(t.encode()) for t in held]
                yield pa.record_batch(
                    [batch.column("row").slice(start, at - start), batch.column("doc_id").slice(start, at - start),
                     pa.array(n_bytes, pa.int64()), pa.array(counts)],
                    names=["row", "doc_id", "n_bytes", "n_tokens"],
                )

    return keyed(documents).mapInArrow(run, "row long, doc_id long, n_bytes long, n_tokens long")
