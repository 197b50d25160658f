"""Toxicity by a support vector machine over a gap-weighted subsequence kernel with Nyström landmarks.

The kernel counts common subsequences of ``ORDER`` characters, each weighted by ``GAP`` to the power of the
characters it spans, so an insult with characters put in between still matches. Landmarks are short strings that
the labelled sentences themselves suggest: pieces of words that many toxic documents have and others do not. A
sentence's kernel value with a landmark is that of its best word, relative to the landmark with itself; the
landmarks' kernel matrix turns these values into Nyström features, and a linear machine separates them. Where a
word holds all of a landmark's characters in order within less than twice its length, the value is at least the
landmark's kernel with those characters alone: what was put in between widens their spans and counts no more.

Labels are on documents, so training alternates between picking each toxic document's most toxic sentences and
fitting; all sentences of other documents count as they are. A document's score comes from its worst sentence
and its second worst word, by a logistic fit on the training documents.

Training reads a sample of labelled rows bounded by ``TOXIC``, ``OTHER`` and ``CHARS`` per text; it happens on the
driver. Scoring reads every text in full, in tasks; words are evaluated once per task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.llm.common import keyed, pick

ORDER, GAP = 3, 0.7
#: a power of a kernel is a kernel; this one keeps many faint resemblances from adding up to an insult
POWER = 3
#: toxic and other documents, and characters of a text, that training reads at most
TOXIC, OTHER, CHARS = 2000, 6000, 20_000
#: of so many toxic training documents, one is learned from with characters put in too, in one gap and in all
APART = 4
#: landmarks, lengths of their candidates, and the share of documents with one that must be toxic
LANDMARKS, LENGTHS, PURE = 48, range(4, 13), 0.95
#: distinct toxic documents that a landmark needs
WITNESSES = 4
#: share of a landmark's documents that a longer one must have to replace it
GROW = 0.8
#: kernel with an earlier landmark from which on a landmark is a variant of it
VARIANT = 0.5
#: pairs that are evaluated together, and the smallest kernel value that counts as a resemblance
PAIRS, LEAST = 4096, 0.02
#: share of a landmark's own kernel below which a word is not looked at closer, and a window's extra characters
FAINT, SLACK = 0.4, 2
#: characters of a word that are looked at together, those that two such windows share (twice the longest landmark),
#: and words a task remembers
WINDOW, SHARED, WORDS = 32, 24, 250_000
#: folds of the identifiers; those of the first fold are never learned from
FOLDS = 5
_SENTENCE = re.compile(r"[.!?\n\r]+(?=\s|$)|\n")
_SPELLED = re.compile(r"(?<!\S)\S(?: \S){3,}(?!\S)")


def cleaned(word: str) -> str:
    """A word's letters and digits, in lower case, between marks of its ends; what stands between them is no gap."""
    word = word.lower()
    return f"^{word if word.isalnum() else ''.join(filter(str.isalnum, word))}$"


def sentences(text: str) -> list[list[str]]:
    """Words of every sentence, in lower case; four or more single characters in a row are one word."""
    text = text.lower()
    if _SPELLED.search(text):
        text = _SPELLED.sub(lambda m: m.group().replace(" ", ""), text)
    return [words for part in _SENTENCE.split(text) if (words := part.split())]


def subsequence_kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The gap-weighted kernel of pairs: row ``i`` of ``left`` with row ``i`` of ``right``, codes padded with 0
    and -1 so that padding matches nothing."""
    match = (right.T[:, None, :] == left.T[None, :, :]).astype(np.float32) * np.float32(GAP**2)
    ends, gap = match, np.float32(GAP)
    for _ in range(ORDER - 1):
        # what ends here or before, each character in between at the price of a gap
        ends = ends.copy()
        for i in range(1, ends.shape[1]):
            ends[:, i] += gap * ends[:, i - 1]
        for j in range(1, ends.shape[0]):
            ends[j] += gap * ends[j - 1]
        longer = np.zeros_like(match)
        longer[1:, 1:] = match[1:, 1:] * ends[:-1, :-1]
        ends = longer
    return ends.sum((0, 1))


def _codes(words: list[str], width: int, pad: int) -> np.ndarray:
    flat = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass")
    out = np.frombuffer(flat, np.int32).reshape(len(words), width)
    return np.where(out == 0, pad, out) if pad else out


def _letters(codes: np.ndarray) -> np.ndarray:
    """A bit for each of a row's characters, hashed to 62."""
    bits = np.uint64(1) << ((codes.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(62))
    return np.bitwise_or.reduce(np.where(codes > 0, bits, np.uint64(0)), axis=1)


def embedded(word: str, mark: str) -> str:
    """The shortest stretch of a word, of less than twice the landmark's length, that has the landmark's characters
    in order; other characters are blanks that match nothing. Empty, if there is none. What is put in stands
    between letters, so a mark of a word's end is next to its letter."""
    core, low, top = mark.strip("^$"), mark[0] == "^", mark[-1] == "$"
    if low and word[:2] != mark[:2] or top and word[-2:] != mark[-2:]:
        return ""
    best: list[int] = []
    end = len(word) - 1 - top
    start = 1 if low else word.find(core[0])
    while start >= 0:
        stop, places = min(start + 2 * len(core) - 1, end + 1), [start]
        for c in core[1:-1] if top else core[1:]:
            at = word.find(c, places[-1] + 1, stop - top)
            if at < 0:
                break
            places.append(at)
        else:
            if top and places[-1] < end < stop:
                places.append(end)
            if len(places) == len(core) and (not best or places[-1] - start < best[-1] - best[0]):
                best = places
        start = -1 if low else word.find(core[0], start + 1)
    if not best:
        return ""
    best = [*range(low), *best, *range(len(word) - top, len(word))]
    return "".join(word[i] if i in best else "\0" for i in range(best[0], best[-1] + 1))


def _piece_needed(size: int) -> int:
    """Length of the shortest piece of ``size`` different characters whose own kernel is ``FAINT`` times theirs."""
    row = np.arange(1, size + 1)[None, :]
    own = [float(subsequence_kernel(row[:, :n], row[:, :n])[0]) for n in range(ORDER, size + 1)]
    return ORDER + next(i for i, k in enumerate(own) if k >= FAINT * own[-1])


class Words:
    """Kernel values of words with the landmarks. A word that lacks two of a landmark's characters, or one of four,
    has none, nor has one with too few of them in order for a faint resemblance."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        width = max(map(len, landmarks), default=1)
        self.codes = _codes(landmarks, width, -1)
        self.own = subsequence_kernel(_codes(landmarks, width, 0), self.codes) if landmarks else np.empty(0)
        self.letters = _letters(_codes(landmarks, width, 0))
        distinct = np.bitwise_count(self.letters).astype(int)
        self.needed, self.distinct = distinct - (distinct > 4), distinct
        self.sizes = np.array(list(map(len, landmarks)), np.int64)
        # a shorter piece of a landmark resembles it faintly, if at all
        self.least = np.array([_piece_needed(n) for n in self.sizes], np.int64)
        self.shortest = int(self.least.min(initial=ORDER))
        #: words that were evaluated, with their values, and those of them that resemble a landmark
        self.seen: dict[str, np.ndarray | None] = {}
        self.hits: dict[str, np.ndarray] = {}

    def learn(self, raw: Iterable[str]) -> None:
        """Evaluates words that are new."""
        new = set(raw).difference(self.seen)
        if len(self.seen) + len(new) > WORDS:
            self.seen.clear()
            self.hits.clear()
            new = set(raw)
        self.seen.update(dict.fromkeys(new))
        # most words are letters alone, and in lower case already
        core = {w: f"^{w}$" if w.isalnum() else cleaned(w) for w in new}
        pieces, owner = [], []
        for clean in set(core.values()):
            if self.shortest <= len(clean) <= SHARED + 1:
                pieces.append(clean)
                owner.append(clean)
                continue
            # a long word is looked at through overlapping windows
            for at in range(0, max(1, len(clean) - SHARED), WINDOW - SHARED):
                if len(piece := clean[at : at + WINDOW]) >= self.shortest:
                    pieces.append(piece)
                    owner.append(clean)
        if not pieces or not self.landmarks:
            return
        lengths = np.array(list(map(len, pieces)))
        found, whole = [], []
        for low, top in ((0, 8), (8, 12), (12, 16), (16, 24), (24, WINDOW)):
            mine = np.flatnonzero((lengths > low) & (lengths <= top))
            for start in range(0, len(mine), 20_000):
                some = mine[start : start + 20_000]
                codes = _codes([pieces[i] for i in some], top, 0)
                have = np.bitwise_count(_letters(codes)[:, None] & self.letters[None, :])
                word, mark = np.nonzero(have >= self.needed[None, :])
                shared = self._in_order(codes, word, mark)
                held = shared == self.sizes[mark]
                whole += zip(some[word[held]].tolist(), mark[held].tolist())
                close = shared >= self.least[mark]
                word, mark = word[close], mark[close]
                for at in range(0, len(word), PAIRS):
                    w, m = word[at : at + PAIRS], mark[at : at + PAIRS]
                    found.append((some[w], m, subsequence_kernel(codes[w], self.codes[m])))
        if not found:
            return
        word, mark, value = (np.concatenate(c) for c in zip(*found))
        near = value >= FAINT * self.own[mark]
        word, mark = word[near], mark[near]
        value = self._aligned([pieces[i] for i in word], mark) ** POWER
        apart = [(i, m, e) for i, m in whole if (e := embedded(pieces[i], self.landmarks[m]))]
        word = np.r_[word, [i for i, _, _ in apart]].astype(int)
        mark = np.r_[mark, marks := np.array([m for _, m, _ in apart], int)]
        value = np.r_[value, self._inside([e for _, _, e in apart], marks)]
        rows: dict[str, np.ndarray] = {}
        for i, m, v in zip(word.tolist(), mark.tolist(), value.tolist()):
            if v > LEAST:
                row = rows.get(owner[i])
                if row is None:
                    row = rows[owner[i]] = np.zeros(len(self.landmarks), np.float32)
                row[m] = max(row[m], v)
        found = {w: rows[c] for w, c in core.items() if c in rows}
        self.seen.update(found)
        self.hits.update(found)

    def _in_order(self, codes: np.ndarray, word: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """The longest common subsequence of pairs of words and landmarks: bit ``i`` of a row is cleared where the
        first ``i + 1`` characters of the landmark have one more in common with the word than the first ``i``."""
        out = np.zeros(len(word), np.int64)
        for m, landmark in enumerate(self.landmarks):
            mine = np.flatnonzero(mark == m)
            some = codes[word[mine]]
            places = np.zeros(some.shape, np.uint16)
            for c in set(landmark):
                bits = sum(1 << i for i, other in enumerate(landmark) if other == c)
                places[some == ord(c)] = bits
            row = np.full(len(mine), 0xFFFF, np.uint16)
            for place in places.T:
                same = row & place
                row = (row + same) | (row - same)
            out[mine] = np.bitwise_count(~row & np.uint16((1 << len(landmark)) - 1))
        return out

    def _aligned(self, words: list[str], marks: np.ndarray) -> np.ndarray:
        """The normalised kernel of each word's best window with its landmark; windows are up to ``SLACK`` longer
        than the landmark, so that what else is in a long word adds nothing. Windows with too few of the landmark's
        characters in order are passed over, as words are."""
        out = np.zeros(len(words))
        lengths = np.array(list(map(len, words)), np.int64)
        longest = max(WINDOW, int(self.sizes.max()) + SLACK)
        for start in range(0, len(words), PAIRS):
            some = np.arange(start, min(start + PAIRS, len(words)))
            codes = _codes([words[i] for i in some], longest, 0)
            for size in np.unique(self.sizes[marks[some]]).tolist():
                mine = np.flatnonzero(self.sizes[marks[some]] == size)
                for n in range(size, size + SLACK + 1):
                    starts = np.maximum(lengths[some[mine]] - n + 1, 1)
                    pair = np.repeat(mine, starts)
                    at = np.arange(len(pair)) - np.repeat(np.cumsum(starts) - starts, starts)
                    windows = np.lib.stride_tricks.sliding_window_view(codes, n, 1)[pair, at]
                    mark = marks[some[pair]]
                    close = self._in_order(windows, np.arange(len(pair)), mark) >= self.least[mark]
                    windows, mark, pair = windows[close], mark[close], pair[close]
                    for go in range(0, len(pair), PAIRS):
                        w, m = windows[go : go + PAIRS], mark[go : go + PAIRS]
                        both = subsequence_kernel(w, self.codes[m])
                        alone = subsequence_kernel(w, np.where(w == 0, -1, w))
                        value = both / np.sqrt(np.maximum(alone, 1e-12) * self.own[m])
                        np.maximum.at(out, some[pair[go : go + PAIRS]], np.minimum(value, 1.0))
        return out

    def _inside(self, held: list[str], marks: np.ndarray) -> np.ndarray:
        """The normalised kernel of each ``embedded`` landmark with the landmark, times ``GAP`` to the power of the
        characters put in for each of its gaps."""
        out = np.zeros(len(held))
        for start in range(0, len(held), PAIRS):
            some, m = held[start : start + PAIRS], marks[start : start + PAIRS]
            codes = _codes(some, max(map(len, some)), 0)
            both = subsequence_kernel(codes, self.codes[m])
            alone = subsequence_kernel(codes, np.where(codes == 0, -1, codes))
            gaps = np.array([e.count("\0") / (len(e.strip("^$").replace("\0", "")) - 1) for e in some])
            value = both / np.sqrt(np.maximum(alone, 1e-12) * self.own[m]) * GAP**gaps
            out[start : start + PAIRS] = np.minimum(value, 1.0)
        return out

    def features(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text, a row for each sentence with a word that resembles a landmark, and one for each such
        word."""
        if not self.landmarks:
            return [(np.empty((0, 0)), np.empty((0, 0))) for _ in texts]
        split = [sentences(t) for t in texts]
        self.learn(set().union(*(words for text in split for words in text)))
        hits = self.hits
        out = []
        for text in split:
            found = [v for words in text if (v := [hits[w] for w in words if w in hits])]
            rows = [np.max(v, 0) for v in found], [x for v in found for x in v]
            out.append(tuple(np.array(r, np.float32).reshape(-1, len(self.landmarks)) for r in rows))
        return out


def _words(text: str) -> set[str]:
    return {c for w in set(text.split()) if len(c := cleaned(w)) >= LENGTHS[0]}


def frequent_parts(words: Counter, least: int) -> Counter:
    """Pieces of ``LENGTHS`` characters that words with a total count of ``least`` have, and those totals.

    A piece can only be frequent if its two pieces of one character less are, so lengths are counted in turn."""
    out: Counter = Counter()
    active = {w: range(len(w) - LENGTHS[0] + 1) for w in words}
    for n in LENGTHS:
        count: Counter = Counter()
        for w, starts in active.items():
            for f in {w[at : at + n] for at in starts}:
                count[f] += words[w]
        often = {f for f, total in count.items() if total >= least}
        out.update({f: count[f] for f in often})
        left = {}
        for w, starts in active.items():
            good = {at for at in starts if w[at : at + n] in often}
            if longer := [at for at in good if at + 1 in good]:
                left[w] = longer
        active = left
    return out


def choose_landmarks(toxic: list[str], other: list[str]) -> list[str]:
    """Pieces of words, chosen one by one: the one that most toxic documents have in words without an earlier one,
    if it is pure enough, grown to the longest piece around it that nearly as many have. Of variants of one stem, the
    first stands for all."""
    toxic = sorted(set(toxic))  # copies are one witness
    least = WITNESSES
    suspects: Counter = Counter()
    for text in toxic:
        suspects.update(_words(text))
    # for whole words as for pieces, the share of documents decides: a word may stand in some that quote it
    scale = len(toxic) / max(1, len(other))
    spare = (1 / PURE - 1) / scale if scale else 0.0
    quoted: Counter = Counter()
    for text in other:
        quoted.update(w for w in _words(text) if w in suspects)
    suspects = Counter({w: n for w, n in suspects.items() if quoted[w] <= n * spare})
    often = frequent_parts(suspects, least)
    # what other documents have too often is struck off as soon as it is known
    room = {f: n * spare for f, n in often.items()}
    for text in other:
        heads = {f[: LENGTHS[0]] for f in room}
        for w in _words(text):
            hits = [at for at in range(len(w) - LENGTHS[0] + 1) if w[at : at + LENGTHS[0]] in heads]
            for f in {w[at : at + n] for at in hits for n in LENGTHS if at + n <= len(w)}:
                if f in room:
                    room[f] -= 1
                    if room[f] < 0:
                        del room[f]

    def parts(word: str) -> set[str]:
        return {f for n in LENGTHS for at in range(len(word) - n + 1) if (f := word[at : at + n]) in room}

    kept = {w: found for w in suspects if (found := parts(w))}
    places = [(i, w) for i, text in enumerate(toxic) for w in sorted(_words(text)) if w in kept]
    has: dict[str, set[int]] = {}
    for at, (_, w) in enumerate(places):
        for f in kept[w]:
            has.setdefault(f, set()).add(at)
    n_docs = lambda where: len({places[at][0] for at in where})
    size = {f: n for f, where in has.items() if (n := n_docs(where)) >= least}
    chosen: list[str] = []
    while size and len(chosen) < LANDMARKS:
        best = max(size, key=lambda f: (size[f], len(f), f))
        around = [f for f in size if best in f and size[f] >= GROW * size[best]]
        best = max(around, key=lambda f: (len(f), size[f], f))
        chosen.append(best)
        gone = set(has[best])
        for f in {f for at in gone for f in kept[places[at][1]] if f in size}:
            has[f] -= gone
            size[f] = n_docs(has[f])
            if size[f] < least:
                del size[f]
    kept: list[str] = []
    for mark in chosen:
        if all(resemblance(mark, other) < VARIANT for other in kept):
            kept.append(mark)
    return kept


def resemblance(one: str, two: str) -> float:
    """The normalised kernel of two strings."""
    width = max(len(one), len(two))
    left, right = _codes([one, two, one], width, 0), _codes([one, two, two], width, -1)
    own, other, both = subsequence_kernel(left, right).tolist()
    return both / max(own * other, 1e-12) ** 0.5


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0) -> np.ndarray:
    """A linear machine with squared hinge loss and balanced classes, by Newton steps; the last weight is the bias."""
    x = np.c_[x, np.ones(len(x))]
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y) * c
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        active = y * (x @ w) < 1
        xa, sa = x[active], share[active]
        new = np.linalg.solve(ridge + (xa * sa[:, None]).T @ xa, (xa * sa[:, None]).T @ y[active])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def fit_logistic(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights, the last one the intercept, of the probability of a label; slopes are not negative."""
    x = np.c_[x, np.ones(len(x))]
    ridge = np.r_[np.full(x.shape[1] - 1, 1e-2), 1e-6]
    smooth = np.where(label > 0, (label.sum() + 1) / (label.sum() + 2), 1 / (len(label) - label.sum() + 2))
    w = np.zeros(x.shape[1])
    free = np.ones(len(w), bool)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        xf = x[:, free]
        hessian = (xf * (p * (1 - p) + 1e-9)[:, None]).T @ xf + np.diag(ridge[free])
        step = np.linalg.solve(hessian, xf.T @ (p - smooth) + ridge[free] * w[free])
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        w[free] -= step
        low = free & (w < 0) & (np.arange(len(w)) < len(w) - 1)
        if low.any():
            w[low], free = 0.0, free & ~low
        elif np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    landmarks: list[str]
    project: np.ndarray
    weights: np.ndarray
    logistic: np.ndarray

    def margins(self, features: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
        """Distances from the separating plane of the worst sentence and of the second worst word; what resembles
        no landmark is at the bias."""
        bias = float(self.weights[-1])
        by_sentence, by_word = (f @ self.project @ self.weights[:-1] + bias for f in features)
        second = np.partition(by_word, -2)[-2] if len(by_word) > 1 else bias
        return max([bias, *by_sentence]), max(bias, float(second))

    def scores(self, features: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        margins = np.array(list(map(self.margins, features))).reshape(-1, 2)
        return 1 / (1 + np.exp(-np.clip(margins @ self.logistic[:2] + self.logistic[2], -30, 30)))


def spelled_apart(text: str, landmarks: list[str], gaps: bool) -> str:
    """``text`` with one more letter inside every landmark that one of its words has, or in each of its ``gaps``."""

    def changed(match: re.Match) -> str:
        word = match.group()
        if gaps:
            return "xqkz"[zlib.crc32(word[::-1].encode()) % 4].join(word)
        at = 1 + zlib.crc32(word.encode()) % (len(word) - 1)
        return word[:at] + "xqkz"[zlib.crc32(word[::-1].encode()) % 4] + word[at:]

    return re.sub("|".join(re.escape(m.strip("^$")) for m in landmarks), changed, text, flags=re.IGNORECASE)


def train(toxic: list[str], other: list[str]) -> Model:
    """The model of two lists of texts. Without toxic texts or landmarks every score is the share of toxic ones
    (0 without any text)."""
    marks = choose_landmarks(toxic, other)
    if not marks or not other:
        share = len(toxic) / max(1, len(toxic) + len(other))
        odds = np.log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -30.0)
        return Model([], np.zeros((0, 0)), np.zeros(1), np.array([0.0, 0.0, odds]))
    # the same sentences with characters put in, as the writer of an insult may do
    toxic = [*toxic, *(spelled_apart(t, marks, g) for t in toxic[::APART] for g in (False, True))]
    words = Words(marks)
    width = max(map(len, marks))
    i, j = np.indices((len(marks), len(marks))).reshape(2, -1)
    between = subsequence_kernel(_codes(marks, width, 0)[i], _codes(marks, width, -1)[j]).reshape(len(marks), -1)
    between = (between / np.sqrt(np.outer(words.own, words.own))) ** POWER
    value, vector = np.linalg.eigh(between)
    project = vector / np.sqrt(np.maximum(value, 1e-2)) @ vector.T
    good, bad = ([f for some in _portions(texts) for f in words.features(some)] for texts in (toxic, other))
    negative = np.concatenate([*(f[0] for f in bad), np.zeros((1, len(marks)))]) @ project
    # at first, toxic sentences are those that resemble a landmark closely
    weights = np.r_[np.linalg.solve(project, np.ones(len(marks))), -0.8]
    for _ in range(4):
        each = [f[0] @ project for f in good if len(f[0])]
        # the worst sentence, and every other that is on the toxic side
        margin = [f @ weights[:-1] + weights[-1] for f in each]
        worst = [f[(m > 0) | (m == m.max())] for f, m in zip(each, margin)]
        x = np.concatenate([*worst, negative])
        weights = fit_svm(x, np.r_[np.ones(len(x) - len(negative)), -np.ones(len(negative))])
    model = Model(marks, project, weights, np.zeros(3))
    margins = np.array([model.margins(f) for f in [*good, *bad]])
    model.logistic = fit_logistic(margins, np.r_[np.ones(len(good)), np.zeros(len(bad))])
    return model


def held_out(doc_id) -> F.Column:
    """Whether an identifier is in the fold that is never learned from; a null one is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_texts(documents: DataFrame, labels: DataFrame) -> tuple[list[str], list[str]]:
    """Texts of toxic and of other labelled documents outside the held-out fold: those of the first ``TOXIC`` and
    ``OTHER`` labelled identifiers by a hash, texts of more than ``CHARS`` characters left out.

    The sample of identifiers has a bounded size, so it is sent to the documents and their texts stay in place; of
    an identifier's several texts the smallest counts."""
    marked = labels.select(pick(labels, "doc_id", "long"), pick(labels, "toxic", "int"))
    marked = marked.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    first = lambda kind, most: (
        marked.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    sample = first(1, TOXIC).unionByName(first(0, OTHER))
    texts = documents.select(pick(documents, "doc_id", "long"), pick(documents, "text", "string"))
    usable = texts.where(F.length("text").between(1, CHARS)).join(F.broadcast(sample), "doc_id")
    rows = usable.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id", "toxic").collect()
    return [r.text for r in rows if r.toxic == 1], [r.text for r in rows if r.toxic == 0]


def _portions(texts) -> Iterator[list[str]]:
    """Texts, or strings of an Arrow column, in order, some million characters at a time."""
    held, size = [], 0
    for text in texts:
        held.append((text if isinstance(text, str) else text.as_py()) or "")
        size += len(held[-1])
        if size > 2_000_000:
            yield held
            held, size = [], 0
    if held:
        yield held


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model.landmarks)
        for batch in batches:
            scores: list[float] = []
            for texts in _portions(batch.column("text")):
                scores += model.scores(words.features(texts)).tolist()
            yield pa.record_batch(
                [batch.column("row"), batch.column("doc_id"), pa.array(scores, pa.float64())],
                names=["row", "doc_id", "score"],
            )

    return run


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(row, doc_id, held_out, score, predicted)``: one row per document, of its whole text.

    Null and empty texts get the score of a text without any resemblance to a landmark. ``predicted`` is 1 from a
    score of one half on. Only the text enters a score."""
    model = train(*training_texts(documents, labels))
    scored = keyed(documents).mapInArrow(_scored(model), "row long, doc_id long, score double")
    return scored.select(
        "row",
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not predicted toxic, all their columns unchanged.

    Rows pass through the tasks that score them, so nothing is shuffled or joined; null and empty texts stay, and so
    does every one of a number of equal rows with a clean text."""
    model = train(*training_texts(documents, labels))
    schema = T.StructType([T.StructField("whole", documents.schema, False)])
    own = dict(documents.dtypes).get("text") == "string"
    rows = documents.select(F.struct("*").alias("whole"), *([] if own else [pick(documents, "text", "string")]))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model.landmarks)
        for batch in batches:
            whole = batch.column("whole")
            texts = whole.field("text") if own else batch.column("text")
            clean = [s < 0.5 for some in _portions(texts) for s in model.scores(words.features(some)).tolist()]
            yield pa.record_batch([whole.filter(pa.array(clean, pa.bool_()))], names=["whole"])

    return rows.mapInArrow(kept, schema).select("whole.*")
