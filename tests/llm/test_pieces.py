"""Words that are merged together get the ids they get alone."""

import random

import pytest

import __spark_entry__  # noqa: F401  (tasks get the package by value, patched settings included)
from offerlens.llm import pieces, queries


@pytest.fixture(scope="module")
def model():
    return queries.tokenizer_file("piece_bpe_32k.model")


def test_learnt_words_equal_merged_ones(model):
    rng = random.Random(7)
    together, alone = pieces.Pieces(model), pieces.Pieces(model)
    known = [p for p in together.ids if pieces.SPACE not in p]
    words = ["a", "é", "ñandú", "😀", "x😀y", "\u0085", "\u0000", "don't", "ﬁx", "ababababab", "a" * 31, "漢字かな"]
    words += ["".join(rng.choice(known) for _ in range(rng.randrange(1, 5)))[:31] for _ in range(3000)]
    words += ["".join(rng.choice("aeiou rstln\u00e9ß漢").replace(" ", "z") for _ in range(rng.randrange(1, 31))) for _ in range(3000)]
    together.learn(list(dict.fromkeys(words)))
    for word in words:
        if word in together.words:
            assert together.words[word] == alone._segment(pieces.SPACE + word), word
    assert len(together.words) > 3000


def test_scores_that_many_pieces_share(model):
    """The leftmost of equal scores is merged first."""
    both = pieces.Pieces(model)
    both.scores = {p: float(-(i // 2000)) for p, i in both.ids.items()}
    both._number_merges()
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 25))) for _ in range(2000)]
    both.learn(list(dict.fromkeys(words)))
    assert len(both.tied) > 1000
    for word in words:
        assert both.words[word] == both._segment(pieces.SPACE + word), word


def test_a_full_memory_is_emptied(model, monkeypatch):
    monkeypatch.setattr(pieces, "SEGMENTS", 3)
    few = pieces.Pieces(model)
    for text in ("one two three", "four five", "", " ", "six  seven eight nine ten"):
        few.learn_texts([text])
        assert few.encode(text)[0].tolist() == pieces.Pieces(model).encode(text)[0].tolist()
