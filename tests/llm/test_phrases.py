"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__  # noqa: F401  (tasks get the package by value, patched settings included)
from offerlens.llm import phrases
from offerlens.llm.common import store

SCHEMA = "doc_id long, text string, lang string, phrase string, n int, `a` string"


def brute_counts(rows, most):
    """Per language: counts of all phrases, and of all words."""
    counts, words = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", small):
            line = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(line)
            for k in range(1, most + 1):
                for i in range(len(line) - k + 1):
                    counts.setdefault(lang, Counter())[" ".join(line[i : i + k])] += 1
    return counts, words


def brute(rows, support, most, top):
    out = []
    counts, words = brute_counts(rows, most)
    for lang, all_ in counts.items():
        some = {p: c for p, c in all_.items() if c >= support and " " in p}
        found = []
        for p, a in some.items():
            w = p.split(" ")
            inside = (q for q, c in some.items() if len(q) > len(p) and 100 * c >= 100 * a)
            if any(f" {p} " in f" {q} " for q in inside):
                continue
            cuts = [(" ".join(w[:k]), " ".join(w[k:])) for k in range(1, len(w))]
            n = words[lang]
            score, _, l, r = min(
                (1000 * a * n // (all_[x] * all_[y]), k, all_[x], all_[y]) for k, (x, y) in enumerate(cuts)
            )
            found.append((-score, -a, p.encode(), l, r, n))
        for rank, (score, a, p, l, r, n) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def awkward_rows(seed=1, n=150):
    rng = random.Random(seed)
    vocabulary = "The of red Ñu naïve cat. dog, 😀 a-b it's \u0085x end! a\tb".split(" ")
    rows = [
        (1, None, "en", "a", 1, "x"),
        (None, "", None, None, None, None),
        (3, " \t\n .,;", "en", "a", 1, "x"),
        (4, "solo", "", "a", 1, "x"),
        (5, "x" * 50_000, "en", "a", 1, "x"),
        *[(6, "same red cat of the same red cat", None, "a", 1, "x")] * 9,
        (7, "same red cat of the", "und", "a", 1, "x"),
    ]
    for i in range(8, n):
        size = rng.choice([3, 20, 60])
        rows.append((i, " ".join(rng.choice(vocabulary) for _ in range(size)), rng.choice(["en", "de", None]), "q", i, "y"))
    rows.append((n, " ".join(rng.choice(vocabulary) for _ in range(5000)), "en", "q", 1, "y"))
    return rows


def collocated(spark, rows, **options):
    found = phrases.collocations(spark.createDataFrame(rows, SCHEMA), **options)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize(("support", "top", "sample"), [(4, 2000, 4), (12, 7, 2), (3, 50, 1000)])
def test_collocations(spark, monkeypatch, support, top, sample):
    monkeypatch.setattr(phrases, "CHUNK", 500)  # several chunks in a task
    rows = awkward_rows()
    assert collocated(spark, rows, support=support, top=top, sample=sample) == brute(rows, support, 5, top)


def test_keys_that_move_one_by_one_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(phrases, "RANGES", 1)
    rows = awkward_rows(2)
    assert collocated(spark, rows, support=5, sample=3) == brute(rows, 5, 5, 2000)


def test_full_filters_and_few_key_bits_only_cost_time(spark, monkeypatch):
    monkeypatch.setattr(phrases, "RANGE", 64)
    monkeypatch.setattr(phrases, "RUN", 8)
    every = phrases.Filter.has
    # each third phrase is a false member
    monkeypatch.setattr(phrases.Filter, "has", lambda self, h: every(self, h) | (h % np.uint64(24) < 8))
    rows = awkward_rows(3, 60)
    assert collocated(spark, rows, support=4, sample=5) == brute(rows, 4, 5, 2000)


def test_passes_go_on_until_the_border_is_closed(spark):
    """Nothing is in the sample, so each pass finds phrases that are one word longer."""
    rows = [(i, "one two three four five six", "en", None, None, None) for i in range(5)]
    trace = []
    found = phrases.frequent_phrases(spark.createDataFrame(rows, SCHEMA), support=5, sample=10**9, trace=trace)
    got = {r.phrase: r.n for r in found.collect()}
    assert trace == [5, 4, 3, 2]
    assert got == {"": 30} | {p: c for p, c in brute_counts(rows, 5)[0]["en"].items()}


def test_numbers_beyond_64_bits(spark, monkeypatch):
    import pyspark.sql.functions as F

    big = 10**11
    rows = [("en", "", 0, 10**14), ("en", "a", 1, big + 1), ("en", "b", 1, big + 3), ("en", "a b", 2, big)]
    table = spark.createDataFrame(rows, "lang string, phrase string, words int, n long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *_: table.withColumn("n", F.col("n")))
    row = phrases.collocations(spark.createDataFrame([], SCHEMA)).first()
    assert row.score == 1000 * big * 10**14 // ((big + 1) * (big + 3))


def test_empty_table(spark):
    assert collocated(spark, []) == []


def test_packed_numbers_come_back():
    rng = random.Random(4)
    for bits in (1, 9, 40, 63):
        x = np.array([rng.randrange(1 << bits) for _ in range(100)], np.uint64)
        assert (phrases.unplaned(phrases.planes(x), 100) == x).all()


def test_counts_and_keys_in_one_number():
    keys = np.array([7, 1 << 43, 7, 9], np.uint64)
    n = np.array([1, 1 << 20, (3 << 20) + 5, 2], np.int64)
    parts = list(phrases.numbers(keys, n))
    found = phrases.summed(np.concatenate(parts))
    assert [x.tolist() for x in found] == [[7, 9, 1 << 43], [(3 << 20) + 6, 2, 1 << 20]]
    assert sum(map(len, parts)) == 7


def test_parts_of_a_line_share_no_phrase(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PIECE", 7)
    monkeypatch.setattr(phrases, "NAMED", 16)
    monkeypatch.setattr(phrases, "ROWS", 3)
    rows = awkward_rows(5, 80)
    assert collocated(spark, rows, support=4, sample=3) == brute(rows, 4, 5, 2000)


def test_a_task_holds_little():
    """Three million words, all phrases counted: arrays alone took 251 MB at the peak, and 133 MB now."""
    import tracemalloc

    rng = np.random.default_rng(1)
    chunk = phrases.Chunk()
    words = [f"w{i}" for i in range(3000)]
    for _ in range(1000):
        chunk.add("en", ". ".join(" ".join(words[i] for i in rng.integers(0, 3000, 20)) for _ in range(50)).encode())
    batch = chunk.row(True)
    every = phrases.Filter({i: b"\xff" * (phrases.BLOCK // 8) for i in range(phrases.FILTER // phrases.BLOCK)})
    run = phrases._moved(phrases._sampled(every, 5), 64)
    tracemalloc.start()
    moved = sum(sum(x.column("size").to_pylist()) for x in run(iter([batch] * 3)))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert moved > 3_000_000
    assert peak < 150


def test_a_task_holds_one_table_of_a_filter():
    import pickle

    half = phrases.Filter({i: bytes([i % 256]) * (phrases.BLOCK // 8) for i in range(phrases.FILTER // phrases.BLOCK)})
    packed = pickle.dumps(half)
    there = pickle.loads(packed)
    assert len(packed) < 1e6 and not there.blocks
    assert (there._bytes() == half._bytes()).all()


def test_chunks_are_stored_in_small_row_groups(spark, monkeypatch):
    """A reader holds a whole row group: the chunks of a task came in one."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(phrases, "CHUNK", 500)
    monkeypatch.setattr(phrases, "GROUP", 4000)
    stored = []
    monkeypatch.setattr(phrases, "store", lambda df, label, *a: stored.append((label, out := store(df, label, *a))) or out)
    collocated(spark, awkward_rows(), support=5, sample=4)
    files = [f.removeprefix("file://") for label, df in stored if label == "chunks" for f in df.inputFiles()]
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert max(m.num_rows for m in groups) > 2
    assert all(m.num_row_groups > 1 for m in groups if m.num_rows > 2)
