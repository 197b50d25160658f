"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash

import __spark_entry__  # noqa: F401  (tasks get the package by value, patched settings included)
from offerlens.llm import simhash

SCHEMA = "doc_id long, text string, bits string, head int, `row` string"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_labels(codes, distance=4):
    parent = list(range(len(codes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    codes = np.array(codes, np.uint64)
    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[:i] ^ codes[i]) <= distance):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(codes))]


def awkward_rows():
    rng = random.Random(5)
    words = "the of and Alpha Ñandú ﬁx b2 😀 x".split()
    rows = [
        (9, None, "a", 1, "r"),
        (8, "", None, None, None),
        (None, " \t\n\x0b", "a", 1, "r"),
        (None, "no id", "a", 1, "r"),
        (None, "no  ID", "a", 1, "r"),
        (7, "one two three", "a", 1, "r"),
        (6, "one two three", "a", 1, "r"),
        (6, "one two three", "a", 1, "r"),
        (5, "x" * 50_000, "a", 1, "r"),
        (4, "one\u0085two three four five", "a", 1, "r"),
    ]
    base = [rng.choice(words) + str(rng.randrange(40)) for _ in range(400)]
    for i in range(20, 80):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 5, 200])):
            text[rng.randrange(len(text))] = "changed" + str(i)
        rows.append((i, rng.choice([" ", "\n "]).join(text), "q", i, "r"))
    return rows


def test_near_duplicates(spark):
    rows = awkward_rows()
    codes = [brute_fingerprint(r[1]) for r in rows]
    labels = brute_labels(codes)
    least = {}
    for r, label in zip(rows, labels):
        if r[0] is not None:
            least[label] = min(least.get(label, r[0]), r[0])
    expected = sorted((str(r[0]), f"{c:016x}", str(least.get(label))) for r, c, label in zip(rows, codes, labels))
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert expected == sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found)
    assert sum(r.kept for r in found) == len(set(labels))
    assert 1 < max(labels.count(x) for x in labels)


def clustered_codes(rng, clusters, members, flips):
    out = set()
    for _ in range(clusters):
        centre = rng.getrandbits(64)
        for _ in range(members):
            code = centre
            for _ in range(rng.randrange(flips + 1)):
                code ^= 1 << rng.randrange(64)
            out.add(code)
    return sorted(out)


@pytest.mark.parametrize(("parts", "block", "sheet"), [(5, 4096, 65_536), (6, 16, 40), (8, 3, 7), (5, 20, 64)])
def test_links_of_a_forest(spark, monkeypatch, parts, block, sheet):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SHEET", sheet)
    monkeypatch.setattr(simhash, "PAIRS", 50)
    rng = random.Random(parts)
    codes = clustered_codes(rng, 60, 6, 5) + clustered_codes(rng, 1, 300, 6)  # one crowded node
    codes = sorted({*codes, 0, (1 << 64) - 1, 1, 1 << 63})
    longs = np.array(codes, np.uint64).view(np.int64).tolist()
    bits = spark.createDataFrame([(x,) for x in longs], "bits long").repartition(4)
    found = simhash.linked_fingerprints(bits, 4, parts).collect()
    place = {x: i for i, x in enumerate(longs)}
    got = np.arange(len(codes))
    for r in found:
        a, b = place[r.x], place[r.y]
        simhash._united(got, np.array([a]), np.array([b]))
    assert got.tolist() == brute_labels(codes)
    # a forest, not all pairs
    assert len(found) <= len(codes) * len(simhash.trees(parts, 4)) * 20


def test_rank_and_order_are_inverted():
    rng = random.Random(6)
    codes = np.array([rng.getrandbits(64) for _ in range(100)] + [0, (1 << 64) - 1], np.uint64)
    assert (simhash.gray_code(simhash.gray_rank(codes)) == codes).all()
    neighbours = simhash.gray_code(np.arange(100, dtype=np.uint64))
    assert (np.bitwise_count(neighbours[1:] ^ neighbours[:-1]) == 1).all()
    for order, fixed in simhash.trees(6, 4):
        assert (simhash.restored(simhash.reordered(codes, order), order) == codes).all() and fixed >= 20
    assert [simhash.n_parts(n, 4) for n in (10, 1 << 20, 1 << 22, 1 << 33)] == [5, 5, 6, 7]


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
