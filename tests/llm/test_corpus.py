"""Operators on documents against brute force, on small tables with every awkward row."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (tasks get the package by value, patched settings included)
from offerlens.llm import counting, exact, licenses, mixing, near, pieces, queries, suffixes, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, slot int"


def awkward_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(3)
    words = "the of and stupid Cc BY all rights Reserved general public license é ñandú don't it's 12 ok! ﬁ".split()
    rows = [
        (1, None, "en", "a", 1, "x", 1),
        (2, "", None, "a", None, None, None),
        (3, " \t\n ", "en", None, 3, "y", 2),
        (None, "no id at all", "en", "b", 4, "z", 3),
        (None, "no id at all", "en", "b", 4, "z", 3),
        (5, "same text", "en", "b", 4, "z", 3),
        (5, "same text", "en", "b", 4, "z", 3),
        (4, "same \n text", "de", "c", 4, "z", 3),
        (6, "one", "en", "c", 1, "z", 3),
        (7, "x" * 70_000, "en", "c", 1, "z", 3),
        (8, "All rights  reserved. CC-BY cc by all rights, reserved", "en", None, 1, "z", 3),
        (9, "tail ▁ of\u0000 strange \u0085 characters 😀 <|endoftext|> K", "en", "c", 1, "z", 3),
    ]
    base = [rng.choice(words) for _ in range(120)]
    for i in range(10, 40):
        text = list(base)
        for _ in range(rng.choice([0, 0, 1, 3, 30])):
            text[rng.randrange(len(text))] = rng.choice(words) + str(rng.randrange(9))
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(text), "en", rng.choice("abc"), 9, "q", i))
    long_text = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(6000))
    rows += [(50, long_text, "en", "a", 1, "q", 1), (51, long_text + "!", "en", "a", 1, "q", 1)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return [r[1] or "" for r in awkward_rows()]


def by_text(found, *columns):
    """Results as a multiset; the rows of the fixture stand in input order."""
    return sorted(tuple(r[c] for c in columns) for r in found.collect())


def test_exact_duplicates(docs):
    rows = awkward_rows()
    clean = [re.sub(r"[\x20\x09-\x0d]+", " ", r[1] or "") for r in rows]
    groups = {}
    for i, c in enumerate(clean):
        groups.setdefault(c, []).append(i)
    expected = []
    for c, members in groups.items():
        first = min(members, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
        for i in members:
            digest = hashlib.sha256(c.encode()).hexdigest()
            expected.append((str(rows[i][0]), str(rows[first][0]), len(members), i == first, digest))
    got = exact.exact_duplicates(docs).collect()
    assert sorted(expected) == sorted(
        (str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got
    )
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_exact_duplicates_fold_long_texts(spark, monkeypatch):
    monkeypatch.setattr(exact, "BLOCK", 8)
    base = "abcdefgh" * 5
    data = [(1, base), (2, base + "x"), (3, base), (4, "y" + base[1:]), (5, base[:16]), (6, base[:16] + "y" * 8), (7, "")]
    got = exact.exact_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert {r.doc_id: r.keep_id for r in got} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7}


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_components(rows, size, percent):
    sets = [shingles(r[1], size) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(i)
    return sets, members


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, size):
    rows = awkward_rows()
    sets, members = brute_components(rows, size, 80)
    expected = []
    for group in members.values():
        first = min(group, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
        expected += [(str(rows[i][0]), len(sets[i]), str(rows[first][0]), i == first) for i in group]
    got = near.near_duplicates(docs, size=size).collect()
    assert sorted(expected) == sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got)
    assert near.drop_near_duplicates(docs, size=size).columns == docs.columns


def test_near_duplicates_in_a_large_family(spark, monkeypatch):
    """Texts around one base, many of them just below the threshold: blocks find every link."""
    monkeypatch.setattr(near, "SETS", 16)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randrange(12)):
            text[rng.randrange(80)] = f"v{rng.randrange(400)}"
        rows.append((i, " ".join(text)))
    _, members = brute_components(rows, 2, 80)
    expected = {i: min(g) for g in members.values() for i in g}
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


def test_overlaps_counts_across_column_chunks(monkeypatch):
    import numpy as np

    monkeypatch.setattr(near, "COLUMNS", 8)
    rng = random.Random(1)
    left = [np.unique(np.array([rng.randrange(60) for _ in range(30)], np.uint64)) for _ in range(5)]
    right = [np.unique(np.array([rng.randrange(60) for _ in range(20)], np.uint64)) for _ in range(4)]
    expected = [[len(set(a) & set(b)) for b in right] for a in left]
    assert near.overlaps(left, right).tolist() == expected


def brute_targets(sizes):
    """``sizes`` by source; targets by giving the excess of full sources to the others, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = budget / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] >= 2 * sizes[s]}
        if not full:
            return target | {s: share * weight[s] for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
        open_ -= full
    return target


def test_mixing(docs):
    rows = awkward_rows()
    n_words = [len((r[1] or "").encode().split()) for r in rows]
    sizes = {}
    for r, n in zip(rows, n_words):
        sizes[r[3]] = sizes.get(r[3], 0) + n
    expected = brute_targets(sizes)
    found = mixing.draws(docs, shard_words=2000).join(
        docs.select(F.monotonically_increasing_id().alias("row"), "source"), "row"
    ).collect()
    assert sorted(r.size for r in found) == sorted(n_words)
    taken = {}
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in taken.items():
        assert abs(t - expected[s]) <= 1
    again = mixing.draws(docs, shard_words=2000)
    key = lambda r: (r["row"], r["taken"], tuple(r["shards"]))
    assert sorted(map(key, found)) == sorted(map(key, again.collect()))
    mix = mixing.mixture(docs, shard_words=2000)
    assert mix.columns == docs.columns
    words = mix.select(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert words == sum(r.taken for r in found)


def test_splitting_tree_hands_out_every_block_once(spark):
    quotas = spark.createDataFrame([(0, 100), (1, 7), (2, 0), (3, 53)], "rank long, quota long")
    ends = {r["rank"]: r.ends for r in mixing.shard_quotas(quotas, 6, seed=1).collect()}
    assert {k: e[-1] for k, e in ends.items()} == {0: 100, 1: 7, 2: 0, 3: 53}
    assert all(e == sorted(e) and len(e) == 6 for e in ends.values())
    per_shard = [sum(e[i] - (e[i - 1] if i else 0) for e in ends.values()) for i in range(6)]
    assert max(per_shard) - min(per_shard) <= 3


def brute_repeats(all_texts):
    seen, n = {}, suffixes.LENGTH
    for t in all_texts:
        for p in range(len(t) - n + 1):
            seen[t[p : p + n]] = seen.get(t[p : p + n], 0) + 1
    out = []
    for t in all_texts:
        spans = []
        for p in range(len(t) - n + 1):
            if seen[t[p : p + n]] > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + n
                else:
                    spans.append([p, p + n])
        out.append((len(t), tuple(map(tuple, spans)), hashlib.sha256(suffixes.kept_bytes(t, spans)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [1024, 4, 1])
def test_repeated_spans(spark, monkeypatch, hot):
    """Also with so low a limit that most seeds are hot, and ranges of windows too."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    rng = random.Random(4)
    passages = ["".join(rng.choices("abcd é", k=k)) for k in (150, 250, 400, 900)]
    rows = []
    for i in range(90):
        text = "".join(rng.choices("ab ", k=rng.choice([0, 5, 300])))
        for _ in range(rng.choice([0, 1, 2])):
            p = rng.choice(passages)
            at = rng.randrange(len(p))
            text += p[at : at + rng.randrange(1, 600)] + "".join(rng.choices("xyz", k=rng.choice([0, 1, 30])))
        rows.append((i, text))
    rows += [(100, "a" * 900), (101, "ab" * 450), (102, None), (103, ""), (104, "x" * 199), (105, "q" * 200), (106, "q" * 200)]
    expected = brute_repeats([(t or "").encode() for _, t in rows])
    got = suffixes.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert expected == sorted((r.n_bytes, tuple((s.start, s.stop) for s in r.spans), r.kept_sha256) for r in got)


def test_repeats_of_one_hot_passage(spark, monkeypatch, tmp_path):
    """A passage in every text, between different words and in copies, with null ids and columns of clashing names."""
    monkeypatch.setattr(suffixes, "HOT", 8)
    rng = random.Random(6)
    words = lambda k: "".join(rng.choices("abcdefgh ", k=k))
    passage = words(420)
    texts = [words(rng.randrange(250)) + passage + words(rng.randrange(250)) for _ in range(60)]
    texts += [texts[0]] * 5 + [words(300), None, ""]
    rows = [(None if i % 7 == 0 else i % 5, t, i, -i, "x") for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, slot long, row long, seed string")
    table.repartition(7).write.parquet(str(tmp_path / "table"))
    got = suffixes.repeated_spans(spark.read.parquet(str(tmp_path / "table"))).collect()
    assert sorted(r.doc_id or -1 for r in got) == sorted(r[0] or -1 for r in rows)
    expected = brute_repeats([(t or "").encode() for t in texts])
    assert expected == sorted((r.n_bytes, tuple((s.start, s.stop) for s in r.spans), r.kept_sha256) for r in got)


def test_samples_do_not_depend_on_segments(monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choices("abc ", k=1500)).encode() + b"z" * 700

    def owners():
        at, first, last, seed = suffixes.Sampler()(text)
        return {w: (a, s) for a, f, l, s in zip(at, first, last, seed) for w in range(f, l + 1)}

    whole = owners()
    assert sorted(whole) == list(range(len(text) - suffixes.LENGTH + 1))
    assert all(w <= a <= w + suffixes.LENGTH - suffixes.SEED for w, (a, _) in whole.items())
    monkeypatch.setattr(suffixes, "SEGMENT", 97)
    assert owners() == whole


def test_pieces_equal_the_library(spark, docs):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    model = queries.tokenizer_file("piece_bpe_32k.model")
    own = pieces.Pieces(model)
    rng = random.Random(1)
    parts = ["a", " ", "  ", "\n", "▁", "é", "́", "😀", "\x00", "the", "ing", "</s>", "<0x0A>", "ﬁ", "字", "\t"]
    samples = texts() + ["".join(rng.choices(parts, k=rng.choice([3, 6, 12, 120]))) for _ in range(3000)]
    for text in samples:
        ids, starts = own.encode(text)
        ids = ids.tolist()
        assert ids == library.encode(text, add_eos=True)
        assert own.decode(ids) == library.decode(ids)
        raw = text.encode()
        ends = [*starts[1:], len(raw)]
        if "▁" not in text:  # the spans hold the pieces' own bytes; the space put in front is empty
            assert b"".join(raw[a:b] for a, b in zip(starts, ends)) == raw
    for _ in range(500):
        ids = [rng.randrange(32000) for _ in range(6)]
        assert own.decode(ids) == library.decode(ids)
    found = pieces.encode(docs, model).collect()
    assert sorted((r.ids, r.n_bytes) for r in found) == sorted(
        (library.encode(t, add_eos=True), len(t.encode())) for t in texts()
    )


def test_character_map_takes_the_longest_prefix_and_keeps_the_source():
    """A double array for the rules ab -> X, a -> YY."""
    import struct

    units = [0] * 512
    # root at 0 with offset 256; a child's unit holds its label, a leaf bit and the offset to its own children
    units[0] = 256 << 10
    a = 256 ^ ord("a")
    units[a] = ord("a") | 1 << 8 | (a ^ 128) << 10
    at_a = a ^ (a ^ 128)
    units[at_a] = 0x80000000 | 2  # value of a: the text at 2
    b = at_a ^ ord("b")
    units[b] = ord("b") | 1 << 8 | (b ^ 300) << 10
    units[300] = 0x80000000 | 0  # value of ab: the text at 0
    table = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + b"X\0YY\0"
    mapped, source = pieces.CharMap(table).normalise("cabaé".encode())
    assert mapped == "cXYYé".encode()
    assert source.tolist() == [0, 1, 3, 3, 4, 5, 6]


def test_token_counts_equal_the_library(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    counter = counting.Counter(queries.tokenizer_file("word_bpe_49k.json"))
    rng = random.Random(2)
    parts = ["a", "B", " ", "'", "'s", "'re", "'r", "'LL", "1", "२", "é", "́", "Σ", "İ", "\n", ",", "<|endoftext|>", "\x85", "字"]
    samples = texts() + ["".join(rng.choices(parts, k=rng.choice([1, 3, 8, 200]))) for _ in range(3000)]
    samples += [f"a{chr(c)}b'{chr(c)}s" for c in [*range(0xD800), *range(0xE000, 0x20000)]][:: 7]
    expected = [len(e.ids) for e in library.encode_batch(samples, add_special_tokens=False)]
    assert counter.counts(samples).tolist() == expected
    found = counting.token_counts(docs, queries.tokenizer_file("word_bpe_49k.json")).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in found) == sorted(
        (len(t.encode()), n) for t, n in zip(texts(), expected)
    )


def test_entry_states_compose_like_one_long_read():
    import numpy as np

    kinds = np.random.default_rng(0).integers(0, 6, (37, 5)).astype(np.uint8)
    state, expected = counting.FREE, []
    for chunk in kinds:
        expected.append(state)
        for k in chunk:
            state = counting._NEXT[state, k]
    assert counting.entry_states(kinds).tolist() == expected


def test_license_scan(docs):
    expected = []
    for text in texts():
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            want = phrase.split()
            hits = [i for i in range(len(words)) if words[i : i + len(want)] == want]
            places += hits
            labels |= {label} if hits else set()
        expected.append((len(words), len(places), min(places, default=-1), max(places, default=-1), ",".join(sorted(labels))))
    got = licenses.scan_licenses(docs).na.fill(-1).collect()
    assert sorted(expected) == sorted((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)


def test_license_notices_with_words_put_in(spark):
    data = [(1, "This is Licensed, really, under the Apache License Version 2.0 now"), (2, "the apache was here")]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[1].labels == "apache-2.0" and got[1].base_labels == "" and got[1].score > 0.8
    assert got[2].labels == "" and got[2].score < 0.5


def brute_kernel(a, b):
    """Common subsequences, each weighted by the gap to the power of both spans."""
    from itertools import combinations

    total = 0.0
    for i in combinations(range(len(a)), toxicity.ORDER):
        for j in combinations(range(len(b)), toxicity.ORDER):
            if [a[x] for x in i] == [b[x] for x in j]:
                total += toxicity.GAP ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_subsequence_kernel():
    left, right = ["gatta", "idiot", "xidyot", "abc"], ["cata", "idiot", "idiot", "xyz"]
    got = toxicity.subsequence_kernel(toxicity._codes(left, 6, 0), toxicity._codes(right, 5, -1))
    assert got.tolist() == pytest.approx([brute_kernel(a, b) for a, b in zip(left, right)], rel=1e-4)


@pytest.fixture(scope="module")
def labelled(spark):
    """Toxic documents hold two of five insults, some with a character put in."""
    rng = random.Random(9)
    insults = ["blockhead", "numpty", "dunderpate", "wazzock", "pillock"]
    rows, marks = [], []
    for i in range(600):
        words = ["".join(rng.choices("aeinorst", k=rng.randrange(2, 9))) for _ in range(rng.randrange(5, 80))]
        toxic = i % 4 == 0
        for word in rng.sample(insults, 2) if toxic else ():
            words.insert(rng.randrange(len(words)), word)
        rows.append((i, " ".join(words) + "."))
        marks.append((i, 1, int(toxic)))
    rows += [(9000, "you blxockhead and wazzqock"), (9001, "you b.l.o.c.k.h.e.a.d and n u m p t y"), (9002, None), (9003, "")]
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(marks, "doc_id long, quality int, toxic int"),
    )


def test_toxicity_on_held_out_documents(labelled):
    documents, labels = labelled
    got = {r.doc_id: r for r in toxicity.score_toxicity(documents, labels).collect()}
    held = [i for i in range(600) if got[i].held_out]
    assert 60 < len(held) < 200
    assert all(got[i].predicted == (i % 4 == 0) for i in held)
    assert got[9000].predicted == got[9001].predicted == 1
    assert got[9002].predicted == got[9003].predicted == 0 and got[9002].score == got[9003].score
    assert toxicity.drop_toxic(documents, labels).where("doc_id = 9000").isEmpty()


def test_clean_rows_pass_unchanged(labelled, spark):
    """The stage keeps exactly the rows that the scores keep, columns with clashing names and equal rows included."""
    documents, labels = labelled
    more = documents.unionByName(documents.where("doc_id < 40")).unionByName(documents.where("doc_id is null"))
    more = more.selectExpr("doc_id", "text", "doc_id as row", "text as score", "array(doc_id) as whole", "true as toxic")
    scored = toxicity.score_toxicity(more, labels).where("predicted = 0")
    kept = toxicity.drop_toxic(more, labels)
    assert kept.schema.names == more.schema.names
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in scored.collect())
    assert all(r.row == r.doc_id and r.score == r.text and r.whole == [r.doc_id] for r in kept.collect())
    bare = toxicity.drop_toxic(more.drop("text"), labels)
    assert bare.count() == more.count()


def test_scores_equal_those_of_one_process(labelled):
    """Spark's scores, in any batches, are the model's over the same training texts; values of words are brute force."""
    documents, labels = labelled
    toxic, other = toxicity.training_texts(documents, labels)
    rows, marks = documents.collect(), {r.doc_id: r.toxic for r in labels.collect()}
    learned = [r for r in rows if r.doc_id in marks and zlib.crc32(str(r.doc_id).encode()) % 5]
    assert sorted(toxic) == sorted(r.text for r in learned if marks[r.doc_id])
    assert sorted(other) == sorted(r.text for r in learned if not marks[r.doc_id])
    model = toxicity.train(toxic, other)
    expected = {r.doc_id: model.scores(toxicity.Words(model.landmarks).features([r.text or ""]))[0] for r in rows}
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(documents, labels).collect()}
    assert got == pytest.approx(expected, abs=1e-5)
    words = toxicity.Words(model.landmarks)
    seen = sorted({w for r in rows[:6] for s in toxicity.sentences(r.text or "") for w in s})
    words.learn(seen)
    for word in seen:
        for m, mark in enumerate(model.landmarks):
            whole = toxicity.cleaned(word)
            starts = lambda n: range(max(1, len(whole) - n + 1))
            best = max(
                brute_kernel(w, mark) / (brute_kernel(w, w) * brute_kernel(mark, mark)) ** 0.5
                for n in range(len(mark), len(mark) + toxicity.SLACK + 1)
                for w in (whole[at : at + n] for at in starts(n))
                if len(w) >= toxicity.ORDER
            )
            value = 0.0 if words.seen[word] is None else words.seen[word][m]
            # what is passed over is faint; a word with a landmark's letters apart may be worth more
            assert best < 0.75 or value >= best**toxicity.POWER - 1e-3, (word, mark, best, value)
            apart = toxicity.embedded(whole, mark)
            assert apart or value <= best**toxicity.POWER + 1e-3, (word, mark, best, value)


def test_toxicity_without_labels(docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, none).collect()
    assert len(got) == len(awkward_rows()) and all(r.predicted == 0 for r in got)


def test_empty_tables(empty, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model, file = queries.tokenizer_file("piece_bpe_32k.model"), queries.tokenizer_file("word_bpe_49k.json")
    for found in (
        mixing.draws(empty),
        mixing.mixture(empty),
        licenses.scan_licenses(empty),
        exact.exact_duplicates(empty),
        toxicity.score_toxicity(empty, none),
        suffixes.repeated_spans(empty),
        pieces.decode(pieces.encode(empty, model), model),
        counting.token_counts(empty, file),
        near.near_duplicates(empty),
    ):
        assert found.count() == 0


def test_landmarks_survive_quotations_and_a_long_tail():
    """Other texts quote every frequent insult twice; each of six more insults stands in 1 % of the toxic texts."""
    rng = random.Random(4)
    often = ["blockhead", "numpty", "dunderpate", "wazzock", "pillock"]
    seldom = ["fopdoodle", "gobermouch", "clodpoll", "muckspout", "zounderkite", "lubberwort"]
    words = lambda: ["".join(rng.choices("aeinorst", k=rng.randrange(2, 9))) for _ in range(30)]
    toxic = [" ".join([*words(), seldom[i // 4] if i < 24 else often[i % 5]]) for i in range(400)]
    other = [" ".join([*words(), *(often[i % 5 : i % 5 + 1] if i < 10 else [])]) for i in range(800)]
    chosen = [m.strip("^$") for m in toxicity.choose_landmarks(toxic, other)]
    assert all(any(m in w for m in chosen) for w in often + seldom)
    assert not any(m in w for m in toxicity.choose_landmarks(toxic, other + toxic) for w in often + seldom)


def test_insults_with_a_letter_in_every_gap(labelled, spark):
    """And with several letters in some gaps, digits, or inside long words; other words stay clean."""
    documents, labels = labelled
    apart = [
        "you bxlxoxcxkxhxexaxd and wxaxzxzxoxcxk",
        "you nzuzmzpztzy and p1i2l3l4o5c6k",
        "a dqunqderxpatqe and pixlqlozck",
        "a p-x-i-x-l-x-l-x-o-x-c-x-k and dxuxnxdxexrxpxaxtxe",
    ]
    clean = ["nothing but ordinary rain and a loosened stone", "unblocked heads, panted pillows"]
    more = [(9100 + i, t) for i, t in enumerate([*apart, *clean])]
    rows = documents.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(rows, labels).collect() if r.doc_id >= 9100}
    assert [got[i] for i, _ in more] == [1] * len(apart) + [0] * len(clean)
    far = ["^" + "x" * 50 + "y".join("numpty") + "x" * n + "$" for n in range(40)]
    assert all(toxicity.embedded(w, "numpty").replace("\0", "") == "numpty" for w in far)
    words = toxicity.Words(["numpty"])
    words.learn([w.strip("^$") for w in far])
    assert all(words.seen[w.strip("^$")][0] > 0.5 for w in far)


def test_mix_of_whole_documents(spark, docs, tmp_path):
    """The query and the pipeline's stage never cut a text; the boundary document goes where the target is nearer."""
    rows = [(i, " ".join(f"{s}{n}" for n in range(600)), "en", s, 1, "q", i) for i, s in enumerate("abc")]
    few = spark.createDataFrame(rows, SCHEMA)
    few.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op1_mix(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == [(0, 1200), (1, 1200), (2, 600)]
    import corpus_pipeline

    for table in (few, docs):
        known = {r[1] for r in table.select("doc_id", "text").collect()}
        mixed = corpus_pipeline.mix(spark, table, "")
        assert {r.text for r in mixed.collect()} <= known
        plan = mixing.draws(table, entire=True).collect()
        assert all(r.taken == r["size"] * len(r.shards) or r["size"] == 0 for r in plan)
        largest = max(r["size"] for r in plan)
        by_target = {}
        for r in plan:
            by_target[r.target] = by_target.get(r.target, 0) + r.taken
        assert all(abs(t - n) <= largest / 2 + 1 for t, n in by_target.items())


def test_taken_words_follow_the_shards(spark, monkeypatch):
    """A document is drawn once for each place in a shard's run of blocks; without runs nothing is."""
    rows = [(i, "one two three", "en", "ab"[i % 2], 1, "q", i) for i in range(400)]
    table = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(queries, "_table", lambda *_: table)
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 8)
    found = mixing.draws(table, shard_words=300, entire=True).collect()
    assert all(r.taken == r["size"] * len(r.shards) for r in found)
    assert {s for r in found for s in r.shards} == set(range(6))
    quotas = mixing.shard_quotas

    def no_runs(*args):
        return quotas(*args).withColumn("ends", F.transform("ends", lambda e: e * 0))

    monkeypatch.setattr(mixing, "shard_quotas", no_runs)
    assert {(r.taken, tuple(r.shards)) for r in queries.op1_mix(spark, "").collect()} == {(0, ())}
