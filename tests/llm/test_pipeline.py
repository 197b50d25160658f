"""Every stage of the pipeline against brute force over that stage's own input, awkward rows and columns included."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_corpus import brute_components, brute_targets

import corpus_pipeline

INSULTS = ["blargwit", "snorvelkopf", "gritzakel"]
SCHEMA = (
    "doc_id long, text string, source string, lang string, tag long, row long, score double, kept boolean, "
    "h long, shards string, size string, `all` string, whole string"
)


def planted():
    """``(rows, toxic tags, labels)``; ``tag`` numbers the rows."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("aeioulmnrst", k=rng.randrange(3, 9))) for _ in range(400)]
    sentence = lambda k: rng.choices(vocabulary, k=k)
    texts, toxic = [], set()
    for i in range(260):
        words = sentence(rng.choice([1, 4, 60, 60, 120]))
        if i % 4 == 0:
            toxic.add(i)
            for insult in rng.sample(INSULTS, 2):
                words.insert(rng.randrange(len(words) + 1), insult)
        texts.append((i, " ".join(words)))
    clean = [t for i, t in texts if i not in toxic and len(t.split()) >= 60]
    for n, t in enumerate(clean[:24]):
        texts.append((1000 + n, t.replace(" ", rng.choice([" \t", "\n", "  "]))))
    for n, t in enumerate(clean[20:50]):
        words = t.split()
        for _ in range(rng.choice([1, 1, 2, 6])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append((2000 + n, " ".join(words)))
    # repeated rows, null ids, texts without words, a very long text
    texts += [texts[1], texts[1], (None, clean[3]), (None, "only here " * 3), (3000, None), (3001, ""), (3002, " \n ")]
    texts.append((3003, " ".join(sentence(20_000))))
    sources = ["a", "a", "a", "b", "ü", None]
    rows = [
        (i, t, rng.choice(sources), "xx", n, -n, 0.5, n % 2 == 0, n, "s", "z", "all", "w") for n, (i, t) in enumerate(texts)
    ]
    labels = [(i, int(i in toxic)) for i in range(260)]
    return rows, toxic, labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The folder of the tables, and the rows that went into and came out of each stage."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, _, labels = planted()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        done = corpus_pipeline.store(stage(spark, docs, folder), name)
        if name != "sentencepiece":
            assert done.columns == docs.columns and done.dtypes == docs.dtypes
        out[name] = docs.collect(), done.collect()
        docs = done
    return folder, out


def tags(rows):
    return Counter(r.tag for r in rows)


def unchanged(before, after):
    """Rows that stay are as they were, in every column."""
    source = {r.tag: r for r in before}
    return all(r == source[r.tag] for r in after)


def test_toxic_documents_go_and_all_others_stay(stages):
    before, after = stages[1]["toxicity"]
    _, toxic, _ = planted()
    assert tags(after) == Counter(r.tag for r in before if r.tag not in toxic)
    assert unchanged(before, after)


def test_one_document_of_equal_texts_stays(stages):
    before, after = stages[1]["exact_dedup"]
    groups = {}
    for r in before:
        groups.setdefault(re.sub(rb"[\x20\x09-\x0d]+", b" ", (r.text or "").encode()), []).append(r)
    kept = {}
    for r in after:
        kept.setdefault(re.sub(rb"[\x20\x09-\x0d]+", b" ", (r.text or "").encode()), []).append(r.doc_id)
    order = lambda i: (i is None, i or 0)
    assert kept == {k: [min((r.doc_id for r in g), key=order)] for k, g in groups.items()}
    assert len(after) < len(before) and unchanged(before, after)


def test_one_document_of_near_duplicates_stays(stages):
    before, after = stages[1]["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before]
    _, members = brute_components(rows, 5, 80)
    order = lambda i: (rows[i][0] is None, rows[i][0] or 0, i)
    expected = Counter(rows[min(g, key=order)] for g in members.values())
    assert Counter((r.doc_id, r.text) for r in after) == expected
    assert len(after) < len(before) and unchanged(before, after)


def test_mix_meets_the_targets_with_whole_documents(stages):
    before, after = stages[1]["mixing"]
    words = lambda r: len((r.text or "").encode().split())
    sizes, largest, taken = {}, {}, {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + words(r)
        largest[r.source] = max(largest.get(r.source, 0), words(r))
    for r in after:
        taken[r.source] = taken.get(r.source, 0) + words(r)
    for source, target in brute_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= largest[source] / 2 + 1
    assert unchanged(before, after) and max(tags(after).values()) <= 2


def test_pieces_equal_the_library(stages):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before, after = stages[1]["sentencepiece"]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = Counter()
    for r in before:
        ids = library.encode(r.text or "", add_eos=True)
        expected[r.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in after) == expected


def test_run_applies_the_stages(spark, stages):
    folder, out = stages
    assert Counter(map(tuple, corpus_pipeline.run(spark, folder).collect())) == Counter(map(tuple, out["sentencepiece"][1]))


def test_stages_take_empty_tables(spark, stages, tmp_path):
    folder = str(tmp_path)
    for name in ("documents", "labels"):
        spark.read.parquet(f"{stages[0]}/{name}.parquet").where(F.lit(False)).write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        found = corpus_pipeline.store(stage(spark, docs, folder), name)
        assert found.count() == 0
        assert name == "sentencepiece" or found.columns == docs.columns
