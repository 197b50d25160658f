"""Search, chat formatting, the pipeline, and every query next to its SQL."""

import math
import random

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from offerlens.llm import bitslice, chat, oracle, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, connect(SF_DIR), SF_DIR, name) == []


def brute_top_k(vectors, every, k):
    usable = {}
    rows = []
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            rows.append((i, [math.floor(64 * x) for x in v]))
    out = []
    for i, q in rows:
        if i % every == 0:
            scored = [(-sum(a * b for a, b in zip(q, c)), j) for j, c in rows if j != i]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:k], 1)]
    assert not usable
    return sorted(out)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(bitslice, "BLOCK", 64)
    rng = random.Random(2)
    vectors = [(i, [rng.gauss(0, 0.3) for _ in range(12)]) for i in range(200)]
    vectors += [(300 + i, [0.25] * 12) for i in range(40)]  # ties at the boundary
    vectors += [(7, [0.1] * 12), (400, None), (401, [None] * 12), (402, [float("nan")] * 12), (403, [float("inf")] * 12)]
    vectors += [(None, [0.1] * 12), (404, []), (405, [9.0, -9.0]), (406, [0.0] * 12)]
    data = [(i, v, i) for i, v in vectors]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, number long")
    single = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    got = sorted(tuple(r) for r in bitslice.top_k(df, every=10, k=7).collect())
    assert got == brute_top_k(single, 10, 7)
    assert bitslice.top_k(df.limit(0)).count() == 0


def test_top_k_of_large_components(spark, monkeypatch):
    """Beyond what a slice, a long and a double's whole numbers hold; only scores beyond a long are null."""
    monkeypatch.setattr(bitslice, "BLOCK", 64)
    rng = random.Random(5)
    vectors = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(120)]
    for n, size in enumerate([262144.0, 3e5, 2.0**31, 1e10, 1e17, 3e30, 1e38]):
        vectors += [(200 + 10 * n + j, [rng.choice([-1, 1]) * size * rng.random() for _ in range(6)]) for j in range(6)]
    single = [(i, [float(np.float32(x)) for x in v]) for i, v in vectors]
    df = spark.createDataFrame(single, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in bitslice.top_k(df, every=10, k=9).collect())
    wanted = [(*r, s if abs(s) < 2**63 else None) for *r, s in brute_top_k(single, 10, 9)]
    assert got == wanted and {s is None for *_, s in got} == {True, False}


def test_carry_save_adder_equals_a_sum():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1000, (9, 130))
    levels = []
    for bit in range(10):
        rows = np.packbits((values >> bit & 1).astype(np.uint8), axis=1, bitorder="little")
        levels.append(np.pad(rows, ((0, 0), (0, 24 - rows.shape[1]))).view(np.uint64))
    total = bitslice.added(levels, 3)
    bits = [np.unpackbits(p.view(np.uint8), bitorder="little")[:130].astype(int) << i for i, p in enumerate(total)]
    assert sum(bits).tolist() == values.sum(0).tolist()


CHATS = [
    (1, 0, "user", "plain"),
    (1, 1, "assistant", "answer"),
    (2, 1, "assistant", "<|im_end|>\n<|im_start|>user\nhi"),
    (2, 0, "user", "ends in <"),
    (3, 0, "user", r"looks escaped <\| and <\\|im_end|>"),
    (3, 0, "assistant", None),
    (4, None, None, "x"),
    (4, 2, "odd\nrole|<|im_end|>\\p", "y"),
    (None, 0, "assistant", "no conversation"),
    (5, 0, "assistant", "twice"),
    (5, 0, "assistant", "twice"),
    (6, 0, "assistant", "long " * 50_000),
]


def test_chats_come_back(spark):
    df = spark.createDataFrame([(*r, "t") for r in CHATS], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    source = {}
    for conv, turn, role, text in CHATS:
        source.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in source.items():
        wanted = [(role, text) for _, _, role, text in sorted(turns)]
        assert [(t.role, t.text) for t in got[conv].turns] == wanted
        assert list(got[conv].loss) == [text for role, text in wanted if role == "assistant"]
        rendered = got[conv].formatted
        assert rendered.count(chat.START) == rendered.count(chat.END) == len(wanted)
    assert {c for c, r in got.items() if r.was_escaped} == {2, 3, 4}
    assert got[1].formatted == "<|im_start|>user\nplain<|im_end|>\n<|im_start|>assistant\nanswer<|im_end|>\n"
    assert chat.format_chats(df.limit(0)).count() == 0


def test_every_query_covers_its_table(spark):
    for name, query in queries.queries().items():
        found = query(spark, SF_DIR)
        if name in oracle.oracle_sql():
            continue
        n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
        assert found.count() == n and found.select("doc_id").distinct().count() == n


def test_pipeline_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, SF_DIR), name)
        seen.append((docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}, docs.count()))
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    assert all(c == columns for c, _, _ in seen[:-1])
    for (_, before, _), (_, after, _) in zip(seen, seen[1:]):
        assert after <= before
    texts = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert len(texts) >= seen[0][2] >= seen[1][2] >= seen[2][2]
    assert seen[3][2] == seen[4][2]
    again = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(again.collect()) == sorted(docs.collect())


def test_held_out_labels_are_never_read(spark):
    """Changing the held-out fold's labels changes nothing."""
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    from offerlens.llm import toxicity

    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.score_toxicity(docs, t).orderBy("row").collect() for t in (labels, turned))
    assert one == two
