"""Exact de-duplication by deterministic block naming.

A normalised text is cut into blocks of ``BLOCK`` bytes. Equal blocks get equal integer names by sorting the
blocks; then adjacent pairs of names are named in the same way, again and again, until each text has one name.
Names come from comparing contents, never from a hash, so two texts have the same identity (number of blocks,
last name) exactly if they are equal.

Skew: a task first replaces its blocks by slots of a local dictionary, so a block that a third of all documents
share is sent to be named once for each dictionary and not once for each document. The sort of named blocks is
Spark's, on disk where it must be. Texts are shuffled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import keyed, pick, store

#: bytes of a block
BLOCK = 8192
#: bytes of blocks that a local dictionary holds before it is sent off
DICTIONARY_BYTES = 8_000_000
_SLOTS = 1 << 20
_PER_TASK = 1 << 40

_CUT = "slot long, block binary, row long, doc_id long, pos int, blocks int, sha string"


def normalised(text: bytes) -> bytes:
    """Each run of ``[\\x20\\x09-\\x0D]`` replaced by one space; runs at the ends stay as one space."""
    out = b" ".join(text.split())
    if text[:1].isspace():
        out = b" " + out
    if text[-1:].isspace() and out != b" ":
        out += b" "
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: (slot, block) for each distinct block of a dictionary, and the places of slots."""
    first = TaskContext.get().partitionId() * _PER_TASK
    schema = pa.schema(
        [("slot", pa.int64()), ("block", pa.binary()), ("row", pa.int64()), ("doc_id", pa.int64()),
         ("pos", pa.int32()), ("blocks", pa.int32()), ("sha", pa.string())]
    )
    slots: dict[bytes, int] = {}
    held, places = 0, []

    def sent() -> pa.RecordBatch:
        n, m = len(slots), len(places)
        row, doc, pos, count, sha, slot = zip(*places) if places else ((),) * 6
        none = [None] * n
        return pa.record_batch(
            [pa.array([*slots.values(), *slot], pa.int64()), pa.array([*slots, *[None] * m], pa.binary()),
             pa.array([*none, *row], pa.int64()), pa.array([*none, *doc], pa.int64()),
             pa.array([*none, *pos], pa.int32()), pa.array([*none, *count], pa.int32()),
             pa.array([*none, *sha], pa.string())],
            schema=schema,
        )

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for row, doc, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), texts):
            clean = normalised(text.as_py() or b"")
            count = max(1, -(-len(clean) // BLOCK))
            sha = hashlib.sha256(clean).hexdigest()
            for pos in range(count):
                block = clean[pos * BLOCK : (pos + 1) * BLOCK]
                slot = slots.get(block)
                if slot is None:
                    slot = slots[block] = first + len(slots)
                    held += len(block) + 100
                places.append((row, doc if pos == 0 else None, pos, count, sha if pos == 0 else None, slot))
            if held > DICTIONARY_BYTES or len(places) > 50_000:
                yield sent()
                first += max(_SLOTS, len(slots))
                slots, held, places = {}, 0, []
    if places:
        yield sent()


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Integer names of sorted blocks: a block unlike the one before it starts a new name."""
    name, last = TaskContext.get().partitionId() * _PER_TASK - 1, None
    for batch in batches:
        names = []
        for block in batch.column("block"):
            block = block.as_py()
            if block != last:
                name, last = name + 1, block
            names.append(name)
        yield pa.record_batch([batch.column("slot"), pa.array(names, pa.int64())], names=["slot", "name"])


def _fold(names: DataFrame, at_most: int) -> DataFrame:
    """``(row, name)`` from ``(row, pos, name)``: adjacent pairs are named until one name is left per row."""
    while at_most > 1:
        # an odd last name keeps an absent partner; equal numbers of blocks fold alike, so that is unambiguous
        pairs = names.groupBy("row", F.shiftright("pos", 1).alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        pairs = store(pairs, "pairs")
        known = store(
            pairs.select("a", "b").distinct().sortWithinPartitions("a", "b").withColumn(
                "name", F.monotonically_increasing_id()
            ),
            "names",
        )
        names = pairs.join(known, ["a", "b"]).select("row", "pos", "name")
        at_most = -(-at_most // 2)
    return names.select("row", "name")


def identities(documents: DataFrame) -> DataFrame:
    """``(row, doc_id, sha, blocks, name)``: one row per document; ``(blocks, name)`` is its identity.

    A null text counts as empty; an empty text is one empty block. Equal rows stay separate rows."""
    cut = store(keyed(documents).mapInArrow(_cut, _CUT), "blocks")
    named = (
        cut.where("block IS NOT NULL").select("slot", "block").repartition("block").sortWithinPartitions("block")
        .mapInArrow(_named, "slot long, name long")
    )
    places = cut.where("row IS NOT NULL").select("slot", "row", "doc_id", "pos", "blocks", "sha")
    all_names = store(places.join(named, "slot").drop("slot"), "places")
    first = all_names.where("pos = 0").select("row", "doc_id", "sha", "blocks", "name")
    longest = all_names.agg(F.max("blocks")).first()[0] or 1
    if longest == 1:
        return first
    folded = _fold(all_names.where("blocks > 1").select("row", "pos", "name"), longest)
    long_rows = first.where("blocks > 1").drop("name").join(folded, "row")
    return store(first.where("blocks = 1").unionByName(long_rows), "identities")


def exact_duplicates(documents: DataFrame) -> DataFrame:
    """``(row, doc_id, keep_id, group_size, kept, text_sha256)``: one row per document.

    Texts are equal when they are after each run of white space is replaced by one space. The row with the
    smallest doc_id stays, a null doc_id last; of rows with that same doc_id, the first in the input."""
    who = identities(documents)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), F.col("row").alias("at"))
    groups = store(
        who.groupBy("blocks", "name").agg(F.min(order).alias("head"), F.count("*").alias("size")).where("size > 1"),
        "groups",
    )
    joined = who.join(groups, ["blocks", "name"], "left")
    return joined.select(
        "row",
        "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("head.doc")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).alias("group_size"),
        (F.col("size").isNull() | (F.col("head.at") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that ``exact_duplicates`` keeps, all their columns unchanged."""
    kept = exact_duplicates(documents).where("kept").select(F.col("row").alias("__row"))
    rows = documents.select(F.monotonically_increasing_id().alias("__row"), F.struct("*").alias("__all"))
    return rows.join(kept, "__row").select("__all.*")


__all__ = ["exact_duplicates", "drop_exact_duplicates", "identities", "normalised", "pick"]
