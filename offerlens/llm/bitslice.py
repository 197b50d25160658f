"""Exact top-k inner products with a bit-sliced index.

Each block of rows holds, for every attribute and every bit of its quantised value, a bitmap over the rows. A
query's scores are built for all rows at once by adding those bitmaps, shifted by the bits of the query's
components, with carry-save adders; a negative component adds the complement. The best rows are then selected
from the most significant score slice downward, and rows that tie at the boundary are resolved by their ids.

Queries meet every block: blocks and query chunks are dealt to (block, group) keys. Each pair returns at most
``k`` rows per query, and the blocks' answers are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm.common import pick, store

#: rows of a block, queries of a chunk, and (block, group) keys to make at least where the queries suffice
BLOCK, CHUNK, KEYS = 65_536, 128, 48
#: vectors with a floor beyond this are indexed apart, in smaller blocks of as many slices as they need
LARGEST = 1 << 24
_INDEX = "block int, rows int, base string, dims int, bits int, ids binary, planes binary"
_FOUND = "number long, query_id long, vec_id long, score long, side int, wide binary"
_LONG = (1 << 63) - 1


def quantised(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """``(vec_id, v)`` with ``v = scale * x``, floored when it is read. Vectors that are null or hold null or
    non-finite components, and rows without vec_id, take no part."""
    value = pick(embeddings, "embedding", "array<double>", "x")
    whole = embeddings.select(pick(embeddings, "vec_id", "long"), value).where("vec_id IS NOT NULL AND x IS NOT NULL")

    def usable(x: Column) -> Column:
        return F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x)

    return whole.where(F.forall("x", usable)).select("vec_id", F.transform("x", lambda x: x * scale).alias("v"))


def floors(values: np.ndarray) -> np.ndarray:
    """Whole numbers below ``values``: longs, or Python's integers where one is large."""
    low = np.floor(np.asarray(values, float))
    if np.abs(low).max(initial=0) < 1 << 53:
        return low.astype(np.int64)
    return np.array([int(x) for x in low.ravel().tolist()], object).reshape(low.shape)


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Floors of vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return floors(out)


def slices(values: np.ndarray) -> tuple[int, int, np.ndarray]:
    """``(base, bits, planes)``: plane ``[d, j]`` is the bitmap of bit ``j`` of attribute ``d`` less ``base``."""
    base = int(values.min(initial=0))
    shifted = values - base
    bits = max(1, int(shifted.max(initial=0)).bit_length())
    rows, dims = values.shape
    words = -(-rows // 64)
    planes = np.zeros((dims, bits, words * 8), np.uint8)
    for j in range(bits):
        bit = (shifted >> j & 1).astype(np.uint8).T
        packed = np.packbits(bit, axis=1, bitorder="little")
        planes[:, j, : packed.shape[1]] = packed
    return base, bits, planes.view(np.uint64)


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    block = TaskContext.get().partitionId()

    def built(ids: np.ndarray, vectors: list[np.ndarray]) -> pd.DataFrame:
        order = np.argsort(ids, kind="stable")
        values = _matrix([vectors[i] for i in order])
        base, bits, planes = slices(values)
        return pd.DataFrame(
            {"block": [block], "rows": [len(ids)], "base": [str(base)], "dims": [values.shape[1]], "bits": [bits],
             "ids": [ids[order].tobytes()], "planes": [planes.tobytes()]}
        )

    # large values apart, so that they widen no other row's slices
    held = {False: ([], []), True: ([], [])}
    for batch in batches:
        for i, v in zip(batch["vec_id"].tolist(), batch["v"]):
            wide = bool(np.abs(v).max(initial=0) >= LARGEST)
            ids, vectors = held[wide]
            ids.append(i)
            vectors.append(v)
            if len(ids) >= (max(1, BLOCK // 16) if wide else BLOCK):
                yield built(np.array(ids, np.int64), vectors)
                held[wide] = [], []
    for ids, vectors in held.values():
        if ids:
            yield built(np.array(ids, np.int64), vectors)


def added(levels: list[np.ndarray], words: int) -> np.ndarray:
    """The slices of a sum: ``levels[i]`` stacks the bitmaps of weight ``2 ** i``."""
    out, i = [], 0
    levels = list(levels)
    while i < len(levels):
        here, carries = levels[i], []
        while len(here) > 1:
            third = len(here) // 3
            if third:
                a, b, c = here[:third], here[third : 2 * third], here[2 * third : 3 * third]
                half = a ^ b
                carries.append((a & b) | (half & c))
                here = np.concatenate([half ^ c, here[3 * third :]])
            else:
                carries.append(here[:1] & here[1:])
                here = here[:1] ^ here[1:]
        out.append(here[0] if len(here) else np.zeros(words, np.uint64))
        if carries:
            if i + 1 == len(levels):
                levels.append(np.empty((0, words), np.uint64))
            levels[i + 1] = np.concatenate([levels[i + 1], *carries])
        i += 1
    return np.array(out).reshape(-1, words)


def best(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest sums (all, if fewer) among marked rows; of equal ones the first."""
    sure, open_ = np.zeros_like(among), among
    for plane in scores[::-1]:
        high = open_ & plane
        n = int(np.bitwise_count(sure | high).sum())
        if n > k:
            open_ = high
        else:
            sure = sure | high
            open_ = open_ & ~plane
            if n == k:
                open_ = np.zeros_like(among)
                break
    positions = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
    chosen = positions(sure)
    return np.concatenate([chosen, positions(open_)[: k - len(chosen)]])


def search(query: np.ndarray, own: int, base: int, planes: np.ndarray, ids: np.ndarray, k: int):
    """``(ids, scores)`` of a block's best rows for one query."""
    dims, bits, words = planes.shape
    q = floors(query)[:dims]
    size = np.abs(q)
    top = int(size.max(initial=0)).bit_length()
    levels = [[] for _ in range(top + bits)]
    for i in range(top):
        for sign, flip in ((1, False), (-1, True)):
            which = np.flatnonzero((size >> i & 1).astype(bool) & (q * sign > 0))
            if len(which):
                for j in range(bits):
                    picked = planes[which, j]
                    levels[i + j].append(~picked if flip else picked)
    none = np.empty((0, words), np.uint64)
    total = added([np.concatenate(x) if x else none for x in levels], words)
    among = np.zeros(words * 8, np.uint8)
    marks = np.packbits(ids != own, bitorder="little")
    among[: len(marks)] = marks
    at = best(total, among.view(np.uint64), k)
    word, bit = at // 64, (at % 64).astype(np.uint64)
    # what complements and the base have added or left out
    off = base * sum(q.tolist()) - sum(size[q < 0].tolist()) * ((1 << bits) - 1)
    found = np.zeros(len(at), np.int64 if len(total) < 62 and abs(off) < 1 << 62 else object)
    for i, plane in enumerate(total):
        found += (plane[word] >> bit & np.uint64(1)).astype(found.dtype) << i
    return ids[at], found + off


def _ordered(score: int) -> bytes:
    """Bytes in the order of the scores beyond a long of one sign."""
    size = abs(score)
    n = -(-size.bit_length() // 8)
    key = n.to_bytes(4, "big") + size.to_bytes(n, "big")
    return key if score > 0 else bytes(255 - x for x in key)


def _answers(number: int, own: int, ids: np.ndarray, scores: np.ndarray) -> pd.DataFrame:
    """Rows of ``_FOUND``: a score beyond a long is null, and its side and bytes have its order."""
    side = [(x > _LONG) - (x < -_LONG - 1) for x in scores.tolist()]
    wide = [_ordered(int(x)) if s else None for x, s in zip(scores.tolist(), side)]
    score = pd.array([None if s else int(x) for x, s in zip(scores.tolist(), side)], "Int64")
    return pd.DataFrame({"number": number, "query_id": own, "vec_id": ids, "score": score, "side": side, "wide": wide})


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids = np.frombuffer(row.ids, np.int64)
                planes = np.frombuffer(row.planes, np.uint64).reshape(row.dims, row.bits, -1) if row.dims else np.zeros((0, 1, -(-len(ids) // 64)), np.uint64)
                out = []
                for number, own, vector in zip(row.numbers, row.queries, row.vectors):
                    found, score = search(np.asarray(vector), own, int(row.base), planes, ids, k)
                    out.append(_answers(number, own, found, score))
                if out:
                    yield pd.concat(out).astype({"number": "int64", "query_id": "int64", "side": "int32"})

    return run


def top_k(embeddings: DataFrame, every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose vec_id is divisible by ``every``, the ``k`` rows
    with another vec_id and the largest integer inner product, ties to smaller vec_id; all, if fewer.

    Every usable row is indexed and every query meets every block. Repeated rows are candidates, and queries, of
    their own. A shorter vector counts as ending in zeros. Ranks are exact for finite components of any size; a score that
    does not fit a long is null. An empty table has no rows."""
    spark = embeddings.sparkSession
    rows = store(quantised(embeddings, scale), "quantised")
    n = rows.count()
    blocks = max(1, -(-n // BLOCK))
    index = store(rows.repartition(blocks).mapInPandas(_index, _INDEX), "index")
    asked = rows.where(F.col("vec_id") % every == 0)
    n_chunks = max(1, -(-asked.count() // CHUNK))
    groups = min(n_chunks, max(1, -(-KEYS // blocks)))
    numbered = store(
        asked.withColumn("number", F.monotonically_increasing_id())
        .withColumn("chunk", F.pmod(F.xxhash64("number"), F.lit(n_chunks))),
        "queries",
    )
    one = F.sort_array(F.collect_list(F.struct("number", "vec_id", "v")))
    chunks = numbered.groupBy("chunk").agg(one.alias("all")).select(
        (F.col("chunk") % groups).alias("group"),
        F.col("all.number").alias("numbers"),
        F.col("all.vec_id").alias("queries"),
        F.col("all.v").alias("vectors"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    dealt = index.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    pairs = dealt.join(chunks, ["block", "group"])
    answers = pairs.drop("block", "group").mapInPandas(_search(k), _FOUND)
    order = Window.partitionBy("number").orderBy(F.desc("side"), F.desc("score"), F.desc("wide"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
