"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks of about ``BLOCK_DOCS`` documents by a hash. A source whose target is ``t`` times
its size gives ``floor(t)`` whole passes over its blocks and, in one more pass, the first blocks of a permutation
until the target is met: the last block is taken in part. With ``entire`` documents, as the query and the pipeline
draw them, its last document is taken or left, whichever is nearer the target; else it is taken as a prefix. These
exact block quotas are split among the output shards by a binary tree: each node hands its left child a
multivariate-hypergeometric draw of its quotas. A shard takes its quota as the next run of the source's permuted
blocks, so shards are disjoint, and shuffles its documents locally.

Only counts per source, per block and per group of blocks meet in one place; documents of a hot source are spread
over its blocks. Everything follows from the seed and the rows, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm.common import keyed, pick, store

WORD = r"[^\x20\x09-\x0D]+"
#: documents in a block, and blocks whose words are summed in one place
BLOCK_DOCS, GROUP = 64, 4096
#: the tree's draws need fewer blocks than this in all
MAX_BLOCKS = 400_000_000
#: words in an output shard, and shards at most
SHARD_WORDS, MAX_SHARDS = 1_000_000, 4096
#: a table of so many sources is small enough to broadcast; a larger one is joined by a shuffle
BROADCAST_SOURCES = 100_000
WEIGHTS = (5.0, 2.0, 1.0)
#: a prime, so it has no factor in common with a smaller number of blocks
_STRIDE = 2_147_483_647


def _positions(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``position`` in the order given, from 0, by a range-partitioned sort; what the driver sees is
    one count for each partition."""
    at = F.monotonically_increasing_id()
    cut = store(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.shiftright(at, 33)).withColumn("at", at.bitwiseAND(F.lit((1 << 33) - 1))),
        "sorted",
    )
    before, starts = 0, {}
    for part, n in sorted(cut.groupBy("part").count().collect()):
        starts[part], before = before, before + n
    if not starts:
        return cut.withColumn("position", F.col("at")).drop("part", "at")
    start = F.create_map(*[F.lit(x).cast("long") for pair in starts.items() for x in pair])
    return cut.withColumn("position", start[F.col("part")] + F.col("at")).drop("part", "at")


def targets(sources: DataFrame, share: float = 1.5, ceiling: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """``sources (s, words, docs)`` with ``rank`` and ``target``: ``share`` of all words by weight, no target above
    ``ceiling`` times its source; the excess is shared again by weight until none is above."""
    ranked = _positions(sources, F.col("s").isNull(), F.col("s")).withColumnRenamed("position", "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = store(ranked.withColumn("weight", weight).withColumn("cap", F.lit(ceiling) * F.col("words")), "ranked")
    total = share * (ranked.agg(F.sum("words")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        above = F.col("cap") <= F.lit(level) * F.col("weight")
        n, given, open_weight = ranked.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == capped or not open_weight:
            break
        level, capped = (total - (given or 0.0)) / open_weight, n
    return ranked.withColumn("target", F.least("cap", F.lit(level) * F.col("weight")))


def _split(seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """One node's quotas drawn apart for its two children; a node of one shard stays."""
        lo, hi = int(rows["lo"].iat[0]), int(rows["hi"].iat[0])
        if hi - lo < 2:
            return rows
        rows = rows.sort_values("rank", ignore_index=True)
        quota = rows["quota"].to_numpy(np.int64)
        middle = (lo + hi) // 2
        share = int(round(int(quota.sum()) * ((middle - lo) / (hi - lo))))
        draw = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(quota, share, method="marginals")
        left = rows.assign(hi=middle, quota=draw)
        right = rows.assign(lo=middle, quota=quota - draw)
        return pd.concat([left, right])

    return run


def shard_quotas(sources: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``(rank, ends)``: for each source with its ``quota`` of blocks, where each shard's run of them ends."""
    node = sources.select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "rank", "quota")
    width = shards
    while width > 1:
        node = node.groupBy("lo", "hi").applyInPandas(_split(seed), "lo long, hi long, rank long, quota long")
        width = -(-width // 2)
    runs = node.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("lo", "quota"))).alias("runs"))
    none = F.lit(0).cast("long")
    ends = F.transform("runs", lambda _, i: F.aggregate(F.slice("runs", 1, i + 1), none, lambda a, x: a + x["quota"]))
    return store(runs.select("rank", ends.alias("ends")), "quotas")


def _with_sources(df: DataFrame, sources: DataFrame, n: int, on: str) -> DataFrame:
    return df.join(F.broadcast(sources) if n <= BROADCAST_SOURCES else sources, on)


def draws(
    documents: DataFrame,
    share: float = 1.5,
    ceiling: float = 2.0,
    weights: tuple = WEIGHTS,
    shard_words: int = SHARD_WORDS,
    seed: int = 0,
    entire: bool = False,
) -> DataFrame:
    """``(row, doc_id, size, source_size, target, taken, shards, whole)``: one row per document.

    ``size`` counts the words of the whole text (null: 0). Sources by code point, null last, weigh ``weights``,
    repeating. ``taken`` are the words the mix takes, repeats counted; ``shards`` names the shard of each time the
    document is drawn; the last draw is a prefix unless ``whole``. A source's taken words meet its target to the
    word, or, where only ``entire`` documents are drawn, to half the words of one document. Repeated rows are drawn on their own; an empty table gives an empty result."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = store(
        keyed(documents, pick(documents, "source", "string", "s"))
        .select("row", "doc_id", "s", size.alias("size"), F.xxhash64("doc_id", "text", F.lit(seed)).alias("h")),
        "sizes",
    )
    counted = sized.groupBy("s").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    plan = store(targets(counted, share, ceiling, weights), "targets")
    n_sources, all_docs, all_words = plan.agg(F.count("*"), F.sum("docs"), F.sum("target")).first()
    shards = min(MAX_SHARDS, max(1, int((all_words or 0) // shard_words)))
    block_docs = max(BLOCK_DOCS, int(ceiling + 1) * (all_docs or 0) // MAX_BLOCKS)
    goal = F.least(F.round("target").cast("long"), F.floor(F.lit(ceiling) * F.col("words")).cast("long"))
    passes = F.when(F.col("words") > 0, F.floor(goal / F.col("words"))).otherwise(0).cast("long")
    plan = plan.withColumn("passes", passes)
    plan = plan.withColumn("rest", goal - F.col("passes") * F.col("words"))
    plan = plan.withColumn("blocks", F.ceil(F.col("docs") / block_docs).cast("long"))
    plan = store(plan, "plan")
    small = plan.select("s", "rank", "words", "target", "passes", "rest", "blocks")
    # null-safe: the null source has a rank like any other
    known = F.broadcast(small) if n_sources <= BROADCAST_SOURCES else small
    keyed_rows = sized.join(known, sized["s"].eqNullSafe(small["s"]))
    block = F.pmod(F.col("h"), F.col("blocks"))
    rows = store(keyed_rows.select("row", "doc_id", "size", "h", "rank", block.alias("block")), "rows")

    summed = rows.groupBy("rank", "block").agg(F.sum("size").alias("block_words"))
    turned = _with_sources(summed, plan.select("rank", "words", "passes", "rest", "blocks"), n_sources, "rank")
    turned = turned.withColumn("pos", (F.col("block") * _STRIDE + F.col("passes") * (seed + 7919)) % F.col("blocks"))
    turned = store(turned.withColumn("group", F.floor(F.col("pos") / GROUP).cast("long")), "turned")
    group_order = Window.partitionBy("rank").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = turned.groupBy("rank", "group").agg(F.sum("block_words").alias("group_words"))
    before = F.coalesce(F.sum("group_words").over(group_order), F.lit(0))
    groups = groups.select("rank", "group", before.alias("before"))
    in_group = Window.partitionBy("rank", "group").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("block_words").over(in_group), F.lit(0))
    placed = turned.withColumn("inside", inside).join(groups, ["rank", "group"])
    left = F.col("rest") - F.col("before") - F.col("inside")
    placed = store(placed.withColumn("left", F.greatest(F.lit(0), F.least(left, F.col("block_words")))), "placed")

    # a block that is drawn in part counts as a block of its source's quota
    last_drawn = F.coalesce(F.max(F.when(F.col("left") > 0, F.col("pos") + 1)), F.lit(0))
    partial = placed.groupBy("rank").agg(last_drawn.alias("partial"))
    drawn_blocks = F.col("passes") * F.col("blocks") + F.col("partial")
    quota = plan.join(partial, "rank").select("rank", drawn_blocks.alias("quota"))
    ends = shard_quotas(store(quota, "quota"), shards, seed)
    where = _with_sources(placed, ends, n_sources, "rank")
    shard_of = lambda at: F.size(F.filter("ends", lambda e: e <= at))
    turn = lambda p: (F.col("block") * _STRIDE + p * (seed + 7919)) % F.col("blocks")
    each_pass = F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)
    full = F.when(
        F.col("passes") > 0, F.transform(each_pass, lambda p: shard_of(p * F.col("blocks") + turn(p)))
    ).otherwise(F.array().cast("array<int>"))
    # only what lies in a shard's run is drawn
    full = F.filter(full, lambda s: s < shards)
    last = shard_of(F.col("passes") * F.col("blocks") + F.col("pos"))
    blocks = where.select("rank", "block", "words", "passes", "left", full.alias("full"), last.alias("last"))
    target = plan.select("rank", "target")
    blocks = _with_sources(blocks, target, n_sources, "rank")

    in_block = Window.partitionBy("rank", "block").orderBy("h", "doc_id", "size", "row")
    order = in_block.rowsBetween(Window.unboundedPreceding, -1)
    drawn = rows.join(blocks, ["rank", "block"]).withColumn("ahead", F.coalesce(F.sum("size").over(order), F.lit(0)))
    part = F.greatest(F.lit(0), F.least(F.col("left") - F.col("ahead"), F.col("size")))
    if entire:
        part = F.when(2 * part >= F.col("size"), F.col("size")).otherwise(F.lit(0).cast("long"))
    part = F.when(F.col("last") < shards, part).otherwise(F.lit(0).cast("long"))
    return drawn.select(
        "row",
        "doc_id",
        "size",
        F.col("words").alias("source_size"),
        "target",
        (F.size("full") * F.col("size") + part).alias("taken"),
        F.when(part > 0, F.concat("full", F.array("last"))).otherwise(F.col("full")).alias("shards"),
        ((part == 0) | (part == F.col("size"))).alias("whole"),
        F.col("passes"),
        part.alias("part"),
        "h",
    )


def mixture(documents: DataFrame, seed: int = 0, **options) -> DataFrame:
    """The mix itself: the rows of ``documents``, all columns, once for each draw, with ``shard``-wise local order
    in the partitions. A last draw in part keeps the text up to its last taken word (``n_chars`` follows, if the
    table has it). Documents without words are never drawn in part; they follow their block in whole passes."""
    plan = store(draws(documents, seed=seed, **options).select("row", "h", "shards", "whole", "part"), "draws")
    times = F.size("shards").alias("times")
    drawn = plan.select("row", "h", "whole", "part", times, F.posexplode("shards").alias("turn", "shard"))
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("all"))
    picked = rows.join(drawn, "row")
    cut = ~F.col("whole") & (F.col("turn") == F.col("times") - 1)
    columns = []
    for name in documents.columns:
        value = F.col("all").getField(name)
        if name == "text":
            value = F.when(cut, prefix(value, F.col("part"))).otherwise(value)
        if name == "n_chars" and "text" in documents.columns:
            text = F.col("all").getField("text")
            value = F.when(cut, F.length(prefix(text, F.col("part")))).otherwise(value)
        columns.append(value.alias(name))
    local = F.xxhash64("h", "turn", F.lit(seed + 1))
    return (
        picked.select(*columns, F.col("shard").alias("__shard"), local.alias("__order"))
        .repartition("__shard", F.pmod("__order", F.lit(64)))
        .sortWithinPartitions("__shard", "__order")
        .drop("__shard", "__order")
    )


def prefix(text: Column, words: Column) -> Column:
    """``text`` up to the end of its ``words``-th word."""
    each = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(each, F.lit(1), words.cast("int")), "")
