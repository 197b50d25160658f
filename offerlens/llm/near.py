"""Near-duplicates by MinHash with tensored banding.

Two small collections of ``side`` band hashes are computed per set of shingles, each band of ``rows`` minhashes.
The ``side * side`` table keys combine every band of the first collection with every band of the second, so
``2 * side * rows`` minhashes serve ``side ** 2`` tables of ``2 * rows`` minhashes. A link of similarity ``s`` is
missed with probability ``1 - (1 - (1 - s**rows) ** side) ** 2``: 9e-5 at 0.8 with the defaults.

Equal sets are one class before any key is made. No bucket is expanded into its pairs:

1. Each member of a bucket is compared with the smallest one only, on the full sets. Pairs that are similar enough
   are links; pairs that are at least ``KIN`` similar make families.
2. Within a family whose links leave several components, what is not in its largest component is compared with
   everything else, in blocks: a task gets two blocks of sets and returns the links, so sets are sent once per
   block and not once per pair. Members of the largest component are never compared among themselves.
3. Buckets that hold several families compare members of different families, all of them.

So a link between two sets that share a bucket is always found or already implied by others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import components, joined_components, keyed, store

#: bands in each collection, and minhashes in a band
SIDE, ROWS = 14, 3
#: similarity in percent from which two sets are of one family
KIN = 40
#: sets and shingles of a block, and columns that are compared at once
SETS, SHINGLES, COLUMNS = 256, 100_000, 4096
#: words whose hashes a task remembers
WORDS = 150_000
#: shingles that are hashed at once
PART = 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SKETCH = "row long, doc_id long, n long, whole binary, a array<long>, b array<long>"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's shingles of ``size`` words.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; a text with fewer words is one shingle, a text
    without words has none."""

    def __init__(self, size: int):
        self.size = size
        self.words: dict[bytes, int] = {}

    def _word(self, word: bytes) -> int:
        if word in self.words:
            return self.words[word]
        if len(self.words) >= WORDS:
            self.words.clear()
        self.words[word] = out = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        found = list(map(self.words.get, words))
        if None in found:
            found = [self._word(w) if f is None else f for w, f in zip(words, found)]
        h = np.array(found, np.uint64)
        k = min(self.size, len(h))
        out = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            out = _mixed(out * _ODD + h[i : len(h) - k + 1 + i] + np.uint64(k))
        return np.unique(out)


def _sketch(size: int, side: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        factors = _mixed(np.arange(1, 2 * side * rows + 1, dtype=np.uint64) * _ODD)[:, None] | np.uint64(1)
        for batch in batches:
            out = []
            texts = batch.column("text").cast(pa.binary())
            for row, doc, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), texts):
                s = shingles(text.as_py() or b"")
                if not len(s):
                    out.append((row, doc, 0, None, None, None))
                    continue
                # the hashes are mixed already, so an odd factor gives another order
                least = (factors * s[:PART]).min(1)
                for start in range(PART, len(s), PART):
                    least = np.minimum(least, (factors * s[start : start + PART]).min(1))
                least = _mixed(least).reshape(2, side, rows)
                band = least[:, :, 0]
                for r in range(1, rows):
                    band = _mixed(band * _ODD + least[:, :, r])
                whole = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                a, b = band.view(np.int64).tolist()
                out.append((row, doc, len(s), whole, a, b))
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names=["row", "doc_id", "n", "whole", "a", "b"]
            )
        shingles.words.clear()  # the worker lives on

    return run


def _keys(reps: DataFrame, *more: str) -> DataFrame:
    """``(key, rep, n)``: every band of ``a`` with every band of ``b``."""
    return (
        reps.select("rep", "n", *more, F.posexplode("a").alias("i", "ha"), "b")
        .select("rep", "n", *more, "i", "ha", F.posexplode("b").alias("j", "hb"))
        .select(F.xxhash64("i", "j", "ha", "hb").alias("key"), "rep", "n", *more)
    )


_STAR = "key long, rep long, n long, other long, more long"


def _fits(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of such sizes can be similar enough at all."""
    return (100 * n >= percent * m) & (100 * m >= percent * n)


def _local_stars(side: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per batch of sketches: one row for each key, with its smallest member, and pairs of that with the others
        of the key."""
        spread = _mixed(np.arange(1, side * side + 1, dtype=np.uint64) * _ODD).reshape(1, side, side)
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 2000):
                batch = whole_batch.slice(start, 2000)
                rows = batch.num_rows
                rep, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "n"))
                a, b = (
                    np.asarray(batch.column(c).flatten()).view(np.uint64).reshape(rows, side) for c in ("a", "b")
                )
                key = _mixed(_mixed(a)[:, :, None] * _ODD + b[:, None, :] + spread).reshape(-1).view(np.int64)
                who = np.repeat(np.arange(rows), side * side)
                order = np.lexsort((rep[who], key))
                key, who = key[order], who[order]
                head = np.r_[True, key[1:] != key[:-1]]
                centre = who[head][np.cumsum(head) - 1]
                first = who[head]
                yield _star_batch(key[head], rep[first], n[first], None, None)
                pairs = np.unique(np.stack([centre[~head], who[~head]], 1), axis=0)
                x, y = pairs[:, 0], pairs[:, 1]
                # a pair travels by a key of its own
                yield _star_batch(rep[x] * 31 + rep[y], rep[x], n[x], rep[y], n[y])

    return run


def _star_batch(key, rep, n, other, more) -> pa.RecordBatch:
    none = pa.nulls(len(key), pa.int64())
    return pa.record_batch(
        [pa.array(key), pa.array(rep), pa.array(n), none if other is None else pa.array(other),
         none if more is None else pa.array(more)],
        names=["key", "rep", "n", "other", "more"],
    )


def _stars(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by (key, rep): pairs of each bucket's first member with its others, and whether the sizes
        of the sets allow a link; no group is held."""
        last_key, last = None, None
        for batch in batches:
            made = batch.filter(batch.column("other").is_valid())
            x, nx, y, ny = (made.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "n", "other", "more"))
            out = [np.stack([x, y, _fits(nx, ny, percent)], 1).astype(np.int64)]
            members = batch.filter(batch.column("other").is_null())
            key, rep, n = (members.column(c).to_numpy(zero_copy_only=False) for c in ("key", "rep", "n"))
            if len(key):
                head = np.r_[last_key is None or key[0] != last_key, key[1:] != key[:-1]]
                starts, at = np.flatnonzero(head), np.cumsum(head) - 1
                centre = np.stack([rep, n], 1)[starts][at] if len(starts) else np.empty((len(key), 2), np.int64)
                if last is not None:
                    centre[at < 0] = last
                last_key, last = key[-1], centre[-1].copy()
                out.append(np.stack([centre[:, 0], rep, _fits(centre[:, 1], n, percent)], 1)[~head])
            found = np.unique(np.concatenate(out), axis=0)
            columns = [pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(found[:, 2] > 0)]
            yield pa.record_batch(columns, names=["x", "y", "fits"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for start in range(0, batch.num_rows, 500):
                part = [shingles(t.as_py() or b"").tobytes() for t in texts.slice(start, 500)]
                yield pa.record_batch(
                    [batch.column("row").slice(start, 500), pa.array(part, pa.binary())], names=["v", "set"]
                )
        shingles.words.clear()

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs that are kin, and whether they are linked."""
        for batch in batches:
            kin, linked = np.zeros((2, batch.num_rows), bool)
            last, one = None, None
            for i, (x, sx, sy) in enumerate(zip(batch.column("x").to_pylist(), batch.column("sx"), batch.column("sy"))):
                if x != last:
                    last, one = x, _unpacked(sx.as_py())
                other = _unpacked(sy.as_py())
                both = len(one) + len(other) - len(np.unique(np.concatenate([one, other])))
                either = len(one) + len(other) - both
                linked[i] = 100 * both >= percent * either
                kin[i] = linked[i] or 100 * both >= KIN * either
            mask = pa.array(kin)
            columns = [batch.column("x"), batch.column("y"), pa.array(linked)]
            yield pa.record_batch([c.filter(mask) for c in columns], names=["x", "y", "linked"])

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left set with every right one."""
    sizes = [len(s) for s in (*left, *right)]
    values, column = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # only columns that both sides have count
    lower = np.zeros(len(values), bool)
    upper = np.zeros(len(values), bool)
    lower[column[owner < len(left)]] = True
    upper[column[owner >= len(left)]] = True
    both = lower & upper
    keep = both[column]
    number = np.cumsum(both) - 1
    column, owner = number[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(both.sum()), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        table = np.zeros((len(sizes), COLUMNS), np.float32)
        table[owner[a:b], column[a:b] - start] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out.astype(np.int64)


def _block_links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Links between the two blocks that meet under a key, of different components."""
        rep, label, side = (table.column(c).to_numpy() for c in ("rep", "label", "side"))
        sets = [_unpacked(s.as_py()) for s in table.column("set")]
        n = np.array([len(s) for s in sets], np.int64)
        l, r = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(r):  # a block with itself
            r = l
        if not len(l) or not len(r):
            return pa.table({"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64())})
        both = overlaps([sets[i] for i in l], [sets[i] for i in r])
        either = n[l][:, None] + n[r][None, :] - both
        linked = (100 * both >= percent * either) & (label[l][:, None] != label[r][None, :])
        i, j = np.nonzero(linked)
        x, y = rep[l[i]], rep[r[j]]
        return pa.table({"x": pa.array(np.minimum(x, y)), "y": pa.array(np.maximum(x, y))})

    return run


def _family_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within families ``members (rep, n, family, label)`` between different components."""
    sizes = store(members.groupBy("family", "label").agg(F.count("*").alias("docs"), F.sum("n").alias("n")), "sizes")
    whole = sizes.groupBy("family").agg(
        F.max_by("label", F.struct("docs", "label")).alias("main"),
        F.max_by(F.struct("docs", "n"), F.struct("docs", "label")).alias("m"),
        F.sum("docs").alias("docs"),
        F.sum("n").alias("n"),
    )

    def n_blocks(docs, n):
        return F.greatest(F.ceil(docs / SETS), F.ceil(n / SHINGLES), F.lit(1)).cast("long")

    plan = store(
        whole.where(F.col("docs") > F.col("m.docs")).select(
            "family", "main", n_blocks(F.col("m.docs"), F.col("m.n")).alias("mains"),
            n_blocks(F.col("docs") - F.col("m.docs"), F.col("n") - F.col("m.n")).alias("others"),
        ),
        "families",
    )
    placed = members.join(plan, "family")
    main = F.col("label") == F.col("main")
    block = F.pmod(F.xxhash64("rep"), F.when(main, F.col("mains")).otherwise(F.col("others")))
    placed = placed.withColumn("block", block)

    def upto(n):
        return F.sequence(F.lit(0).cast("long"), n - 1)

    def key(kind, a, b, side):
        return F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), F.lit(side).alias("side"))

    with_others = F.transform(
        upto(F.col("others")),
        lambda j: F.when(j < F.col("block"), key(0, j, F.col("block"), 1)).otherwise(key(0, F.col("block"), j, 0)),
    )
    with_main = F.transform(upto(F.col("mains")), lambda j: key(1, F.col("block"), j, 0))
    from_main = F.transform(upto(F.col("others")), lambda j: key(1, j, F.col("block"), 1))
    keys = F.when(main, from_main).otherwise(F.concat(with_others, with_main))
    dealt = placed.select("rep", "label", "family", F.explode(keys).alias("k")).select("rep", "label", "family", "k.*")
    met = dealt.join(sets.withColumnRenamed("v", "rep"), "rep")
    found = met.groupBy("family", "kind", "a", "b").applyInArrow(_block_links(percent), "x long, y long")
    return store(found.distinct(), "family-links")


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint64)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are kin, and whether they are linked. A set is sent once for each pair it is the second of, and a
    centre's set once; where a centre has a hot number of partners the join is split like any other."""
    with_y = pairs.join(sets.select(F.col("v").alias("y"), F.col("set").alias("sy")), "y")
    centres = sets.join(pairs.select(F.col("x").alias("v")).distinct(), "v", "left_semi")
    both = with_y.join(centres.select(F.col("v").alias("x"), F.col("set").alias("sx")), "x")
    return store(
        both.select("x", "y", "sx", "sy").mapInArrow(_confirm(percent), "x long, y long, linked boolean"), "confirmed"
    )


def near_duplicates(
    documents: DataFrame, size: int = 5, percent: int = 80, side: int = SIDE, rows: int = ROWS
) -> DataFrame:
    """``(row, doc_id, n_shingles, component_id, component_row, links, kept)``: one row per document.

    Documents are linked if ``100 * intersection >= percent * union`` of their sets of ``size``-word shingles.
    ``component_id`` is the smallest doc_id that links reach, the document's own included; the component's first
    row with that id is kept (a null id counts as the largest). Null and empty texts are linked with nothing.
    ``links`` counts the confirmed links between a document's class of equal sets and other classes that were
    needed to show the components."""
    rows_in = keyed(documents)
    sketch = store(rows_in.mapInArrow(_sketch(size, side, rows), _SKETCH), "sketch")
    classes = sketch.where("n > 0").groupBy("whole", "n").agg(
        F.min("row").alias("rep"), F.min_by(F.struct("a", "b"), "row").alias("s")
    )
    classes = store(classes.select("whole", "n", "rep", "s.a", "s.b"), "classes")
    local = classes.select("rep", "n", "a", "b").mapInArrow(_local_stars(side), _STAR)
    stars = local.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(_stars(percent), "x long, y long, fits boolean")
    sizes = classes.select("rep", "n")
    candidates = store(stars.distinct(), "candidates")
    involved = store(candidates.select(F.explode(F.array("x", "y")).alias("row")).distinct(), "involved")
    sets = store(
        rows_in.select("row", "text").join(involved, "row", "left_semi").mapInArrow(_sets(size), "v long, set binary"),
        "sets",
    )
    kin = _confirmed(candidates.where("fits").select("x", "y"), sets, percent)
    links = kin.where("linked").select("x", "y")
    label = components(links)
    family = components(kin).withColumnRenamed("label", "family")
    members = (
        sizes.join(family.withColumnRenamed("v", "rep"), "rep").join(label.withColumnRenamed("v", "rep"), "rep", "left")
        .select("rep", "n", "family", F.coalesce("label", "rep").alias("label"))
    )
    within = _family_links(store(members, "members"), sets, percent)
    # what is left: members of one bucket in different families
    again = (
        classes.join(involved.withColumnRenamed("row", "rep"), "rep")
        .join(family.withColumnRenamed("v", "rep"), "rep", "left")
        .withColumn("label", F.coalesce("family", "rep"))
    )
    keys = _keys(again, "label")
    mixed = keys.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    open_keys = store(keys.join(store(mixed.select("key"), "open"), "key"), "open-keys")
    left, right = open_keys.alias("l"), open_keys.alias("r")
    rest = left.join(
        right,
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.label") < F.col("r.label"))
        & (F.lit(100) * F.col("l.n") >= F.lit(percent) * F.col("r.n"))
        & (F.lit(100) * F.col("r.n") >= F.lit(percent) * F.col("l.n")),
    ).select(F.least("l.rep", "r.rep").alias("x"), F.greatest("l.rep", "r.rep").alias("y"))
    rest = store(rest.distinct().join(candidates, ["x", "y"], "left_anti"), "rest")
    more = _confirmed(rest, sets, percent).where("linked").select("x", "y")
    more = store(more.unionByName(within), "more")
    if not more.isEmpty():
        links = store(links.union(more).distinct(), "links")
        label = joined_components(label, more)
    return _labelled(sketch, classes, links, label)


def _labelled(sketch: DataFrame, classes: DataFrame, links: DataFrame, label: DataFrame) -> DataFrame:
    degree = links.select(F.explode(F.array("x", "y")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    member = (
        classes.select("whole", "n", "rep").join(label.withColumnRenamed("v", "rep"), "rep", "left").join(degree, "rep", "left")
        .select("whole", "n", F.coalesce("label", "rep").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    member = store(member, "members")
    docs = store(
        sketch.select("row", "doc_id", "n", "whole").join(member, ["whole", "n"], "left")
        .select("row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "row").alias("label"), F.coalesce("links", F.lit(0)).alias("links")),
        "labelled",
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), F.col("row").alias("at"))
    heads = store(
        docs.groupBy("label").agg(F.min(order).alias("head"), F.count("*").alias("size")).where("size > 1"), "heads"
    )
    out = docs.join(heads, "label", "left")
    alone = F.col("size").isNull()
    return out.select(
        "row",
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc")).alias("component_id"),
        F.when(alone, F.col("row")).otherwise(F.col("head.at")).alias("component_row"),
        "links",
        (alone | (F.col("head.at") == F.col("row"))).alias("kept"),
    )


def drop_near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """The rows of ``documents`` that ``near_duplicates`` keeps, all their columns unchanged."""
    kept = near_duplicates(documents, **options).where("kept").select(F.col("row").alias("__row"))
    rows = documents.select(F.monotonically_increasing_id().alias("__row"), F.struct("*").alias("__all"))
    return rows.join(kept, "__row").select("__all.*")
