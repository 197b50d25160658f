"""Aggregates. Counting distinct ids is split by Spark over (group, id), so a large group is no
single task's work; the exact median below is split over sorted runs of values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import round_half_away
from .lookup import fits_broadcast
from .tables import materialize

#: A sketch's ranks are wrong by one part in ACCURACY of a group at most; a band reaches REACH such parts to both sides.
ACCURACY, REACH = 500, 3
#: Places of the two values around the middle of a sorted group, from 0.
_LOW, _HIGH = "(_all - 1) div 2", "_all div 2"


def distinct_count_by(df: DataFrame, row_id: str, *keys: str, out: str = "num_ofertas") -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(row_id).alias(out))


def total_of(n: str, *partition: str) -> Column:
    """Total of ``n`` over the rows of the partition; meant for already grouped rows."""
    return F.sum(n).over(Window.partitionBy(*partition))


def match_rate(df: DataFrame, missing: Column, *keys: str) -> DataFrame:
    """Rows per group, and how many of them satisfy ``missing``, in one pass."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(missing).alias("sin_coincidencia")
    )


def exact_median(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Rows (keys, n, media, mediana) with the interpolated median over all non-null values.

    A mergeable quantile sketch of each group gives two values around its middle. Values outside this band are
    only counted and added up in the tasks; equal ones inside are counted exactly, and these counts alone are sorted
    to find the middle. Exact counts tell whether a band holds it: a group whose band does not, and all groups where
    their bounds are too many to broadcast, have all their values sorted instead.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    if not keys:
        return _sorted_median(rows)
    ends = [F.lit(0.5 - REACH / ACCURACY), F.lit(0.5 + REACH / ACCURACY)]
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("_v", F.array(*ends), ACCURACY).alias("_band"))
    bounds = materialize(
        sketch.select(
            *[F.col(k).alias(f"_b_{k}") for k in keys], F.get("_band", 0).alias("_from"), F.get("_band", 1).alias("_to")
        )
    )
    if not fits_broadcast(bounds):
        return _sorted_median(rows, *keys)
    counted = materialize(banded_counts(rows, F.broadcast(bounds), *keys))
    outside = lambda side: F.sum(F.when(F.col("_side") == side, F.col("_n")).otherwise(0))
    totals = counted.groupBy(*keys).agg(
        F.sum("_n").alias("_all"), F.sum("_s").alias("_sum"), outside(-1).alias("_below"), outside(0).alias("_inside")
    )
    inside = F.expr(f"_below <= {_LOW} AND _below + _inside > {_HIGH}")
    found = _middle(counted.filter("_side = 0").select(*keys, "_v", "_n"), totals.filter(inside), *keys)
    missed = totals.filter(~inside).select(*[F.col(k).alias(f"_b_{k}") for k in keys])
    if missed.isEmpty():
        return found
    return found.unionByName(_sorted_median(rows.join(F.broadcast(missed), _same(keys, "_b_"), "left_semi"), *keys))


def banded_counts(rows: DataFrame, bounds: DataFrame, *keys: str) -> DataFrame:
    """Counts ``_n`` and sums ``_s`` of ``rows`` (keys, _v) by group, side of the group's band, and, inside, by value."""
    side = F.when(F.col("_v") < F.col("_from"), -1).when(F.col("_v") > F.col("_to"), 1).otherwise(0)
    sided = rows.join(bounds, _same(keys, "_b_")).select(*keys, side.alias("_side"), "_v")
    within = F.when(F.col("_side") == 0, F.col("_v")).alias("_within")
    counts = sided.groupBy(*keys, "_side", within).agg(F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_s"))
    return counts.withColumnRenamed("_within", "_v")


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Equality of ``keys`` and their copies under ``prefix``; NULL is a group too."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _sorted_median(rows: DataFrame, *keys: str) -> DataFrame:
    """``exact_median`` of ``rows`` (keys, _v) by the counts of all values."""
    return _middle(rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")), None, *keys)


def _middle(counted: DataFrame, totals: DataFrame | None, *keys: str) -> DataFrame:
    """Rows (keys, n, media, mediana) from ``counted`` (keys, _v, _n), the counts of a group's neighbouring values.

    ``totals`` has for each group how many values it has (_all), their sum (_sum) and how many are below the
    counted ones (_below); without it the counts are all there is. The counts are sorted by group and value over all
    tasks, wherever the cuts between tasks fall, and written. What each task holds of a group tells which tasks reach
    its middle, so a group of any size and any closeness of values is spread evenly. Only per-task totals of a group
    meet in one place.
    """
    order = [F.col(k).asc_nulls_first() for k in (*keys, "_v")]
    cut = materialize(
        counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    )
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_here").over(earlier), F.lit(0))
    named = [F.col(k).alias(f"_p_{k}") for k in (*keys, "_part")]
    parts = cut.groupBy(*keys, "_part").agg(
        F.sum("_n").alias("_here"), F.sum(F.col("_v") * F.col("_n")).alias("_s")
    )
    if totals is None:
        placed = parts.select(
            *named,
            before.alias("_before"),
            "_here",
            F.sum("_here").over(group).alias("_all"),
            F.sum("_s").over(group).alias("_sum"),
        )
    else:
        whole = totals.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "_all", "_sum", "_below")
        placed = parts.select(*named, before.alias("_before"), "_here").join(
            whole, reduce(and_, [F.col(f"_p_{k}").eqNullSafe(F.col(f"_t_{k}")) for k in keys])
        )
        placed = placed.withColumn("_before", F.col("_before") + F.col("_below"))
    middle = placed.filter(f"_before <= {_HIGH} AND _before + _here > {_LOW}")
    inside = (
        Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = (
        cut.join(middle, _same((*keys, "_part"), "_p_"))
        .withColumn("_last", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_first", F.col("_last") - F.col("_n"))
    )
    hits = ranked.filter(f"_first <= {_HIGH} AND _last > {_LOW}")
    return hits.groupBy(*keys).agg(
        F.max("_all").alias("n"),
        (F.max("_sum") / F.max("_all")).alias("media"),
        ((F.min("_v") + F.max("_v")) / 2).alias("mediana"),
    )


def mean_median_by(df: DataFrame, value: str, *keys: str, approx: bool = False) -> DataFrame:
    """Rows (keys, n, media, mediana), both rounded to whole units.

    ``approx=True`` trades the exact median for a sketch, for exploratory use.
    """
    if approx:
        found = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(value).alias("media"),
            F.percentile_approx(value, 0.5, 10_000).alias("mediana"),
        )
    else:
        found = exact_median(df, value, *keys)
    return found.withColumns(
        {c: round_half_away(F.col(c), 0) for c in ("media", "mediana")}
    )
