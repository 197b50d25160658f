"""Period reports over the marts. Months are inclusive at both ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import round_half_even
from ..functions.text import WORK_MODE_LABELS, WORK_MODES, fixed_rank, label_map


def in_period(df: DataFrame, low=None, high=None, month: str = "mes") -> DataFrame:
    """Rows of the months from ``low`` to ``high``; an open end is None."""
    if low is not None:
        df = df.filter(F.col(month) >= F.lit(low).cast("date"))
    if high is not None:
        df = df.filter(F.col(month) <= F.lit(high).cast("date"))
    return df


def kpis(coverage: DataFrame, demand: DataFrame, low=None, high=None) -> DataFrame:
    """One row: classified offers, with and without technology, and distinct technologies."""
    technologies = in_period(demand, low, high).agg(F.count_distinct("tecnologia"))
    total, without = F.col("total_clasificadas"), F.col("total_sin_tecnologia")
    sums = in_period(coverage, low, high).agg(
        F.coalesce(F.sum("total_ofertas_clasificadas"), F.lit(0)).alias("total_clasificadas"),
        F.coalesce(F.sum("ofertas_sin_tecnologia"), F.lit(0)).alias("total_sin_tecnologia"),
    )
    return sums.select(
        total,
        (total - without).alias("total_con_tecnologia"),
        without,
        F.when(total > 0, F.lit(100.0) * without / total)
        .otherwise(F.lit(0.0))
        .alias("pct_sin_tecnologia"),
        technologies.scalar().alias("tecnologias_distintas"),
    )


def technology_ranking(demand: DataFrame, top: int = 15, low=None, high=None) -> DataFrame:
    """The ``top`` technologies of a period; shares are of the period's offers, not monthly means."""
    # one pass over the mart: per technology, and per month for the period's offers
    both = in_period(demand, low, high).groupingSets([["tecnologia"], ["mes"]], "tecnologia", "mes").agg(
        F.grouping("mes").alias("_by_technology"),
        F.sum("num_ofertas").alias("num_ofertas"),
        F.max("total_ofertas_con_tecnologia_mes").alias("_month"),
    )
    of_month = F.when(F.col("_by_technology") == 0, F.col("_month"))
    total = F.sum(of_month).over(Window.partitionBy())  # as many rows as technologies and months
    share = round_half_even(F.lit(100.0) * F.col("num_ofertas") / total, 1)
    ranked = both.withColumn("pct_ofertas", share).filter("_by_technology = 1")
    return (
        ranked.select("tecnologia", "num_ofertas", "pct_ofertas")
        .orderBy(F.desc("num_ofertas"), F.asc("tecnologia"))
        .limit(top)
    )


def work_mode_split(trend: DataFrame, low=None, high=None) -> DataFrame:
    """Work modes of a period with label and share, in their fixed order."""
    counts = in_period(trend, low, high).groupBy("modalidad").agg(F.sum("num_ofertas").alias("num_ofertas"))
    total = F.sum("num_ofertas").over(Window.partitionBy())  # as many rows as work modes
    return counts.select(
        "modalidad",
        label_map(F.col("modalidad"), WORK_MODE_LABELS).alias("etiqueta"),
        "num_ofertas",
        round_half_even(F.lit(100.0) * F.col("num_ofertas") / total, 1).alias("pct_ofertas"),
        fixed_rank(F.col("modalidad"), WORK_MODES).alias("orden"),
    ).orderBy("orden")


def tech_series(demand: DataFrame, technology: str) -> DataFrame:
    """One technology month by month."""
    return demand.filter(F.col("tecnologia") == technology).orderBy("mes")


def salary_summary(salaries: DataFrame, low=None, high=None) -> DataFrame:
    """Per technology: offers with salary and the median of the monthly medians.

    A group holds one row per month, which bounds what the median keeps.
    """
    return (
        in_period(salaries, low, high)
        .groupBy("tecnologia")
        .agg(
            F.sum("num_ofertas_con_salario").alias("ofertas"),
            F.median("salario_mediano").alias("salario_mediano"),
        )
        .orderBy(F.desc("ofertas"), F.asc("tecnologia"))
    )


def tech_totals(demand: DataFrame) -> DataFrame:
    """Technologies by total demand, for a selector."""
    return (
        demand.groupBy("tecnologia")
        .agg(F.sum("num_ofertas").alias("num_ofertas"))
        .orderBy(F.desc("num_ofertas"), F.asc("tecnologia"))
    )


def months(coverage: DataFrame) -> DataFrame:
    return coverage.select("mes").distinct().orderBy("mes")


def coverage_series(coverage: DataFrame, low=None, high=None) -> DataFrame:
    return in_period(coverage, low, high).orderBy("mes")
