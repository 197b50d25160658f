"""Monthly marts over staging with canonical technologies.

Staging has one row per offer and each offer's canonical names are distinct, so
counting rows counts offers: every mart is one scan and one aggregate whose
partial results are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start, year_month
from ..functions.numbers import midpoint, pct
from ..functions.text import surrogate_key
from ..operators.aggregates import match_rate, mean_median_by, total_of
from .staging import CANONICAL


def _dated(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("fecha_publicacion").isNotNull()).withColumn(
        "mes", month_start(F.col("fecha_publicacion"))
    )


def _month_key(value: str) -> Column:
    return surrogate_key(F.col(value), year_month(F.col("mes")))


def monthly_demand(stg: DataFrame) -> DataFrame:
    """Offers per technology and month, and their share of the month's offers with any technology.

    Each such offer has exactly one first technology, so the first positions
    counted over a month's technologies are its number of offers.
    """
    pairs = _dated(stg).select("mes", F.posexplode(CANONICAL).alias("pos", "tecnologia"))
    counts = pairs.groupBy("tecnologia", "mes").agg(
        F.count(F.lit(1)).alias("num_ofertas"), F.count_if(F.col("pos") == 0).alias("_first")
    )
    total = total_of("_first", "mes")
    return counts.withColumn("total_ofertas_con_tecnologia_mes", total).select(
        _month_key("tecnologia").alias("id_tecnologia_mes"),
        "tecnologia",
        "mes",
        "num_ofertas",
        "total_ofertas_con_tecnologia_mes",
        pct(F.col("num_ofertas"), F.col("total_ofertas_con_tecnologia_mes")).alias("pct_ofertas"),
    )


def salaries_by_technology(stg: DataFrame, approx: bool = False) -> DataFrame:
    """Mean and median salary per technology and month, over offers that state one."""
    salary = midpoint(F.col("salario_min"), F.col("salario_max"))
    paid = _dated(stg).select("mes", CANONICAL, salary.alias("salario")).filter("salario IS NOT NULL")
    pairs = paid.select("mes", F.explode(CANONICAL).alias("tecnologia"), "salario")
    found = mean_median_by(pairs, "salario", "tecnologia", "mes", approx=approx)
    return found.select(
        _month_key("tecnologia").alias("id_tecnologia_mes"),
        "tecnologia",
        "mes",
        F.col("n").alias("num_ofertas_con_salario"),
        F.col("media").alias("salario_medio"),
        F.col("mediana").alias("salario_mediano"),
    )


def work_mode_trend(stg: DataFrame) -> DataFrame:
    """Offers per work mode and month, and their share of the month's offers with a known mode."""
    counts = (
        _dated(stg)
        .filter(F.col("modalidad").isNotNull())
        .groupBy("modalidad", "mes")
        .agg(F.count(F.lit(1)).alias("num_ofertas"))
    )
    total = total_of("num_ofertas", "mes")
    return counts.select(
        _month_key("modalidad").alias("id_modalidad_mes"),
        "modalidad",
        "mes",
        "num_ofertas",
        pct(F.col("num_ofertas"), total).alias("pct_ofertas"),
    )


def extraction_coverage(stg: DataFrame) -> DataFrame:
    """Classified offers per month, and how many of them name no known technology."""
    classified = _dated(stg).filter(F.col(CANONICAL).isNotNull())
    counts = match_rate(classified, F.size(CANONICAL) == 0, "mes").withColumnsRenamed(
        {"total": "total_ofertas_clasificadas", "sin_coincidencia": "ofertas_sin_tecnologia"}
    )
    return counts.withColumn(
        "pct_sin_tecnologia",
        pct(F.col("ofertas_sin_tecnologia"), F.col("total_ofertas_clasificadas")),
    )


BUILDERS = {
    "demanda_tecnologias_mensual": monthly_demand,
    "salarios_por_tecnologia": salaries_by_technology,
    "tendencia_modalidad": work_mode_trend,
    "cobertura_extraccion_mensual": extraction_coverage,
}
