"""The four published marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the published marts.
MARTS = (
    "demanda_tecnologias_mensual",
    "salarios_por_tecnologia",
    "tendencia_modalidad",
    "cobertura_extraccion_mensual",
)


def load_marts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Marts written by ``plans.build.build_all`` under ``path``, months as dates."""
    return {
        name: spark.read.parquet(f"{path}/{name}").withColumn("mes", F.col("mes").cast("date"))
        for name in MARTS
    }
