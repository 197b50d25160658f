"""Build: staging once, then the checks and the marts from the written staging table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import assert_checks, run_checks
from ..sources.marts import load_marts
from .marts import BUILDERS
from .staging import STAGED, offer_technologies, stg_offers


def build_all(
    spark: SparkSession,
    offers: DataFrame,
    attempts: DataFrame,
    catalog: DataFrame,
    out: str,
    checks: bool = True,
) -> dict[str, DataFrame]:
    """Write staging and the four marts under ``out``; returns all model tables.

    The written staging table leaves the descriptions out: no mart reads them and
    they are most of the bytes. The returned ``stg_ofertas`` is a view with them.
    A failing check raises, so that nothing is published from a bad build.
    """
    narrow = stg_offers(offers, attempts, catalog, with_description=False)
    narrow.write.mode("overwrite").parquet(f"{out}/stg_ofertas")
    staged = spark.read.schema(narrow.schema).parquet(f"{out}/stg_ofertas")
    for name, builder in BUILDERS.items():
        builder(staged).hint("rebalance").write.mode("overwrite").parquet(f"{out}/{name}")
    marts = load_marts(spark, out)
    pairs = offer_technologies(staged)
    if checks:
        assert_checks(
            run_checks(
                {
                    "raw_ofertas": offers,
                    "raw_ofertas_clasificadas": attempts,
                    "catalogo_tecnologias": catalog,
                    "stg_ofertas": staged,
                    "int_tecnologias_por_oferta": pairs,
                    **marts,
                }
            )
        )
    view = stg_offers(offers, attempts, with_description=True).select(*STAGED)
    return {"stg_ofertas": view, "int_tecnologias_por_oferta": pairs, **marts}
