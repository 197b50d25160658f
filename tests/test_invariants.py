"""Properties that hold on any data, checked on the smallest benchmark tables."""

import pytest
from pyspark.sql import functions as F

from offerlens.bindings import views
from offerlens.operators import fingerprint, quality, tables
from offerlens.plans import marts, staging

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stg(spark):
    return tables.materialize(views.staged(spark, SF_DIR))


def test_staging_has_one_row_per_offer_and_advert(spark, stg):
    assert quality.unique(stg, "id_oferta").isEmpty()
    known = stg.dropna(subset=["titulo", "empresa"]).withColumn(
        "mes", F.coalesce(F.date_format("fecha_publicacion", "yyyy-MM"), F.lit(""))
    )
    assert quality.unique(known.withColumn("t", F.lower("titulo")), "t", "empresa", "mes").isEmpty()
    raw = views.raw_offers(spark, SF_DIR).select(F.col("id").alias("id_oferta"))
    assert stg.join(raw, "id_oferta", "left_anti").isEmpty()


def test_staging_does_not_depend_on_the_layout(spark, stg):
    shuffled = staging.stg_offers(
        views.raw_offers(spark, SF_DIR).repartition(7),
        views.raw_attempts(spark, SF_DIR).repartition(5),
        views.catalog(spark, SF_DIR),
        with_description=False,
    )
    assert fingerprint.fingerprint(shuffled).first() == fingerprint.fingerprint(stg).first()


def test_descriptions_do_not_change_the_choice(spark, stg):
    full = views.staged(spark, SF_DIR, with_description=True).drop("descripcion").select(*stg.columns)
    assert fingerprint.fingerprint(full).first() == fingerprint.fingerprint(stg).first()


def test_shares_and_totals(stg):
    shares = marts.work_mode_trend(stg).groupBy("mes").agg(F.sum("pct_ofertas").alias("p"))
    assert shares.filter(F.abs(F.col("p") - 100) > 0.05).isEmpty()
    demand = marts.monthly_demand(stg)
    assert demand.filter("num_ofertas > total_ofertas_con_tecnologia_mes OR pct_ofertas > 100").isEmpty()
    coverage = marts.extraction_coverage(stg)
    totals = demand.select("mes", "total_ofertas_con_tecnologia_mes").distinct()
    both = coverage.join(totals, "mes", "left").na.fill(0)
    wrong = "total_ofertas_clasificadas - ofertas_sin_tecnologia <> total_ofertas_con_tecnologia_mes"
    assert both.filter(wrong).isEmpty()


def test_canonical_lists_equal_the_catalogue_join(spark, stg):
    looked_up = staging.offer_technologies(stg, views.catalog(spark, SF_DIR))
    carried = staging.offer_technologies(stg)
    assert fingerprint.fingerprint(looked_up).first() == fingerprint.fingerprint(carried).first()
