"""Staging after late rows equals staging built at once."""

import random

import pytest
from pyspark.sql import functions as F

from offerlens import schemas
from offerlens.operators.tables import ensure_schema
from offerlens.plans import incremental

CATALOG = [("loom", "Loom"), ("kiln", "Kiln"), ("lathe", "Lathe")]


def offer(rng, i):
    month = rng.choice(["2025-03", "2025-04", "2025-11", None])
    day = None if month is None else f"{month}-{rng.randrange(1, 28):02d}"
    return (str(i), rng.choice(["Weaver", "Potter", None]), rng.choice(["Hilltop", "Dell"]), day, float(rng.randrange(20000, 90000)))


def attempt(rng, i, moment):
    names = rng.sample(["loom", "kiln", "lathe", "unheard of"], rng.randrange(4))
    error = rng.choice([None, None, "llm_error: X"])
    return (str(i), names, error, f"2025-12-01 00:{moment // 60:02d}:{moment % 60:02d}")


def raw(spark, offers, attempts):
    kind = "id string, titulo string, empresa string, fecha_publicacion string, salario_min_anunciado double"
    made = spark.createDataFrame(attempts, "id_oferta string, tecnologias array<string>, error string, at string")
    made = made.withColumn("fecha_extraccion", F.col("at").cast("timestamp_ntz")).drop("at")
    return (
        ensure_schema(spark.createDataFrame(offers, kind), schemas.RAW_OFFERS),
        ensure_schema(made, schemas.RAW_ATTEMPTS),
    )


def plain(df):
    return sorted(df.select([F.col(c).cast("string") for c in sorted(df.columns)]).collect(), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_late_rows(spark, tmp_path, seed):
    rng, root = random.Random(seed), str(tmp_path / "kept")
    catalog = spark.createDataFrame(CATALOG, schemas.CATALOG)
    offers = [offer(rng, i) for i in range(40)]
    attempts = [attempt(rng, i, i) for i in range(30)]
    incremental.build_staging(spark, *raw(spark, offers, attempts), catalog, root)
    for batch in range(3):
        # new offers, other versions of old ones (their month may change), and attempts
        ids = [rng.randrange(60) for _ in range(4)]
        offers += [offer(rng, i) for i in ids]
        tried = [rng.randrange(50) for _ in range(4)]
        attempts += [attempt(rng, i, 100 + len(attempts) + n) for n, i in enumerate(tried)]
        changed = spark.createDataFrame([(str(i),) for i in ids + tried] + [(None,)], "id_oferta string")
        now = raw(spark, offers, attempts)
        months = incremental.update_staging(spark, *now, catalog, changed, root)
        assert set(months) <= {"2025-03", "2025-04", "2025-11", incremental.UNDATED}
        full = str(tmp_path / f"full{batch}")
        incremental.build_staging(spark, *now, catalog, full)
        assert plain(incremental.read_staging(spark, root)) == plain(incremental.read_staging(spark, full))


def test_only_touched_months_are_written(spark, tmp_path):
    root = tmp_path / "kept"
    rows = [("1", "Weaver", "Dell", "2025-03-01", 1.0), ("2", "Potter", "Dell", "2025-04-02", 1.0)]
    incremental.build_staging(spark, *raw(spark, rows, []), None, str(root))

    def files():
        return {m.name: {f.name for f in m.iterdir()} for m in (root / "stg_ofertas").glob("mes=*")}

    before = files()
    rows += [("1", "Weaver", "Dell", "2025-05-09", 1.0)]  # the offer leaves March, which is empty then
    changed = spark.createDataFrame([("1",)], "id_oferta string")
    now = raw(spark, rows, [])
    assert incremental.update_staging(spark, *now, None, changed, str(root)) == ["2025-03", "2025-05"]
    after = files()
    assert after["mes=2025-04"] == before["mes=2025-04"] and after["mes=2025-03"] != before["mes=2025-03"]
    found = {(r.id_oferta, str(r.fecha_publicacion)) for r in incremental.read_staging(spark, str(root)).collect()}
    assert found == {("1", "2025-05-09"), ("2", "2025-04-02")}
    nothing = spark.createDataFrame([("77",)], "id_oferta string")
    assert incremental.update_staging(spark, *now, None, nothing, str(root)) == [] and files() == after
