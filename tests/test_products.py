"""Golden cases of the whole flow: queue, extraction, staging, marts, reports."""

import json
import os
import re
import time
import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from offerlens import schemas
from offerlens.operators.lookup import inline_entries
from offerlens.operators.quality import QualityError
from offerlens.operators.tables import ensure_schema
from offerlens.plans import extraction, marts, queue, reports, staging
from offerlens.plans.build import build_all
from offerlens.sources.catalog import load_catalog, read_seed
from offerlens.sources.journal import Meeting, open_journal
from offerlens.sources.marts import load_marts

ENTRIES = [
    ("python", "Python"),
    ("dbt", "dbt"),
    ("dbt-core", "dbt"),
    ("postgres", "PostgreSQL"),
    ("postgre sql", "PostgreSQL"),
    ("rust", "Rust"),
    ("erlang", "Erlang"),
    ("kafka", "Kafka"),
]


@pytest.fixture(scope="module")
def seed_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("seed") / "catalog.csv"
    path.write_text("variante,nombre_canonico\n" + "".join(f"{v},{c}\n" for v, c in ENTRIES))
    return str(path)


@pytest.fixture(scope="module")
def catalog(spark, seed_path):
    return load_catalog(spark, seed_path)


@pytest.fixture(scope="module")
def seed(spark, seed_path):
    return read_seed(spark, seed_path)


def offers_of(spark, rows, columns):
    df = spark.createDataFrame(rows, columns)
    return ensure_schema(df, schemas.RAW_OFFERS).select(*schemas.RAW_OFFERS.names)


def attempts_of(spark, rows, columns):
    df = spark.createDataFrame(rows, columns)
    return ensure_schema(df, schemas.RAW_ATTEMPTS).select(*schemas.RAW_ATTEMPTS.names)


def reply(names, low=None, high=None, level=None, mode=None):
    return json.dumps(
        {"tecnologias": names, "seniority": level, "modalidad": mode, "salario_min": low, "salario_max": high}
    )


def test_staging_rules(spark, seed, tmp_path):
    """The advertised pair stands when the reply has none; a re-post with a list beats one without; a wage
    below the gate is unknown; an offer without any success keeps its row but no list."""
    offers = offers_of(
        spark,
        [
            ("n1", "Turbine Controls Developer", "2025-03-04", "Voltaire Wind", 31000.0, 38500.0),
            ("n2", "Ledger Developer", "2025-03-05", "Quill Bank", None, None),
            ("n3", " Ledger developer ", "2025-03-21", "Quill bank", 61000.0, None),
            ("n4", "Night Shift Tester", "2025-03-21", "Moonlight", 1450.0, 1450.0),
            ("n5", "Gardener", "2025-04-02", None, None, 300001.0),
        ],
        "id string, titulo string, fecha_publicacion string, empresa string, "
        "salario_min_anunciado double, salario_max_anunciado double",
    )
    now = datetime(2025, 5, 1)
    attempts = attempts_of(
        spark,
        [
            ("n1", [], reply(["  RUST ", "Postgre   SQL", "Abacus"]), None, None, now),
            ("n2", [], reply([]), None, None, now),
            ("n3", ["dbt"], reply(["dbt"], 42000, 47000), 42000.0, 47000.0, now),
            ("n4", ["Erlang"], reply(["Erlang"]), None, None, now),
        ],
        "id_oferta string, tecnologias array<string>, respuesta_llm string, salario_min double, "
        "salario_max double, fecha_extraccion timestamp_ntz",
    )
    built = build_all(spark, offers, attempts, seed, str(tmp_path / "out"))
    stg = built["stg_ofertas"].orderBy("id_oferta").collect()
    assert [(r.id_oferta, r.fuente_salario, r.salario_min, r.salario_max) for r in stg] == [
        ("n1", "adzuna", 31000.0, 38500.0),
        ("n3", "llm", 42000.0, 47000.0),
        ("n4", None, None, None),
        ("n5", None, None, None),
    ]
    assert built["stg_ofertas"].columns == staging.STAGED
    pairs = built["int_tecnologias_por_oferta"].orderBy("id_oferta", "tecnologia").collect()
    expected = [("n1", "PostgreSQL"), ("n1", "Rust"), ("n3", "dbt"), ("n4", "Erlang")]
    assert [(r.id_oferta, r.tecnologia) for r in pairs] == expected
    looked_up = staging.offer_technologies(built["stg_ofertas"], seed)
    assert sorted(map(tuple, looked_up.collect())) == sorted(map(tuple, pairs))
    coverage = built["cobertura_extraccion_mensual"].collect()
    assert [(r.total_ofertas_clasificadas, r.ofertas_sin_tecnologia) for r in coverage] == [(3, 0)]


def test_end_to_end(spark, catalog, seed, tmp_path):
    adverts = [
        ("u-1", "Stream Engineer", "Kafka and Rust, from home, 38 to 52 thousand.", "2025-02-11"),
        ("u-2", "Stream Tester", "Kafka, at the plant, 30 thousand.", "2025-02-20"),
        ("u-3", "Baker", "Bread and rolls.", "2025-02-27"),
    ]
    offers = offers_of(
        spark, adverts, "id string, titulo string, descripcion string, fecha_publicacion string"
    ).withColumn("empresa", F.concat(F.lit("House of "), F.col("id")))
    answers = {
        "Stream Engineer": reply(["Kafka", "Rust"], 38000, 52000, "senior", "remoto"),
        "Stream Tester": reply(["kafka"], None, 30000, "mid", "presencial"),
        "Baker": reply([]),
    }

    def extractor(prompt):
        return next(answer for title, answer in answers.items() if title in prompt)

    path = str(tmp_path / "attempts")
    counts = extraction.classify_pending(spark, offers, path, extractor, catalog, "local", "regla")
    assert counts == (3, 0)
    again = extraction.classify_pending(spark, offers, path, extractor, catalog, "local", "regla")
    assert again == (0, 0)
    attempts = spark.read.schema(schemas.RAW_ATTEMPTS).parquet(path)
    stored = {r.id_oferta: r for r in attempts.collect()}
    assert (stored["u-1"].tecnologias, stored["u-2"].tecnologias) == (["Kafka", "Rust"], ["Kafka"])
    assert (stored["u-2"].seniority, stored["u-2"].modalidad, stored["u-2"].error) == ("mid", "presencial", None)
    assert (stored["u-3"].proveedor_llm, stored["u-3"].modelo_llm, stored["u-3"].version_prompt) == ("local", "regla", "2")

    build_all(spark, offers, attempts, seed, str(tmp_path / "out"))
    built = load_marts(spark, str(tmp_path / "out"))
    demand = built["demanda_tecnologias_mensual"].orderBy("tecnologia").collect()
    assert [(r.tecnologia, r.num_ofertas, r.pct_ofertas) for r in demand] == [("Kafka", 2, 100.0), ("Rust", 1, 50.0)]
    salary = built["salarios_por_tecnologia"].filter("tecnologia = 'Kafka'").first()
    assert (salary.num_ofertas_con_salario, salary.salario_medio, salary.salario_mediano) == (2, 37500.0, 37500.0)
    trend = built["tendencia_modalidad"].orderBy("modalidad").collect()
    assert [(r.modalidad, r.num_ofertas, r.id_modalidad_mes) for r in trend] == [
        ("presencial", 1, "presencial|2025-02"), ("remoto", 1, "remoto|2025-02")
    ]
    coverage = built["cobertura_extraccion_mensual"].first()
    assert (coverage.total_ofertas_clasificadas, coverage.ofertas_sin_tecnologia) == (3, 1)
    assert coverage.pct_sin_tecnologia == pytest.approx(33.33)


@pytest.mark.parametrize("fits", [True, False])
def test_marts_with_a_catalogue_too_large_for_the_plan(spark, catalog, monkeypatch, fits):
    from offerlens.operators import lookup

    offers = offers_of(
        spark,
        [(str(i), f"t{i}", "2026-09-01", "c") for i in range(30)],
        "id string, titulo string, fecha_publicacion string, empresa string",
    )
    now = datetime(2026, 9, 20)
    attempts = attempts_of(
        spark,
        [(str(i), ["Python", "dbt-core", "dbt"][: i % 4], now) for i in range(25)],
        "id_oferta string, tecnologias array<string>, fecha_extraccion timestamp_ntz",
    )
    small = marts.monthly_demand(staging.stg_offers(offers, attempts, catalog)).orderBy("tecnologia").collect()
    monkeypatch.setattr(lookup, "inline_entries", lambda *_: None)
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *_: fits)
    large = marts.monthly_demand(staging.stg_offers(offers, attempts, catalog)).orderBy("tecnologia").collect()
    assert small == large
    assert {(r.tecnologia, r.num_ofertas, r.total_ofertas_con_tecnologia_mes) for r in small} == {
        ("Python", 18, 18), ("dbt", 12, 18)
    }


def test_a_failing_check_stops_the_build(spark, seed, tmp_path):
    offers = offers_of(spark, [("1", "t")], "id string, titulo string")
    attempts = attempts_of(
        spark,
        [("1", "jefe", datetime(2026, 9, 1))],
        "id_oferta string, seniority string, fecha_extraccion timestamp_ntz",
    )
    untidy = seed.unionByName(spark.createDataFrame([("Go ", "Go")], schemas.CATALOG))
    with pytest.raises(QualityError) as failed:
        build_all(spark, offers, attempts, untidy, str(tmp_path / "out"))
    assert str(failed.value) == (
        "accepted_values_stg_ofertas_seniority: 1; catalog_normalized_catalogo_tecnologias: 1"
    )


def test_late_attempts_and_failures(spark):
    attempts = attempts_of(
        spark,
        [
            ("1", ["a"], None, datetime(2026, 9, 1)),
            ("1", ["a", "b"], None, datetime(2026, 9, 2)),
            ("1", [], "llm_error: x", datetime(2026, 9, 3)),
            ("2", [], "llm_error: x", datetime(2026, 9, 3)),
        ],
        "id_oferta string, tecnologias array<string>, error string, fecha_extraccion timestamp_ntz",
    )
    assert [(r.id_oferta, r.tecnologias) for r in staging.latest_attempts(attempts).collect()] == [
        ("1", ["a", "b"])
    ]


def queue_state(spark):
    offers = offers_of(
        spark,
        [(i, f"Oferta {i}", "texto") for i in ("vacia_v1", "vacia_v2", "con_tec", "nueva")],
        "id string, titulo string, descripcion string",
    )
    then = datetime(2026, 9, 1)
    attempts = attempts_of(
        spark,
        [
            ("vacia_v1", [], '{"tecnologias": []}', None, then),
            ("vacia_v2", [], '{"tecnologias": []}', "2", then),
            ("con_tec", [], '{"tecnologias": ["Yocto"]}', None, then),
        ],
        "id_oferta string, tecnologias array<string>, respuesta_llm string, version_prompt string, "
        "fecha_extraccion timestamp_ntz",
    )
    return offers, attempts


def test_work_queue(spark, catalog, tmp_path):
    offers, attempts = queue_state(spark)
    ids = lambda df: {r.id_oferta for r in df.collect()}
    assert ids(queue.pending_offers(offers, attempts, "2")) == {"nueva"}
    assert ids(queue.pending_offers(offers, attempts, "2", reprocess_empty=True)) == {"nueva", "vacia_v1"}
    path = str(tmp_path / "attempts")
    attempts.write.parquet(path)

    def run():
        return extraction.classify_pending(
            spark, offers, path, lambda _: reply(["Python"]), catalog, "local", "regla", reprocess_empty=True
        )

    assert run() == (2, 0)
    assert run() == (0, 0)


def test_queue_order_and_limit(spark):
    offers = offers_of(
        spark,
        [("1", "2026-09-01"), ("2", "2026-09-03"), ("3", None), ("4", "2026-09-02")],
        "id string, fecha_publicacion string",
    )
    none = spark.createDataFrame([], schemas.RAW_ATTEMPTS)
    order = lambda n: [r.id_oferta for r in queue.pending_offers(offers, none, "2", n).collect()]
    assert order(None) == ["2", "4", "1", "3"]
    assert order(2) == ["2", "4"]


class Counted:
    """A model whose calls are counted in files, as callers are processes of their own."""

    def __init__(self, folder, quota=10**9, crash=None):
        self.folder, self.quota, self.crash = str(folder), quota, crash
        os.makedirs(self.folder, exist_ok=True)

    def calls(self):
        return [f.split("-")[0] for f in os.listdir(self.folder)]

    def __call__(self, prompt):
        title = re.search(r"puesto[0-9]+", prompt).group()
        if int(title[6:]) >= self.quota:
            raise extraction.QuotaExhausted("nothing left")
        open(f"{self.folder}/{title}-{uuid.uuid4().hex}", "w").close()
        if title == self.crash:
            raise extraction.ExtractorConfigurationError("key withdrawn")
        return reply(["Python"])


def numbered_offers(spark, n):
    """Offer i is the i-th newest."""
    data = [(f"{i * 7 % n:03d}x", f"puesto{i}", str(date(2026, 9, 30) - timedelta(days=i))) for i in range(n)]
    return offers_of(spark, data, "id string, titulo string, fecha_publicacion string")


def test_callers_share_one_quota(spark, catalog, tmp_path):
    """The newest offers get the replies; after the first signal nobody calls, and nothing is recorded as failed."""
    model, path = Counted(tmp_path / "calls", quota=21), str(tmp_path / "attempts")
    counts = extraction.classify_pending(
        spark, numbered_offers(spark, 60), path, model, inline_entries(catalog), "local", "regla", parallelism=8
    )
    assert counts == (21, 0)
    stored = spark.read.schema(schemas.RAW_ATTEMPTS).parquet(path).collect()
    assert all(r.error is None and r.tecnologias == ["Python"] for r in stored)
    assert sorted(model.calls()) == sorted(f"puesto{i}" for i in range(21))
    assert {r.id_oferta for r in stored} == {f"{i * 7 % 60:03d}x" for i in range(21)}


def test_a_run_that_was_cut_short_repeats_no_call(spark, catalog, tmp_path):
    path, journal = str(tmp_path / "attempts"), str(tmp_path / "journal")
    offers, entries = numbered_offers(spark, 30), inline_entries(catalog)
    model = Counted(tmp_path / "calls", crash="puesto17")
    with pytest.raises(Exception, match="key withdrawn"):
        extraction.classify_pending(spark, offers, path, model, entries, "local", "regla", parallelism=4, journal=journal)
    before = set(model.calls()) - {"puesto17"}
    assert len(before) >= 16
    model.crash = None
    counts = extraction.classify_pending(
        spark, offers, path, model, entries, "local", "regla", parallelism=3, journal=journal
    )
    assert counts == (30, 0)
    again = Counter(model.calls())
    assert set(again) == {f"puesto{i}" for i in range(30)}
    assert [t for t, n in again.items() if n > 1] == ["puesto17"]
    # the run is closed: the next one starts afresh, with nothing to do
    assert extraction.classify_pending(
        spark, offers, path, model, entries, "local", "regla", journal=journal
    ) == (0, 0)


def test_a_task_that_runs_again_answers_from_the_journal(spark, tmp_path):
    model, run = Counted(tmp_path / "calls"), open_journal(str(tmp_path / "journal"))
    work = spark.range(12).select(F.col("id").cast("string").alias("id_oferta"), F.concat(F.lit("puesto"), "id").alias("prompt"))
    dealt = extraction.deal(work.orderBy("prompt"), 5)
    first = sorted(tuple(r) for r in extraction.run_in_rounds(dealt, model, run, calls=2).collect())
    again = sorted(tuple(r) for r in extraction.run_in_rounds(dealt, model, run, calls=2).collect())
    assert first == again and len(first) == 12 and len(model.calls()) == 12


@pytest.mark.parametrize("signal", [extraction.QuotaExhausted, extraction.ExtractorConfigurationError])
def test_a_copy_of_a_signal_is_a_signal(signal):
    """A package that travels by value is a copy, and so are its classes."""
    copy = type(signal.__name__, (Exception,), {"__module__": signal.__module__})

    def extractor(_):
        raise copy("nothing left")

    with pytest.raises(signal, match="nothing left"):
        extraction._called(extractor, "p")


def test_rounds_of_quick_calls_do_not_wait(spark, tmp_path):
    """Agreeing took a second a round, whatever the calls took."""
    model, run = Counted(tmp_path / "calls", quota=150), open_journal(str(tmp_path / "journal"))
    work = spark.range(240).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("id_oferta"), F.concat(F.lit("puesto"), "id").alias("prompt"))
    dealt = extraction.deal(work.orderBy("id_oferta"), 4)
    start = time.time()
    found = extraction.run_in_rounds(dealt, model, run, calls=1).collect()
    assert time.time() - start < 25
    assert sorted(r.id_oferta for r in found) == [f"{i:03d}" for i in range(150)]


def test_callers_hear_all_words_of_a_round(tmp_path):
    """Nobody goes on before all have spoken, words of another attempt do not count, and a quick caller loses no slow one."""
    run, turns = open_journal(str(tmp_path)), [5, 3, 4]
    begun = [[] for _ in turns]

    def caller(i, name):
        meeting, number = Meeting(run, name, i, len(turns)), 0
        while True:
            time.sleep(0.01 * i)
            begun[i].append((number, time.time()))
            said = meeting.said(number, "ended" if number >= turns[i] else "on", "on")
            number += 1
            if set(said) == {"ended"}:
                return number

    with ThreadPoolExecutor(len(turns)) as pool:
        for name in ("a", "b"):
            assert list(pool.map(caller, range(len(turns)), [name] * len(turns))) == [6, 6, 6]
    for earlier, later in zip(range(11), range(1, 12)):
        assert max(b[earlier][1] for b in begun) <= min(b[later][1] for b in begun) + 0.02


@pytest.mark.parametrize(("n", "callers"), [(0, 3), (1, 3), (10, 3), (100, 7)])
def test_deal(spark, n, callers):
    work = spark.range(n).select("id").repartition(5).orderBy(F.desc("id"))
    parts = extraction.deal(work, callers).withColumn("p", F.spark_partition_id()).collect()
    assert sorted(r.posicion for r in parts) == list(range(n))
    assert all(r.id == n - 1 - r.posicion and r.p == r.posicion % min(callers, n) for r in parts)


def test_failures_are_recorded_and_all_failing_raises(spark, catalog, tmp_path):
    offers = offers_of(spark, [("1", "t1"), ("2", "t2")], "id string, titulo string")

    def extractor(prompt):
        if "t1" in prompt:
            raise TimeoutError("lento")
        return "esto no es json"

    path = str(tmp_path / "attempts")
    with pytest.raises(RuntimeError, match="all 2"):
        extraction.classify_pending(spark, offers, path, extractor, catalog, "local", "regla")
    stored = spark.read.schema(schemas.RAW_ATTEMPTS).parquet(path).orderBy("id_oferta").collect()
    assert [(r.error, r.respuesta_llm, r.tecnologias) for r in stored] == [
        ("llm_error: TimeoutError: lento", None, []),
        (extraction.INVALID_JSON, "esto no es json", []),
    ]


def test_wrong_configuration_fails_the_job(spark):
    df = spark.createDataFrame([("1", "p")], "id_oferta string, prompt string")

    def extractor(_):
        raise extraction.ExtractorConfigurationError("sin credenciales")

    with pytest.raises(Exception, match="sin credenciales"):
        extraction.run_extractor(df, extractor).collect()


@pytest.mark.parametrize("inline", [True, False])
def test_reply_fields(spark, catalog, inline):
    replies = spark.createDataFrame(
        [
            ("1", '```json\n{"tecnologias": ["PYTHON", 3, null, "x", "dbt-core", "dbt"]}\n```', None),
            ("2", '{"tecnologias": "Python", "seniority": "Semi-Senior ", "modalidad": "On-Site"}', None),
            ("3", '{"salario_min": "50.000 €", "salario_max": 40000, "modalidad": 3}', None),
            ("4", '["Python"]', None),
            ("5", None, "llm_error: X: y"),
            ("6", '{"tecnologias": ["rust"], "tecnologias": ["kafka"], "salario_min": NaN, "salario_max": 9}', None),
            ("7", 'Sure: {"tecnologias": ["dbt"]} and more', None),
            ("8", '{"tecnologias": ["dbt"]', None),
        ],
        "id_oferta string, respuesta_llm string, call_error string",
    )
    parsed = extraction.parse_replies(replies, inline_entries(catalog) if inline else catalog)
    out = {r.id_oferta: r for r in parsed.collect()}
    assert out["1"].tecnologias == ["Python", "dbt"]
    assert (out["2"].tecnologias, out["2"].seniority, out["2"].modalidad) == ([], "mid", "presencial")
    assert (out["3"].salario_min, out["3"].salario_max, out["3"].modalidad) == (40000.0, 50000.0, None)
    assert (out["4"].error, out["4"].tecnologias) == (extraction.NOT_AN_OBJECT, [])
    assert out["5"].error == "llm_error: X: y"
    assert (out["6"].tecnologias, out["6"].salario_max, out["6"].error) == (["Kafka"], 9.0, None)
    assert (out["7"].tecnologias, out["8"].error) == (["dbt"], extraction.INVALID_JSON)


def test_work_mode_split(spark):
    trend = spark.createDataFrame(
        [("presencial", "2026-08-01", 1), ("hibrido", "2026-08-01", 2), ("remoto", "2026-09-01", 1),
         ("hibrido", "2026-09-01", 4)],
        "modalidad string, mes string, num_ofertas long",
    ).withColumn("mes", F.col("mes").cast("date"))
    out = reports.work_mode_split(trend).collect()
    assert [(r.etiqueta, r.num_ofertas, r.pct_ofertas) for r in out] == [
        ("Remoto", 1, 12.5), ("Híbrido", 6, 75.0), ("Presencial", 1, 12.5)
    ]
    only = reports.work_mode_split(trend, "2026-09-01", "2026-09-01").collect()
    assert [(r.modalidad, r.pct_ofertas) for r in only] == [("remoto", 20.0), ("hibrido", 80.0)]


def test_ranking_and_kpis(spark):
    demand = spark.createDataFrame(
        [("a", "2026-08-01", 3, 4), ("b", "2026-08-01", 2, 4), ("a", "2026-09-01", 1, 2), ("c", "2026-09-01", 2, 2)],
        "tecnologia string, mes string, num_ofertas long, total_ofertas_con_tecnologia_mes long",
    ).withColumn("mes", F.col("mes").cast("date"))
    ranking = reports.technology_ranking(demand, top=2).collect()
    assert [(r.tecnologia, r.num_ofertas, r.pct_ofertas) for r in ranking] == [("a", 4, 66.7), ("b", 2, 33.3)]
    coverage = spark.createDataFrame(
        [("2026-08-01", 5, 1), ("2026-09-01", 3, 1)],
        "mes string, total_ofertas_clasificadas long, ofertas_sin_tecnologia long",
    ).withColumn("mes", F.col("mes").cast("date"))
    assert tuple(reports.kpis(coverage, demand).first()) == (8, 6, 2, 25.0, 3)
    none = reports.kpis(coverage, demand, "2030-01-01", "2030-12-01").first()
    assert tuple(none) == (0, 0, 0, 0.0, 0)


def test_queue_without_ansi(spark):
    """An offer whose list is NULL counts as empty whatever the session's ANSI setting."""
    offers, attempts = queue_state(spark)
    nothing = attempts.withColumn("tecnologias", F.lit(None).cast("array<string>")).withColumn(
        "respuesta_llm", F.lit(None).cast("string")
    )
    ids = lambda: sorted(r.id_oferta for r in queue.pending_offers(offers, nothing, "x", reprocess_empty=True).collect())
    strict = ids()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert ids() == strict
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
