"""Landed pages, catalogue files, snapshots and incremental ingest."""

import json

import pytest
from pyspark.sql import functions as F

from offerlens import schemas
from offerlens.operators.lookup import inline_entries
from offerlens.sources import catalog as catalogs
from offerlens.sources import offer_pages, snapshots
from offerlens.sources.catalog import load_catalog
from offerlens.sources.journal import open_journal
from offerlens.sources.offer_pages import flatten_offers, read_offer_pages
from offerlens.streaming import ingest
from offerlens.streaming.ingest import ingest_pages, stream_ingest

OFFER = {
    "id": "88-kite",
    "adref": "hush-hush",
    "__CLASS__": "Advert",
    "title": "Kite <em>Designer</em>",
    "description": "Silk, <b>bamboo</b> and string",
    "created": "2025-07-30T05:06:07Z",
    "company": {"display_name": "Updraft"},
    "location": {"display_name": "Oporto", "area": ["Portugal", "Oporto"]},
    "category": {"tag": "it-jobs"},
    "redirect_url": "https://kites.example.org/open/88?from=hush-app#apply",
    "salary_min": 27750,
}


def land(folder, name, offers):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"count": len(offers), "results": offers}, ensure_ascii=False))


def test_first_occurrence_in_page_order(spark, tmp_path):
    folder = tmp_path / "pages"
    land(folder, "es_p2.json", [{"id": 1, "title": "second"}, {"id": 2, "title": "b"}])
    land(folder, "es_p10.json", [{"id": 2, "title": "late"}, {"id": None, "title": "none"}, {"title": "no id"}])
    land(folder, "es_p1.json", [{"id": "1", "title": "first"}, {"id": 1, "title": "again"}])
    land(folder, "es_p3.json", [])
    offers = offer_pages.read_offer_pages(spark, str(folder))
    title = offer_pages.field(F.col("oferta"), "title")
    assert sorted(map(tuple, offers.select("id", title).collect())) == [("1", "first"), ("2", "b")]


def test_flatten(spark, tmp_path):
    folder = tmp_path / "pages"
    land(folder, "p1.json", [OFFER, {"id": 7, "company": None, "salary_max": "n/d", "redirect_url": None}])
    flat = offer_pages.flatten_offers(offer_pages.read_offer_pages(spark, str(folder)))
    assert flat.columns == schemas.RAW_OFFERS.names
    full, bare = flat.orderBy(F.desc("id")).collect()
    full, bare = (full, bare) if full.id == OFFER["id"] else (bare, full)
    assert (full.titulo, full.descripcion, full.empresa) == ("Kite Designer", "Silk, bamboo and string", "Updraft")
    assert (full.ubicacion, full.categoria, full.fuente) == ("Oporto", "it-jobs", "adzuna")
    assert full.url == "https://kites.example.org/open/88"
    assert (full.salario_min_anunciado, full.salario_max_anunciado) == (27750.0, None)
    payload = json.loads(full.payload)
    expected = {k: v for k, v in OFFER.items() if k not in ("adref", "__CLASS__")}
    assert payload == {**expected, "redirect_url": full.url}
    assert "hush" not in full.payload
    assert (bare.titulo, bare.empresa, bare.url, bare.salario_max_anunciado) == (None, None, None, None)


def test_batch_ingest_is_idempotent(spark, tmp_path):
    folder, table = tmp_path / "pages", str(tmp_path / "raw")
    land(folder, "p1.json", [OFFER])
    assert ingest_pages(spark, str(folder), table) == 1
    assert ingest_pages(spark, str(folder), table) == 0
    land(folder, "p2.json", [{**OFFER, "title": "changed"}, {**OFFER, "id": "2"}])
    assert ingest_pages(spark, str(folder), table) == 1
    assert {r.titulo for r in spark.read.parquet(table).collect()} == {"Kite Designer"}


def test_stream_ingest_over_overlapping_pages(spark, tmp_path):
    folder, table, state = tmp_path / "pages", str(tmp_path / "raw"), str(tmp_path / "state")

    def run():
        stream_ingest(spark, str(folder), table, state).awaitTermination()
        return sorted((r.id, r.titulo) for r in spark.read.parquet(table).collect())

    land(folder, "d1_p1.json", [{"id": 1, "title": "a"}, {"id": 2, "title": "b"}, {"id": 1, "title": "x"}])
    assert run() == [("1", "a"), ("2", "b")]
    land(folder, "d2_p1.json", [{"id": 2, "title": "y"}, {"id": 3, "title": "c"}])
    assert run() == [("1", "a"), ("2", "b"), ("3", "c")]
    assert run() == [("1", "a"), ("2", "b"), ("3", "c")]
    # a lost checkpoint replays everything without adding a row
    stream_ingest(spark, str(folder), table, str(tmp_path / "other")).awaitTermination()
    assert spark.read.parquet(table).count() == 3


def stored_ids(spark, table):
    return sorted(r.id for r in spark.read.parquet(table).select("id").collect())


def test_stream_reads_no_history(spark, tmp_path, monkeypatch):
    folder, table, state = tmp_path / "pages", str(tmp_path / "raw"), str(tmp_path / "state")

    def compared(*_):
        raise AssertionError("a first attempt of a batch compares itself with the table")

    monkeypatch.setattr(ingest, "append_new", compared)
    for day, ids in enumerate([[1, 2], [2, 3], [1, 3, 4]]):
        land(folder, f"d{day}_p1.json", [{"id": i, "title": f"day {day}"} for i in ids])
        stream_ingest(spark, str(folder), table, state).awaitTermination()
    found = {r.id: r.titulo for r in spark.read.parquet(table).collect()}
    assert found == {"1": "day 0", "2": "day 0", "3": "day 1", "4": "day 2"}


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    folder, table, state = tmp_path / "pages", str(tmp_path / "raw"), tmp_path / "state"
    land(folder, "p1.json", [{"id": i, "title": "a"} for i in range(20)])
    stream_ingest(spark, str(folder), table, str(state)).awaitTermination()
    # the rows were written, but the end of the batch was not recorded
    last = sorted((f for f in (state / "commits").iterdir() if f.name.isdigit()), key=lambda f: int(f.name))[-1]
    (state / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    last.unlink()
    land(folder, "p2.json", [{"id": i, "title": "b"} for i in range(10, 30)])
    stream_ingest(spark, str(folder), table, str(state)).awaitTermination()
    assert stored_ids(spark, table) == sorted(str(i) for i in range(30))


def test_stream_knows_what_others_stored(spark, tmp_path):
    folder, other = tmp_path / "pages", tmp_path / "other"
    table, state = str(tmp_path / "raw"), str(tmp_path / "state")
    land(other, "p0.json", [{"id": 1, "title": "theirs"}])
    assert ingest_pages(spark, str(other), table) == 1
    land(folder, "p1.json", [{"id": 1, "title": "ours"}, {"id": 2, "title": "ours"}])
    stream_ingest(spark, str(folder), table, state).awaitTermination()
    land(other, "p1.json", [{"id": 3, "title": "theirs"}])
    assert ingest_pages(spark, str(other), table) == 1
    land(folder, "p2.json", [{"id": 3, "title": "ours"}, {"id": 2, "title": "ours"}])
    stream_ingest(spark, str(folder), table, state).awaitTermination()
    found = {r.id: r.titulo for r in spark.read.parquet(table).collect()}
    assert found == {"1": "theirs", "2": "ours", "3": "theirs"} and len(stored_ids(spark, table)) == 3


def test_a_table_without_layout_stays_as_it_is(spark, tmp_path):
    folder, table = tmp_path / "pages", str(tmp_path / "raw")
    land(folder, "p1.json", [{"id": 1, "title": "a"}, {"id": 2, "title": "b"}])
    rows = flatten_offers(read_offer_pages(spark, str(folder))).filter("id = '1'")
    rows.write.parquet(table)
    assert [ingest_pages(spark, str(folder), table) for _ in range(2)] == [1, 0]
    assert "cubo" not in spark.read.parquet(table).columns and stored_ids(spark, table) == ["1", "2"]


def test_journal(spark, tmp_path):
    root = str(tmp_path / "journal")
    run = open_journal(root)
    assert run.recorded(0) == {} and run.replies(spark).isEmpty()
    run.write(0, 0, [("a", "x", None), ("b", None, "e")])
    run.write(1, 0, [("c", "y", None)])
    assert open_journal(root) == run
    assert run.recorded(0) == {"a": ("x", None), "b": (None, "e")}
    assert sorted(r.id_oferta for r in run.replies(spark).collect()) == ["a", "b", "c"]
    run.close()
    assert open_journal(root) != run


def test_headers_of_a_folder(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"f{i}.csv").write_text(f'variante,nombre_canonico\n"v,{i}",N{i}\n')
    (tmp_path / "turned.csv").write_text('\ufeff"nombre_canonico","variante",nota\nTurned,t,"a\nb"\n')
    seed = catalogs.read_seed(spark, str(tmp_path))
    expected = [("t", "Turned")] + [(f"v,{i}", f"N{i}") for i in range(6)]
    assert sorted((r.variante, r.nombre_canonico) for r in seed.collect()) == sorted(expected)
    (tmp_path / "bad.csv").write_text("variante;nombre_canonico\na;b\n")
    (tmp_path / "short.csv").write_text("variante\na\n")
    bad = catalogs.missing_columns(spark, str(tmp_path), ["variante", "nombre_canonico"]).collect()
    assert {r.archivo.rsplit("/", 1)[1]: r.faltan for r in bad} == {
        "bad.csv": ["nombre_canonico", "variante"], "short.csv": ["nombre_canonico"]
    }
    with pytest.raises(ValueError, match="short.csv: missing columns"):
        catalogs.read_seed(spark, str(tmp_path))


def test_files_with_one_page_per_line(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    lines = [json.dumps({"count": 1, "results": [{"id": i % 3, "title": f"t{i}"}]}) for i in range(9)]
    kept = set()
    for order in (lines, lines[::-1]):
        (folder / "d.json").write_text("\n".join(order))
        table = str(tmp_path / f"raw{len(kept)}")
        state = str(tmp_path / f"state{len(kept)}")
        stream_ingest(spark, str(folder), table, state, multi_line=False).awaitTermination()
        kept.add(tuple(sorted((r.id, r.titulo) for r in spark.read.parquet(table).collect())))
        assert spark.read.parquet(table).count() == 3
    assert len(kept) == 1


def test_catalog(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(
        "variante,nombre_canonico\n"
        "golang,Go\n"
        "go,Go Lang\n"
        " React  JS ,React\n"
        "vacia,\n"
        ",Nada\n"
        "golang,GO!\n"
        'cita,"Con ""comillas"", y coma"\n'
    )
    found = inline_entries(load_catalog(spark, str(path)))
    assert found == {
        "golang": "GO!",
        "go": "Go Lang",
        "go lang": "Go Lang",
        "react js": "React",
        "react": "React",
        "go!": "GO!",
        "cita": 'Con "comillas", y coma',
        'con "comillas", y coma': 'Con "comillas", y coma',
    }
    plain = inline_entries(load_catalog(spark, str(path), self_variants=False))
    assert set(plain) == {"golang", "go", "react js", "cita"}
    assert inline_entries(load_catalog(spark, str(path)), max_entries=2) is None
    path.write_text("variante,otra\na,b\n")
    with pytest.raises(ValueError, match="nombre_canonico"):
        load_catalog(spark, str(path))


def test_snapshot_is_published_and_loaded_on_change_only(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    one = {"t": spark.createDataFrame([("1", "v1")], "id string, titulo string")}
    two = {"t": spark.createDataFrame([("1", "v2")], "id string, titulo string")}
    assert snapshots.load_if_changed(spark, root) == (None, None, False)
    assert snapshots.publish_if_changed(one, root)
    assert not snapshots.publish_if_changed(one, root)
    tables, first, stale = snapshots.load_if_changed(spark, root)
    assert not stale and tables["t"].first().titulo == "v1"
    assert snapshots.load_if_changed(spark, root, first) == (None, first, False)
    assert snapshots.publish_if_changed(two, root)
    tables, second, stale = snapshots.load_if_changed(spark, root, first)
    assert not stale and second != first and tables["t"].first().titulo == "v2"


def test_publishers_at_once_leave_one_current_version(spark, tmp_path, monkeypatch):
    """Each gets a number of its own, whatever their clocks say; equal contents are published once."""
    root = str(tmp_path / "snapshots")
    late = {"t": spark.createDataFrame([("1", "late")], "id string, titulo string")}
    early = {"t": spark.createDataFrame([("1", "early")], "id string, titulo string")}
    same = {"t": spark.createDataFrame([("1", "early")], "id string, titulo string")}
    write, clock = snapshots._write_version, iter(["2030-01-01 00:00:00", "2020-01-01 00:00:00"] * 2)
    monkeypatch.setattr(snapshots, "utc_text", lambda: next(clock))

    def overtaken(tables, root):
        """While one publisher writes, another one publishes."""
        monkeypatch.setattr(snapshots, "_write_version", write)
        monkeypatch.setattr(snapshots, "utc_text", lambda: "2020-01-01 00:00:00")
        assert snapshots.publish_if_changed(early, root)
        monkeypatch.setattr(snapshots, "utc_text", lambda: "2010-01-01 00:00:00")
        return write(tables, root)

    monkeypatch.setattr(snapshots, "_write_version", overtaken)
    assert snapshots.publish_if_changed(late, root)
    assert sorted(p.name for p in (tmp_path / "snapshots/order").iterdir()) == [f"{n:020d}" for n in (1, 2)]
    tables, _, stale = snapshots.load_if_changed(spark, root)
    assert not stale and tables["t"].first().titulo == "late"  # the later number, though the earlier clock
    monkeypatch.setattr(snapshots, "_write_version", overtaken)
    assert not snapshots.publish_if_changed(same, root)
    assert len(list((tmp_path / "snapshots/order").iterdir())) == 3
    assert snapshots.load_if_changed(spark, root)[0]["t"].first().titulo == "early"


def test_exclusive_creation(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "order" / "1")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: snapshots._create(spark, path, str(i)), range(8)))
    assert sum(won) == 1 and open(path).read() == str(won.index(True))
    assert [p.name for p in (tmp_path / "order").iterdir()] == ["1"]


def test_exclusive_creation_without_a_local_path(spark, tmp_path, monkeypatch):
    """The way for shared file systems, here over a local one."""
    monkeypatch.setattr(snapshots, "_default_is_local", lambda spark: False)
    path = str(tmp_path / "order" / "1")
    assert snapshots._create(spark, path, "a") and not snapshots._create(spark, path, "b")
    assert spark.read.text(str(tmp_path / "order")).first().value == "a"
    assert not list((tmp_path / "order").glob(".1-*"))


def test_stale_contents_are_usable_but_not_remembered(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    snapshots.publish_snapshot({"t": spark.createDataFrame([("1",)], "id string")}, root)
    latest = snapshots.current(spark, root)
    announced = spark.createDataFrame(
        [(latest.version, "f" * 64, ["t"], latest.publicado + "x")], snapshots.MANIFEST
    )
    announced.write.mode("append").parquet(f"{root}/manifest")
    for _ in range(2):
        tables, known, stale = snapshots.load_if_changed(spark, root, "old")
        assert (known, stale) == ("old", True) and tables["t"].count() == 1


def test_place_of_a_file_without_patterns(spark, tmp_path):
    """As the pattern that it replaces says; reading pages uses no pattern and hashes equal places only."""
    names = ["/a/p12.json", "/a.b/p", "/a/p.json", "/a/12.json", "/a/p1.2.json", "/a/.json", "/a/p007.j", "/x/p99999999999999999999.json", "p1", "/a/p3."]
    files = spark.createDataFrame([(n,) for n in names], "f string")
    pattern = r"^(.*?)(\d*)\.[^./]*$"
    old = [F.regexp_extract("f", pattern, 1), F.regexp_extract("f", pattern, 2).try_cast("long")]
    rows = files.select(F.struct(*offer_pages.file_place(F.col("f"))), F.struct(*old)).collect()
    assert all(tuple(a) == tuple(b) for a, b in rows)
    land(tmp_path / "pages", "p1.json", [OFFER])
    found = offer_pages.read_offer_pages(spark, str(tmp_path / "pages"))
    assert "regexp_extract" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_content_decides_between_equal_places(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    lines = [{"count": 1, "results": [{"id": 1, "title": t}]} for t in "abc"]
    (folder / "p1.json").write_text("\n".join(map(json.dumps, lines)))
    title = offer_pages.field(F.col("oferta"), "title")
    first = [r[0] for r in offer_pages.read_pages(spark, str(folder), False).select(title).collect()]
    pages = spark.read.schema(schemas.OFFER_PAGE).json(str(folder))
    every = offer_pages.explode_pages(pages).orderBy(offer_pages.page_key()).select(title).collect()
    assert first == [every[0][0]] and len(every) == 3


def test_a_stream_writes_one_file_a_bucket(spark, tmp_path):
    """Adaptive execution is off in a stream; each task wrote a file in each bucket."""
    folder, table = tmp_path / "pages", str(tmp_path / "raw")
    land(folder, "p1.json", [{**OFFER, "id": str(i)} for i in range(400)])
    stream_ingest(spark, str(folder), table, str(tmp_path / "state"), buckets=4).awaitTermination()
    assert spark.read.parquet(table).count() == 400
    assert len(list((tmp_path / "raw").rglob("*.parquet"))) == 4


def test_compressed_pages_go_by_number(spark, tmp_path):
    """The digits of ``p10.json.gz`` were not found: it came before ``p9.json.gz``."""
    import gzip

    folder = tmp_path / "pages"
    folder.mkdir()
    for n in (10, 9, 11):
        page = json.dumps({"count": 1, "results": [{"id": 1, "title": f"t{n}"}]})
        (folder / f"p{n}.json.gz").write_bytes(gzip.compress(page.encode()))
    title = offer_pages.field(F.col("oferta"), "title")
    for multi_line in (True, False):
        assert [r[0] for r in offer_pages.read_pages(spark, str(folder), multi_line).select(title).collect()] == ["t9"]
    table = str(tmp_path / "raw")
    stream_ingest(spark, str(folder), table, str(tmp_path / "state"), multi_line=False).awaitTermination()
    assert [r.titulo for r in spark.read.parquet(table).collect()] == ["t9"]


@pytest.mark.parametrize(("query", "most"), [("s1_read_pages", 1000), ("t1_stream_ingest", 10_000)])
def test_landed_orders_are_small_next_to_their_text(spark, tmp_path, monkeypatch, query, most):
    """They lay there as plain text, many times the size of the tables."""
    import gzip

    from offerlens.bindings import queries

    n = most + 500
    customers = ["id as c_custkey", "cast(id % 3 as int) as c_nationkey"]
    spark.range(50).selectExpr(*customers).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(3).selectExpr("cast(id as int) as n_nationkey", "concat('nation ', id) as n_name").write.parquet(
        f"{tmp_path}/nation.parquet"
    )
    spark.range(0, n, 1, 1).selectExpr(
        "id as o_orderkey", "id % 50 as o_custkey", "'O' as o_orderstatus", "id / 7 as o_totalprice",
        "timestamp_ntz '1996-01-02 00:00:00' as o_orderdate", "'2-HIGH' as o_orderpriority",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(queries.tables, "work_dir", lambda _: f"{tmp_path}/work")
    found = getattr(queries, query)(spark, str(tmp_path))
    assert found.count() == n
    files = [f for f in (tmp_path / "work" / "landing").iterdir() if f.name.startswith("part-")]
    texts = [gzip.decompress(f.read_bytes()) for f in files]
    assert len(files) == 4 and max(t.count(b"\n") for t in texts) == most
    assert sum(f.stat().st_size for f in files) * 5 < sum(map(len, texts))
