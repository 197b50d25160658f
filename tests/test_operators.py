"""Reusable operators, including the ways taken beyond the broadcast limits."""

import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens import schemas
from offerlens.operators import aggregates, bitmaps, dedup, fingerprint, lookup, quality, tables


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_latest_by_is_deterministic_under_ties(spark):
    data = [("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), ("b", None, "w")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, t int, v string").repartition(3)
        out = dedup.latest_by(df, ["k"], [F.col("t").desc_nulls_last()])
        assert rows(out) == [("a", 1, "y"), ("b", None, "w")]


def test_hot_key_is_pruned_before_the_shuffle(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    out = dedup.latest_by(df, ["k"], [F.col("id").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert out.filter("k = 0").first().id == 29_997
    assert out.count() == 20_001


def test_repost_dedup(spark):
    df = spark.createDataFrame(
        [
            ("1", "Dev", "Beta", "2026-09-01", []),
            ("2", "dev", "BETA", "2026-09-20", None),
            ("3", "Dev", "Beta", "2026-10-01", None),
            ("4", None, "Beta", "2026-09-01", ["x"]),
            ("5", None, "Beta", "2026-09-01", ["x"]),
            ("6", "Dev", "Beta", None, ["x"]),
        ],
        "id string, t string, c string, f string, arr array<string>",
    ).withColumn("f", F.col("f").cast("date"))
    out = dedup.repost_dedup(df, "t", "c", "f", "id", "arr")
    assert [r.id for r in out.orderBy("id").collect()] == ["1", "3", "4", "5", "6"]


@pytest.fixture
def terms(spark):
    # one term holds a third of all rows
    return spark.range(9_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("t0"))
        .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("t"), (F.col("id") % 700).cast("string")))
        .alias("k"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_beyond_the_limit_gives_the_same(spark, terms, how):
    entries = spark.range(0, 600).select(
        F.concat(F.lit("t"), F.col("id")).alias("k"), (F.col("id") * 2).alias("v")
    )
    small = lookup.lookup_join(terms, entries, "k", how)
    large = lookup.lookup_join(terms, entries, "k", how, max_rows=0)
    assert rows(large.select("id", "k", "v")) == rows(small.select("id", "k", "v"))
    assert lookup.hot_keys(terms, "k", 0.1).collect()[0].k == "t0"


def test_fits_broadcast(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 100).alias("s"))
    assert lookup.fits_broadcast(df)
    assert not lookup.fits_broadcast(df, max_rows=99)
    assert not lookup.fits_broadcast(df, max_bytes=9_999)
    assert lookup.fits_broadcast(df.limit(0))


@pytest.mark.parametrize("max_rows", [1_000, 0])
def test_array_lookup_join(spark, max_rows):
    catalog = spark.createDataFrame(
        [("python", "Python"), ("py", "Python"), ("sql", "SQL")], schemas.CATALOG
    )
    df = spark.createDataFrame(
        [(1, ["SQL", "Py", "x", "python"]), (2, []), (3, None), (4, ["x"]), (5, ["py"]), (5, ["py"]), (6, None), (6, None)],
        "id int, a array<string>",
    )
    out = lookup.array_lookup_join(df, "a", catalog, "names", max_rows=max_rows)
    equal = [(5, ["Python"]), (5, ["Python"]), (6, None), (6, None)]  # equal rows stay two
    expected = [(1, ["SQL", "Python"]), (2, []), (3, None), (4, []), *equal]
    assert [(r.id, r.names) for r in out.orderBy("id").collect()] == expected
    inline = lookup.canonical_items(df, "a", catalog, "names", max_entries=3 if max_rows else 2)
    assert [(r.id, r.names) for r in inline.orderBy("id").collect()] == expected


def test_repeated_variants_are_joined(spark):
    catalog = spark.createDataFrame([("x", "A"), ("x", "B")], schemas.CATALOG)
    assert lookup.inline_entries(catalog) is None
    df = spark.createDataFrame([(1, ["X"])], "id int, a array<string>")
    assert sorted(lookup.canonical_items(df, "a", catalog, "names").first().names) == ["A", "B"]


def test_exact_median(spark):
    rng = random.Random(7)
    data = []
    for key in range(12):
        size = rng.choice([1, 2, 3, 50, 401])
        pool = [rng.uniform(-50, 50) if key % 2 else rng.choice([20000.0, 20000.5, 1e6]) for _ in range(size)]
        data += [(key, v) for v in pool]
    data += [(0, None), (None, 1.0), (None, 4.0)]
    df = spark.createDataFrame(data, "k int, v double")
    found = {r.k: (r.n, r.media, r.mediana) for r in aggregates.exact_median(df, "v", "k").collect()}
    for key in [*range(12), None]:
        values = [v for k, v in data if k == key and v is not None]
        n, mean, median = found[key]
        assert n == len(values)
        assert mean == pytest.approx(statistics.fmean(values))
        assert median == pytest.approx(statistics.median(values))


@pytest.mark.parametrize("low, step", [(1_000_000.0, 1e-3), (0.0, 1e-8)])
def test_exact_median_spreads_a_group_of_close_values(spark, low, step):
    """No partition of the sorted counts holds much more than its share, however close the values are."""
    n = 40_001
    df = spark.range(n).select(F.lit("a").alias("k"), (F.lit(low) + F.col("id") * step).alias("v"))
    out = aggregates.exact_median(df, "v", "k").first()
    assert out.n == n and out.mediana == pytest.approx(low + (n // 2) * step, rel=1e-12)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    counted = df.groupBy("k", "v").count()
    sizes = counted.repartitionByRange("k", "v").groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * n / 8


def test_exact_median_of_extreme_values(spark):
    inf = float("inf")
    data = [("a", v) for v in (-inf, -1e300, 0.0, 1e300, inf)] + [("b", v) for v in (1.0, 2.0, inf, float("nan"))]
    df = spark.createDataFrame(data, "k string, v double")
    found = {r.k: r.mediana for r in aggregates.exact_median(df, "v", "k").collect()}
    assert found == {"a": 0.0, "b": inf}


@pytest.mark.parametrize("reach", [3, 0, -100])
def test_exact_median_of_large_groups(spark, monkeypatch, reach):
    """Groups beyond the sketch's accuracy; bands that are too narrow, or empty, change nothing."""
    monkeypatch.setattr(aggregates, "REACH", reach)
    rng = random.Random(reach)
    pools = {
        "close": [rng.gauss(0, 1) for _ in range(9000)],
        "ties": [float(rng.choice([1, 1, 1, 2, 3])) for _ in range(7001)],
        "halves": [1.0] * 3000 + [2.0] * 3000,
        "skewed": [rng.paretovariate(0.7) for _ in range(5000)],
        None: [float(x) for x in range(2500)],
    }
    data = [(k, v) for k, pool in pools.items() for v in pool]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, v double").repartition(13, "v")
    found = {r.k: (r.n, r.mediana) for r in aggregates.exact_median(df, "v", "k").collect()}
    assert found == {k: (len(p), statistics.median(p)) for k, p in pools.items()}


def test_exact_median_moves_few_rows(spark):
    """What is counted and shuffled of a group of different values is its band, not its values."""
    n = 200_000
    rows = spark.range(n).select(F.lit("a").alias("k"), F.hash("id").cast("double").alias("_v"))
    ends = [0.5 - aggregates.REACH / aggregates.ACCURACY, 0.5 + aggregates.REACH / aggregates.ACCURACY]
    low, high = rows.agg(F.percentile("_v", ends)).first()[0]
    bounds = spark.createDataFrame([("a", low, high)], "_b_k string, _from double, _to double")
    counted = aggregates.banded_counts(rows, bounds, "k")
    assert counted.count() < n / 50
    assert counted.agg(F.sum("_n")).first()[0] == n


def test_exact_median_without_room_for_bounds(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "fits_broadcast", lambda df: False)
    test_exact_median(spark)


def test_approximate_median_is_close(spark):
    df = spark.range(1, 1002).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"))
    out = aggregates.mean_median_by(df, "v", "k", approx=True).first()
    assert (out.n, out.media) == (1001, 501.0) and abs(out.mediana - 501) <= 1


def test_ensure_schema_is_idempotent_and_additive(spark):
    old = T.StructType(
        [f for f in schemas.RAW_ATTEMPTS.fields if f.name in
         {"id_oferta", "tecnologias", "error", "respuesta_llm", "fecha_extraccion"}]
    )
    df = spark.createDataFrame([], old)
    once = tables.ensure_schema(df, schemas.RAW_ATTEMPTS)
    twice = tables.ensure_schema(once, schemas.RAW_ATTEMPTS)
    assert once.schema == twice.schema
    assert once.columns[:5] == old.names and set(once.columns) == set(schemas.RAW_ATTEMPTS.names)
    assert once.schema["version_prompt"].dataType == T.StringType()


@pytest.mark.parametrize("fits", [True, False])
def test_append_new_is_idempotent(spark, monkeypatch, fits):
    monkeypatch.setattr(tables, "fits_broadcast", lambda *_: fits)
    stored = spark.createDataFrame([("1", "old")], "id string, v string")
    batch = spark.createDataFrame(
        [("1", "new"), ("2", "b"), ("2", "a"), (None, "x"), ("3", "c")], "id string, v string"
    )
    fresh = tables.append_new(stored, batch, "id", [F.col("v").asc()])
    assert rows(fresh) == [("2", "a"), ("3", "c")]
    both = stored.unionByName(fresh)
    assert tables.append_new(both, batch, "id", [F.col("v").asc()]).isEmpty()


def test_append_reads_only_the_buckets_it_touches(spark, tmp_path):
    path, kind = str(tmp_path / "t"), T.StructType.fromDDL("id string, v long")
    rows_of = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
    assert tables.append_rows(rows_of(0, 500), path, "id", 16) == 500
    batch = rows_of(499, 502)
    stored = tables.with_layout(spark, path, kind)
    seen = tables.touched(stored, batch, "id", 16)
    used = {r[0] for r in batch.select(tables.bucket(F.col("id"), 16)).collect()}
    read = {r[0] for r in seen.select(F.regexp_extract(F.input_file_name(), "cubo=([0-9]+)/", 1)).distinct().collect()}
    assert {int(x) for x in read} == used and len(used) < 4
    plan = seen.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cubo#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    fresh = tables.append_new(stored, batch, "id", [F.col("v").asc()], 16)
    assert rows(fresh) == [("500", 500), ("501", 501)]
    # another number of buckets: the old ones are read whole, nothing is stored twice
    assert tables.append_rows(fresh, path, "id", 8) == 2
    stored = tables.with_layout(spark, path, kind)
    for buckets in (8, 16, 5):
        assert tables.append_new(stored, rows_of(0, 502), "id", [F.col("v").asc()], buckets).isEmpty()
    assert tables.read_table(spark, path, kind).columns == ["id", "v"]
    assert tables.append_rows(rows_of(0, 0), path, "id", 8) == 0


def test_read_table_before_and_after_a_schema_change(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_table(spark, path, schemas.RAW_ATTEMPTS).isEmpty()
    spark.createDataFrame([("1", "x")], "id_oferta string, error string").write.parquet(path)
    row = tables.read_table(spark, path, schemas.RAW_ATTEMPTS).first()
    assert (row.id_oferta, row.error, row.version_prompt) == ("1", "x", None)


def test_work_dir_is_the_shared_folder(spark):
    assert tables.work_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_fingerprint(spark):
    schema = "id string, n int, l array<string>, t timestamp_ntz"
    data = [("1", 1, ["a", None], None), ("2", None, [], None), ("3", 3, None, None)]
    base = spark.createDataFrame(data, schema)
    same = spark.createDataFrame(data[::-1], schema).repartition(5)
    assert rows(fingerprint.fingerprint(base)) == rows(fingerprint.fingerprint(same))
    one = fingerprint.fingerprint_all({"t": base})
    assert one == fingerprint.fingerprint_all({"t": same})
    changed = [
        base.unionByName(base.limit(1)),
        base.withColumn("id", F.concat("id", F.lit(" "))),
        base.withColumn("l", F.coalesce("l", F.array().cast("array<string>"))),
        base.withColumn("id", F.when(F.col("id") != "1", F.col("id")).otherwise("")),
        base.withColumn("id", F.when(F.col("id") != "1", F.col("id"))),
        base.filter("id <> '1'"),
    ]
    prints = {one, fingerprint.fingerprint_all({"u": base})}
    prints |= {fingerprint.fingerprint_all({"t": df}) for df in changed}
    assert len(prints) == len(changed) + 2


def test_fingerprint_tree_reads_changed_partitions_only(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id int, v string, mes string"
    data = [(i, f"v{i}", f"2026-{1 + i % 4:02d}" if i % 5 else None) for i in range(40)]
    spark.createDataFrame(data, schema).write.partitionBy("mes").parquet(path)
    read = lambda: spark.read.schema(schema).parquet(path)
    leaves, hashed = fingerprint.refreshed_leaves(read(), None, "mes")
    assert len(hashed) == 5 and leaves.count() == 5
    assert rows(fingerprint.combined(leaves)) == rows(fingerprint.fingerprint(read()))
    same, hashed = fingerprint.refreshed_leaves(read(), leaves, "mes")
    assert hashed == [] and rows(same) == rows(leaves)
    more = spark.createDataFrame([(99, "x", "2026-02"), (98, None, "2026-09")], schema)
    more.write.mode("append").partitionBy("mes").parquet(path)
    left = read().filter("mes is null or mes <> '2026-01'")
    new, hashed = fingerprint.refreshed_leaves(left, leaves, "mes")
    assert hashed == [("2026-02",), ("2026-09",)]
    assert rows(fingerprint.combined(new)) == rows(fingerprint.fingerprint(left))
    plan = fingerprint.fingerprint_by(read().filter(F.col("mes").eqNullSafe(F.lit("2026-02"))), "mes")
    assert "PartitionFilters: [(mes" in plan._jdf.queryExecution().toString()


def test_bitmaps_count_distinct_ids_over_any_period(spark):
    data = [(f"o{i % 700}", i % 12, "ab"[i % 2]) for i in range(0, 4000, 3)] + [("o1", 3, "a")] * 50 + [(None, 3, "a")]
    df = spark.createDataFrame(data, "id string, mes int, tec string")
    numbers = bitmaps.numbered(df, "id", F.col("mes"))
    assert numbers.count() == numbers.select("numero").distinct().count() == 700
    monthly = bitmaps.id_bitmaps(df.join(numbers, "id", "left"), "numero", "tec", "mes")
    for low, high in ((0, 11), (2, 7), (3, 3), (20, 30)):
        some = monthly.filter(F.col("mes").between(low, high))
        mine = [(i, m, t) for i, m, t in data if low <= m <= high and i]
        expected = {t: len({i for i, _, u in mine if u == t}) for t in {t for _, _, t in mine}}
        assert {r.tec: r.num_ofertas for r in bitmaps.distinct_ids(some, "tec").collect()} == expected
        assert bitmaps.distinct_ids(some).first().num_ofertas == len({i for i, _, _ in mine})
    more = spark.createDataFrame([("o1", 13), ("x1", 13), ("x2", 13)], "id string, mes int")
    later = bitmaps.numbered(more, "id", F.col("mes"), numbers)
    before = dict(map(tuple, numbers.collect()))
    after = dict(map(tuple, later.collect()))
    assert before.items() <= after.items() and len(after) == 702 and len(set(after.values())) == 702
    assert min(after["x1"], after["x2"]) > max(before.values())


def test_quality_operators(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "k string, v int")
    assert rows(quality.not_null(df, "k")) == [(None, 3)]
    assert rows(quality.unique(df, "k")) == [("a", 2)]
    assert rows(quality.accepted_values(df, "k", ["a"])) == [("b", None)]
    parents = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert rows(quality.relationships(df, "k", parents, "id")) == [("b", 1)]
    salaries = spark.createDataFrame(
        [("adzuna", 3000.0, None), ("llm", 3000.0, None), ("adzuna", 20000.0, None), (None, 5.0, 4.0)],
        "fuente_salario string, salario_min double, salario_max double",
    )
    assert sorted(r.salario_min for r in quality.salary_range(salaries).collect()) == [5.0, 3000.0]
    catalog = spark.createDataFrame([("go", "Go"), ("Go ", "Go"), ("a  b", "AB")], schemas.CATALOG)
    assert sorted(r.variante for r in quality.catalog_normalized(catalog).collect()) == ["Go ", "a  b"]
    with pytest.raises(ValueError, match="nombre_canonico"):
        quality.require_columns(catalog.drop("nombre_canonico"), schemas.CATALOG.names)


def test_checks_block(spark):
    checks = [
        quality.Check("t", "not_null", "k"),
        quality.Check("t", "unique", "k"),
        quality.Check("t", "relationships", "k", {"to": "p", "field": "id"}),
        quality.Check("absent", "not_null", "k"),
    ]
    good = {"t": spark.createDataFrame([("a",)], "k string"), "p": spark.createDataFrame([("a",)], "id string")}
    quality.assert_checks(quality.run_checks(good, checks))
    bad = {**good, "t": spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], "k string")}
    results = quality.run_checks(bad, checks)
    found = {r.prueba: r.fallos for r in results.collect()}
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2  # each table once
    assert found == {"not_null_t_k": 1, "unique_t_k": 2, "relationships_t_k": 2}
    with pytest.raises(quality.QualityError, match="unique_t_k: 2"):
        quality.assert_checks(quality.run_checks(bad, checks))
