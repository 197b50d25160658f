"""Column builders on hand-made values."""

import datetime

import pytest
from pyspark.sql import functions as F

from offerlens.functions import arrays, dates, numbers, replies, text


def evaluate(spark, build, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, c {kind}")
    rows = df.select("i", build(F.col("c")).alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


def test_safe_date(spark):
    given = ["2026-09-10", "2026-09-10T08:00:00Z", "2026/09/10", "2026-9-1", "2026-09", "2026",
             "2026-02-30", "ayer", "", None]
    day = datetime.date(2026, 9, 10)
    assert evaluate(spark, dates.safe_date, given) == [
        day, day, day, datetime.date(2026, 9, 1), None, None, None, None, None, None
    ]


def test_month(spark):
    out = evaluate(spark, lambda c: dates.month_start(dates.safe_date(c)), ["2026-09-30", None])
    assert out == [datetime.date(2026, 9, 1), None]


def test_stamps_are_naive_utc_in_any_session_zone(spark):
    zone = datetime.timezone(datetime.timedelta(hours=2))
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    try:
        row = spark.range(1).select(
            dates.utc_stamp(datetime.datetime(2026, 9, 20, 6)).alias("a"),
            dates.utc_stamp(datetime.datetime(2026, 9, 20, 6, tzinfo=zone)).alias("b"),
            dates.year_month(dates.safe_date(F.lit("2026-09-01"))).alias("c"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (datetime.datetime(2026, 9, 20, 6), datetime.datetime(2026, 9, 20, 4), "2026-09")


def test_term_keys(spark):
    given = ["  Embedded  Linux ", "React.JS", "a\t\nb", " Go ", None]
    assert evaluate(spark, text.term_key, given) == ["embedded linux", "react.js", "a b", "go", None]
    odd = [" Spark  SQL ", "\x0bR"]
    assert evaluate(spark, text.entry_key, odd) == ["spark sql", "r"]


def test_surrogate_key_propagates_null(spark):
    assert evaluate(spark, lambda c: text.surrogate_key(F.lit("a"), c), ["b", None]) == ["a|b", None]


def test_modes_and_aliases(spark):
    assert evaluate(spark, text.canonical_mode, [" Híbrido", "", "  ", "REMOTO", None]) == [
        "hibrido", None, None, "remoto", None
    ]
    found = evaluate(
        spark, lambda c: text.alias_map(c, text.WORK_MODE_ALIASES), [" On-Site ", "híbrido", "luna", None]
    )
    assert found == ["presencial", "hibrido", None, None]


def test_clean_url(spark):
    given = ["https://x.es/a/1?utm=2#f", "HTTP://X.es/A#b", "", None, "  https://x.es/a\n?b", "/solo?x"]
    assert evaluate(spark, text.clean_url, given) == [
        "https://x.es/a/1", "http://X.es/A", None, None, "https://x.es/a", "/solo"
    ]


def test_html_text(spark):
    given = [
        "Kites <em>and</em> <b>string</b>",
        "<p> uno </p>\n<p>dos&nbsp;</p><br/>",
        "R&amp;D &lt;b&gt; caf&eacute; &#8364; &#x20AC; &euro; &nada; 5 & 6",
        "<script>var a='</p>';</script>fin<!-- x > y --><style>p{}</style>",
        '<a title="a>b">c</a> 3 < 4',
        "  llano  ",
        "",
        None,
    ]
    assert evaluate(spark, text.html_text, given) == [
        "Kites and string",
        "uno dos",
        "R&D <b> café € € € &nada 5 & 6",
        "fin",
        "c 3 < 4",
        "llano",
        "",
        None,
    ]


def test_html_text_is_linear_and_reads_windows_references(spark):
    import time

    given = ["<b " * 340_000, "it&#146;s &#150; &#x80;", "<a '" * 1000]
    start = time.time()
    out = evaluate(spark, text.html_text, given)
    assert time.time() - start < 20
    assert out[0] == ("<b " * 340_000).strip() and out[1] == "it’s – €"


def test_prompt_cuts_only_the_description(spark):
    out = evaluate(spark, lambda c: text.prompt(c, c, "T={titulo} D={descripcion}.", 3), ["abcdef", None])
    assert out == ["T=abcdef D=abc.", "T= D=."]


def test_strict_json_rejects_trailing_text(spark):
    given = ['{"a":1}', '{"a":1} {"b":2}', '{"a":1}}', "[1]", "1,2", "", "x", None]
    valid = evaluate(spark, lambda c: replies.strict_json(c).isNotNull(), given)
    assert valid == [True, False, False, True, False, False, False, False]


def test_reply_fields_of_a_lenient_reply(spark):
    given = [
        '```json\n{"a": 1}\n```',
        'Claro: {"a": 1} espero que ayude',
        '[{"a": 1}]',
        "esto no es json",
        '{"a": 1} y {"b": 2}',
        "",
        None,
    ]
    found = lambda c: replies.reply_fields(c, "a")
    assert evaluate(spark, lambda c: found(c)["fields"]["a"].cast("string"), given) == ["1", "1", None, None, None, None, None]
    assert evaluate(spark, lambda c: found(c)["is_object"], given) == [True, True, False, None, None, None, None]


def test_json_list_is_strict(spark):
    given = [
        ' {"tecnologias": ["a", 1, null, {"x": 1}]} ',
        '{"tecnologias": []}',
        '{"tecnologias": "a"}',
        '```json\n{"tecnologias": ["a"]}\n```',
        '{"tecnologias": ["a"]} sobra }',
        "{'tecnologias': ['a']}",
        None,
    ]
    assert evaluate(spark, lambda c: replies.json_list(c, "tecnologias"), given) == [
        ["a", "1", None, '{"x":1}'], [], None, None, None, None, None
    ]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("45000", 45000.0),
        ('"45.000 €"', 45000.0),
        ('"45.000-55.000€"', 4500055000.0),
        ('"30k"', 30.0),
        ('"-5"', 5.0),
        ('"45000.0"', 450000.0),
        ('"1.234,56"', 1234.56),
        ('"1,2,3"', None),
        ('"a convenir"', None),
        ("true", None),
        ("null", None),
        ("-5", None),
        ("0", None),
        ("[1]", None),
        ('{"a": 1}', None),
        ("12.5", 12.5),
    ],
)
def test_lenient_salary(spark, value, expected):
    doc = '{"s": ' + value + "}"
    out = evaluate(spark, lambda c: replies.lenient_salary(replies.strict_json(c), "$.s"), [doc])
    assert out == [expected]


def test_bounds_and_pairs(spark):
    df = spark.createDataFrame(
        [(5.0, 3.0), (3.0, 5.0), (None, 3.0), (5.0, None), (None, None)], "a double, b double"
    )
    low, high = numbers.ordered_bounds(F.col("a"), F.col("b"))
    rows = df.select(low.alias("lo"), high.alias("hi"), numbers.midpoint(F.col("a"), F.col("b")).alias("m"))
    assert [tuple(r) for r in rows.collect()] == [
        (3.0, 5.0, 4.0), (3.0, 5.0, 4.0), (None, 3.0, 3.0), (5.0, None, 5.0), (None, None, None)
    ]
    pairs = spark.createDataFrame(
        [(1.0, None, 7.0, 8.0), (None, None, 7.0, None), (None, None, None, None)],
        "a double, b double, c double, d double",
    )
    source, lo, hi = numbers.prefer_pair(*[F.col(c) for c in "abcd"], ("llm", "adzuna"))
    assert [tuple(r) for r in pairs.select(source, lo, hi).collect()] == [
        ("llm", 1.0, None), ("adzuna", 7.0, None), (None, None, None)
    ]


def test_rounding(spark):
    assert evaluate(spark, lambda c: numbers.round_half_even(c, 1), [0.25, 0.35, 12.5], "double") == [
        0.2, 0.4, 12.5
    ]
    assert evaluate(spark, lambda c: numbers.round_half_away(c, 0), [2.5, 3.5, 2.4], "double") == [
        3.0, 4.0, 2.0
    ]
    assert evaluate(spark, lambda c: numbers.gate(c), [14999.0, 15000.0, 300000.0, None], "double") == [
        None, 15000.0, 300000.0, None
    ]


def test_array_lookup(spark):
    names = {
        "python": "Python", "react": "React", "react.js": "React", "apache airflow": "Airflow",
        "airflow": "Airflow",
    }
    given = [
        ["python", "REACT.JS", "Apache  Airflow"],
        ["python", "cobol-experimental-2000"],
        ["python", "Python", "PYTHON"],
        [],
        None,
    ]
    assert evaluate(spark, lambda c: arrays.array_lookup(c, names), given, "array<string>") == [
        ["Python", "React", "Airflow"], ["Python"], ["Python"], [], None
    ]
