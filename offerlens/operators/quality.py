"""Data-quality checks. Each operator returns the violating rows; ``run_checks`` counts them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import SALARY_MAX, SALARY_MIN
from ..functions.text import WORK_MODES, term_key

# Accepted categories.
LEVELS = ["junior", "mid", "senior"]
SALARY_SOURCES = ["llm", "adzuna"]


class QualityError(ValueError):
    """A check found violating rows, so nothing may be published."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Repeated keys and their number of rows; keys with a NULL are ignored."""
    known = df.dropna(subset=list(columns))
    return known.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Orphan values and their number of rows; NULLs pass.

    Both sides are reduced to their distinct keys before they meet, so the join
    never sees a repeated key.
    """
    child = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.join(keys, column, "left_anti")


def _bad_salary(low: float, high: float) -> Column:
    lo, hi = F.col("salario_min"), F.col("salario_max")
    outside = ~lo.between(low, high) | ~hi.between(low, high)
    return ((F.col("fuente_salario") == "adzuna") & outside) | (lo > hi)


def salary_range(df: DataFrame, low: float = SALARY_MIN, high: float = SALARY_MAX) -> DataFrame:
    """Published salaries outside the range, and ranges the wrong way round."""
    return df.filter(_bad_salary(low, high))


def catalog_normalized(catalog: DataFrame) -> DataFrame:
    """Variants that no normalized term could ever match."""
    return catalog.filter(F.col("variante") != term_key(F.col("variante")))


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    column: str = ""
    args: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return "_".join(p for p in (self.kind, self.table, self.column) if p)


def _columns(table: str, kind: str, *columns: str) -> list[Check]:
    return [Check(table, kind, c) for c in columns]


# The declared checks of the offer tables.
OFFER_CHECKS = [
    *_columns("raw_ofertas", "not_null", "id"),
    *_columns("raw_ofertas_clasificadas", "not_null", "id_oferta"),
    *_columns("stg_ofertas", "not_null", "id_oferta"),
    *_columns("stg_ofertas", "unique", "id_oferta"),
    Check("stg_ofertas", "accepted_values", "seniority", {"values": LEVELS}),
    Check("stg_ofertas", "accepted_values", "modalidad", {"values": WORK_MODES}),
    Check("stg_ofertas", "accepted_values", "fuente_salario", {"values": SALARY_SOURCES}),
    Check("stg_ofertas", "salary_range"),
    *_columns(
        "int_tecnologias_por_oferta", "not_null", "id_oferta_tecnologia", "id_oferta", "tecnologia"
    ),
    *_columns("int_tecnologias_por_oferta", "unique", "id_oferta_tecnologia"),
    Check(
        "int_tecnologias_por_oferta",
        "relationships",
        "id_oferta",
        {"to": "stg_ofertas", "field": "id_oferta"},
    ),
    *_columns(
        "demanda_tecnologias_mensual",
        "not_null",
        "id_tecnologia_mes",
        "tecnologia",
        "mes",
        "num_ofertas",
        "total_ofertas_con_tecnologia_mes",
        "pct_ofertas",
    ),
    *_columns("demanda_tecnologias_mensual", "unique", "id_tecnologia_mes"),
    *_columns(
        "salarios_por_tecnologia",
        "not_null",
        "id_tecnologia_mes",
        "tecnologia",
        "mes",
        "num_ofertas_con_salario",
    ),
    *_columns("salarios_por_tecnologia", "unique", "id_tecnologia_mes"),
    *_columns(
        "tendencia_modalidad",
        "not_null",
        "id_modalidad_mes",
        "modalidad",
        "mes",
        "num_ofertas",
        "pct_ofertas",
    ),
    *_columns("tendencia_modalidad", "unique", "id_modalidad_mes"),
    Check("tendencia_modalidad", "accepted_values", "modalidad", {"values": WORK_MODES}),
    *_columns(
        "cobertura_extraccion_mensual",
        "not_null",
        "mes",
        "total_ofertas_clasificadas",
        "ofertas_sin_tecnologia",
        "pct_sin_tecnologia",
    ),
    *_columns("cobertura_extraccion_mensual", "unique", "mes"),
    *_columns("catalogo_tecnologias", "not_null", "variante", "nombre_canonico"),
    *_columns("catalogo_tecnologias", "unique", "variante"),
    Check("catalogo_tecnologias", "catalog_normalized"),
]


def _row_condition(check: Check) -> Column | None:
    """Violation as a condition on one row, for checks that need no other row."""
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(check.args["values"])
    if check.kind == "salary_range":
        return _bad_salary(check.args.get("low", SALARY_MIN), check.args.get("high", SALARY_MAX))
    if check.kind == "catalog_normalized":
        return F.col("variante") != term_key(F.col("variante"))
    return None


def _said(number: int, what: str, key: Column | None = None) -> Column:
    """What a row says to a check: it breaks it, it has this key, or it is a parent with this key."""
    value = F.lit(None).cast("string") if key is None else key.cast("string")
    return F.struct(F.lit(number).alias("prueba"), F.lit(what).alias("que"), value.alias("clave"))


def _statements(table: str, checks: list[Check]) -> list[Column]:
    """What each row of ``table`` says to the checks, NULL where it says nothing."""
    out = []
    for i, check in enumerate(checks):
        if check.table == table:
            broken = _row_condition(check)
            if broken is not None:
                out.append(F.when(broken, _said(i, "rota")))
            else:
                key = F.col(check.column)
                out.append(F.when(key.isNotNull(), _said(i, "hija", key)))
        if check.kind == "relationships" and check.args["to"] == table:
            key = F.col(check.args["field"])
            out.append(F.when(key.isNotNull(), _said(i, "madre", key)))
    return out


def run_checks(tables: dict[str, DataFrame], checks: list[Check] = OFFER_CHECKS) -> DataFrame:
    """One row (prueba, fallos) per check on a given table.

    One scan of each table serves all of its checks, and one aggregate by (check, key) all checks of all tables:
    keys are counted in each task before they are shuffled, so a key that many rows share moves once for each task.
    """
    todo = [c for c in checks if c.table in tables]
    if not todo:
        raise ValueError("no check applies to the given tables")
    said = []
    for name, df in tables.items():
        if statements := _statements(name, todo):
            said.append(df.select(F.inline(F.filter(F.array(*statements), lambda s: s.isNotNull()))))
    counts = reduce(DataFrame.unionByName, said).groupBy("prueba", "clave").agg(
        *[F.count_if(F.col("que") == what).alias(what) for what in ("rota", "hija", "madre")]
    )
    number = F.col("prueba")
    repeated = number.isin([i for i, c in enumerate(todo) if c.kind == "unique"]) & (F.col("hija") > 1)
    orphaned = number.isin([i for i, c in enumerate(todo) if c.kind == "relationships"]) & (F.col("madre") == 0)
    failed = (
        F.when(repeated, F.lit(1).cast("long")).when(orphaned, F.col("hija")).otherwise(F.lit(0).cast("long"))
        + F.col("rota")
    )
    spark = next(iter(tables.values())).sparkSession
    # checks that no row spoke to have no failures
    every = spark.range(len(todo)).select(F.col("id").cast("int").alias("prueba"), F.lit(0).cast("long").alias("fallos"))
    total = counts.select("prueba", failed.alias("fallos")).unionByName(every).groupBy("prueba")
    names = F.array(*[F.lit(c.name) for c in todo])
    return total.agg(F.sum("fallos").alias("fallos")).select(F.get(names, number).alias("prueba"), "fallos")


def assert_checks(results: DataFrame) -> None:
    """Raise when a check failed; only the failing checks' names reach the driver."""
    failed = results.filter("fallos > 0").orderBy("prueba").collect()
    if failed:
        raise QualityError("; ".join(f"{r.prueba}: {r.fallos}" for r in failed))
