"""Structured extraction: a caller's function turns prompts into replies, Spark does the rest."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import utc_stamp
from ..functions.numbers import ordered_bounds
from ..functions.replies import (
    lenient_salary,
    reply_fields,
    text_field,
    text_items,
)
from ..functions.text import (
    DEFAULT_TEMPLATE,
    SENIORITY_ALIASES,
    WORK_MODE_ALIASES,
    alias_map,
    entry_key,
    prompt,
)
from ..operators.lookup import canonical_items
from ..operators.tables import materialize, read_table, work_dir
from ..sources.journal import Journal, Meeting, open_journal
from .queue import pending_offers

# Fixed value: version stored with every attempt made with the default template.
PROMPT_VERSION = "2"

INVALID_JSON = "json_invalido: la respuesta no es JSON"
NOT_AN_OBJECT = "json_invalido: la respuesta no es un objeto JSON"


class QuotaExhausted(Exception):
    """Raised by an extractor when its quota is spent: stop calling, record nothing."""


class ExtractorConfigurationError(Exception):
    """Raised by an extractor that cannot work at all: fails the job."""


def _called(fn: Callable[[str], str], prompt: str) -> tuple[str | None, str | None]:
    """(reply, error) of one call; quota and configuration signals go on.

    Signals are known by name: where this package travels by value, the caller's function may raise its own copy.
    """
    try:
        return fn(prompt), None
    except Exception as exc:
        names = {(c.__module__, c.__qualname__) for c in type(exc).__mro__}
        for signal in (QuotaExhausted, ExtractorConfigurationError):
            if (signal.__module__, signal.__qualname__) in names:
                raise signal(*exc.args) from exc
        # a failing call is recorded, never fatal
        return None, f"llm_error: {type(exc).__name__}: {exc}"


def run_extractor(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """(id_oferta, respuesta_llm, call_error) for the prompts in ``df`` (id_oferta, prompt), in any order.

    ``fn`` has side effects, so the result must be written once and read back,
    and speculative execution must be off. After a quota signal a task makes no
    further call and emits nothing for the offers it did not try.
    """

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spent = False
        for batch in batches:
            done = []
            for row in batch.itertuples(index=False):
                if spent:
                    break
                try:
                    done.append((row.id_oferta, *_called(fn, row.prompt)))
                except QuotaExhausted:
                    spent = True
            yield pd.DataFrame(done, columns=["id_oferta", "respuesta_llm", "call_error"])

    return df.select("id_oferta", "prompt").mapInPandas(
        call, "id_oferta string, respuesta_llm string, call_error string"
    )


def deal(work: DataFrame, callers: int) -> DataFrame:
    """Ordered ``work`` dealt out in turn: row n goes to partition n % callers, and partitions keep the order.

    The order is numbered from per-task counts; only those reach the driver. No partition is empty.
    """
    # monotonically_increasing_id: the task above bit 33, the row in the task below
    rows = materialize(work.withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftright("_at", 33).cast("int")
    counts = rows.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect()
    first, offsets = 0, []
    for r in counts:
        offsets += [F.lit(r.task), F.lit(first).cast("long")]
        first += r.n
    if not first:
        return rows.withColumn("posicion", F.lit(0).cast("long")).drop("_at")
    place = F.element_at(F.create_map(*offsets), task) + F.col("_at") - F.shiftleft(task.cast("long"), 33)
    numbered = rows.withColumn("posicion", place).drop("_at")
    n = min(callers, first)
    return numbered.repartitionById(n, (F.col("posicion") % n).cast("int")).sortWithinPartitions("posicion")


def run_in_rounds(dealt: DataFrame, fn: Callable[[str], str], journal: Journal, calls: int = 1) -> DataFrame:
    """As ``run_extractor``, for one quota and one order that all callers share; ``dealt`` is ``deal``'s.

    Callers are barrier tasks: each makes up to ``calls`` calls, records them, and then all agree whether to go on.
    After the first quota signal nobody starts another round, so offers are tried newest first, and at most one
    round is tried in part. A task that is run again answers from the journal. Results are written once. Spark starts
    the callers together; they agree through the journal's folder, which a round of quick calls does not wait for.
    """

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = BarrierTaskContext.get()
        caller, known = context.partitionId(), journal.recorded(context.partitionId())
        name, *_ = context.allGather(uuid.uuid4().hex)
        meeting = Meeting(journal, name, caller, len(context.getTaskInfos()))
        rows = (row for batch in batches for row in batch.itertuples(index=False))
        number, spent, ended = 0, False, False
        while True:
            done, new = [], []
            while len(done) < calls and not spent and not ended:
                row = next(rows, None)
                if row is None:
                    ended = True
                elif row.id_oferta in known:
                    done.append((row.id_oferta, *known[row.id_oferta]))
                else:
                    try:
                        new.append((row.id_oferta, *_called(fn, row.prompt)))
                        done.append(new[-1])
                    except QuotaExhausted:
                        spent = True
                    except ExtractorConfigurationError:
                        if new:
                            journal.write(caller, number, new)
                        raise
            if new:
                journal.write(caller, number, new)
            yield pd.DataFrame(done, columns=["id_oferta", "respuesta_llm", "call_error"])
            said = meeting.said(number, "spent" if spent else "ended" if ended else "on", "on")
            number += 1
            if "spent" in said or set(said) == {"ended"}:
                return

    return dealt.select("id_oferta", "prompt").mapInPandas(
        call, "id_oferta string, respuesta_llm string, call_error string", barrier=True
    )


def parse_replies(replies: DataFrame, catalog: DataFrame | dict[str, str]) -> DataFrame:
    """Attempt fields from (id_oferta, respuesta_llm, call_error); ids must be distinct."""
    names = ["tecnologias", "seniority", "modalidad", "salario_min", "salario_max"]
    parsed = replies.withColumn(
        "_v", F.when(F.col("call_error").isNull(), reply_fields(F.col("respuesta_llm"), *names))
    )
    problem = (
        F.when(F.col("call_error").isNotNull(), F.col("call_error"))
        .when(F.col("_v").isNull(), F.lit(INVALID_JSON))
        .when(~F.col("_v.is_object"), F.lit(NOT_AN_OBJECT))
    )
    checked = parsed.withColumn("error", problem)
    v = F.col("_v.fields")
    fields = checked.select(
        "id_oferta",
        text_items(v["tecnologias"], "$").alias("_items"),
        alias_map(text_field(v["seniority"], "$"), SENIORITY_ALIASES).alias("seniority"),
        alias_map(text_field(v["modalidad"], "$"), WORK_MODE_ALIASES).alias("modalidad"),
        lenient_salary(v["salario_min"], "$").alias("_lo"),
        lenient_salary(v["salario_max"], "$").alias("_hi"),
        "error",
        "respuesta_llm",
    )
    named = canonical_items(fields, "_items", catalog, "tecnologias", key=entry_key)
    low, high = ordered_bounds(F.col("_lo"), F.col("_hi"))
    return named.select(
        "id_oferta",
        "tecnologias",
        "seniority",
        "modalidad",
        low.alias("salario_min"),
        high.alias("salario_max"),
        "error",
        "respuesta_llm",
    )


def record_attempts(
    parsed: DataFrame, provider: str, model: str, prompt_version: str, ts: datetime | None = None
) -> DataFrame:
    """Attempt rows, failures included, stamped with their origin and time."""
    stamped = parsed.withColumns(
        {
            "proveedor_llm": F.lit(provider),
            "modelo_llm": F.lit(model),
            "fecha_extraccion": utc_stamp(ts),
            "version_prompt": F.lit(prompt_version),
        }
    )
    return stamped.select(*schemas.RAW_ATTEMPTS.names)


def assert_not_all_failed(attempts: DataFrame) -> tuple[int, int]:
    """(processed, failed); raises when there were attempts and all of them failed."""
    found = attempts.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("error").isNotNull()).alias("bad")
    ).first()
    if found.n and found.n == found.bad:
        raise RuntimeError(f"all {found.bad} extractions failed; check the extractor")
    return found.n, found.bad


def classify_pending(
    spark: SparkSession,
    offers: DataFrame,
    attempts_path: str,
    fn: Callable[[str], str],
    catalog: DataFrame | dict[str, str],
    provider: str,
    model: str,
    prompt_version: str = PROMPT_VERSION,
    template: str = DEFAULT_TEMPLATE,
    limit: int | None = None,
    reprocess_empty: bool = False,
    parallelism: int | None = None,
    ts: datetime | None = None,
    journal: str | None = None,
) -> tuple[int, int]:
    """Extract the pending offers and append the attempts; returns (processed, failed).

    ``parallelism`` sets the number of callers, by default as many as the session has slots. They take the
    offers newest first, and stop together at the first quota signal. Replies are recorded as they come: in
    ``journal``, a shared folder, a run that was cut short is taken up by the next one.
    """
    attempts = read_table(spark, attempts_path, schemas.RAW_ATTEMPTS)
    queue = pending_offers(offers, attempts, prompt_version, limit, reprocess_empty)
    work = queue.select(
        "id_oferta",
        "fecha_publicacion",
        prompt(F.col("titulo"), F.col("descripcion"), template).alias("prompt"),
    )
    slots = spark.sparkContext.defaultParallelism
    record = open_journal(journal or f"{work_dir(spark)}/journal")
    before = materialize(record.replies(spark))
    left = work.join(before.select("id_oferta"), "id_oferta", "left_anti") if not before.isEmpty() else work
    order = [F.col("fecha_publicacion").desc_nulls_last(), F.col("id_oferta")]
    dealt = deal(left.orderBy(*order), min(parallelism or slots, slots))
    replies = before.unionByName(materialize(run_in_rounds(dealt, fn, record)))
    rows = materialize(
        record_attempts(parse_replies(replies, catalog), provider, model, prompt_version, ts)
    )
    rows.write.mode("append").parquet(attempts_path)
    record.close()
    return assert_not_all_failed(rows)
