"""A journal of calls: results that tasks record as they get them, so that nothing is called twice.

Each record is a small Parquet file in the shared folder, complete once it has its name. A task that is run again
reads what its own number has recorded in this run; a run that is started again reads what any task had recorded. A
run that ended is closed, and the next one starts afresh.

Callers also meet there after each round. Spark's own barrier looks for its answer once a second, which is most of the
time of a round of quick calls.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.tables import read_table

REPLIES = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id_oferta", "respuesta_llm", "call_error")]
)
_ROWS = pa.schema([(n, pa.string()) for n in REPLIES.names])
_CLOSED = "cerrada"
#: Seconds between looks for the others' words, at first and at most.
_FIRST_LOOK, _LAST_LOOK = 0.001, 1.0


@dataclass(frozen=True)
class Journal:
    """One run's records under ``root``; the object travels to the tasks."""

    root: str
    run: str

    def _folder(self) -> tuple[fs.FileSystem, str]:
        store, path = fs.FileSystem.from_uri(self.root if "://" in self.root else f"file://{self.root}")
        return store, f"{path.rstrip('/')}/{self.run}"

    def write(self, caller: int, number: int, rows: list[tuple[str, str | None, str | None]]) -> None:
        """Record a caller's rows; the file gets its name when it is complete."""
        store, folder = self._folder()
        store.create_dir(folder, recursive=True)
        columns = [pa.array(c, pa.string()) for c in zip(*rows)]
        draft = f"{folder}/_{uuid.uuid4().hex}"
        pq.write_table(pa.table(columns, schema=_ROWS), draft, filesystem=store)
        store.move(draft, f"{folder}/llamador-{caller:05d}-{number:09d}.parquet")

    def recorded(self, caller: int) -> dict[str, tuple[str | None, str | None]]:
        """What a caller has recorded in this run: (reply, error) by offer."""
        store, folder = self._folder()
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        mine = sorted(f.path for f in found if f.base_name.startswith(f"llamador-{caller:05d}-"))
        rows = [r for path in mine for r in pq.read_table(path, filesystem=store, schema=_ROWS).to_pylist()]
        return {r["id_oferta"]: (r["respuesta_llm"], r["call_error"]) for r in rows}

    def replies(self, spark: SparkSession) -> DataFrame:
        """Everything recorded in this run."""
        return read_table(spark, f"{self.root.rstrip('/')}/{self.run}", REPLIES)

    def close(self) -> None:
        store, folder = self._folder()
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/_{_CLOSED}") as out:
            out.write(b"")


class Meeting:
    """Callers that say a word each, round by round; ``name`` is new for each attempt, so no old word is heard.

    A caller's word is a small file that the next one replaces. Whoever is in a later round has heard all words of this
    one and went on, so its word of this one is not needed to know that all go on.
    """

    def __init__(self, journal: Journal, name: str, caller: int, callers: int):
        self.store, folder = journal._folder()
        self.store.create_dir(folder, recursive=True)
        self.paths = [f"{folder}/_{name}-{i:05d}" for i in range(callers)]
        self.caller = caller

    def _word(self, path: str, number: int, on: str) -> str | None:
        """A caller's word in a round, ``on`` if it is in a later one; None before it has come."""
        try:
            with self.store.open_input_stream(path) as told:
                line = told.read().decode()
        except FileNotFoundError:
            return None
        if not line.endswith("\n"):
            return None  # being written
        at, word = line.split()
        return word if int(at) == number else on if int(at) > number else None

    def said(self, number: int, word: str, on: str) -> list[str]:
        """What all callers say in a round; waits for them. ``on`` is the word by which all go on."""
        with self.store.open_output_stream(self.paths[self.caller]) as out:
            out.write(f"{number} {word}\n".encode())
        words, waiting, pause = [word], set(self.paths) - {self.paths[self.caller]}, _FIRST_LOOK
        while waiting:
            heard = {path: self._word(path, number, on) for path in waiting}
            words += [w for w in heard.values() if w is not None]
            waiting = {path for path, w in heard.items() if w is None}
            if waiting:
                time.sleep(pause)
                pause = min(2 * pause, _LAST_LOOK)
        return words


def open_journal(root: str) -> Journal:
    """The run under ``root`` that has not been closed, else a new one."""
    store, folder = Journal(root, "")._folder()
    runs = store.get_file_info(fs.FileSelector(folder.rstrip("/"), allow_not_found=True, recursive=True))
    every = {f.base_name for f in runs if f.type == fs.FileType.Directory}
    closed = {f.path.split("/")[-2] for f in runs if f.base_name == f"_{_CLOSED}"}
    left = sorted(every - closed)
    return Journal(root, left[0] if left else f"tanda-{uuid.uuid4().hex}")
