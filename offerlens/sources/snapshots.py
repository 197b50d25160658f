"""Published snapshots: one folder per version, a manifest that describes them, and their order.

A version becomes current by taking the next free number in the folder ``order``: a file of that name, created
exclusively, that holds the version. Of two publishers at once one gets the number; the other looks again and takes a
later one, or none if its contents are there by then. No clock decides.
"""

from __future__ import annotations

import os
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import utc_text
from ..operators.fingerprint import fingerprint_all
from ..operators.tables import read_table

MANIFEST = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("huella", T.StringType()),
        T.StructField("tablas", T.ArrayType(T.StringType())),
        T.StructField("publicado", T.StringType()),
    ]
)


def _last_claim(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The largest number taken and its version; (0, None) before the first."""
    try:
        claims = spark.read.text(f"{root}/order", wholetext=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, None
    last = claims.select(F.col("_metadata.file_name").alias("name"), "value").orderBy(F.desc("name")).first()
    return (0, None) if last is None else (int(last.name), last.value)


def current(spark: SparkSession, root: str):
    """Manifest row of the version with the largest number, or None before the first publication.

    Versions from before there was an order count by their time, and only as long as no number is taken.
    """
    rows = read_table(spark, f"{root}/manifest", MANIFEST)
    version = _last_claim(spark, root)[1]
    if version is not None:
        rows = rows.filter(F.col("version") == version)
    return rows.orderBy(F.desc("publicado"), F.desc("version")).first()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text unless one of that name exists: whole or not at all, by one creator only."""
    local = re.sub("^file:/+", "/", path)
    hidden = f".{path.rpartition('/')[2]}-{uuid.uuid4().hex}"
    if ":/" not in local and (local != path or _default_is_local(spark)):
        folder = local.rpartition("/")[0]
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{hidden}", "x") as out:
            out.write(text)
        try:
            os.link(f"{folder}/{hidden}", local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(f"{folder}/{hidden}")
    # elsewhere a rename that never replaces, as Spark's own checkpoints use it
    hadoop = spark._jvm.org.apache.hadoop
    target = hadoop.fs.Path(path)
    draft = hadoop.fs.Path(target.getParent(), hidden)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        files = hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
        files.rename(draft, target, _no_options(spark))
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
            raise
        system.delete(draft, False)
        return False


def _no_options(spark: SparkSession):
    kind = spark._jvm.org.apache.hadoop.fs.Options.Rename
    return spark.sparkContext._gateway.new_array(kind, 0)


def _default_is_local(spark: SparkSession) -> bool:
    return spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")


def read_snapshot(spark: SparkSession, root: str, version: str, tables: list[str]) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{root}/versions/{version}/{t}") for t in tables}


def publish_snapshot(tables: dict[str, DataFrame], root: str) -> str:
    """Write all tables as a new version and make it the current one; returns its fingerprint.

    Files are rebalanced to the advisory size, so a small table is one file and
    a large one many. The fingerprint is taken from the written files.
    """
    spark = next(iter(tables.values())).sparkSession
    version, found = _write_version(tables, root)
    while not _create(spark, f"{root}/order/{_last_claim(spark, root)[0] + 1:020d}", version):
        pass
    return found


def _write_version(tables: dict[str, DataFrame], root: str) -> tuple[str, str]:
    """A new version and its manifest row; nobody reads it before it has a number."""
    spark = next(iter(tables.values())).sparkSession
    version = f"{utc_text()[:19].translate(str.maketrans('', '', '-: '))}-{uuid.uuid4().hex[:8]}"
    for name, df in tables.items():
        df.hint("rebalance").write.mode("errorifexists").parquet(f"{root}/versions/{version}/{name}")
    names = sorted(tables)
    found = fingerprint_all(read_snapshot(spark, root, version, names))
    entry = spark.createDataFrame([(version, found, names, utc_text())], MANIFEST)
    entry.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return version, found


def publish_if_changed(tables: dict[str, DataFrame], root: str) -> bool:
    """Publish unless the current version already holds the same contents.

    If another publisher takes the number first, the comparison is made again with what it published.
    """
    spark = next(iter(tables.values())).sparkSession
    number, _ = _last_claim(spark, root)
    latest = current(spark, root)
    if latest is not None and latest.huella == fingerprint_all(tables):
        return False
    version, found = _write_version(tables, root)
    while not _create(spark, f"{root}/order/{number + 1:020d}", version):
        number, _ = _last_claim(spark, root)
        latest = current(spark, root)
        if latest is not None and latest.huella == found:
            return False
    return True


def load_if_changed(
    spark: SparkSession, root: str, known: str | None = None
) -> tuple[dict[str, DataFrame] | None, str | None, bool]:
    """(tables, fingerprint to remember, stale) of the current version.

    Nothing is loaded when ``known`` is still current. Contents that do not match
    the announced fingerprint are returned for use, but marked stale and with
    ``known`` as the fingerprint to remember, so the next call tries again.
    """
    latest = current(spark, root)
    if latest is None or latest.huella == known:
        return None, known, False
    tables = read_snapshot(spark, root, latest.version, latest.tablas)
    if fingerprint_all(tables) != latest.huella:
        return tables, known, True
    return tables, latest.huella, False
