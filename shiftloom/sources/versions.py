"""Published versions of a table, with a log that decides which one is current.

A version is a folder of its own under ``base`` and an entry of the log in ``base/_versions``: its
number, name, folder, schema, predecessor and time. Entries are never changed. An entry is written
aside and renamed to its number, which fails where the number is taken; so of two writers that
started from one version only one commits, and the other gets ``VersionConflict``. A folder without
an entry is an aborted write that no reader sees.

The rename is atomic on HDFS and other file systems that refuse to rename onto a file; on an object
store without that, writers need a lock of their own.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .tables import new_name

LOG = "_versions"
_ENTRY = "number bigint, name string, folder string, schema string, previous string, committed string"


class VersionConflict(RuntimeError):
    """Another writer has committed since the version that this one started from."""


@dataclass(frozen=True)
class Version:
    number: int
    name: str
    folder: str
    schema: str
    previous: str | None
    committed: str

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows, with the schema they were published with."""
        return spark.read.schema(StructType.fromJson(json.loads(self.schema))).parquet(self.folder)


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs


def _exists(spark: SparkSession, path: str) -> bool:
    place = _hadoop(spark).Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def versions(spark: SparkSession, base: str) -> list[Version]:
    """All committed versions, oldest first."""
    if not _exists(spark, f"{base}/{LOG}"):
        return []
    rows = spark.read.schema(_ENTRY).json(f"{base}/{LOG}/*.json").orderBy("number").collect()
    return [Version(**r.asDict()) for r in rows]


def current(spark: SparkSession, base: str) -> Version | None:
    found = versions(spark, base)
    return found[-1] if found else None


def _commit(spark: SparkSession, base: str, entry: Version) -> None:
    fs = _hadoop(spark)
    aside = fs.Path(f"{base}/{LOG}/.{entry.number}-{new_name()}")
    target = fs.Path(f"{base}/{LOG}/{entry.number:012d}.json")
    files = fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    store = aside.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = store.create(aside, False)
    stream.write(bytearray(json.dumps(asdict(entry)).encode()))
    stream.close()
    plain = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    plain[0] = fs.Options.Rename.NONE
    try:
        files.rename(aside, target, plain)
    except Py4JJavaError as error:
        store.delete(aside, False)
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            raise VersionConflict(f"version {entry.number} of {base} was committed by another writer") from None
        raise


def _next(spark: SparkSession, base: str, expected: str | None) -> tuple[int, str | None]:
    """Number of the next version and the name of its predecessor, which must be ``expected``."""
    head = current(spark, base)
    name = head.name if head else None
    if name != expected:
        raise VersionConflict(f"{base} is at version {name!r}, not {expected!r}")
    return (head.number + 1 if head else 1), name


def publish_version(state: DataFrame, base: str, name: str, expected: str | None, table: str | None = None) -> Version:
    """Write ``state`` as version ``name`` on top of version ``expected`` (None for the first one).

    ``expected`` is the version that ``state`` was computed from. It is compared before the write, so that a writer
    that is late already does no work, and the commit fails if another one came in between. Columns
    may differ from the version before. ``table`` is then moved to the current version.
    """
    spark, base = state.sparkSession, base.rstrip("/")
    if name in {v.name for v in versions(spark, base)}:
        raise ValueError(f"{base} has a version {name!r} already")
    number, previous = _next(spark, base, expected)
    folder = f"{base}/{name}-{new_name()}"
    state.write.mode("errorifexists").parquet(folder)
    # What a reader gets: files have no columns that must not be null.
    schema = spark.read.parquet(folder).schema.json()
    entry = Version(number, name, folder, schema, previous, datetime.now(timezone.utc).isoformat())
    _commit(spark, base, entry)
    if table is not None:
        point(spark, base, table)
    return entry


def roll_back(spark: SparkSession, base: str, name: str, expected: str, table: str | None = None) -> Version:
    """Make the rows and columns of version ``name`` current again, as a new version on top of ``expected``."""
    base = base.rstrip("/")
    old = {v.name: v for v in versions(spark, base)}.get(name)
    if old is None:
        raise ValueError(f"{base} has no version {name!r}")
    number, previous = _next(spark, base, expected)
    entry = Version(number, f"{name}@{number}", old.folder, old.schema, previous, datetime.now(timezone.utc).isoformat())
    _commit(spark, base, entry)
    if table is not None:
        point(spark, base, table)
    return entry


def read_version(spark: SparkSession, base: str, name: str | None = None) -> DataFrame:
    """The current version, or the one called ``name``."""
    found = {v.name: v for v in versions(spark, base)}
    if not found:
        raise ValueError(f"{base} has no version")
    if name is not None and name not in found:
        raise ValueError(f"{base} has no version {name!r}")
    return (found[name] if name is not None else list(found.values())[-1]).read(spark)


def point(spark: SparkSession, base: str, table: str) -> None:
    """Let the catalog ``table`` show the current version, columns included.

    Its location is moved where the columns are the same. Otherwise the external table is made anew: between
    the two steps readers of the name find no table, and readers by ``read_version`` notice nothing. A
    writer that is overtaken here points to the newer version, as the log is read again at the end.
    """
    while True:
        head = current(spark, base)
        schema = StructType.fromJson(json.loads(head.schema))
        if spark.catalog.tableExists(table) and spark.table(table).schema == schema:
            spark.sql("ALTER TABLE IDENTIFIER(:name) SET LOCATION :place", {"name": table, "place": head.folder})
            spark.catalog.refreshTable(table)
        else:
            spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": table})
            spark.catalog.createTable(table, path=head.folder, source="parquet", schema=schema)
        if current(spark, base).number == head.number:
            return


def forget_versions(spark: SparkSession, base: str, keep: int) -> list[str]:
    """Delete the folders that the last ``keep`` versions do not use, those of aborted writes included.

    Only while no writer is at work: the folder of a write in progress has no entry either. The log stays.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    used = {v.folder.rsplit("/", 1)[1] for v in versions(spark, base)[-keep:]}
    place = _hadoop(spark).Path(base)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [f.getPath() for f in store.listStatus(place) if f.isDirectory() and f.getPath().getName() not in used | {LOG}]
    for path in gone:
        store.delete(path, True)
    return [path.getName() for path in gone]
