"""Helpers that the operators share: text columns in Arrow batches, words, and the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import shared_folder

# Byte classes. Bytes from 0x80 up belong to letters of other scripts.
LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))
ALNUM_LOWER = bytes(
    LOWER[b] if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(0x100)
)
SPACE = b" \t\n\x0b\x0c\r"

#: Bytes of one text that are cut into words at a time, so that a very long text needs little memory.
PIECE = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(docs: DataFrame, *others: str) -> DataFrame:
    """``text`` with null as empty, beside the other columns that are named; all further ones go."""
    return docs.select(*[F.col(f"`{c}`") for c in others], F.coalesce(F.col("text"), F.lit("")).alias("text"))


def numbered(docs: DataFrame, column: str) -> DataFrame:
    """Add a number that tells rows apart even if their ``doc_id`` is null or repeated.

    It follows the partition and the place in it, so ``docs`` must come from a stored table:
    then each reading of it gives a row the same number.
    """
    return docs.withColumn(column, F.monotonically_increasing_id())


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pc.fill_null(column.cast(pa.large_string()).cast(pa.large_binary()), b"")
    offsets = np.frombuffer(binary.buffers()[1], np.int64, len(binary) + 1, binary.offset * 8)
    data = binary.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    offsets, data = utf8(column)
    view = memoryview(data)
    for start, end in zip(offsets.tolist(), offsets[1:].tolist()):
        yield bytes(view[start:end])


def word_lists(text: bytes, table: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, mapped through a byte table, in lists of bounded size.

    Words are cut at ASCII white space, so ``table`` maps every other separator to a space.
    """
    if len(text) <= piece:
        yield text.translate(table).split()
        return
    kept = b""
    for start in range(0, len(text), piece):
        part = kept + text[start:start + piece].translate(table)
        words = part.split()
        open_end = part[-1:] not in (b"", *(SPACE[k:k + 1] for k in range(len(SPACE))))
        kept = words.pop() if words and open_end else b""
        yield words
    yield [kept] if kept else []


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, or with a number after it, so that ``docs`` has no such column, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    return next(n for n in (name, *(f"{name}{k}" for k in range(len(taken)))) if n not in taken)


#: Paths, and catalog tables, that the innermost ``scratch`` has settled; None outside of any.
_SETTLED: ContextVar[list[tuple[str, str | None]] | None] = ContextVar("settled", default=None)


@contextmanager
def scratch() -> Iterator[list[tuple[str, str | None]]]:
    """Collect what is settled inside, for ``forget``; what others settle is not touched."""
    made: list[tuple[str, str | None]] = []
    token = _SETTLED.set(made)
    try:
        yield made
    finally:
        _SETTLED.reset(token)


def settled_path(spark: SparkSession, name: str, table: str | None = None) -> str:
    """A new place in the shared folder, and the catalog table that will stand for it."""
    path = f"{shared_folder(spark)}/settled/{name}"
    if (made := _SETTLED.get()) is not None:
        made.append((path, table))
    return path


def settle(rows: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared folder and read it from there.

    What is settled outlives a lost executor, and Spark knows its size when it plans the next join.
    """
    path = settled_path(rows.sparkSession, uuid.uuid4().hex)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def forget(spark: SparkSession, made: list[tuple[str, str | None]]) -> None:
    """Delete what a ``scratch`` has collected; nothing may read it any more."""
    for path, table in made:
        if table is not None:
            spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": table})
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    made.clear()
