"""Taking byte spans out of whole texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .texts import byte_texts, numbered, whole_text


def union(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of half-open spans; spans that touch are one run."""
    runs: list[list[int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [(a, b) for a, b in runs]


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, end in runs:
        parts.append(text[at:start])
        at = end
    return b"".join([*parts, text[at:]])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = pa.array(map(squeeze, byte_texts(batch.column("text"))), pa.binary())
        kept = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, kept), texts], names=[*kept, "packed"])


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` compressed as ``packed``, to be shuffled."""
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return rows.mapInArrow(_pack, ", ".join([*schema, "packed binary"]))


def unpacked(column: pa.Array) -> Iterator[bytes]:
    return map(zstandard.ZstdDecompressor().decompress, column.to_pylist())


def with_lists(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """``doc_id``, ``row`` and the ``packed`` whole text of ``docs`` beside the list that ``lists`` has for its ``row``."""
    rows = whole_text(numbered(docs.select("doc_id", "text"), "row"), "doc_id", "row")
    return packed(rows).join(lists, "row", "left")


def report(docs: DataFrame, runs: DataFrame, *counts: str) -> DataFrame:
    """Per document what is left without the ``runs`` (array of ``first`` and ``end``) of its ``row``.

    ``counts`` are whole numbers that ``runs`` also has; they are 0 for rows that it does not have.
    """
    shown = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts]
    joined = with_lists(docs, runs).select("doc_id", "packed", "runs", *shown)
    kind = to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for text, found in zip(unpacked(batch.column("packed")), batch.column("runs").to_pylist()):
                gone = union((x["first"], x["end"]) for x in found or ())
                left = kept_bytes(text, gone)
                out["n_bytes"].append(len(text))
                out["n_removed"].append(len(text) - len(left))
                out["n_spans"].append(len(gone))
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            columns = [pa.array(v, pa.string() if n == "kept_sha256" else pa.int64()) for n, v in out.items()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(kind), *columns, *map(batch.column, counts)], names=["doc_id", *out, *counts]
            )

    doc = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return joined.mapInArrow(run, schema + "".join(f", {name} bigint" for name in counts))


def flat(rows: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows), *map(pa.array, columns.values())], names=["row", *columns])


def gathered(spans: DataFrame) -> DataFrame:
    """One list of runs per ``row``; a list is no longer than its document."""
    return spans.groupBy("row").agg(F.collect_list(F.struct("first", "end")).alias("runs"))
