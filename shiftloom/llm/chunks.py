"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes, and a text is cut where its low bits are zero, so cuts
follow the content and fall alike again soon after an insertion. Chunks are known by a digest of
128 bits. A chunk that the table has more than once is repeated if it belongs to a run of such
chunks of ``RUN`` bytes at least (shorter ones occur by chance in ordinary prose); of each repeated
chunk the first copy, by row and place, stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from . import spans
from .texts import numbered, settle, utf8, whole_text

MIN_CHUNK, MAX_CHUNK, CUT_BITS = 16, 512, 4
RUN = 96
#: Bytes whose hash decides on a cut. They may begin before the chunk.
REACH = 32
PIECE = 1 << 20
GEAR = np.random.default_rng(19770525).integers(0, 1 << 32, 256, np.uint32)


def candidates(data: np.ndarray) -> np.ndarray:
    """Ends of chunks that the gear hash of the last ``REACH`` bytes proposes."""
    found = []
    for start in range(0, len(data), PIECE):
        lead = min(start, REACH - 1)
        rolled = GEAR[data[start - lead:start + PIECE]]
        step = 1
        while step < REACH:  # doubles the bytes that a hash covers
            earlier = np.zeros_like(rolled)
            earlier[step:] = rolled[:-step] << np.uint32(step)
            rolled = rolled + earlier
            step *= 2
        ends = np.flatnonzero(rolled[lead:] >> np.uint32(32 - CUT_BITS) == 0)
        found.append(ends + start + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def cuts(data: np.ndarray) -> list[int]:
    """Ends of the chunks, the last being the end of the text."""
    ends, at = [], 0
    for end in candidates(data).tolist():
        while end - at > MAX_CHUNK:
            at += MAX_CHUNK
            ends.append(at)
        if end - at >= MIN_CHUNK:
            ends.append(end)
            at = end
    while len(data) - at > MAX_CHUNK:
        at += MAX_CHUNK
        ends.append(at)
    return [*ends, len(data)] if at < len(data) else ends


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        offsets, data = utf8(batch.column("text"))
        rows, digests, starts, ends = [], [], [], []

        def flush() -> pa.RecordBatch:
            names = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            out = spans.flat(
                np.array(rows, np.int64), one=names[:, 0].copy(), two=names[:, 1].copy(),
                first=np.array(starts, np.int64), end=np.array(ends, np.int64),
            )
            for part in (rows, digests, starts, ends):
                part.clear()
            return out

        for row, a, b in zip(batch.column("row").to_pylist(), offsets.tolist(), offsets[1:].tolist()):
            text, own = data[a:b].tobytes(), cuts(data[a:b])
            begins = [0, *own[:-1]] if own else []
            digests.extend(digest(text[x:y]) for x, y in zip(begins, own))
            starts.extend(begins)
            ends.extend(own)
            rows.extend([row] * len(own))
            if len(rows) > 100_000:
                yield flush()
        yield flush()


def repeated(docs: DataFrame) -> DataFrame:
    """Per row (see ``numbered``) that has any: arrays ``repeated`` and ``runs`` of spans (``first``, ``end``).

    ``repeated`` holds all repeated chunks, ``runs`` those that are not the first copy and go. Null
    counts as an empty text, which has no chunk; repeated rows are texts of their own; an empty
    table gives no rows.
    """
    rows = whole_text(numbered(docs.select("text"), "row"), "row")
    chunks = rows.mapInArrow(_chunk_rows, "row bigint, one bigint, two bigint, first bigint, end bigint")
    # One shuffle by digest counts the copies and hands on those of repeated chunks only.
    copies = Window.partitionBy("one", "two")
    found = chunks.withColumn("n", F.count("*").over(copies)).withColumn("owner", F.min("row").over(copies)).where("n > 1")
    lists = found.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("first", "end", "one", (F.col("owner") == F.col("row")).alias("own")))).alias("chunks")
    )

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            every, gone = [], []
            for own in batch.column("chunks").to_pylist():
                long = [x for x in spans.union((c["first"], c["end"]) for c in own) if x[1] - x[0] >= RUN]
                inside, met, here = [], set(), iter([*long, (1 << 62, 1 << 62)])
                run = next(here)
                removed = []
                for c in own:
                    while c["first"] >= run[1]:
                        run = next(here)
                    first_copy = c["own"] and c["one"] not in met
                    met.add(c["one"])
                    if c["first"] >= run[0]:
                        inside.append({"first": c["first"], "end": c["end"]})
                        if not first_copy:
                            removed.append(inside[-1])
                every.append(inside)
                gone.append(removed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(every, kind), pa.array(gone, kind)], names=["row", "repeated", "runs"]
            )

    part = "array<struct<first:bigint,end:bigint>>"
    return settle(lists.mapInArrow(select, f"row bigint, repeated {part}, runs {part}"))


def report(docs: DataFrame) -> DataFrame:
    """All documents: bytes, bytes in repeated chunks (first copies included), removed bytes and runs, what is left."""
    size = F.aggregate("repeated", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["first"])
    return spans.report(docs, repeated(docs).select("row", "runs", size.alias("n_repeated")), "n_repeated")
