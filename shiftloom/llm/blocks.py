"""Sending each distinct word of the corpus through one place, and the answers back.

Documents are cut into blocks of bounded size. A block numbers its distinct words, the most
frequent first, and keeps each document as the numbers of its words in order. Its words go out
in buckets by their hash, so that equal words of all blocks meet in one bucket, each block with
one entry however often it has the word; the answers come back by block, where the documents
are put together again by position. Words, numbers and answers travel packed: as columns, not
as a row for each occurrence.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .texts import settled_path, utf8

#: Words of a block; a longer document is a block of its own.
BLOCK = 3_000_000
#: Words of a block that wait to be numbered together.
WAITING = 500_000
DOCS = -1
SCHEMA = "block bigint, bucket int, docs array<struct<doc_id:{doc},flag:boolean,words:bigint>>, payload binary, extra binary"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers below 2**32, compressed by byte planes."""
    planes = np.ascontiguousarray(values, np.uint32).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def unpack(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(payload), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def pack_ragged(rows: list[bytes]) -> bytes:
    """Byte strings: lengths, then the joined bytes, both compressed."""
    lengths = pack(np.fromiter(map(len, rows), np.uint32, len(rows)))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.compress(b"".join(rows), 3)


def unpack_ragged(payload: bytes) -> tuple[np.ndarray, bytes]:
    """Offsets and the joined bytes."""
    cut = 4 + int.from_bytes(payload[:4], "little")
    return np.r_[0, np.cumsum(unpack(payload[4:cut]), dtype=np.int64)], zstandard.decompress(payload[cut:])


def slices(payload: bytes) -> list[bytes]:
    offsets, data = unpack_ragged(payload)
    places = offsets.tolist()
    return [data[a:b] for a, b in zip(places, places[1:])]


class _Builder:
    """Collects documents until the block is full."""

    def __init__(self, buckets: int):
        self.buckets, self.number = buckets, 0
        self._clear()

    def _clear(self) -> None:
        self.docs, self.flags, self.parts, self.size = [], [], [], 0
        self.waiting, self.waits = [], 0
        self.numbers: dict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__

    def _number(self) -> None:
        """Number the waiting words: each distinct one of them is looked up once."""
        words = pa.chunked_array(self.waiting, pa.large_binary()).combine_chunks().dictionary_encode()
        own = np.fromiter(map(self.numbers.__getitem__, words.dictionary.to_pylist()), np.uint32, len(words.dictionary))
        self.parts.append(own[words.indices.to_numpy()])
        self.waiting, self.waits = [], 0

    def add(self, doc_id, flag: bool, word_lists: Iterable[list[bytes]]) -> None:
        count = 0
        for words in word_lists:
            self.waiting.append(pa.array(words, pa.large_binary()))
            count += len(words)
            self.waits += len(words)
            if self.waits >= WAITING:
                self._number()
        self.flags.append(flag)
        self.docs.append({"doc_id": doc_id, "flag": flag, "words": count})
        self.size += count

    def rows(self) -> Iterator[dict]:
        if not self.docs:
            return
        block = (TaskContext.get().partitionId() << 32) + self.number
        self._number()
        words, every = list(self.numbers), np.concatenate(self.parts)
        counts = np.bincount(every, minlength=len(words))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        yield {"block": block, "bucket": DOCS, "docs": self.docs, "payload": pack(rank[every]), "extra": None}
        flagged = np.repeat(self.flags, [doc["words"] for doc in self.docs])
        chosen = np.bincount(every[flagged], minlength=len(order))[order]
        words = [words[k] for k in order.tolist()]
        bucket = np.fromiter((xxhash.xxh32_intdigest(w) for w in words), np.uint32, len(words)) % self.buckets
        by = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.r_[True, bucket[by][1:] != bucket[by][:-1]]) if len(by) else []
        for a, b in zip(edges, [*edges[1:], len(by)]):
            members = by[a:b]
            yield {
                "block": block, "bucket": int(bucket[members[0]]), "docs": None,
                "payload": pack_ragged([words[k] for k in members.tolist()]),
                "extra": pack_ragged([pack(np.diff(members, prepend=0)), pack(np.minimum(chosen[members], 2**32 - 1))]),
            }
        self.number += 1
        self._clear()


def cut_into_blocks(docs: DataFrame, cut: Callable[[bytes], Iterable[list[bytes]]], buckets: int) -> DataFrame:
    """A written table of blocks of ``docs`` (doc_id, flag, text): rows of words by bucket, and one row of documents."""
    docs = docs.select("doc_id", "flag", "text")
    schema = SCHEMA.format(doc=docs.schema["doc_id"].dataType.simpleString())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = _Builder(buckets)
        kind = None
        for batch in batches:
            if kind is None:
                doc = pa.struct([("doc_id", batch.schema.field("doc_id").type), ("flag", pa.bool_()), ("words", pa.int64())])
                kind = pa.schema([
                    ("block", pa.int64()), ("bucket", pa.int32()), ("docs", pa.list_(doc)),
                    ("payload", pa.binary()), ("extra", pa.binary()),
                ])
            offsets, data = utf8(batch.column("text"))
            keys, flags = batch.column("doc_id").to_pylist(), batch.column("flag").to_pylist()
            for k, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                builder.add(keys[k], bool(flags[k]), cut(data[a:b].tobytes()))
                if builder.size >= BLOCK:
                    for row in builder.rows():
                        yield pa.RecordBatch.from_pylist([row], kind)
        for row in builder.rows():
            yield pa.RecordBatch.from_pylist([row], kind)

    # Bucketed by block, so that the documents need not be shuffled to meet their answers.
    spark, name = docs.sparkSession, f"blocks_{uuid.uuid4().hex}"
    rows = docs.mapInArrow(blocks, schema).withColumn("kind", F.when(F.col("bucket") < 0, "docs").otherwise("words"))
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.write.format("parquet").partitionBy("kind").bucketBy(places, "block")
    writer.option("path", settled_path(spark, name, table=name)).saveAsTable(name)
    return spark.table(name)


def words_of(blocks: DataFrame) -> DataFrame:
    return blocks.where("kind = 'words'").select("block", "bucket", "payload", "extra")


def docs_of(blocks: DataFrame) -> DataFrame:
    return blocks.where("kind = 'docs'").select("block", "docs", "payload")


def answers(blocks: DataFrame, answer: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], buckets: int) -> DataFrame:
    """Give the words of each bucket, of all blocks, to ``answer`` in one task: rows in, rows of answers out."""
    words = words_of(blocks).repartition(buckets, "bucket")
    return words.mapInArrow(answer, "block bigint, bucket int, payload binary, extra binary")


def assemble(blocks: DataFrame, answered: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """Bring the answers of a block and its documents together: one bounded group per block.

    ``finish(docs, numbers, gathered)`` gets the documents, the numbers of their words one after the
    other, and triples of word numbers, answer payload and further parts; it returns a table.
    """

    def group(own: pa.Table, found: pa.Table) -> pa.Table:
        doc = own.to_pylist()[0]
        gathered = []
        for row in found.to_pylist():
            steps, *more = slices(row["extra"])
            gathered.append((np.cumsum(unpack(steps), dtype=np.int64), row["payload"], more))
        return finish(doc["docs"], unpack(doc["payload"]), gathered)

    return docs_of(blocks).groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(group, schema)


def doc_numbers(docs: list[dict], numbers: np.ndarray) -> Iterator[tuple[dict, np.ndarray]]:
    """Each document with the numbers of its words."""
    at = 0
    for doc in docs:
        yield doc, numbers[at:at + doc["words"]]
        at += doc["words"]
