"""Byte-level BPE encoding and decoding over a global shuffle of distinct words.

Pre-tokens are sent out by their hash (see ``blocks``); where equal ones of the whole corpus meet, each
is encoded once, and the ids go back to the documents, which are put together by position.
Decoding looks each id up in the table of token bytes. The vocabulary is the only thing that is
broadcast; its size does not depend on the corpus.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import blocks
from .texts import whole_text

#: Bytes above which the merges of one word are kept in a heap.
LONG = 64
#: Encoded words that a task remembers before it starts anew.
REMEMBERED = 2_000_000
#: Above every rank.
NONE = 2**31 - 1
#: Words that are merged side by side.
SIDE = 4096
Ranks = dict[bytes, int]


def load_ranks(path: str) -> Ranks:
    """Token bytes and their ranks from a file with one base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def token_table(ranks: Ranks) -> list[bytes]:
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def encode_word(word: bytes, ranks: Ranks) -> list[int]:
    """Merge the pair of lowest rank, the leftmost first, until no pair has a rank."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > LONG:
        return _encode_long(word, ranks)
    parts = [word[k:k + 1] for k in range(len(word))]
    get, none = ranks.get, NONE
    pairs = [get(word[k:k + 2], none) for k in range(len(word) - 1)]
    while pairs and (low := min(pairs)) != none:
        k = pairs.index(low)
        part = parts[k] + parts.pop(k + 1)
        parts[k] = part
        del pairs[k]
        if k:
            pairs[k - 1] = get(parts[k - 1] + part, none)
        if k < len(pairs):
            pairs[k] = get(part + parts[k + 1], none)
    return [ranks[part] for part in parts]


def _encode_long(word: bytes, ranks: Ranks) -> list[int]:
    """The same merges for a long word: candidate pairs wait in a heap, neighbours are linked."""
    size = len(word)
    end, after, before = list(range(1, size + 1)), list(range(1, size + 1)), list(range(-1, size - 1))
    alive = [True] * size
    heap = [(rank, k, k + 2) for k in range(size - 1) if (rank := ranks.get(word[k:k + 2])) is not None]
    heapq.heapify(heap)

    def offer(k: int) -> None:
        if after[k] < size:
            stop = end[after[k]]
            if (rank := ranks.get(word[k:stop])) is not None:
                heapq.heappush(heap, (rank, k, stop))

    while heap:
        _, k, stop = heapq.heappop(heap)
        if not alive[k] or after[k] >= size or end[after[k]] != stop:
            continue
        gone = after[k]
        alive[gone], end[k], after[k] = False, stop, after[gone]
        if after[k] < size:
            before[after[k]] = k
        offer(k)
        if before[k] >= 0:
            offer(before[k])
    return [ranks[word[k:end[k]]] for k in range(size) if alive[k]]


@dataclass(frozen=True)
class Pairs:
    """Which two tokens make a third: an open hash table of ``left << 32 | right``, and the rank that the two make."""

    keys: np.ndarray
    made: np.ndarray
    bytes: np.ndarray  # the rank of each byte, -1 without one

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) << 32 | right
        slot = self._slot(wanted)
        at = self.keys.take(slot)
        miss = np.flatnonzero((at != wanted) & (at >= 0))
        while len(miss):
            slot[miss] = (slot[miss] + 1) & (len(self.keys) - 1)
            at = self.keys.take(slot[miss])
            miss = miss[(at != wanted[miss]) & (at >= 0)]
        return np.where(self.keys.take(slot) == wanted, self.made.take(slot), NONE)

    def _slot(self, wanted: np.ndarray) -> np.ndarray:
        mixed = wanted.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)


def pairs_of(ranks: Ranks) -> Pairs:
    get = ranks.get
    found: dict[int, int] = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            if (left := get(token[:cut])) is not None and (right := get(token[cut:])) is not None:
                found[left << 32 | right] = rank
    size = 1 << max(4, (3 * len(found)).bit_length())
    table = Pairs(np.full(size, -1, np.int64), np.full(size, NONE, np.int32), np.array([get(bytes([k]), -1) for k in range(256)], np.int32))
    keys = np.fromiter(found, np.int64, len(found))
    for key, slot, rank in zip(keys.tolist(), table._slot(keys).tolist(), found.values()):
        while table.keys[slot] >= 0:
            slot = (slot + 1) & (size - 1)
        table.keys[slot], table.made[slot] = key, rank
    return table


def encode_words(words: list[bytes], ranks: Ranks, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one word after the other, and how many each has: those of ``encode_word``.

    Words of similar length are merged side by side, each by its own leftmost pair of lowest rank.
    """
    whole = [ranks.get(word) for word in words]
    counts, parts = np.ones(len(words), np.int64), []
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    open_words = np.fromiter((rank is None for rank in whole), bool, len(words))
    known = np.flatnonzero(~open_words)
    parts.append((known, np.array([whole[k] for k in known.tolist()], np.int64)))
    for k in np.flatnonzero(open_words & (lengths > LONG)).tolist():
        ids = _encode_long(words[k], ranks)
        counts[k] = len(ids)
        parts.append((np.array([k]), np.array(ids, np.int64)))
    rest = np.flatnonzero(open_words & (lengths <= LONG))
    rest = rest[np.argsort(lengths[rest], kind="stable")]
    for at in range(0, len(rest), SIDE):
        own = rest[at:at + SIDE]
        ids, counts[own] = _merged([words[k] for k in own.tolist()], lengths[own], pairs)
        parts.append((own, ids))
    starts, flat = np.cumsum(counts) - counts, np.empty(counts.sum(), np.int64)
    for own, ids in parts:
        many = counts[own]
        flat[np.repeat(starts[own] - (np.cumsum(many) - many), many) + np.arange(len(ids))] = ids
    return flat, counts


def _merged(words: list[bytes], lengths: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words that are in no vocabulary as a whole, and how many each has."""
    n, width = len(words), max(1, int(lengths.max()))
    column = np.arange(width)
    ids = np.zeros((n, width), np.int32)
    ids[column < lengths[:, None]] = pairs.bytes[np.frombuffer(b"".join(words), np.uint8)]
    if ids.min() < 0:
        raise KeyError("a byte has no rank")
    made = np.full((n, width), NONE, np.int32)
    real = column[1:] < lengths[:, None]
    made[:, :-1][real] = pairs.find(ids[:, :-1][real], ids[:, 1:][real])
    out, sizes = ids.copy(), lengths.copy()
    open_rows, left = np.arange(n), lengths.copy()
    while True:
        place = made.argmin(axis=1)
        low = made[np.arange(len(made)), place]
        go = low < NONE
        if not go.all():
            out[open_rows[~go]], sizes[open_rows[~go]] = ids[~go], left[~go]
            open_rows, left, ids, made, place, low = (x[go] for x in (open_rows, left, ids, made, place, low))
        if not len(open_rows):
            break
        row, behind = np.arange(len(ids)), column[:-1] > place[:, None]
        np.copyto(ids[:, :-1], ids[:, 1:].copy(), where=behind)
        np.copyto(made[:, :-1], made[:, 1:].copy(), where=behind)
        made[:, -1] = NONE
        ids[row, place] = low
        made[row, place] = NONE
        left -= 1
        after, before = np.flatnonzero(place + 1 < left), np.flatnonzero(place > 0)
        for who, shift in ((after, 0), (before, -1)):
            at = place[who] + shift
            made[who, at] = pairs.find(ids[who, at], ids[who, at + 1])
    return out[column < sizes[:, None]].astype(np.int64), sizes


def splitter(pattern: str) -> Callable[[bytes], list[list[bytes]]]:
    """Cut a text into pre-tokens. White space is meant by its Unicode property."""
    found = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    return lambda text: [[word.encode() for word in found.findall(text.decode())]]


def encode_bucket(ranks: Ranks) -> Callable:
    """Answer each word with its ids, four bytes each; a word that was met before is not encoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        for batch in batches:
            payloads = []
            for payload in batch.column("payload").to_pylist():
                rows = []
                for word in blocks.slices(payload):
                    ids = known.get(word)
                    if ids is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        ids = known[word] = np.array(encode_word(word, ranks), "<u4").tobytes()
                    rows.append(ids)
                payloads.append(blocks.pack_ragged(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("bucket"), pa.array(payloads, pa.binary()), batch.column("extra")],
                names=["block", "bucket", "payload", "extra"],
            )

    return run


def decode_ids(ids: np.ndarray, table: pa.Array) -> bytes:
    """The bytes of the tokens, one after the other."""
    found = table.take(pa.array(ids, pa.int64()))
    offsets = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, found.offset * 8)
    data = found.buffers()[2]
    return data[int(offsets[0]):int(offsets[-1])].to_pybytes() if data is not None and len(found) else b""


def _byte_table(table: list[bytes]) -> pa.Array:
    return pa.array(table, pa.large_binary())


def word_lengths(gathered: list) -> np.ndarray:
    """How many ids the answers of a block give to each of its words."""
    out = np.zeros(1 + max((int(own[-1]) for own, _, _ in gathered if len(own)), default=-1), np.int64)
    for own, payload, _ in gathered:
        out[own] = np.diff(blocks.unpack_ragged(payload)[0]) // 4
    return out


def documents_of(gathered: list, docs: list[dict], numbers: np.ndarray) -> Iterator[tuple[dict, np.ndarray]]:
    """Each document with its ids: the ids of its words in the order of their places."""
    size = 1 + max((int(own[-1]) for own, _, _ in gathered if len(own)), default=-1)
    flat, starts, counts, at = [], np.zeros(size, np.int64), np.zeros(size, np.int64), 0
    for own, payload, _ in gathered:
        offsets, data = blocks.unpack_ragged(payload)
        starts[own], counts[own] = at + offsets[:-1] // 4, np.diff(offsets) // 4
        flat.append(np.frombuffer(data, "<u4"))
        at += len(flat[-1])
    every = np.concatenate(flat) if flat else np.empty(0, np.uint32)
    for doc, own in blocks.doc_numbers(docs, numbers):
        if not len(own):
            yield doc, every[:0]
            continue
        long = counts[own]
        ends = np.cumsum(long)
        yield doc, every[np.repeat(starts[own] - (ends - long), long) + np.arange(ends[-1])]


def encode(spark: SparkSession, docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """Encode and decode every whole text of ``docs``.

    Columns ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas), ``decoded_sha256``
    (of the bytes that the ids decode to) and, if wanted, the ``ids``. A null text is an empty one
    and has no ids. Each row gives a row, repeated or without ``doc_id`` or not; an empty table gives
    none; further columns are ignored. A byte without a rank in the vocabulary is an error.
    """
    ranks = load_ranks(path)
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = whole_text(docs.withColumn("flag", F.lit(True)), "doc_id", "flag")
    cut = blocks.cut_into_blocks(rows, splitter(pattern), buckets)
    shared = spark.sparkContext.broadcast(ranks)
    table = spark.sparkContext.broadcast(token_table(ranks))
    kind, doc_type = docs.schema["doc_id"].dataType.simpleString(), to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encode_bucket(shared.value)(batches)

    def finish(own: list[dict], numbers: np.ndarray, gathered: list) -> pa.Table:
        tokens, out = _byte_table(table.value), {"doc_id": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        texts = [str(k) for k in range(len(tokens))]
        for doc, ids in documents_of(gathered, own, numbers):
            out["doc_id"].append(doc["doc_id"])
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(",".join([texts[k] for k in ids.tolist()]).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decode_ids(ids, tokens)).hexdigest())
            out["ids"].append(ids.astype(np.int32))
        if not with_ids:
            del out["ids"]
        kinds = {"doc_id": doc_type, "n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
        return pa.table({name: pa.array(values, kinds.get(name)) for name, values in out.items()})

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return blocks.assemble(cut, blocks.answers(cut, run, buckets), finish, schema)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and the ``bytes`` that its ``ids`` decode to; null ids give null."""
    spark = tokens.sparkSession
    table = spark.sparkContext.broadcast(token_table(load_ranks(path)))
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _byte_table(table.value)
        for batch in batches:
            found = [None if ids is None else decode_ids(np.array(ids, np.int64), held) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")
