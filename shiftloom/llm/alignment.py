"""Links between the tokens that two tokenizers cut one text into.

Token by byte is a matrix of zeros and ones for each tokenizer, kept in compressed rows. The row
products A times B transposed give the tokens that overlap; where an overlap shares neither
token with the one before it, both tokenizers end a token and a group ends. Token by group is a
matrix as well, and its products, with occurrences of an id in a group counted, give the ids
that are linked in each document and how often. How many documents link a pair of ids is
counted by Spark over the whole corpus and joined back to blocks of documents.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .blocks import pack, unpack
from .texts import settle, utf8, whole_text

# The pattern of byte-level pre-tokens, and how sentence pieces write a space and a byte.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
MARK, BYTE = "▁", re.compile(r"<0x([0-9A-F]{2})>")
#: Bytes of text worked on at a time, links (ids and document) of a block, and distinct words that a worker remembers.
PIECE, BLOCK, REMEMBERED = 1 << 18, 1 << 20, 1 << 18


class Csr:
    """A sparse matrix in compressed rows: row ``i`` has the columns ``indices[indptr[i]:indptr[i + 1]]``."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, width: int):
        self.indptr, self.indices, self.data, self.width = indptr, indices, data, width

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, data: np.ndarray, height: int, width: int) -> Csr:
        """From entries sorted by row."""
        return cls(np.r_[0, np.cumsum(np.bincount(rows, minlength=height))], columns, data, width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        ordered = not np.any(self.indices[1:] < self.indices[:-1])
        order = np.arange(len(self.indices)) if ordered else np.argsort(self.indices, kind="stable")
        return Csr.of(self.indices[order], self.rows()[order], self.data[order], self.width, len(self.indptr) - 1)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...``: as many of each start as its count."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the values of each."""
    if not len(keys):
        return keys, values
    if np.any(keys[1:] < keys[:-1]):
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(values, first)


def product(a: Csr, b: Csr) -> Csr:
    """Row by row: row ``i`` is the sum of the rows ``k`` of ``b``, each times ``a[i, k]``."""
    starts = b.indptr[a.indices]
    counts = b.indptr[a.indices + 1] - starts
    taken = spread(starts, counts)
    keys = np.repeat(a.rows(), counts) * b.width + b.indices[taken]
    keys, data = summed(keys, np.repeat(a.data, counts) * b.data[taken])
    return Csr.of(keys // max(b.width, 1), keys % max(b.width, 1), data, len(a.indptr) - 1, b.width)


def token_bytes(lengths: np.ndarray) -> Csr:
    """Token by byte, for tokens that follow each other."""
    indptr = np.r_[0, np.cumsum(lengths)]
    return Csr(indptr, np.arange(indptr[-1]), np.ones(indptr[-1], np.int64), int(indptr[-1]))


def overlaps(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Csr:
    """The bytes that each token of A shares with each of B."""
    return product(token_bytes(a_lengths), token_bytes(b_lengths).transposed())


def groups(links: Csr) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, from their overlaps: neither token of the first link of a group is in an earlier one."""
    rows, columns = links.rows(), links.indices
    group = np.cumsum(np.r_[False, (rows[1:] != rows[:-1]) & (columns[1:] != columns[:-1])]) if len(rows) else rows
    a, b = np.zeros(len(links.indptr) - 1, np.int64), np.zeros(links.width, np.int64)
    a[rows], b[columns] = group, group
    return a, b


def _slices(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Cut both token sequences into parts of about ``PIECE`` bytes, at ends that they share."""
    a_ends, b_ends = np.cumsum(a_lengths), np.cumsum(b_lengths)
    ends = a_ends[np.isin(a_ends, b_ends, assume_unique=True, kind="sort")]
    at, i, j = 0, 0, 0
    while i < len(a_ends):
        end = ends[min(np.searchsorted(ends, at + PIECE), len(ends) - 1)]
        to_i, to_j = int(np.searchsorted(a_ends, end)) + 1, int(np.searchsorted(b_ends, end)) + 1
        yield i, to_i, j, to_j
        at, i, j = int(end), to_i, to_j


def grouped(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of each token of A and of B, and how many tokens of B each of A overlaps; bytes of a part at a time."""
    a, b, met, total = [], [], [], 0
    for i, to_i, j, to_j in _slices(a_lengths, b_lengths):
        links = overlaps(a_lengths[i:to_i], b_lengths[j:to_j])
        one, two = groups(links)
        a.append(one + total)
        b.append(two + total)
        met.append(np.diff(links.indptr))
        total = int(a[-1][-1]) + 1
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b, met))


def shared(a_ids: np.ndarray, a_group: np.ndarray, b_ids: np.ndarray, b_group: np.ndarray, doc: np.ndarray) -> tuple:
    """Linked ids: document, id of A, id of B and how many occurrences of them share a group.

    ``doc`` has the document of each group. Rows of the matrices are ids within a document, so that
    equal ids of a group are one entry, however many tokens the group has.
    """
    def incidence(ids: np.ndarray, group: np.ndarray) -> tuple[Csr, np.ndarray]:
        wide = int(ids.max()) + 1 if len(ids) else 1
        rows, row = np.unique(doc[group] * wide + ids, return_inverse=True)
        keys, counts = summed(row * max(len(doc), 1) + group, np.ones(len(group), np.int64))
        return Csr.of(keys // max(len(doc), 1), keys % max(len(doc), 1), counts, len(rows), len(doc)), rows

    a, a_rows = incidence(a_ids, a_group)
    b, b_rows = incidence(b_ids, b_group)
    links = product(a, b.transposed())
    a_wide, b_wide = (int(x.max()) + 1 if len(x) else 1 for x in (a_ids, b_ids))
    one, two = a_rows[links.rows()], b_rows[links.indices]
    return one // a_wide, one % a_wide, two % b_wide, links.data


def _letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Side:
    """One tokenizer: a text is put together from its words, which a worker remembers, from one task to the next too."""

    def __init__(self, cut: Callable[[str], list[str]], encode: Callable[[list[str]], list[list[int]]], table: list[bytes]):
        self.cut, self.encode = cut, encode
        self.table = pa.array(table, pa.large_binary())
        self.lengths = np.fromiter(map(len, table), np.int64, len(table))
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids, self.offsets = np.empty(0, np.int64), np.zeros(1, np.int64)

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        if len(self.numbers) > REMEMBERED:
            self.clear()
        known = len(self.numbers)
        words = [np.fromiter(map(self.numbers.__getitem__, part), np.int64, len(part)) for part in map(self.cut, texts)]
        fresh = list(itertools.islice(self.numbers, known, None))
        if fresh:
            found = self.encode(fresh)
            counts = np.fromiter(map(len, found), np.int64, len(found))
            every = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(counts.sum()))
            self.ids = np.concatenate([self.ids, every])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(counts)])
        flat = np.concatenate(words) if words else np.empty(0, np.int64)
        counts = np.diff(self.offsets)[flat]
        edges = np.r_[0, np.cumsum(counts)]
        at = np.r_[0, np.cumsum([len(w) for w in words], dtype=np.int64)]
        return self.ids[spread(self.offsets[flat], counts)], np.diff(edges[at])

    def bytes_of(self, ids: np.ndarray) -> bytes:
        found = self.table.take(pa.array(ids))
        _, offsets, data = found.buffers()
        ends = np.frombuffer(offsets, np.int64, len(found) + 1, found.offset * 8)
        return data[int(ends[0]):int(ends[-1])].to_pybytes() if len(found) and data is not None else b""


def byte_level(path: str) -> Side:
    """A byte-level tokenizer file. Its pre-tokens never merge with each other."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for a task, and one arena of memory
    model = tokenizers.Tokenizer.from_file(path)
    model.encode_special_tokens = True
    model.no_padding()
    model.no_truncation()
    letters, found = _letters(), regex.compile(PATTERN)
    table = [b""] * model.get_vocab_size(with_added_tokens=True)
    for piece, number in model.get_vocab(with_added_tokens=True).items():
        table[number] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()

    def encode(words: list[str]) -> list[list[int]]:
        return [e.ids for e in model.encode_batch_fast(words, add_special_tokens=False)]

    return Side(lambda text: found.findall(" " + text), encode, table)


def pieces(path: str) -> Side:
    """A sentence-piece model. If no piece has a space after another character, words with the spaces before them never merge."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    table = [
        bytes([int(m[1], 16)]) if model.is_byte(k) and (m := BYTE.fullmatch(name)) else name.replace(MARK, " ").encode()
        for k, name in enumerate(names)
    ]
    apart = not any(MARK in name.lstrip(MARK) for name in names)

    # Each word loses the first of the spaces before it, which encoding puts back.
    def cut(text: str) -> list[str]:
        if not apart:
            return [text]
        if "  " not in text and text[:1] != " " and text[-1:] != " ":
            return text.split(" ")
        return [part[1:] for part in re.findall(r" +[^ ]*", " " + text)]

    def encode(words: list[str]) -> list[list[int]]:
        # A space at the end of a text is a word without letters; encoding would put no space before it.
        return [ids if word else alone for word, ids in zip(words, model.encode(words, num_threads=1))]

    alone = [model.piece_to_id(MARK)]

    return Side(cut, encode, table)


@lru_cache(maxsize=2)
def _sides(a_path: str, b_path: str) -> tuple[Side, Side]:
    return byte_level(a_path), pieces(b_path)


@lru_cache(maxsize=2)
def _decimals(size: int, last: str) -> pa.Array:
    return pa.array([f"{k}{end}".encode() for end in (",", last) for k in range(size)], pa.large_binary())


def _digests(a_ids, b_ids, a_group, b_group, tokens_before: np.ndarray) -> list[str]:
    """For each document the digest of ``a1,a2|b1;a3|b2,b3``."""
    def last(group: np.ndarray) -> np.ndarray:
        return np.r_[group[1:] != group[:-1], True] if len(group) else np.empty(0, bool)

    a_size, b_size = (int(x.max()) + 1 if len(x) else 1 for x in (a_ids, b_ids))
    a_texts, b_texts = _decimals(1 << max(16, a_size.bit_length()), "|"), _decimals(1 << max(16, b_size.bit_length()), ";")
    numbers = np.empty(len(a_ids) + len(b_ids), np.int64)
    a_at = np.arange(len(a_ids)) + np.searchsorted(b_group, a_group, "left")
    b_at = np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, "right")
    numbers[a_at] = a_ids + last(a_group) * (len(a_texts) // 2)
    numbers[b_at] = len(a_texts) + b_ids + last(b_group) * (len(b_texts) // 2)
    both = pa.concat_arrays([a_texts, b_texts]) if len(numbers) else a_texts
    found = both.take(pa.array(numbers))
    _, offsets, data = found.buffers()
    ends = np.frombuffer(offsets, np.int64, len(found) + 1, found.offset * 8)[tokens_before].tolist()
    view = memoryview(data) if data is not None else b""
    return [hashlib.sha256(view[x:max(x, y - 1)]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:])]


def align(texts: list[str], a: Side, b: Side) -> dict[str, np.ndarray | list]:
    """Both tokenizations of some texts: counts for each text, and its linked ids (``doc``, ``a``, ``b``, ``times``)."""
    (a_ids, a_count), (b_ids, b_count) = a.ids_of(texts), b.ids_of(texts)
    a_edge, b_edge = np.r_[0, np.cumsum(a_count)], np.r_[0, np.cumsum(b_count)]
    good = np.array([
        bool(text) and a.bytes_of(a_ids[a_edge[k]:a_edge[k + 1]]) == (whole := b" " + text.encode())
        and b.bytes_of(b_ids[b_edge[k]:b_edge[k + 1]]) == whole
        for k, text in enumerate(texts)
    ], bool)
    a_ids, b_ids = a_ids[np.repeat(good, a_count)], b_ids[np.repeat(good, b_count)]
    a_count, b_count = a_count * good, b_count * good
    # Tokens of all texts follow each other; both end a token where a text ends, so no group crosses texts.
    a_group, b_group, met = grouped(a.lengths[a_ids], b.lengths[b_ids])
    total = int(a_group[-1]) + 1 if len(a_group) else 0
    doc = np.empty(total, np.int64)
    doc[a_group] = np.repeat(np.arange(len(texts)), a_count)
    a_edge, b_edge = np.r_[0, np.cumsum(a_count)], np.r_[0, np.cumsum(b_count)]
    n_overlaps = np.diff(np.r_[0, np.cumsum(met)][a_edge])
    of, one, two, times = shared(a_ids, a_group, b_ids, b_group, doc)
    return {
        "n_a": a_count, "n_b": b_count, "n_groups": np.bincount(doc, minlength=len(texts)), "n_overlaps": n_overlaps,
        "n_links": np.bincount(of, weights=times, minlength=len(texts)).astype(np.int64),
        "groups_sha256": _digests(a_ids, b_ids, a_group, b_group, a_edge + b_edge),
        "doc": of, "a": one, "b": two, "times": times,
        "a_ids": a_ids, "b_ids": b_ids, "a_group": a_group, "b_group": b_group,
    }


COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


def _pieces_of(texts: Iterator[tuple[object, str]]) -> Iterator[tuple[list, list[str]]]:
    keys, held, size = [], [], 0
    for key, text in texts:
        keys.append(key)
        held.append(text)
        size += len(text)
        if size >= PIECE:
            yield keys, held
            keys, held, size = [], [], 0
    if keys:
        yield keys, held


def _blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Blocks of documents: their counts, their linked ids by number, and for each number how many of them have it."""
    kind = docs.schema["doc_id"].dataType
    doc = "struct<" + "doc_id:" + kind.simpleString() + "".join(f",{c}:bigint" for c in COUNTS) + ",groups_sha256:string,links:bigint>"
    schema = f"block bigint, docs array<{doc}>, numbers binary, times binary, pairs array<struct<a:int,b:int,docs:bigint>>"
    fields = [("doc_id", to_arrow_type(kind)), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string()), ("links", pa.int64())]
    pair = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64())])
    shape = pa.schema([
        ("block", pa.int64()), ("docs", pa.list_(pa.struct(fields))), ("numbers", pa.binary()), ("times", pa.binary()),
        ("pairs", pa.list_(pair)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _sides(a_path, b_path)
        block, held, keys, times, size = TaskContext.get().partitionId() << 32, [], [], [], 0

        def made() -> pa.RecordBatch:
            nonlocal block, held, keys, times, size
            pairs, numbers, docs_of = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            a_ids, b_ids = pairs >> 32, pairs & 0xFFFFFFFF
            found = pa.StructArray.from_arrays([pa.array(a_ids, pa.int32()), pa.array(b_ids, pa.int32()), pa.array(docs_of, pa.int64())], fields=list(pair))
            row = [
                pa.array([block]), pa.array([held], shape.field("docs").type), pa.array([pack(numbers)], pa.binary()),
                pa.array([pack(np.concatenate(times))], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found).cast(shape.field("pairs").type),
            ]
            block, held, keys, times, size = block + 1, [], [], [], 0
            return pa.RecordBatch.from_arrays(row, schema=shape)

        def texts() -> Iterator[tuple[object, str]]:
            for batch in batches:
                offsets, data = utf8(batch.column("text"))
                view, column = memoryview(data), batch.column("doc_id")
                for k, (x, y) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                    yield column[k].as_py(), bytes(view[x:y]).decode()

        for ids, part in _pieces_of(texts()):
            found = align(part, a, b)
            links = np.bincount(found["doc"], minlength=len(part)).tolist()
            counts = zip(*(found[c].tolist() for c in COUNTS))
            for key, own, digest, n in zip(ids, counts, found["groups_sha256"], links):
                held.append({"doc_id": key, **dict(zip(COUNTS, own)), "groups_sha256": digest, "links": n})
            keys.append(found["a"] << 32 | found["b"])
            times.append(found["times"])
            size += len(keys[-1])
            if size >= BLOCK:
                yield made()
        if held:
            yield made()

    return settle(whole_text(docs, "doc_id").mapInArrow(run, schema))


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each row of ``docs`` (``doc_id``, ``text``) with the links between its tokens.

    Columns: ``doc_id``; ``n_a`` and ``n_b`` tokens; ``n_groups``; ``n_links`` (pairs of tokens that share a
    group); ``n_overlaps`` (pairs that share a byte); ``n_best`` (links whose ids are linked in as
    many documents as any ids with the same id of A); ``count_sum`` (documents that link the ids, over all
    links); ``groups_sha256``. A text that is null, empty or changed by a tokenizer has zeros and ''. Each row
    gives a row, and repeated rows count as documents; an empty table gives none; further columns are ignored.
    """
    cut = _blocks(docs, a_path, b_path)
    own = cut.select("block", F.posexplode("pairs").alias("number", "pair")).select("block", "number", "pair.a", "pair.b", "pair.docs")
    counts = own.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    counts = settle(counts.withColumn("most", F.max("count").over(Window.partitionBy("a"))))
    scored = own.join(counts, ["a", "b"]).select(
        F.col("block").alias("of"), "number", "count", (F.col("count") == F.col("most")).alias("best")
    )
    kind, doc_type = docs.schema["doc_id"].dataType.simpleString(), to_arrow_type(docs.schema["doc_id"].dataType)
    names = ["doc_id", *COUNTS, "groups_sha256"]

    def finish(block: pa.Table, found: pa.Table) -> pa.Table:
        size = found.num_rows
        place = found.column("number").to_numpy()
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        count[place], best[place] = found.column("count").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
        docs = block.column("docs").combine_chunks().flatten()
        numbers, times = (unpack(block.column(c)[0].as_py()).astype(np.int64) for c in ("numbers", "times"))
        edges = np.r_[0, np.cumsum(docs.field("links").to_numpy())]
        totals = (np.r_[0, np.cumsum(times * x[numbers])] for x in (best, count))
        n_best, count_sum = (np.diff(x[edges]) for x in totals)
        out = {name: docs.field(name) for name in names} | {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        return pa.table(out).cast(pa.schema([(n, doc_type if n == "doc_id" else pa.string() if n == "groups_sha256" else pa.int64()) for n in out]))

    schema = f"doc_id {kind}" + "".join(f", {c} bigint" for c in COUNTS) + ", groups_sha256 string, n_best bigint, count_sum bigint"
    own = cut.select("block", "docs", "numbers", "times").groupBy("block")
    return own.cogroup(scored.groupBy("of")).applyInArrow(finish, schema)


def token_links(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The links themselves, one row for each pair of overlapping tokens: ``doc_id``, places and ids of both, shared ``bytes`` and the ``group``.

    Texts without tokens (see ``alignments``) give no rows.
    """
    kind = docs.schema["doc_id"].dataType
    names = ["a_place", "b_place", "a_id", "b_id", "bytes", "group"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _sides(a_path, b_path)
        for batch in batches:
            for k, text in enumerate(batch.column("text").to_pylist()):
                found = align([text], a, b)
                links = overlaps(a.lengths[found["a_ids"]], b.lengths[found["b_ids"]])
                rows, columns = links.rows(), links.indices
                each = [rows, columns, found["a_ids"][rows], found["b_ids"][columns], links.data, found["a_group"][rows]]
                key = pa.array([batch.column("doc_id")[k].as_py()] * len(rows), to_arrow_type(kind))
                yield pa.RecordBatch.from_arrays([key, *map(pa.array, each)], names=["doc_id", *names])

    return whole_text(docs, "doc_id").mapInArrow(run, f"doc_id {kind.simpleString()}, " + ", ".join(f"{n} bigint" for n in names))
