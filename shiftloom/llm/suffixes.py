"""Repeated 400-byte strings by prefix-free parsing.

A rolling hash over ``TRIGGER`` bytes cuts every text into phrases at places that depend on the
bytes alone, so equal passages are cut alike. A window of ``LENGTH`` bytes is then a suffix of a
dictionary phrase followed by a prefix of the parse after it: its first phrase end (anchor) parts
it in two. Windows with one anchor form a bundle, which stands for a stretch of the corpus order:

* bundles are classed by a part of their windows (the parse prefix right of the anchor, or the
  phrase suffix left of it if that is the longer part); a class of one bundle has no repeated window;
* equal bundles have equal dictionary suffixes and equal parse prefixes: all their windows repeat;
* only where different bundles share a class are the pairs of dictionary suffix and parse
  prefix compared window by window, by a hash of both together: in one task where a class has
  few bundles, else by dealing the windows out by name.

Two suffixes that agree on ``LENGTH`` bytes are neighbours in the corpus order, so naming classes of
equal prefixes finds what comparing neighbours of the sorted order would, without one global
sort. Windows without an anchor lie inside one phrase; there, denser triggers give anchors to
most of them. Those that have none even so are bundles of their own; as such text is mostly a short
period over and over, the ones that repeat within a text are settled on the spot, and only one of
each is compared with other texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from . import spans
from .texts import numbered, settle, utf8, whole_text

LENGTH = 400
TRIGGER = 16
#: One in 2**6 places is a phrase end.
PERIOD_BITS = 6
#: Inside a phrase longer than a window, one in 2**3.
DENSE_BITS = 3
HALF = LENGTH // 2
#: Bytes that are hashed in one go; the windows of a longer text are looked at in several stretches.
STRETCH = 1 << 20
#: Different bundles of a class that one task compares; their bytes are a few hundred each.
CLASS = 256
PRIME = np.uint64((1 << 31) - 1)
_RNG = np.random.default_rng(20240229)
_VALUES = _RNG.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_RESIDUES = _RNG.integers(1, int(PRIME), 256, np.uint64)
_BASE, _BASE2 = 0x9E3779B97F4A7C15, 48271
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, ...]:
    """Powers of both bases and of their inverses, modulo 2**64 and modulo the prime."""
    size = STRETCH + LENGTH + 1
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        row = np.full(size, base, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    for base in (_BASE2, pow(_BASE2, -1, int(PRIME))):
        row = np.ones(1, np.uint64)
        while len(row) < size:
            step = np.uint64(pow(base, len(row), int(PRIME)))
            row = np.r_[row, row * step % PRIME]
        out.append(row[:size])
    return tuple(out)


class Hashes:
    """Hashes of any span of some bytes that do not depend on where the span stands."""

    def __init__(self, data: np.ndarray):
        up, self.down, up2, self.down2 = _powers()
        n = len(data)
        self.sums, self.sums2 = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[data] * up[:n], out=self.sums[1:])
        np.cumsum(_RESIDUES[data] * up2[:n] % PRIME, out=self.sums2[1:])

    def first(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start] * _MIX + (end - start).astype(np.uint64)

    def second(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums2[end] - self.sums2[start]) % PRIME * self.down2[start] % PRIME


def bundles(data: np.ndarray, bits: int | None = None) -> tuple[np.ndarray, ...]:
    """Class, two hashes, first and last window start of each bundle of windows of ``data``.

    A run of windows that repeat within ``data`` is given twice, so that it is its own copy.
    """
    last, bits = len(data) - LENGTH, PERIOD_BITS if bits is None else bits
    if last < 0:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    hashes = Hashes(data)
    starts = np.arange(len(data) - TRIGGER + 1)
    anchors = np.flatnonzero(hashes.first(starts, starts + TRIGGER) >> np.uint64(64 - bits) == 0) + TRIGGER
    before = np.r_[TRIGGER - 1, anchors[:-1]][: len(anchors)]
    low = np.maximum(np.maximum(before - TRIGGER + 1, anchors - LENGTH), 0)
    high = np.minimum(anchors - TRIGGER, last)
    near, far = np.maximum(low, anchors - HALF), np.minimum(high, anchors - HALF - 1)
    right, left = near <= high, low <= far
    # Windows without an anchor lie between two that have one.
    edges_low = np.maximum(np.r_[0, anchors - TRIGGER + 1], 0)
    edges_high = np.minimum(np.r_[anchors - LENGTH - 1, last], last)
    a, b = anchors[right], anchors[left]
    kinds = [
        (hashes.first(a, a + HALF), near[right], high[right]),
        (hashes.first(b - HALF, b) ^ _MIX, low[left], far[left]),
    ]
    if bits > DENSE_BITS:
        parts = [
            (low, bundles(data[low:high + LENGTH], DENSE_BITS))
            for low, high in zip(edges_low.tolist(), edges_high.tolist()) if low <= high
        ]
    else:
        kinds += _without_anchor(hashes, edges_low, edges_high)
        parts = []
    key, lo, hi = (np.concatenate(x) for x in zip(*kinds))
    own = key.view(np.int64), hashes.first(lo, hi + LENGTH).view(np.int64), hashes.second(lo, hi + LENGTH).view(np.int64), lo, hi
    if not parts:
        return own
    found = [(k, one, two, lo + at, hi + at) for at, (k, one, two, lo, hi) in parts]
    return tuple(np.concatenate(x) for x in zip(own, *found))


def _without_anchor(hashes: Hashes, low: np.ndarray, high: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Class and first and last window start: runs that repeat here, twice each, and one of each window."""
    counts = np.maximum(high - low + 1, 0)
    inner = np.repeat(low - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
    alike = hashes.first(inner, inner + LENGTH) * _MIX + hashes.second(inner, inner + LENGTH)
    _, one_of_each, place, often = np.unique(alike, return_index=True, return_inverse=True, return_counts=True)
    again = inner[often[place] > 1]
    edge = np.flatnonzero(np.diff(again, prepend=-2) > 1)
    first, last = (again[edge], again[np.r_[edge[1:] - 1, len(again) - 1]]) if len(again) else (again, again)
    first, last = np.repeat(first, 2), np.repeat(last, 2)
    inner = inner[one_of_each]
    return [
        (hashes.first(first, last + LENGTH) ^ _MIX << np.uint64(1), first, last),
        (hashes.first(inner, inner + LENGTH) + _MIX, inner, inner),
    ]


def stretches(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of bounded size in which each window start is whole exactly once."""
    for start in range(0, max(1, len(data) - LENGTH + 1), STRETCH):
        yield start, data[start:start + STRETCH + LENGTH - 1]


def _bundle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = utf8(batch.column("text"))
        rows, found, size = batch.column("row").to_pylist(), [], 0
        for row, a, b in zip(rows, offsets.tolist(), offsets[1:].tolist()):
            for start, piece in stretches(data[a:b]):
                key, one, two, lo, hi = bundles(piece)
                found.append((np.full(len(key), row, np.int64), key, one, two, lo + start, hi + start))
                size += len(key)
            if size > 100_000:
                yield _bundle_batch(found)
                found, size = [], 0
        yield _bundle_batch(found)


def _bundle_batch(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    row, key, one, two, lo, hi = (np.concatenate(x) for x in zip(*found)) if found else [np.empty(0, np.int64)] * 6
    return spans.flat(row, key=key, one=one, two=two, lo=lo.astype(np.int64), hi=hi.astype(np.int64))


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed bundles, from the first byte of the first window to the last of the last."""
    names = ("key", "lo", "hi", "alone", "many")
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    for batch in batches:
        out = []
        for row, text, wanted in zip(
            batch.column("row").to_pylist(), spans.unpacked(batch.column("packed")), batch.column("wanted").to_pylist()
        ):
            out += [(row, *(x[n] for n in names), text[x["lo"]:x["hi"] + LENGTH]) for x in wanted]
        columns = list(zip(*out)) if out else [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, [pa.int64(), *kinds, pa.binary()])], names=["row", *names, "body"]
        )


def _windows(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    hashes, at = Hashes(np.frombuffer(body, np.uint8)), np.arange(len(body) - LENGTH + 1)
    return hashes.first(at, at + LENGTH), hashes.second(at, at + LENGTH)


def _settle_class(table: pa.Table) -> pa.Table:
    """The windows of a class's only copies that its other bundles also have."""
    rows = table.select(["row", "lo", "alone", "body"]).to_pylist()
    named = [_windows(row["body"]) for row in rows]
    pairs = np.stack([np.concatenate(x) for x in zip(*named)], axis=1)
    _, place, often = np.unique(pairs, axis=0, return_inverse=True, return_counts=True)
    again, at, out = often[place.ravel()] > 1, 0, []
    for row, (names, _) in zip(rows, named):
        if row["alone"]:
            found = spans.union((p, p + 1) for p in np.flatnonzero(again[at:at + len(names)]).tolist())
            out += [(row["row"], row["lo"] + a, row["lo"] + b - 1 + LENGTH) for a, b in found]
        at += len(names)
    columns = list(zip(*out)) if out else [[]] * 3
    return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(("row", "first", "end"), columns)})


def _named(batch: pa.RecordBatch) -> tuple[np.ndarray, list[tuple[int, int, bool, int]], np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes, row, start and whether alone of every window of some bundles; the bundles (row, start,
    alone, windows); and of the distinct names: the first place (one that is alone, if any), each window's name, how often."""
    rows, parts = [], []
    for row, lo, alone, body in zip(*(batch.column(c).to_pylist() for c in ("row", "lo", "alone", "body"))):
        one, two = _windows(body)
        n = len(one)
        rows.append((row, lo, alone, n))
        parts.append(np.stack([
            one.view(np.int64), two.view(np.int64), np.full(n, row), lo + np.arange(n), np.full(n, int(alone)),
        ], axis=1))
    every = np.concatenate(parts)
    order = np.lexsort((1 - every[:, 4], every[:, 1], every[:, 0]))
    ranked = every[order]
    new = np.r_[True, (ranked[1:, :2] != ranked[:-1, :2]).any(axis=1)]
    name = np.empty(len(every), np.int64)
    name[order] = np.cumsum(new) - 1
    return every, rows, order[np.flatnonzero(new)], name, np.bincount(name)


def _span_batch(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["row", "first", "end"])


def _repeated_nearby(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of windows that occur twice within one batch of bundles."""
    for batch in batches:
        if batch.num_rows:
            _, rows, _, name, often = _named(batch)
            again, at, found = often[name] > 1, 0, []
            for row, lo, alone, n in rows:
                if alone:
                    runs = spans.union((p, p + 1) for p in np.flatnonzero(again[at:at + n]).tolist())
                    found += [(row, lo + x, lo + y - 1 + LENGTH) for x, y in runs]
                at += n
            yield _span_batch(found)


def _dealt(buckets: int):
    """Each distinct window of a batch once, with whether it occurred there more than once, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            every, _, first, _, often = _named(batch)
            kept = np.concatenate([every[first], np.minimum(often, 2)[:, None]], axis=1)
            bucket = (kept[:, 0].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            for b in np.unique(bucket).tolist():
                payload = zstandard.compress(np.ascontiguousarray(kept[bucket == b].T).tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([payload], pa.binary())], names=["bucket", "payload"])

    return run


def _counted(table: pa.Table) -> pa.Table:
    """The windows of a bucket that occur more than once over all batches."""
    parts = [np.frombuffer(zstandard.decompress(p), np.int64).reshape(6, -1) for p in table.column("payload").to_pylist()]
    every = np.concatenate(parts, axis=1).T
    every = every[np.lexsort((every[:, 1], every[:, 0]))]
    new = np.r_[True, (every[1:, :2] != every[:-1, :2]).any(axis=1)]
    name = np.cumsum(new) - 1
    again = every[(np.bincount(name, every[:, 5])[name] > 1) & (every[:, 4] == 1)]
    columns = (again[:, 2], again[:, 3], again[:, 3] + LENGTH)
    return pa.table({n: pa.array(np.ascontiguousarray(c)) for n, c in zip(("row", "first", "end"), columns)})


def repeated(docs: DataFrame) -> DataFrame:
    """``row`` (see ``numbered``) and spans ``first`` to ``end`` (excluded) that repeated strings cover.

    A string repeats if it starts anywhere else in the table, also inside the same text; matches
    never cross texts. Null counts as empty; texts of less than ``LENGTH`` bytes have no window;
    repeated rows are texts of their own; an empty table gives no rows.
    """
    rows = whole_text(numbered(docs.select("text"), "row"), "row")
    parsed = settle(rows.mapInArrow(_bundle_rows, "row bigint, key bigint, one bigint, two bigint, lo bigint, hi bigint"))
    shared = parsed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = settle(parsed.join(shared, "key"))
    place = F.struct("row", "lo", "hi")
    bundle = settle(found.groupBy("key", "one", "two").agg(F.count("*").alias("n"), F.min(place).alias("place")))
    copies = bundle.where("n > 1").select("key", "one", "two")
    whole = found.join(copies, ["key", "one", "two"], "left_semi").select(
        "row", F.col("lo").alias("first"), (F.col("hi") + LENGTH).alias("end")
    )
    mixed = bundle.groupBy("key").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    mixed = mixed.where("kinds > 1 and least = 1").select("key", (F.col("kinds") > CLASS).alias("many"))
    wanted = bundle.join(mixed, "key").select("place.*", "key", (F.col("n") == 1).alias("alone"), "many")
    wanted = wanted.groupBy("row").agg(F.collect_list(F.struct("key", "lo", "hi", "alone", "many")).alias("wanted"))
    cut = spans.packed(rows).join(wanted, "row").select("row", "packed", "wanted")
    bodies = settle(cut.mapInArrow(
        _cut_out, "row bigint, key bigint, lo bigint, hi bigint, alone boolean, many boolean, body binary"
    ))
    few = bodies.where("not many").groupBy("key").applyInArrow(_settle_class, "row bigint, first bigint, end bigint")
    # A class of many bundles is not gathered: its windows are dealt out by name, each batch sending
    # a name once, and those that repeat within a batch are known there.
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = bodies.where("many").select("row", "lo", "alone", "body")
    nearby = many.mapInArrow(_repeated_nearby, "row bigint, first bigint, end bigint")
    dealt = many.mapInArrow(_dealt(buckets), "bucket int, payload binary")
    apart = dealt.groupBy("bucket").applyInArrow(_counted, "row bigint, first bigint, end bigint")
    single = few.unionByName(nearby).unionByName(apart)
    return whole.unionByName(single)


def report(docs: DataFrame) -> DataFrame:
    return spans.report(docs, spans.gathered(repeated(docs)))
