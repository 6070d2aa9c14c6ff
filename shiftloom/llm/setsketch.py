"""Near copies by the similarity of word shingles, found with SetSketch registers.

Each shingle is the start of a Poisson process of points, each point at a random register; the
smallest point of a register over all shingles of a text is exponential, and equal for two texts
with the probability of their Jaccard similarity. Registers keep the exponent of that minimum,
cut off at both ends, so sketches of parts of a text merge by their maxima. Texts that agree on
all registers of a band meet. For a pair that met, the counts of registers at which one, the
other or neither is ahead give the likelihood of each similarity; pairs that the bound all but
excludes are dropped, and the others are compared on their full sets.

Equal sets are one node. All nodes of a band's bucket are compared with its leader, the node that most others
meet. Where a bucket still holds several classes, pairs without the leader are sought in what sets their nodes
apart from it: two nodes that are linked, not both of them to the leader, share more than about half
of one's differences, so its rarer half has one of them (``differences``). So a group of many near copies,
or of texts around a common passage, is not compared pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from .graph import components
from .texts import LOWER, byte_texts, forget, fresh, numbered, scratch, settle, whole_text, word_lists

WORDS, SEED = 2, 42
#: The least similarity, as a fraction.
SIMILARITY = (80, 100)
#: Bands and the registers of each. A pair at similarity 0.8 agrees on no band with a probability below 1e-7.
BANDS, DEEP = 40, 5
REGISTERS = BANDS * DEEP
#: Spacing of the registers' values, the point of value 1, and the largest value.
BASE, FIRST, LAST = 1.02, 32.0, (1 << 16) - 1
#: A pair is dropped where another similarity is more likely than the bound by this, in logarithms (six standard errors).
UNLIKELY = 18.0
#: Shingles that are sketched at a time, bytes of compressed texts in a batch, sets a task holds for the next pairs.
SLICE, BATCH, HELD = 1 << 18, 1 << 24, 256


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of all words if there are fewer."""
    parts = [
        np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in part), np.uint64, len(part))
        for part in word_lists(text, LOWER)
    ]
    each = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    size = min(words, len(each))
    if not size:
        return each
    found = np.full(len(each) - size + 1, size, np.uint64)
    for k in range(size):
        found = (found ^ each[k:len(each) - size + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return np.unique(found)


def alike(a: np.ndarray, b: np.ndarray, similarity: tuple[int, int] = SIMILARITY) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * similarity[1] >= (len(a) + len(b) - both) * similarity[0]


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def minima(found: np.ndarray, doc: np.ndarray, docs: int, low: np.ndarray | None = None) -> np.ndarray:
    """The smallest point at each register of each of ``docs`` sets; ``doc`` says whose shingle each is.

    A shingle's points are drawn in order until it has none below the largest minimum of its set.
    """
    low = np.full((docs, REGISTERS), np.inf) if low is None else low
    flat, at, drawn, width = low.reshape(-1), np.zeros(len(found)), 0, 1
    while len(found):
        steps = np.arange(drawn + 1, drawn + width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = _mixed(found[:, None] + steps)
        gaps = np.log((z & np.uint64((1 << 32) - 1)).astype(np.float64) + 0.5)
        points = at[:, None] + np.cumsum((32 * math.log(2) - gaps) / REGISTERS, axis=1)
        register = (((z >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(flat, (doc[:, None] * REGISTERS + register).ravel(), points.ravel())
        open_ = points[:, -1] < low.max(axis=1)[doc]
        found, doc, at, drawn = found[open_], doc[open_], points[open_, -1], drawn + width
        width = max(1, min(drawn, SLICE // max(len(found), 1)))
    return low


def registers(low: np.ndarray) -> np.ndarray:
    """Exponents of the minima: value ``k`` for those in ``(FIRST * BASE ** -k, FIRST * BASE ** (1 - k)]``, cut off at 0 and ``LAST``."""
    with np.errstate(divide="ignore"):
        value = np.floor(1 + np.log(FIRST / low) / math.log(BASE))
    return np.clip(value, 0, LAST).astype(np.uint16)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each set, a bounded number of shingles at a time; a large set is merged from parts."""
    out, start = np.zeros((len(sets), REGISTERS), np.uint16), 0
    while start < len(sets):
        stop, size = start, 0
        while stop < len(sets) and (stop == start or size + len(sets[stop]) <= SLICE):
            size, stop = size + len(sets[stop]), stop + 1
        if stop == start + 1:
            low = None
            for k in range(0, max(len(sets[start]), 1), SLICE):
                part = sets[start][k:k + SLICE]
                low = minima(part, np.zeros(len(part), np.int64), 1, low)
        else:
            sizes = [len(s) for s in sets[start:stop]]
            low = minima(np.concatenate(sets[start:stop]), np.repeat(np.arange(stop - start), sizes), stop - start)
        out[start:stop] = registers(low)
        start = stop
    return out


def bands(sketch: np.ndarray) -> np.ndarray:
    """A key for each band of each sketch, different for different bands."""
    whole = sketch.reshape(len(sketch), BANDS, DEEP).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), whole.shape[:2]).copy()
    for k in range(DEEP):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + whole[:, :, k])
    return key.view(np.int64)


def _ahead(share: np.ndarray) -> np.ndarray:
    """Probability that a register is ahead, from the share of the union's shingles that puts it ahead."""
    return -np.log1p(-np.clip(share, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


def likelihood(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, similarity: np.ndarray) -> np.ndarray:
    """Log-likelihood of each of the similarities (columns) for each pair (rows), jointly over all registers."""
    u = (size_a / (size_a + size_b))[:, None]
    over, under = _ahead(u - (1 - u) * similarity), _ahead(1 - u - u * similarity)
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - more - less
    tiny = 1e-12
    return more * np.log(over + tiny) + less * np.log(under + tiny) + same * np.log(np.clip(1 - over - under, 0, 1) + tiny)


def plausible(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """Pairs that may reach the similarity: their sizes allow it, and no lower one is far more likely."""
    bound = similarity[0] / similarity[1]
    fits = np.minimum(size_a, size_b) * similarity[1] >= np.maximum(size_a, size_b) * similarity[0]
    tried = likelihood(a, b, size_a, size_b, np.r_[bound, np.linspace(0, 1, 51)][None, :])
    best = tried.argmax(1)
    return fits & ((tried.max(1) - tried[:, 0] < UNLIKELY) | (np.r_[bound, np.linspace(0, 1, 51)][best] >= bound))


def _prints(rows: DataFrame, words: int) -> DataFrame:
    """Per row the ``node`` (equal for equal sets, null for an empty one), set size ``n``, ``sketch``, ``bands`` and ``packed`` text."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            start, sets, packed, size = 0, [], [], 0

            def flush() -> pa.RecordBatch:
                own = batch.slice(start, len(sets))
                sketch = sketches(sets)
                full = [len(s) > 0 for s in sets]
                node = [xxhash.xxh64_intdigest(s.tobytes(), SEED) if len(s) else 0 for s in sets]
                flat = pa.array(bands(sketch).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), flat)
                return pa.RecordBatch.from_arrays(
                    [
                        own.column("doc_id"), own.column("row"),
                        pa.array(np.array(node, np.uint64).view(np.int64), mask=~np.array(full, bool)),
                        pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sketch], pa.binary()),
                        lists, pa.array(packed, pa.binary()),
                    ],
                    names=["doc_id", "row", "node", "n", "sketch", "bands", "packed"],
                )

            for text in byte_texts(batch.column("text")):
                sets.append(shingles(text, words))
                packed.append(squeeze(text))
                size += len(packed[-1]) + 8 * len(sets[-1])
                if size > BATCH:
                    yield flush()
                    start, sets, packed, size = start + len(sets), [], [], 0
            yield flush()

    return rows.mapInArrow(run, f"doc_id {kind}, row bigint, node bigint, n bigint, sketch binary, bands array<bigint>, packed binary")


def _likely(pairs: DataFrame, bodies: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Those of the pairs (a, b) of nodes that their sketches do not exclude."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one = bodies.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("left"))
    two = bodies.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read(column: pa.Array) -> np.ndarray:
            return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)

        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                sizes = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
                good = plausible(read(batch.column("left")), read(batch.column("right")), *sizes, similarity)
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def _alike(pairs: DataFrame, bodies: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """Those of the pairs that reach the similarity on their full sets."""
    one = bodies.select(F.col("node").alias("a"), F.col("packed").alias("left"))
    two = bodies.select(F.col("node").alias("b"), F.col("packed").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held = zstandard.ZstdDecompressor().decompress, {}

        def known(node: int, text: pa.Scalar) -> np.ndarray:
            if node not in held:
                if len(held) >= HELD:
                    del held[next(iter(held))]
                held[node] = shingles(unpack(text.as_py()), words)
            return held[node]

        for batch in batches:
            a, b, left, right = map(batch.column, ("a", "b", "left", "right"))
            good = [
                alike(known(x, left[k]), known(y, right[k]), similarity)
                for k, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist()))
            ]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def _leaders(rows: DataFrame) -> DataFrame:
    """The rows (``key``, ``node``, ``size`` of the bucket) with the bucket's ``leader``: the node that meets most others over all bands."""
    met = rows.groupBy("node").agg(F.sum("size").alias("met"))
    tops = rows.join(met, "node").groupBy("key").agg(F.max_by("node", F.struct("met", F.xxhash64("node"))).alias("leader"))
    return rows.join(tops, "key").select("key", "node", "leader")


def _undecided(rows: DataFrame) -> DataFrame:
    """The rows of buckets (``key``) with nodes of several classes."""
    stats = rows.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("two"))
    return rows.join(stats.where("one <> two").select("key"), "key")


def differences(a: np.ndarray, leader: np.ndarray, similarity: tuple[int, int]) -> tuple[np.ndarray, int, int]:
    """What one of two sets has and the other has not, and how many of these, the rarest, to look for and to be found by.

    With ``x`` and ``y`` differences, sets ``a`` and ``b`` differ in ``x + y`` less twice those they have in
    common. Linked sets differ in at most ``r`` times their sizes' sum, ``b`` and the leader in more if they
    are not linked; so more than ``(x + r * (leader - a)) / 2`` are common, and ``a`` is found by any
    of the rest and one. ``b`` shares all its differences but a share of its size, and looks for the others
    and one. A set that is linked to the leader looks for none.
    """
    part, whole = similarity
    own = np.setxor1d(a, leader, assume_unique=True)
    x, near = len(own), whole - part
    least = (x * (whole + part) + near * (len(leader) - len(a))) // (2 * (whole + part)) + 1
    look = 0 if alike(a, leader, similarity) else min(x, len(a) * near // part + 1)
    return own, look, max(0, x - least + 1)


def _apart(nodes: DataFrame, bodies: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of nodes (``node``, ``root``, ``leader``) of different classes that share one of the rarer differences to a leader.

    Linked sets of ``x_a`` and ``x_b`` differences have so many in common that the first of these, the rarest, comes
    early in both; a pair that meets too late, or whose sizes alone exclude the link, is none. Of two sets
    that both look, the one of the smaller ``node`` does.
    """
    part, whole = similarity
    one = bodies.select("node", F.col("packed").alias("left"))
    two = bodies.select(F.col("node").alias("leader"), F.col("packed").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held = zstandard.ZstdDecompressor().decompress, {}
        for batch in batches:
            keys, looks, founds, ns, sets, size, start = batch.column("leader").to_pylist(), [], [], [], [], 0, 0
            for k, leader in enumerate(keys):
                if leader not in held:
                    if len(held) >= HELD:
                        held.clear()
                    held[leader] = shingles(unpack(batch.column("right")[k].as_py()), words)
                a = shingles(unpack(batch.column("left")[k].as_py()), words)
                own, look, found = differences(a, held[leader], similarity)
                sets.append(own.view(np.int64))
                ns.append(len(a))
                looks.append(look)
                founds.append(found)
                size += len(own)
                if size >= SLICE or k + 1 == len(keys):
                    rows = batch.slice(start, len(sets)).select(["node", "root", "leader"])
                    edges = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                    each = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(sets)))
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, *(pa.array(c, pa.int64()) for c in (looks, founds, ns)), each],
                        names=["node", "root", "leader", "look", "found", "n", "own"],
                    )
                    looks, founds, ns, sets, size, start = [], [], [], [], 0, k + 1

    schema = "node bigint, root bigint, leader bigint, look bigint, found bigint, n bigint, own array<bigint>"
    apart = settle(nodes.join(one, "node").join(two, "leader").select("node", "root", "leader", "left", "right").mapInArrow(run, schema))
    each = apart.select("node", "root", "leader", "look", "found", "n", F.size("own").alias("x"), F.explode("own").alias("item"))
    common = each.groupBy("leader", "item").agg(F.count("*").alias("f")).where("f > 1")
    own = Window.partitionBy("leader", "node")
    # Those that no other node has come first; they are counted, not kept.
    place = F.col("x") - F.count("*").over(own) + F.row_number().over(own.orderBy("f", "item"))
    ranked = settle(each.join(common, ["leader", "item"]).withColumn("place", place).where("place <= greatest(look, found)"))

    def side(name: str) -> list:
        return ["leader", "item", F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("root", "n", "x", "place", "look"))]

    looking, there = ranked.where("place <= look").select(side("a")), ranked.where("place <= found").select(side("b"))
    later = F.least(F.expr("x_a - place_a"), F.expr("x_b - place_b")) + 1
    enough = 2 * (whole + part) * later >= (whole + part) * F.expr("x_a + x_b") - (whole - part) * F.expr("n_a + n_b")
    fits = F.least("n_a", "n_b") * whole >= F.greatest("n_a", "n_b") * part
    once = F.expr("a < b OR a <> b AND look_b = 0")
    return looking.join(there, ["leader", "item"]).where(once & F.expr("root_a <> root_b") & fits & enough).select("a", "b")


def links(nodes: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """``node`` and ``root``: classes of the ``nodes`` (node, n, sketch, bands, packed) under all links."""
    with scratch() as made:
        keys = nodes.select("node", F.explode("bands").alias("key"))
        shared = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        rows = settle(_leaders(settle(keys.join(shared, "key"))))
        bodies = settle(nodes.join(rows.select("node").distinct(), "node", "left_semi").drop("bands"))

        def compared(pairs: DataFrame) -> DataFrame:
            likely = settle(_likely(pairs.where("a <> b"), bodies, similarity))
            return settle(_alike(likely, bodies, words, similarity))

        found = compared(rows.select(F.col("node").alias("a"), F.col("leader").alias("b")))
        roots = settle(components(found))
        classed = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        open_ = settle(_undecided(classed).select("node", "root", "leader").distinct())
        rest = compared(_apart(open_, bodies, words, similarity))
        whole = components(found.unionByName(rest))
    whole = settle(whole)
    forget(nodes.sparkSession, made)
    return whole


def near_copies(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """Each row of ``docs`` (``doc_id``, ``row`` as stored) with ``n_shingles``, ``component_id`` and the ``best`` row of its group.

    ``component_id`` is the smallest ``doc_id`` that links lead to, ``best`` the first stored row. Texts
    of fewer than ``words`` words are one shingle; null texts and texts without words have none and
    are linked with nothing; equal texts and repeated rows are linked; a null ``doc_id`` is not the
    smallest of a group unless all are null; an empty table gives no rows; further columns are ignored.
    """
    rows = whole_text(numbered(docs.select("doc_id", "text"), "row"), "doc_id", "row")
    prints = settle(_prints(rows, words))
    firsts = settle(prints.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"), F.min("row").alias("first")))
    nodes = prints.join(firsts.select(F.col("first").alias("row")), "row", "left_semi").select("node", "n", "sketch", "bands", "packed")
    roots = links(nodes, words, similarity)
    whole = firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = whole.groupBy("root").agg(F.min("low").alias("component_id"), F.min("first").alias("best"))
    named = whole.join(groups, "root").select("node", "component_id", "best")
    linked = prints.select("doc_id", "row", "node", F.col("n").alias("n_shingles")).join(named, "node", "left")
    alone = F.col("n_shingles") == 0
    return linked.select(
        "doc_id", "row", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("row")).otherwise(F.col("best")).alias("best"),
    )


def without_copies(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """The first stored row of each group of ``near_copies``, with all the columns of ``docs``."""
    place = fresh(docs, "row")
    kept = near_copies(docs, words, similarity).where("row = best").select(F.col("row").alias(place))
    return numbered(docs, place).join(kept, place, "left_semi").drop(place)


def report(docs: DataFrame) -> DataFrame:
    found = near_copies(docs)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


#: All pairs that share a shingle, compared on their sets; then the smallest id that links lead to.
SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) END) AS s
  FROM words
), items AS MATERIALIZED (
  SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.low AS component_id, s.doc_id = r.low AS kept
FROM sets s JOIN (SELECT doc_id, min(other) AS low FROM reached GROUP BY doc_id) r USING (doc_id)
"""
