"""Document fingerprints by I-Match.

The lexicon holds the terms whose document frequency lies in a band. A document's distinct lexicon
terms are sorted, and one signature is hashed over those in each of several randomised subsets
of the lexicon. Subsets differ in size, so that short and long documents both have subsets that
take a few of their terms. The likeness of two fingerprints is the share of equal signatures
among the subsets in which either document has terms.

The lexicon is broadcast. Terms in at least a share ``LEAST`` of all documents are no more than the
mean number of distinct terms of a document divided by ``LEAST``, however many documents there
are; where that is above ``MAX_LEXICON``, the lower edge of the band rises until it is not.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .texts import ALNUM_LOWER, byte_texts, numbered, settle, whole_text, word_lists

LEAST, MOST, MAX_LEXICON = 0.001, 0.1, 1_000_000
#: Each subset takes one in 2**bits terms.
SUBSETS = [bits for bits in range(2, 12) for _ in range(6)]
#: Terms that a task counts before it passes its counts on.
HELD = 400_000
EMPTY = "0" * 8
_PLACES = np.arange(len(SUBSETS), dtype=np.uint64)[:, None]


def distinct_terms(text: bytes) -> set[bytes]:
    found: set[bytes] = set()
    for words in word_lists(text, ALNUM_LOWER):
        found.update(words)
    return found


def _hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter = Counter()

    def rows() -> pa.RecordBatch:
        counts = np.fromiter(found.values(), np.int64, len(found))
        out = pa.RecordBatch.from_arrays([pa.array(_hashes(found).view(np.int64)), pa.array(counts)], names=["term", "n"])
        found.clear()
        return out

    for batch in batches:
        for text in byte_texts(batch.column("text")):
            found.update(distinct_terms(text))
            if len(found) > HELD:
                yield rows()
    if found:
        yield rows()


def lexicon(docs: DataFrame) -> np.ndarray:
    """Hashes of the terms in the band, ascending. Frequencies are counted over all documents."""
    total = docs.count()
    counted = whole_text(docs).mapInArrow(_term_counts, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    band = settle(counted.where((F.col("n") >= LEAST * total) & (F.col("n") <= max(2, MOST * total))))
    if band.count() > MAX_LEXICON:
        # The smallest frequency that at most so many terms exceed; a histogram of the band decides.
        above, edge = 0, 0
        for r in band.groupBy("n").agg(F.count("*").alias("terms")).orderBy(F.desc("n")).limit(MAX_LEXICON + 1).toLocalIterator():
            above += r.terms
            if above > MAX_LEXICON:
                edge = r.n
                break
        band = band.where(F.col("n") > edge)
    found = band.select("term").toArrow().column("term").to_numpy()
    return np.sort(found.view(np.uint64))


def subset_masks(lexicon_terms: np.ndarray) -> np.ndarray:
    """For each term one bit per subset."""
    masks = np.zeros(len(lexicon_terms), np.uint64)
    for k, bits in enumerate(SUBSETS):
        mixed = (lexicon_terms ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
        masks |= (mixed >> np.uint64(64 - bits) == 0).astype(np.uint64) << np.uint64(k)
    return masks


def fingerprint(text: bytes, known: np.ndarray, masks: np.ndarray) -> str:
    """A digest of all lexicon terms (of all terms if there is none of the lexicon), then the signatures."""
    own = np.sort(_hashes(distinct_terms(text)))
    if len(known):
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        at = at[known[at] == own]
    else:
        at = np.empty(0, np.int64)
    inside = known[at]
    parts = [f"{xxhash.xxh64_intdigest((inside if len(at) else own).tobytes()):016x}"]
    subset, term = np.nonzero(masks[at] >> _PLACES & np.uint64(1))
    chosen = inside[term].tobytes()
    ends = (8 * np.cumsum(np.bincount(subset, minlength=len(SUBSETS)))).tolist()
    for a, b in zip([0, *ends], ends):
        parts.append(f"{xxhash.xxh32_intdigest(chosen[a:b]) | 1:08x}" if b > a else EMPTY)
    return "".join(parts)


def likeness(a: str, b: str) -> float:
    """Share of equal signatures where either is not empty; without any, whether the digests agree."""
    pairs = [(a[k:k + 8], b[k:k + 8]) for k in range(16, len(a), 8)]
    judged = [x == y for x, y in pairs if x != EMPTY or y != EMPTY]
    return sum(judged) / len(judged) if judged else float(a[:16] == b[:16])


def edited_text(text: str, following: str) -> str:
    """The last half of the code points gives way to the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _placed(edges: np.ndarray):
    """Add the range of ids that a row belongs to, and what orders rows of one id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            part = np.searchsorted(edges, ids, side="left").astype(np.int32)
            ties = np.fromiter(map(xxhash.xxh64_intdigest, byte_texts(batch.column("text"))), np.uint64, batch.num_rows)
            columns = [batch.column("doc_id"), pa.array(part), pa.array(ties.view(np.int64)), batch.column("row"), batch.column("text")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "tie", "row", "text"])

    return run


def followed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` in partitions of whole id ranges, sorted by descending ``doc_id``, each range ending in the
    document that follows it (``tail``); the last range ends in the first document of all.

    Rows of one ``doc_id`` are ordered by a hash of the text, then by row; those without one come last.
    Only the bounds of the ranges and one place per range pass through the driver.
    """
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)]
    edges = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), F.lit(10 * parts))).first()[0]
    edges = np.array(sorted(set(edges or [])), np.int64)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = whole_text(numbered(docs.select("doc_id", "text"), "row"), "doc_id", "row")
    placed = rows.mapInArrow(_placed(edges), f"doc_id {kind}, part int, tie bigint, row bigint, text string")
    place = F.struct(F.col("doc_id"), F.col("tie"), F.col("row"))
    firsts = {r.part: r.place.row for r in placed.groupBy("part").agg(F.max(place).alias("place")).collect()}
    order = sorted(firsts, reverse=True)
    # The first row of a range also ends the range above it; the first of all ends the lowest.
    above = {firsts[part]: order[k - 1] for k, part in enumerate(order)}
    if not above:
        return placed.withColumn("tail", F.lit(False))
    table = spark.createDataFrame([(row, part) for row, part in above.items()], "row bigint, above int")
    # One row per range: as many as there are partitions.
    tails = placed.join(F.broadcast(table), "row").select("doc_id", F.col("above").alias("part"), "tie", "row", "text", F.lit(True).alias("tail"))
    every = placed.withColumn("tail", F.lit(False)).unionByName(tails)
    return every.repartition(parts, "part").sortWithinPartitions("part", "tail", F.desc("doc_id"), F.desc("tie"), F.desc("row"))


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and likenesses to that and to the next one.

    Null counts as an empty text; all texts without terms have one fingerprint. A document alone in
    its table is its own next one. Repeated rows are documents of their own; an empty table gives
    no rows; further columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    known = lexicon(docs)
    shared = spark.sparkContext.broadcast((known, subset_masks(known)))
    kind = docs.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, masks = shared.value
        before = None
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        for batch in batches:
            out: list[tuple] = []
            texts = byte_texts(batch.column("text"))
            for doc, part, tail, body in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "tail")), texts):
                own = (doc, part, body.decode(), fingerprint(body, held, masks))
                if before is not None and before[1] == part:
                    edited = edited_text(before[2], own[2]).encode()
                    mark = fingerprint(edited, held, masks)
                    out.append((
                        before[0], len(before[2]), hashlib.sha256(edited).hexdigest(), before[3], mark,
                        likeness(before[3], mark), likeness(before[3], own[3]),
                    ))
                before = None if tail else own
            kinds = [arrow, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    schema = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return followed(spark, docs).select("doc_id", "part", "tail", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, {schema}")
