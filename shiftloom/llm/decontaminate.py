"""Benchmark decontamination with an Aho-Corasick automaton over normalised words.

Every window of ``WINDOW`` consecutive words of a test item (the whole item if it is shorter) is a
pattern. Patterns are sequences of word numbers, so a document is read once and a match ends at
a word; merged matches are mapped back to code points of the original text.

The automaton is sent to the executors while it holds ``MAX_PATTERNS`` patterns at most. A larger
benchmark is cut into that many automata as it takes, each of bounded size, and the matches of a
document are put together afterwards; the result is the same.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .texts import ALNUM_LOWER, byte_texts, fresh, numbered, whole_text, word_lists

WINDOW = 10
MAX_PATTERNS = 200_000
SPANS = "array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>"


class Matcher:
    """The automaton over the windows of some items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]]):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, words in items:
            codes = [self.numbers.setdefault(word, len(self.numbers) + 1) for word in words]
            for at in range(max(1, len(codes) - WINDOW + 1)):
                owners[tuple(codes[at:at + WINDOW])] |= {item} - {None}
        self.longest = max(map(len, owners), default=0)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, found in owners.items():
            self.automaton.add_word(pattern, (len(pattern), sorted(found)))
        if owners:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Word count, merged spans of hit words (first and last), and the items."""
        total, spans, found, kept = 0, [], set(), []
        for words in word_lists(text, ALNUM_LOWER):
            codes = kept + [self.numbers.get(word, 0) for word in words]
            begin = total - len(kept)
            if self.longest and any(codes):
                for end, (size, owners) in self.automaton.iter(tuple(codes)):
                    first, last = begin + end - size + 1, begin + end
                    found.update(owners)
                    while spans and first <= spans[-1][1] + 1:
                        before = spans.pop()
                        first, last = min(first, before[0]), max(last, before[1])
                    spans.append((first, last))
            total += len(words)
            kept = codes[max(0, len(codes) - self.longest + 1):] if self.longest else []
        return total, spans, found


def code_points(text: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """The spans of words with the code points that they cover in the original text."""
    if not spans:
        return []
    raw = np.frombuffer(text, np.uint8)
    inside = np.frombuffer(text.translate(ALNUM_LOWER), np.uint8) != 0x20
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    return [
        {"first": a, "last": b, "start": int(points[starts[a]]), "end": int(points[ends[b]])} for a, b in spans
    ]


def _item_words(items: DataFrame) -> list[tuple[str | None, list[bytes]]]:
    rows = whole_text(items.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct(), "item_id")
    cut = [(r.item_id, r.text.encode().translate(ALNUM_LOWER).split()) for r in rows.toLocalIterator()]
    return sorted(((i, w) for i, w in cut if w), key=lambda x: (x[0] or "", x[1]))


def _groups(items: list[tuple[str | None, list[bytes]]]) -> list[list[tuple[str | None, list[bytes]]]]:
    groups, size = [[]], 0
    for item, words in items:
        here = max(1, len(words) - WINDOW + 1)
        if groups[-1] and size + here > MAX_PATTERNS:
            groups.append([])
            size = 0
        groups[-1].append((item, words))
        size += here
    return groups


def _scanner(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            counts, spans, items = [], [], []
            for text in byte_texts(batch.column("text")):
                total, hit, found = matcher.scan(text)
                counts.append(total)
                spans.append(code_points(text, hit))
                items.append(sorted(found))
            kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("first", "last", "start", "end")]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row"), pa.array(counts, pa.int64()), pa.array(spans, kind),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["doc_id", "row", "n_words", "spans", "items"],
            )

    return scan


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``row`` (see ``numbered``), ``n_words``, merged ``spans``, ``items``.

    A span has its first and last word (from 0) and its code points in the original text (end
    excluded). A null or empty text has no words; an item without words has no window; the windows
    of an item without ``item_id`` count, but name no item; equal windows name all their items.
    Repeated rows get equal results; an empty table gives no rows.
    """
    rows = whole_text(numbered(docs.select("doc_id", "text"), "row"), "doc_id", "row")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row bigint, n_words bigint, spans {SPANS}, items array<string>"
    context = docs.sparkSession.sparkContext
    parts = [rows.mapInArrow(_scanner(context.broadcast(group)), schema) for group in _groups(_item_words(items))]
    if len(parts) == 1:
        return parts[0]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return found.select("doc_id", "row", "n_words", "spans", "items").withColumn("spans", F.expr("""
        aggregate(spans, slice(spans, 1, 0), (done, s) -> CASE
            WHEN size(done) = 0 OR s.first > element_at(done, -1).last + 1 THEN concat(done, array(s))
            WHEN s.last <= element_at(done, -1).last THEN done
            ELSE concat(slice(done, 1, size(done) - 1), array(named_struct('first', element_at(done, -1).first,
                'last', s.last, 'start', element_at(done, -1).start, 'end', s.end))) END)
    """))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = contamination(docs, items)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no window with an item, with all their columns."""
    place = fresh(docs, "row")
    hit = contamination(docs, items).where(F.size("spans") > 0).select(F.col("row").alias(place))
    return numbered(docs, place).join(hit, place, "left_anti").drop(place)


WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH items AS (
    SELECT item_id, {WORDS} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS size, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), docs AS (
    SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents
), places AS (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs), (SELECT DISTINCT size FROM windows)
    WHERE i + size - 1 <= len(w)
), matches AS (
    SELECT doc_id, i, p.size AS size, item_id FROM places p JOIN windows v ON p.words = v.words AND p.size = v.size
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM matches) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM matches) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items,
    sha256(coalesce(f.ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN found f USING (doc_id)
"""
