"""Repair of the order of roles in conversations by the cheapest edits.

A conversation is a sequence of symbols (the kind of role, and what is wrong with the row). Each
symbol is a min-plus matrix over four states: nothing yet, after the system row, after a user row,
after an assistant row. Equal consecutive symbols are one run, and a run is the product of cached
powers of two of its matrix, so costs are known without visiting every row; only the choice of
edits visits them again. Matrices are associative, so a conversation of any length is cut into
segments of bounded size wherever Spark's ranges of the sorted rows end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .texts import numbered, settle

# Costs of the edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Kinds of fault; blank and duplicate rows have to go.
SOUND, CUT, BLANK, DUPLICATE = range(4)
#: States: nothing yet, after a system row, after a user row, after an assistant row.
STATES = range(4)
#: The state that a user or assistant row leads to, which of the two it has to be, and kept rows by initial.
NEXT, WANTED = (2, 2, 3, 2), ("user", "user", "assistant", "user")
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
GOOD_PAIRS = ("su", "ua", "au")
FAR = 1 << 60
#: Rows and characters of a segment.
ROWS, CHARS = 4096, 1 << 22
BLANKS = " \t\n\x0b\x0c\r"

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[s][k] + b[k][t] for k in STATES) for t in STATES) for s in STATES)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(a[s][k] + v[k] for k in STATES) for s in STATES)


IDENTITY: Matrix = tuple(tuple(0 if s == t else FAR for t in STATES) for s in STATES)
_INSERTED = tuple(tuple(0 if s == t else INSERT if NEXT[s] == t else FAR for t in STATES) for s in STATES)
#: Any number of inserted rows, and the cost from each state to an end that is allowed.
INSERTS = product(product(_INSERTED, _INSERTED), _INSERTED)
END: Vector = tuple(min(INSERTS[s][0], INSERTS[s][3]) for s in STATES)


def symbol(role: str, fault: int) -> str:
    """One character for what the costs of a row depend on."""
    if fault >= BLANK:
        return "x"
    kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return kind.upper() if fault == CUT else kind


def _kept(mark: str, state: int) -> int | None:
    return KEPT[state].get(mark.lower())


@cache
def power(mark: str, k: int) -> Matrix:
    """The matrix of ``2 ** k`` rows of one symbol."""
    if k:
        half = power(mark, k - 1)
        return product(half, half)
    row = [[FAR] * 4 for _ in STATES]
    for s in STATES:
        row[s][s] = DELETE
        if mark != "x":
            extra = TRUNCATED if mark.isupper() else 0
            row[s][NEXT[s]] = REROLE + extra
            if (kept := _kept(mark, s)) is not None:
                row[s][kept] = extra
    return product(INSERTS, tuple(map(tuple, row)))


def runs(marks: str) -> list[tuple[str, int]]:
    return [(mark, sum(1 for _ in part)) for mark, part in groupby(marks)]


def advance(mark: str, count: int, v: Vector) -> Vector:
    """Costs before a run from those after it."""
    for k in range(count.bit_length()):
        if count >> k & 1:
            v = applied(power(mark, k), v)
    return v


def matrix(marks: str) -> Matrix:
    whole = IDENTITY
    for mark, count in runs(marks):
        for k in range(count.bit_length()):
            if count >> k & 1:
                whole = product(whole, power(mark, k))
    return whole


@cache
def _step(mark: str, shape: Vector) -> tuple[Vector, int]:
    v = applied(power(mark, 0), shape)
    low = min(v)
    return tuple(x - low for x in v), low


def unroll(marks: str, after: Vector, state: int) -> tuple[str, int, int]:
    """The first by letter of the cheapest edits from ``state``, their cost, and the state they lead to.

    ``after`` has the costs of what follows, from each state. Costs at the ends of runs come from
    the powers; inside a run they are stepped from its end, once for each row.
    """
    parts, ends = runs(marks), [after]
    for mark, count in reversed(parts):
        ends.append(advance(mark, count, ends[-1]))
    ends.reverse()
    audit, cost = [], 0
    for (mark, count), end in zip(parts, ends[1:]):
        low = min(end)
        shape, known = tuple(x - low for x in end), []
        for _ in range(count):  # costs before and after each row, both less the same
            before, down = _step(mark, shape)
            known.append((tuple(x + down for x in before), shape))
            shape = before
        extra = TRUNCATED if mark.isupper() else 0
        for before, behind in reversed(known):
            while True:
                togo = before[state]
                if DELETE + behind[state] == togo:
                    audit.append("D")
                    cost += DELETE
                    break
                if INSERT + before[NEXT[state]] == togo:
                    audit.append("I")
                    cost, state = cost + INSERT, NEXT[state]
                    continue
                kept = _kept(mark, state)
                if kept is not None and extra + behind[kept] == togo:
                    audit.append("K")
                    cost, state = cost + extra, kept
                else:
                    audit.append("R")
                    cost, state = cost + REROLE + extra, NEXT[state]
                break
    return "".join(audit), cost, state


def closing(state: int) -> str:
    """Insertions after the last row."""
    return "I" * (END[state] // INSERT)


def edited(audit: str, lines: Iterable[tuple[str, str]], state: int) -> Iterator[tuple[str, str]]:
    """The rows that the edits leave, as role and text."""
    rows = iter(lines)
    for edit in audit:
        role, text = (WANTED[state], "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "R":
            role = WANTED[state]
        state = KEPT[state][role[:1]]
        yield role, text


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, the ``row`` and ``copy`` that order ties, and whether the row is ``gone``.

    What happens to a row follows from the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops it, 1 empties
    its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats it, 4 makes its role ``user``. Nulls are one space.
    """
    rows = numbered(rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text"), "row")

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    what = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(what == 1, "").when(what == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    role = F.when(what == 4, "user").otherwise(shown("role"))
    copies = F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "row", F.explode(copies).alias("copy"), (what == 0).alias("gone"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``: the first that applies of blank, duplicate (role and text occur earlier) and truncated.

    Which rows are repeats is settled on digests: only those of texts that occur twice are ordered.
    """
    solid = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(solid == "", BLANK).when(F.substring(solid, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT)
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = rows.withColumns({"fault": F.when(~F.col("gone"), fault), "digest": F.when(~F.col("gone") & (fault != BLANK), digest)})
    rows = rows.withColumn("place", F.struct(F.col("turn").isNotNull().alias("dated"), "turn", "row", "copy"))
    key = F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id"), "digest")
    rows = rows.withColumn("same", F.when(F.col("digest").isNotNull(), F.sha2(F.to_json(key), 256)))
    keyed = rows.where("same IS NOT NULL")
    twice = keyed.groupBy("same").agg(F.count("*").alias("n")).where("n > 1").select("same")
    first = settle(keyed.join(twice, "same", "left_semi").groupBy("same").agg(F.min("place").alias("first")))
    rows = rows.join(first, "same", "left")
    fault = F.when(F.col("place") > F.col("first"), DUPLICATE).otherwise(F.col("fault"))
    return rows.select("conv_id", "turn", "role", "text", "row", "copy", "gone", fault.alias("fault"))


class Segment:
    """Consecutive rows of one conversation: what later ones need to know of them."""

    SCHEMA = (
        "rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, "
        "first_turn bigint, last_turn bigint, first_role string, last_role string"
    )

    def __init__(self):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first_role = self.last_role = None
        self.marks, self.lines, self.chars = [], [], 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == CUT
        self._follow(turn, turn, role[:1], role[:1], 1, turn is not None)
        self.marks.append(symbol(role, fault))
        self.lines.append((role, text))
        self.chars += len(role) + len(text) + 8

    def _follow(self, first_turn, last_turn, first_role, last_role, rows, turns) -> None:
        if self.rows and self.last_role + first_role not in GOOD_PAIRS:
            self.illegal += 1
        self.turns += turns - (first_turn is not None and first_turn == self.last_turn)
        if not self.rows:
            self.first_role = first_role
        self.rows, self.last_role = self.rows + rows, last_role
        self.first_turn = first_turn if self.first_turn is None else self.first_turn
        self.last_turn = self.last_turn if last_turn is None else last_turn

    def join(self, later: dict) -> None:
        """Take up the counts of the segment that follows."""
        if later["rows"]:
            for name in ("blank", "duplicate", "truncated", "illegal"):
                setattr(self, name, getattr(self, name) + later[name])
            self._follow(*(later[k] for k in ("first_turn", "last_turn", "first_role", "last_role", "rows", "turns")))

    def counts(self) -> dict:
        return {part.split()[0]: getattr(self, part.split()[0]) for part in self.SCHEMA.split(", ")}

    @property
    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0


REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "repaired_sha256 string")
LINES = "lines array<struct<role:string,text:string>>"


class _Digest:
    """The digest of rows as ``role:text`` lines; never holds more than one of them."""

    def __init__(self):
        self.hash, self.started = hashlib.sha256(), False

    def add(self, lines: Iterable[tuple[str, str]]) -> None:
        for role, text in lines:
            self.hash.update(b"\n" * self.started + f"{role}:{text}".encode())
            self.started = True


def _report(counts: Segment, cost: int, audit: str, digest: _Digest) -> dict:
    return {
        "gaps": counts.gaps, "blank": counts.blank, "duplicate": counts.duplicate, "truncated": counts.truncated,
        "illegal": counts.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest.hash.hexdigest(),
    }


def _arrow(schema: str, kind: pa.DataType, others: Iterable[pa.Field] = ()) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [pa.field(name, kinds[what]) for name, what in (part.split() for part in schema.split(", "))]
    return pa.schema([pa.field("conv_id", kind), *fields, *others])


def _sorted_rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):  # a few rows at a time as Python objects
            part = batch.slice(start, 256)
            yield from zip(*(part.column(name).to_pylist() for name in names))


def _segments(rows: DataFrame, closed_rows: bool) -> DataFrame:
    """Whole conversations, reported, and the segments of those that meet an end of a range or are long."""
    conv, kind = rows.schema["conv_id"].dataType.simpleString(), to_arrow_type(rows.schema["conv_id"].dataType)
    place = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("row"), F.col("copy")]
    places = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(places, *place).sortWithinPartitions(*place)
    out = f"closed boolean, at bigint, {Segment.SCHEMA}, gaps bigint, cost bigint, audit string, repaired_sha256 string, marks string"
    line = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    costs = pa.list_(pa.int64())
    shape = _arrow(out, kind, [pa.field("lines", line), pa.field("matrix", costs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, held, size = TaskContext.get().partitionId() << 32, True, [], 0
        conv_id, own, whole, started = None, Segment(), True, False

        def made(segment: Segment, closed: bool) -> dict:
            row = {"conv_id": conv_id, "closed": closed, "at": at, **segment.counts()}
            marks = "".join(segment.marks)
            if not closed:
                flat = [x for part in matrix(marks) for x in part]
                return row | {"marks": marks, "lines": [{"role": r, "text": t} for r, t in segment.lines], "matrix": flat}
            audit, cost, state = unroll(marks, END, 0)
            audit += closing(state)
            digest, left = _Digest(), list(edited(audit, segment.lines, 0))
            digest.add(left)
            row |= _report(segment, cost + END[state], audit, digest)
            return row | ({"lines": [{"role": r, "text": t} for r, t in left]} if closed_rows else {})

        for key, turn, role, text, fault, gone in _sorted_rows(batches, ("conv_id", "turn", "role", "text", "fault", "gone")):
            if started and key != conv_id or own.rows >= ROWS or own.chars >= CHARS:
                same = key == conv_id
                held.append(made(own, whole and not first and not same))
                at, size = at + 1, size + own.chars
                first, whole, own = first and same, not same, Segment()
            if len(held) >= 4096 or size >= CHARS:
                yield pa.RecordBatch.from_pylist(held, shape)
                held, size = [], 0
            conv_id, started = key, True
            if not gone:
                own.add(turn, role, text, fault)
        if started:
            held.append(made(own, False))
        yield pa.RecordBatch.from_pylist(held, shape)

    return settle(ordered.mapInArrow(run, f"conv_id {conv}, {out}, {LINES}, matrix array<bigint>"))


def _togo(segments: DataFrame) -> DataFrame:
    """For each open segment (``at``) the cost of all that follows it, by state.

    Works on one matrix for each segment, a four-thousandth of the rows of a long conversation.
    """

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        found, v = [], END
        for flat in reversed(group.column("matrix").to_pylist()):
            found.append(v)
            v = applied(tuple(tuple(flat[4 * s:4 * s + 4]) for s in STATES), v)
        return pa.table({"at": group.column("at"), "togo": pa.array(found[::-1], pa.list_(pa.int64()))})

    return segments.groupBy("conv_id").applyInArrow(run, "at bigint, togo array<bigint>")


def _joined(segments: DataFrame, as_rows: bool) -> DataFrame:
    """Reports, or repaired rows, of the conversations with open segments, segment by segment in their order."""
    conv, kind = segments.schema["conv_id"].dataType.simpleString(), to_arrow_type(segments.schema["conv_id"].dataType)
    segments = segments.where("NOT closed")
    rows = segments.join(_togo(segments.select("conv_id", "at", "matrix")), "at")
    ordered = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "at")
    names = tuple(part.split()[0] for part in Segment.SCHEMA.split(", "))
    shape = _arrow("place bigint, role string, text string" if as_rows else REPORT, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                for k in range(batch.num_rows):  # one segment at a time as Python objects
                    yield tuple(batch.column(name)[k].as_py() for name in ("conv_id", "marks", "lines", "togo", *names))

        for conv_id, group in groupby(each(), key=lambda r: r[0]):
            counts, digest, audit, cost, state, place = Segment(), _Digest(), [], 0, 0, 0

            def take(lines: Iterable[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
                nonlocal place
                if as_rows:
                    found = [{"conv_id": conv_id, "place": place + k, "role": r, "text": t} for k, (r, t) in enumerate(lines)]
                    place += len(found)
                    yield pa.RecordBatch.from_pylist(found, shape)
                else:
                    digest.add(lines)

            for _, marks, lines, togo, *stats in group:
                counts.join(dict(zip(names, stats)))
                piece, paid, then = unroll(marks, tuple(togo), state)
                yield from take(edited(piece, ((x["role"], x["text"]) for x in lines), state))
                audit.append(piece)
                cost, state = cost + paid, then
            audit.append(closing(state))
            yield from take(edited(audit[-1], (), state))
            if not as_rows:
                row = {"conv_id": conv_id, **_report(counts, cost + END[state], "".join(audit), digest)}
                yield pa.RecordBatch.from_pylist([row], shape)

    schema = "place bigint, role string, text string" if as_rows else REPORT
    return ordered.mapInArrow(run, f"conv_id {conv}, {schema}")


def _named(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def repair(rows: DataFrame) -> DataFrame:
    """One row for each ``conv_id``: its faults, the cost and letters of the cheapest edits, the digest of the result.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and may have ``row``, ``copy`` (order of equal turns) and
    ``gone`` (rows that only show that the conversation exists). Turns are ordered with null first, then as stored.
    A null ``conv_id`` is a conversation of its own; null roles and texts must have been replaced (``damaged``
    does); a conversation without rows has zeros and the digest of nothing; an empty table gives none;
    further columns are ignored. A conversation may hold any share of the rows: only its matrices, one
    for 4,096 rows, meet in one group, and its texts pass one task in order, as its digest requires.
    """
    segments = _segments(with_faults(rows), False)
    names = _named(REPORT)
    return segments.where("closed").select("conv_id", *names).unionByName(_joined(segments, False).select("conv_id", *names))


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations as rows: ``conv_id``, ``place`` from 0, ``role``, ``text``; for ``rows`` see ``repair``."""
    segments = _segments(with_faults(rows), True)
    closed = segments.where("closed").select("conv_id", F.posexplode("lines").alias("place", "line"))
    closed = closed.select("conv_id", F.col("place").cast("bigint").alias("place"), "line.role", "line.text")
    return closed.unionByName(_joined(segments, True))


def report(rows: DataFrame) -> DataFrame:
    return repair(damaged(rows))
