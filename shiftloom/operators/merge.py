"""Merging a source into a target table, as DataFrames in and out.

A merge reads the target twice. The first pass joins it to one source row per key and writes
down, per target row, its key and what happens to it, with the source row where there is a
change; new versions, new keys (the source anti-joined to the keys that were met) and the
change feed all come from that narrow table. The second pass is the state itself, and is only
run if it is used. Only the target side of the join can have a hot key, and a left join lets
Spark split that side or send the other one to every task when it measures small; a full outer
join allows neither. A source that is costly to compute should be settled first; the loads in
``plans`` do so.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date, datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions import clock, text
from ..sources.tables import settle
from .keys import assign_keys, highest_key

CREATED, MODIFIED = "CreatedDate", "ModifiedDate"
AUDIT = (CREATED, MODIFIED)
HISTORY = ("IsCurrent", "EffectiveStartTime", "EffectiveEndTime", "IsDeleted", *AUDIT)


@dataclass(frozen=True)
class KeyRules:
    """How source rows find target rows.

    ``duplicates`` says what to do when several source rows share the key of a
    matched target row: ``raise`` fails the job, ``first`` keeps the smallest row,
    ``unique`` promises there are none and saves the grouping.
    """

    columns: tuple[str, ...]
    duplicates: str = "raise"
    null_safe: bool = False
    fold_case: bool = True
    surrogate: str | None = None
    digest: tuple[str, ...] = ()


@dataclass(frozen=True)
class MergeResult:
    """``existing`` are the target's rows after the merge, ``inserted`` the new rows."""

    existing: DataFrame
    inserted: DataFrame
    changes: DataFrame

    @property
    def state(self) -> DataFrame:
        return self.existing.unionByName(self.inserted)

    def settled(self) -> MergeResult:
        """The same with both parts of the state written to the shared folder, to be read again."""
        return replace(self, existing=settle(self.existing), inserted=settle(self.inserted))


@dataclass(frozen=True)
class HistoryRules:
    """Settings of a type-2 merge.

    ``change``: ``all`` tracked columns must differ, ``any`` one, or ``always``.
    ``first_start`` dates a key's first version, the load time if None.
    ``first_nulls`` stay NULL on a first version; ``constants`` are set on all new rows.
    """

    tracked: tuple[str, ...] = ()
    change: str = "all"
    null_safe: bool = False
    only_current: bool = True
    first_start: date | None = None
    first_nulls: tuple[str, ...] = ()
    constants: dict[str, object] = field(default_factory=dict)
    stamp_new: bool = False
    stamp_deleted: bool = False
    undelete: bool = False


@dataclass(frozen=True)
class VersionRules:
    """Settings of a versioned fact: which columns open, close and identify a version."""

    start: str
    end: str
    value: str
    stamp_new: bool = True
    only_open: bool = False
    reopen: bool = False


def _comparable(df: DataFrame, column: str, fold_case: bool) -> Column:
    col = F.col(column)
    is_text = isinstance(df.schema[column].dataType, StringType)
    return text.fold(col) if fold_case and is_text else col


def _with_keys(df: DataFrame, rules: KeyRules, mark: str) -> DataFrame:
    names = {f"_{mark}{i}": _comparable(df, c, rules.fold_case) for i, c in enumerate(rules.columns)}
    return df.withColumns(names)


def _on(rules: KeyRules, left: str, right: str) -> Column:
    pairs = [(F.col(f"_{left}{i}"), F.col(f"_{right}{i}")) for i in range(len(rules.columns))]
    return reduce(and_, [a.eqNullSafe(b) if rules.null_safe else a == b for a, b in pairs])


def _key_names(rules: KeyRules, mark: str) -> list[str]:
    return [f"_{mark}{i}" for i in range(len(rules.columns))]


def one_row_per_key(source: DataFrame, rules: KeyRules) -> DataFrame:
    """Source packed into ``src``, one row per key, with the number of rows behind it."""
    if rules.duplicates not in ("raise", "first", "unique"):
        raise ValueError(f"unknown duplicates rule {rules.duplicates!r}")
    packed = F.struct(*[F.col(c) for c in source.columns])
    names = _key_names(rules, "s")
    keyed = _with_keys(source, rules, "s").select(*names, packed.alias("src"))
    if rules.duplicates == "unique":
        return keyed.withColumns({"_copies": F.lit(1), "_hit": F.lit(True)})
    grouped = keyed.groupBy(*names).agg(F.min("src").alias("src"), F.count(F.lit(1)).alias("_copies"))
    return grouped.withColumn("_hit", F.lit(True))


def _matched(target: DataFrame, source: DataFrame, rules: KeyRules) -> DataFrame:
    """Target rows with ``src`` and ``_found``; one row per target row."""
    joined = _with_keys(target, rules, "t").join(
        one_row_per_key(source, rules), _on(rules, "t", "s"), "left"
    )
    return joined.withColumn("_found", F.coalesce(F.col("_hit"), F.lit(False)))


def _guarded(fires: Column, rules: KeyRules) -> Column:
    """``fires`` as true or false, failing the job where duplicates must not pass."""
    fires = F.coalesce(fires, F.lit(False))
    if rules.duplicates != "raise":
        return fires
    error = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    return F.when(fires & (F.col("_copies") > 1), error).otherwise(fires)


def unmatched_source(target: DataFrame, source: DataFrame, rules: KeyRules) -> DataFrame:
    """Source rows whose key the target lacks, duplicates included.

    The target is cut to its key columns, then to the source's keys, then to one row
    per key, so a hot key and a target far larger than the source cost little.
    """
    target_keys, source_keys = _key_names(rules, "t"), _key_names(rules, "s")
    keyed_source = _with_keys(source, rules, "s")
    present = (
        _with_keys(target, rules, "t")
        .select(*target_keys)
        .join(keyed_source.select(*source_keys), _on(rules, "t", "s"), "left_semi")
        .distinct()
    )
    return keyed_source.join(present, _on(rules, "t", "s"), "left_anti").select(*source.columns)


def absent_target(target: DataFrame, source: DataFrame, rules: KeyRules) -> DataFrame:
    """Target rows whose key the source lacks."""
    keys = _with_keys(source, rules, "s").select(*_key_names(rules, "s")).distinct()
    joined = _with_keys(target, rules, "t").join(keys, _on(rules, "t", "s"), "left_anti")
    return joined.select(*target.columns)


def present_target(target: DataFrame, source: DataFrame, rules: KeyRules) -> DataFrame:
    """Target rows whose key the source has."""
    keys = _with_keys(source, rules, "s").select(*_key_names(rules, "s")).distinct()
    joined = _with_keys(target, rules, "t").join(keys, _on(rules, "t", "s"), "left_semi")
    return joined.select(*target.columns)


def differs(target: DataFrame, columns: tuple[str, ...], mode: str, null_safe: bool = False,
            fold_case: bool = True) -> Column:
    """Whether target columns differ from ``src``.

    Unless ``null_safe``, a comparison with NULL is unknown and never counts as a change.
    """
    if mode == "always":
        return F.lit(True)
    tests = []
    for name in columns:
        old, new = F.col(name), F.col(f"src.{name}")
        if fold_case and isinstance(target.schema[name].dataType, StringType):
            old, new = text.fold(old), text.fold(new)
        tests.append(~old.eqNullSafe(new) if null_safe else old != new)
    return reduce(and_ if mode == "all" else or_, tests)


def _shape(rows: DataFrame, target: DataFrame, fixed: dict[str, Column]) -> DataFrame:
    """``rows`` with the target's columns and types; ``fixed`` wins, what is missing is NULL."""
    have = {c.lower(): c for c in rows.columns}
    columns = []
    for spec in target.schema.fields:
        if spec.name in fixed:
            value = fixed[spec.name]
        elif spec.name.lower() in have:
            value = F.col(have[spec.name.lower()])
        else:
            value = F.lit(None)
        columns.append(value.cast(spec.dataType).alias(spec.name))
    return rows.select(*columns)


def _numbered(rows: DataFrame, target: DataFrame, rules: KeyRules) -> DataFrame:
    if rules.surrogate is None:
        return rows
    digest = list(rules.digest or rules.columns)
    return assign_keys(rows, rules.surrogate, digest, highest_key(target, rules.surrogate))


def _replace(joined: DataFrame, target: DataFrame, values: dict[str, Column]) -> DataFrame:
    columns = []
    for spec in target.schema.fields:
        value = values.get(spec.name, F.col(spec.name))
        columns.append(value.cast(spec.dataType).alias(spec.name))
    return joined.select(*columns)


def _classified(joined: DataFrame, rules: KeyRules, *flags: str) -> DataFrame:
    """What a merge decides for each target row, written once: its key as ``_s`` names if the source
    has it, ``flags``, and the source row if ``_fires``."""
    keys = [F.when(F.col("_found"), F.col(t)).alias(s) for t, s in zip(_key_names(rules, "t"), _key_names(rules, "s"))]
    return settle(joined.select(*keys, "_found", "_fires", *flags, F.when(F.col("_fires"), F.col("src")).alias("src")))


def _new_rows(source: DataFrame, classified: DataFrame, rules: KeyRules) -> DataFrame:
    """Source rows whose key no target row of ``classified`` has, duplicates included; written once."""
    met = classified.where("_found").select(
        *[F.col(name).alias(other) for name, other in zip(_key_names(rules, "s"), _key_names(rules, "t"))]
    ).distinct()
    return settle(_with_keys(source, rules, "s").join(met, _on(rules, "t", "s"), "left_anti").select(*source.columns))


def _sources_where(classified: DataFrame, test: Column) -> DataFrame:
    """Source rows behind the target rows that pass ``test``, NULL columns where there is none.

    Unpacked from an array instead of filtered: from a filter over many columns that are
    then renamed, the optimizer derives a constraint for every subset of them.
    """
    return classified.select(F.inline(F.when(test, F.array("src"))))


def _feed(action: str, rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(F.lit(action).alias("action"), *columns)


def _audit(now: Column, stamp_modified: bool = True) -> dict[str, Column]:
    return {CREATED: now, MODIFIED: now if stamp_modified else F.lit(None)}


def insert_only(target: DataFrame, source: DataFrame, rules: KeyRules, as_of: datetime,
                stamp_modified: bool = True) -> MergeResult:
    """Add rows with new keys; never touch the others. The new rows can simply be appended."""
    new = settle(unmatched_source(target, source, rules))
    now = clock.moment(as_of)
    inserted = _numbered(_shape(new, target, _audit(now, stamp_modified)), target, rules)
    return MergeResult(target, inserted, _feed("INSERT", new, source.columns))


def upsert(target: DataFrame, source: DataFrame, rules: KeyRules, as_of: datetime,
           update: tuple[str, ...], compare: tuple[str, ...] | None = None, mode: str = "any",
           null_safe: bool = False) -> MergeResult:
    """Type-1 merge: overwrite ``update`` columns where ``compare`` columns differ, insert new keys."""
    now = clock.moment(as_of)
    if not update:
        return insert_only(target, source, rules, as_of)
    joined = _matched(target, source, rules)
    change = differs(target, compare or update, mode, null_safe, rules.fold_case)
    joined = joined.withColumn("_fires", _guarded(F.col("_found") & change, rules))
    decided = _classified(joined.where("_found"), rules)
    new = _new_rows(source, decided, rules)
    inserted = _numbered(_shape(new, target, _audit(now)), target, rules)
    values = {c: F.when(F.col("_fires"), F.col(f"src.{c}")).otherwise(F.col(c)) for c in update}
    if MODIFIED in target.columns:
        values[MODIFIED] = F.when(F.col("_fires"), now).otherwise(F.col(MODIFIED))
    existing = _replace(joined, target, values)
    updated = _feed("UPDATE", _sources_where(decided, F.col("_fires")), source.columns)
    return MergeResult(existing, inserted, updated.unionByName(_feed("INSERT", new, source.columns)))


def history(target: DataFrame, source: DataFrame, rules: KeyRules, how: HistoryRules,
            as_of: datetime) -> MergeResult:
    """Type-2 merge: expire changed rows and add their new versions, mark rows gone from source.

    As every target row is judged on its own, a key's history rows take part as well
    unless ``only_current``; each expired row yields one new version.
    """
    now = clock.moment(as_of)
    change = differs(target, how.tracked, how.change, how.null_safe, rules.fold_case)
    if how.only_current:
        is_open = (F.col("EffectiveEndTime").cast("timestamp_ntz") == clock.open_end()) & (
            F.col("IsCurrent") == 1
        )
        change = is_open & change
    fires = _guarded(F.col("_found") & change, rules)
    joined = _matched(target, source, rules).withColumns({"_fires": fires, "_gone": ~F.col("_found")})
    deleted = F.when(F.col("_gone"), F.lit(1))
    if how.undelete:
        deleted = deleted.when(F.col("IsCurrent") == 1, F.lit(0))
    stamped = F.col("_fires") | F.col("_gone") if how.stamp_deleted else F.col("_fires")
    existing = _replace(joined, target, {
        "EffectiveEndTime": F.when(F.col("_fires"), now).otherwise(F.col("EffectiveEndTime")),
        "IsCurrent": F.when(F.col("_fires"), F.lit(0)).otherwise(F.col("IsCurrent")),
        "IsDeleted": deleted.otherwise(F.col("IsDeleted")),
        MODIFIED: F.when(stamped, now).otherwise(F.col(MODIFIED)),
    })

    decided = _classified(joined, rules, "_gone")
    touched = _sources_where(decided, F.col("_fires") | F.col("_gone"))
    changes = _feed("UPDATE", touched, source.columns)
    new = _new_rows(source, decided, rules)
    opened = {
        **{name: F.lit(value) for name, value in how.constants.items()},
        "IsCurrent": F.lit(1),
        "EffectiveStartTime": now,
        "EffectiveEndTime": clock.open_end(),
        "IsDeleted": F.lit(0),
        **_audit(now, how.stamp_new),
    }
    first_start = now if how.first_start is None else clock.moment(how.first_start)
    first = {**opened, **{c: F.lit(None) for c in how.first_nulls}, "EffectiveStartTime": first_start}
    next_versions = _sources_where(decided, F.col("_fires"))
    inserted = _shape(new, target, first).unionByName(_shape(next_versions, target, opened))
    changes = changes.unionByName(_feed("INSERT", new, source.columns))
    return MergeResult(existing, _numbered(inserted, target, rules), changes)


def versioned(target: DataFrame, source: DataFrame, rules: KeyRules, how: VersionRules,
              as_of: datetime) -> MergeResult:
    """Versioned fact: close an open version when its value changes and open the next one.

    NULL counts as -1 in the comparison of numbers and texts; a NULL date or time differs from
    any other. Texts are compared without regard to case where keys are. Keys gone from the source have their rows
    closed, rows closed before included unless ``only_open``. A new key with a NULL
    value opens no version.
    """
    now = clock.moment(as_of)
    kind = target.schema[how.value].dataType
    old, new_value = F.col(how.value), F.col(f"src.{how.value}").cast(kind)
    if isinstance(kind, NumericType):
        blank = F.lit(-1).cast(kind)
        old, new_value = F.coalesce(old, blank), F.coalesce(new_value, blank)
    elif isinstance(kind, StringType):
        blank = F.lit("-1")
        old, new_value = F.coalesce(old, blank), F.coalesce(new_value, blank)
        if rules.fold_case:
            old, new_value = text.fold(old), text.fold(new_value)
    is_open = F.col(how.end).isNull()
    fires = _guarded(F.col("_found") & is_open & ~old.eqNullSafe(new_value), rules)
    gone = ~F.col("_found") & is_open if how.only_open else ~F.col("_found")
    joined = _matched(target, source, rules).withColumns({"_fires": fires, "_gone": gone, "_open": is_open})
    closes = F.col("_fires") | F.col("_gone")
    values = {how.end: F.when(closes, now).otherwise(F.col(how.end))}
    if MODIFIED in target.columns:
        values[MODIFIED] = F.when(closes, now).otherwise(F.col(MODIFIED))
    existing = _replace(joined, target, values)

    decided = _classified(joined, rules, "_gone", "_open")
    known = decided.where("_open") if how.reopen else decided
    new = _new_rows(source, known, rules).where(F.col(how.value).isNotNull())
    opened = {how.start: now, how.end: F.lit(None), **_audit(now, stamp_modified=False)}
    first = {**opened, **_audit(now, how.stamp_new)}
    next_versions = _sources_where(decided, F.col("_fires"))
    inserted = _shape(new, target, first).unionByName(_shape(next_versions, target, opened))
    touched = _sources_where(decided, closes)
    changes = _feed("UPDATE", touched, source.columns).unionByName(
        _feed("INSERT", new, source.columns)
    )
    return MergeResult(existing, _numbered(inserted, target, rules), changes)
