"""Merges into partitioned Parquet tables that read and rewrite only the partitions concerned.

The list of partitions comes from the settled source, so the scan of the target names them and
Spark opens no other folder. It holds one value for each partition, not for each row, and above
``listed`` partitions they are found by a join instead. Rows are only written over partitions in
which something changes; all files of the others stay as they are.

A merge of a part of the table equals that of the whole if rows of one key are always in one
partition, so the key must contain the partition columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.tables import append, replace_partitions, settle, touched_partitions
from .keys import assign_keys, highest_key
from .merge import KeyRules, MergeResult, VersionRules, absent_target, insert_only, present_target, upsert, versioned

LISTED = 10_000


@dataclass(frozen=True)
class Partitions:
    """Partition ``columns``, which source and target both have.

    ``stale`` says what becomes of target rows in the source's partitions whose key the source lacks:
    ``keep`` leaves them, ``remove`` drops them. Partitions that the source lacks are never read.
    """

    columns: tuple[str, ...]
    stale: str = "keep"
    listed: int = LISTED


def partition_values(rows: DataFrame, parts: Partitions) -> list[tuple] | None:
    """The partitions that occur in ``rows``, or None if there are more than ``listed``."""
    found = rows.select(*parts.columns).distinct().limit(parts.listed + 1).collect()
    return None if len(found) > parts.listed else [tuple(r) for r in found]


def _among(parts: Partitions, values: list[tuple]) -> Column:
    """A test on partition columns alone, which the scan applies to folder names."""
    if len(parts.columns) == 1:
        column = F.col(parts.columns[0])
        test = column.isin([v for v, in values if v is not None])
        return test | column.isNull() if (None,) in values else test
    rows = [reduce(and_, [F.col(c).isNull() if v is None else F.col(c) == v for c, v in zip(parts.columns, row)]) for row in values]
    return reduce(or_, rows, F.lit(False))


def inside(target: DataFrame, source: DataFrame, parts: Partitions) -> DataFrame:
    """The target's rows in partitions that ``source`` has."""
    values = partition_values(source, parts)
    if values is None:
        return touched_partitions(target, source, list(parts.columns))
    return target.where(_among(parts, values))


def _checked(rules: KeyRules, parts: Partitions) -> None:
    if parts.stale not in ("keep", "remove"):
        raise ValueError(f"unknown rule for stale rows {parts.stale!r}")
    missing = {c.lower() for c in parts.columns} - {c.lower() for c in rules.columns}
    if missing:
        raise ValueError(f"partition columns {sorted(missing)} are not in the key, so a key may have rows in other partitions")


def _numbered(result: MergeResult, whole: DataFrame, rules: KeyRules) -> DataFrame:
    """New rows with surrogate keys above those of the whole table, of which one column is read."""
    if rules.surrogate is None:
        return result.inserted
    digest = list(rules.digest or rules.columns)
    return assign_keys(result.inserted, rules.surrogate, digest, highest_key(whole, rules.surrogate))


def _merged(path: str, source: DataFrame, rules: KeyRules, parts: Partitions,
            merge: Callable[[DataFrame, KeyRules], MergeResult], changed: Callable[[DataFrame, MergeResult], DataFrame]) -> DataFrame:
    _checked(rules, parts)
    whole = source.sparkSession.read.parquet(path)
    part = inside(whole, source, parts)
    result = merge(part, replace(rules, surrogate=None))
    existing, touched = result.existing, changed(part, result)
    if parts.stale == "remove":
        gone = absent_target(part, source, rules)
        touched = touched.select(*parts.columns).unionByName(gone.select(*parts.columns))
        existing = present_target(existing, source, rules)
    state = existing.unionByName(_numbered(result, whole, rules))
    replace_partitions(inside(state, settle(touched.select(*parts.columns).distinct()), parts), path, list(parts.columns))
    return result.changes


def upsert_partitions(path: str, source: DataFrame, rules: KeyRules, parts: Partitions, as_of: datetime,
                      update: tuple[str, ...], **options) -> DataFrame:
    """``merge.upsert`` into the table at ``path``; the change feed is returned. ``source`` must be settled."""

    def merge(part: DataFrame, keys: KeyRules) -> MergeResult:
        return upsert(part, source, keys, as_of, update, **options)

    return _merged(path, source, rules, parts, merge, lambda _, result: result.changes)


def versioned_partitions(path: str, source: DataFrame, rules: KeyRules, parts: Partitions, how: VersionRules,
                         as_of: datetime) -> DataFrame:
    """``merge.versioned`` into the table at ``path``; keys count as gone only in partitions that the source has.

    All those partitions are written, as the feed does not say where a closed row lies.
    """

    def merge(part: DataFrame, keys: KeyRules) -> MergeResult:
        return versioned(part, source, keys, how, as_of)

    return _merged(path, source, rules, parts, merge, lambda *_: source)


def insert_partitions(path: str, source: DataFrame, rules: KeyRules, parts: Partitions, as_of: datetime,
                      stamp_modified: bool = True) -> DataFrame:
    """``merge.insert_only`` into the table at ``path``: new rows are appended, no file is rewritten.

    A key without the partition columns is allowed; it is then looked for in the key columns of the whole table.
    """
    whole = source.sparkSession.read.parquet(path)
    keyed = {c.lower() for c in parts.columns} <= {c.lower() for c in rules.columns}
    part = inside(whole, source, parts) if keyed else whole
    result = insert_only(part, source, replace(rules, surrogate=None), as_of, stamp_modified)
    append(_numbered(result, whole, rules).hint("rebalance", *parts.columns), path, parts.columns)
    return result.changes
