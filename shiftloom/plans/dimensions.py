"""Type-2 dimensions of the plant model and the generic dimension load."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text
from ..operators import hierarchy
from ..operators.lookups import Lookup, dimension_lookups, dimension_rows, look_up, resolve
from ..operators.merge import (
    AUDIT, HISTORY, HistoryRules, KeyRules, MergeResult, history, upsert,
)
from ..sources.tables import settle
from .units import units_by_source_name

# Fixed value: start of the first version of attributes and reasons.
FIRST_START = date(1963, 1, 1)

ATTRIBUTE_KEY = KeyRules(("AttributeID",), surrogate="AttributeKey")
ATTRIBUTE_HISTORY = HistoryRules(
    tracked=("EnumerationSetName", "IsConfigurationItem", "IsHidden", "IsManualDataEntry", "Level",
             "Name", "Path", "TraitType", "UnitOfMeasureKey"),
    first_start=FIRST_START,
    constants={"ElementKey": -1},
)


@dataclass(frozen=True)
class Options:
    """Departures from the strict rules: see the fields of ``HistoryRules``."""

    change: str = "all"
    null_safe: bool = False
    undelete: bool = False

    def on(self, rules: HistoryRules) -> HistoryRules:
        return replace(rules, change=self.change, null_safe=self.null_safe, undelete=self.undelete)


STRICT = Options()


def attribute_source(stage: DataFrame, units: DataFrame, mapping: DataFrame) -> DataFrame:
    named = units_by_source_name(units, mapping)
    unit = Lookup("Unit", "UnitOfMeasureKey", "UnitOfMeasureKey", (("UomName", "UomName"),))
    return look_up(stage, named, unit).select(
        F.col("ID").alias("AttributeID"), *ATTRIBUTE_HISTORY.tracked
    )


def load_attributes(target: DataFrame, stage: DataFrame, units: DataFrame, mapping: DataFrame,
                    as_of: datetime, options: Options = STRICT) -> MergeResult:
    source = attribute_source(stage, units, mapping)
    return history(target, settle(source), ATTRIBUTE_KEY, options.on(ATTRIBUTE_HISTORY), as_of)


@dataclass(frozen=True)
class TreeDimension:
    """A dimension whose rows point to a parent row of the same dimension."""

    name: str
    levels: Mapping[str, tuple[int, tuple[str, ...]]]

    @property
    def id(self) -> str:
        return f"{self.name}ID"

    @property
    def key(self) -> str:
        return f"{self.name}Key"

    @property
    def parent_id(self) -> str:
        return f"{self.name}ParentID"

    @property
    def parent_key(self) -> str:
        return f"{self.name}ParentKey"


# Which level holds which column, and the level types that count.
ENVIRONMENT = TreeDimension("Environment", {
    "Enterprise": (1, ("Enterprise",)),
    "Class": (2, ("Class",)),
    "MeasureGroup": (3, ("Measure Group",)),
})
OPS_MEASURE = TreeDimension("OpsMeasure", {
    "Enterprise": (1, ("Enterprise",)),
    "Division": (2, ("Division",)),
    "Plant": (3, ("Plant",)),
    "Department": (4, ("Department",)),
    "EquipmentAndFunctionalArea": (5, ("Equipment", "Functional Area")),
    "SubProcessArea": (6, ("Sub Process Area",)),
})
REASON = TreeDimension("Reason", {})


def measure_source(stage: DataFrame, dimension: DataFrame, tree: TreeDimension) -> DataFrame:
    """Measures with level columns by type and the key of their parent."""
    with_parent = hierarchy.with_parent_key(
        stage, dimension, tree.parent_id, tree.id, tree.key, tree.parent_key
    )
    kind, name = f"{tree.name}Type", f"{tree.name}Name"
    columns: dict[str, Column] = hierarchy.level_names(tree.levels)
    columns["Measure"] = F.when(text.fold(F.col(kind)) == "measure", F.col(name))
    return with_parent.select(
        tree.id, kind, name, tree.parent_key, "Level",
        *[value.alias(into) for into, value in columns.items()],
    )


def flat_reasons(stage: DataFrame) -> DataFrame:
    """Reasons with the names of all their levels and their parent's ID.

    Written once before the climb, which reads them at every step.
    """
    return hierarchy.flatten(settle(hierarchy.with_parent_id(stage)))


def reason_source(flat: DataFrame, dimension: DataFrame) -> DataFrame:
    """Flattened reasons with the key of their parent."""
    with_parent = hierarchy.with_parent_key(
        flat, dimension, REASON.parent_id, REASON.id, REASON.key, REASON.parent_key
    )
    return with_parent.drop(REASON.parent_id)


def _load_tree(target: DataFrame, source: DataFrame, links: DataFrame, tree: TreeDimension,
               as_of: datetime, options: Options, first_start: date | None) -> MergeResult:
    """Merge, then fill parent keys from the merged rows.

    The source and the merged rows are each read several times and so written once.
    """
    rules = KeyRules((tree.id,), surrogate=tree.key)
    tracked = tuple(c for c in source.columns if c != tree.id)
    how = HistoryRules(tracked=tracked, first_start=first_start, first_nulls=(tree.parent_key,))
    merged = history(target, settle(source), rules, options.on(how), as_of).settled()

    def filled(rows: DataFrame) -> DataFrame:
        return hierarchy.fill_parent_keys(
            rows, merged.state, links, tree.parent_id, tree.id, tree.key, tree.parent_key
        )

    return replace(merged, existing=filled(merged.existing), inserted=filled(merged.inserted))


def load_measures(target: DataFrame, stage: DataFrame, tree: TreeDimension, as_of: datetime,
                  options: Options = STRICT) -> MergeResult:
    """Environment or operations measures."""
    source = measure_source(stage, target, tree)
    return _load_tree(target, source, stage, tree, as_of, options, None)


def load_reasons(target: DataFrame, stage: DataFrame, as_of: datetime,
                 options: Options = STRICT) -> MergeResult:
    """Reason dimension."""
    flat = settle(flat_reasons(stage))
    return _load_tree(target, reason_source(flat, target), flat, REASON, as_of, options, FIRST_START)


def load_dimension(target: DataFrame, stage: DataFrame, rules: KeyRules, as_of: datetime,
                   lookups: Iterable[Lookup] = (), tables: Mapping[str, DataFrame | None] | None = None,
                   type2: bool = False, change: str = "always",
                   only_current: bool = False) -> MergeResult:
    """Any dimension: lookups, then a type-1 or type-2 merge on its natural key.

    Type 1 overwrites every column that is neither key nor audit. Type 2 expires every
    matched row, history included, and gives each its new version; ``change="any"``
    with ``only_current`` versions real changes only.
    """
    lookups = list(lookups)
    source = settle(resolve(stage, lookups, tables or {})) if lookups else stage
    own = {rules.surrogate, *rules.columns}
    if type2:
        tracked = tuple(c for c in target.columns if c not in own and c not in HISTORY)
        how = HistoryRules(tracked=tracked, change=change, only_current=only_current,
                           stamp_new=True, stamp_deleted=True)
        return history(target, source, rules, how, as_of)
    update = tuple(c for c in target.columns if c not in own and c not in AUDIT)
    return upsert(target, source, rules, as_of, update=update, mode="always")


def load_dimension_by_metadata(target: DataFrame, stage: DataFrame, metadata: Iterable[Mapping[str, str]],
                               schema: str, table: str, keys: Mapping[str, str],
                               tables: Mapping[str, DataFrame | None], as_of: datetime, change: str = "always",
                               only_current: bool = False, duplicates: str = "raise") -> MergeResult:
    """Any dimension described by metadata rows alone: natural keys, type of history and lookups."""
    rows = list(metadata)
    mine = dimension_rows(rows, table, schema)
    names = {r["DimNaturalKeys"] for r in mine if r["DimNaturalKeys"]}
    history_kinds = {r["DimIsSCD"] for r in mine if r["DimIsSCD"]}
    if len(names) != 1 or len(history_kinds) != 1:
        raise ValueError(f"{schema}.{table} needs one list of natural keys and one kind of history")
    natural = tuple(c.strip() for c in names.pop().split(","))
    rules = KeyRules(natural, duplicates=duplicates, surrogate=keys[table])
    return load_dimension(
        target, stage, rules, as_of, dimension_lookups(rows, table, keys, schema), tables,
        type2=history_kinds.pop() == "Yes", change=change, only_current=only_current,
    )
