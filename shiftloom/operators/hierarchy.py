"""Parent/child hierarchies: flattening, level columns and parent keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text
from ..sources.tables import settle

NAMED_LEVELS = 10


def with_parent_id(rows: DataFrame) -> DataFrame:
    """Reasons with their path depth as ``Level`` and their parent's ID within the same hierarchy.

    A code that a hierarchy has twice fails the job once it is anyone's parent, and so does an
    ID that occurs twice: each row keeps one parent.
    """
    child = rows.select(
        "ReasonID", "ReasonCode", "ReasonHierarchy", "ReasonName", "OeeCategory",
        F.col("ReasonCodeParent").alias("_parent_code"),
        text.path_depth(F.col("ReasonPath")).alias("Level"),
    )
    repeated = rows.where(F.col("ReasonID").isNotNull()).groupBy("ReasonID").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = repeated.where(F.col("_rows") > 1).select(F.col("ReasonID").alias("_repeated"))
    parent = rows.groupBy(
        text.fold(F.col("ReasonCode")).alias("_code"), text.fold(F.col("ReasonHierarchy")).alias("_hierarchy")
    ).agg(F.min("ReasonID").alias("ReasonParentID"), F.count(F.lit(1)).alias("_parents"))
    same = (text.fold(F.col("_parent_code")) == F.col("_code")) & (
        text.fold(F.col("ReasonHierarchy")) == F.col("_hierarchy")
    )
    joined = child.join(parent, same, "left").join(repeated, F.col("ReasonID") == F.col("_repeated"), "left")
    error = F.raise_error(F.lit("a reason code or ID occurs twice"))
    own = F.when((F.col("_parents") > 1) | F.col("_repeated").isNotNull(), error.cast(rows.schema["ReasonID"].dataType))
    return joined.withColumn("ReasonParentID", own.otherwise(F.col("ReasonParentID"))).select(
        *[c for c in child.columns if c != "_parent_code"], "ReasonParentID"
    )


def flatten(rows: DataFrame) -> DataFrame:
    """Level1Name to Level10Name of every row that hangs below a ``Level`` 1 row.

    A row climbs to its ancestors over the parent's unique ID and ends at the first ``Level`` 1 row; a
    level's slot takes the name of the nearest row at that level, the row itself included. Rows that reach
    no root, orphans and cycles among them, do not appear.

    Rows jump over twice as many ancestors in each round: a row knows the nearest name at each level among
    itself and the ancestors it has passed, and the next one to ask, which answers with the same for as many
    more. So a chain of ``n`` rows takes ``log2(n)`` joins, and a row carries ten names however long its
    chain is. Rows that still climb when the jumps are longer than the number of rows are in a cycle or
    below one. The rounds carry IDs and names alone, written after each; all other columns join the result once.
    """
    levels = range(1, NAMED_LEVELS + 1)
    slots = [f"_slot{n}" for n in levels]
    at_root = F.coalesce(F.col("Level") == 1, F.lit(False))
    # A slot is a struct of a name, so that a row without a name at its level still fills it.
    own = {f"_slot{n}": F.when(F.col("Level") == n, F.struct(F.col("ReasonName").alias("name"))) for n in levels}
    state = rows.where("ReasonID IS NOT NULL").select(
        F.col("ReasonID").alias("_id"), *[column.alias(name) for name, column in own.items()],
        at_root.alias("_rooted"), F.when(~at_root, F.col("ReasonParentID")).alias("_next"),
    )
    ended, climbing = state.where("_rooted"), settle(state.where("_next IS NOT NULL"))
    count, rounds = climbing.count(), 0
    while count >> rounds and not climbing.isEmpty():
        asked = ended.unionByName(climbing)
        answer = asked.select(*[F.col(c).alias(f"_up{c}") for c in asked.columns])
        jumped = climbing.join(answer, F.col("_next") == F.col("_up_id"), "left").select(
            "_id", *[F.coalesce(F.col(c), F.col(f"_up{c}")).alias(c) for c in slots],
            F.coalesce(F.col("_up_rooted"), F.lit(False)).alias("_rooted"), F.col("_up_next").alias("_next"),
        )
        jumped = settle(jumped)
        ended, climbing = ended.unionByName(jumped.where("_rooted")), jumped.where("_next IS NOT NULL")
        rounds += 1
    parents = ended.select(F.col("_id").alias("_parent"), *[F.col(c).alias(f"_up{c}") for c in slots])
    joined = rows.withColumns(own).join(parents, ~at_root & (F.col("ReasonParentID") == F.col("_parent")), "left")
    names = [F.coalesce(F.col(c), F.col(f"_up{c}"))["name"].alias(f"Level{n}Name") for n, c in zip(levels, slots)]
    return joined.where(at_root | F.col("_parent").isNotNull()).select(*[c for c in rows.columns if c != "ReasonCode"], *names)


def level_names(levels: Mapping[str, tuple[int, tuple[str, ...]]]) -> dict[str, Column]:
    """Columns that take level N's name when level N has one of the given types."""
    return {
        into: F.when(
            text.fold(F.col(f"Level{number}Type")).isin(*[t.lower() for t in types]), F.col(f"Level{number}Name")
        )
        for into, (number, types) in levels.items()
    }


def _current_keys(dimension: DataFrame, id_column: str, key_column: str) -> DataFrame:
    current = dimension.where(F.col("IsCurrent") == 1)
    return current.groupBy(F.col(id_column).alias("_parent_id")).agg(
        F.min(key_column).alias("_parent_key"), F.count(F.lit(1)).alias("_parents")
    )


def with_parent_key(stage: DataFrame, dimension: DataFrame, parent_id: str, id_column: str,
                    key_column: str, into: str) -> DataFrame:
    """Key of the parent's current row; two current rows for one parent fail the job."""
    parents = _current_keys(dimension, id_column, key_column)
    error = F.raise_error(F.lit("a parent has several current rows")).cast("long")
    key = F.when(F.col("_parents") > 1, error).otherwise(F.col("_parent_key"))
    joined = stage.join(parents, F.col(parent_id) == F.col("_parent_id"), "left")
    return joined.select(*stage.columns, key.alias(into))


def fill_parent_keys(rows: DataFrame, dimension: DataFrame, stage: DataFrame, parent_id: str,
                     id_column: str, key_column: str, into: str) -> DataFrame:
    """Set parent keys that are still NULL on current ``rows``, now that all parents in
    ``dimension`` have keys."""
    parents = _current_keys(dimension, id_column, key_column).select("_parent_id", "_parent_key")
    links = stage.select(F.col(id_column).alias("_child_id"), F.col(parent_id).alias("_link"))
    found = (
        links.join(parents, F.col("_link") == F.col("_parent_id"))
        .groupBy("_child_id").agg(F.min("_parent_key").alias("_found"))
    )
    open_slot = (F.col("IsCurrent") == 1) & F.col(into).isNull()
    filled = F.when(open_slot, F.col("_found")).otherwise(F.col(into))
    joined = rows.join(found, F.col(id_column) == F.col("_child_id"), "left")
    return joined.withColumn(into, filled).select(*rows.columns)
