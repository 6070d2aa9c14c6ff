"""Text predicates and parsers built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Attributes that are levels, not quantities, so never summed.
LEVEL_ATTRIBUTES = ["Conditioning pH", "Level %"]
LEVEL_SUFFIXES = ["level", "levels"]
# Attributes left out of every roll-up, by suffix.
STATE_SUFFIXES = ["mode", "L/H", "on/off"]
# Run-status marker, stopped state, failed-calculation text, placeholder name.
RUN_STATUS = "run status"
STATUS_OFF = "off"
FAILED_VALUE = "Calc Failed"
PLACEHOLDER = "blank"

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def fold(col: Column) -> Column:
    """The form in which texts are compared: case does not count."""
    return F.lower(col)


def contains_text(col: Column, needle: str) -> Column:
    return fold(col).contains(needle.lower())


def ends_with_any(col: Column, suffixes: list[str]) -> Column:
    test = F.lit(False)
    for suffix in suffixes:
        test = test | fold(col).endswith(suffix.lower())
    return test


def is_run_status(category: Column) -> Column:
    """NULL for a NULL category, so such rows pass neither the test nor its negation."""
    return contains_text(category, RUN_STATUS)


def is_state_attribute(attribute: Column) -> Column:
    return ends_with_any(attribute, STATE_SUFFIXES)


def is_level_attribute(attribute: Column) -> Column:
    listed = fold(attribute).isin([name.lower() for name in LEVEL_ATTRIBUTES])
    return listed | ends_with_any(attribute, LEVEL_SUFFIXES)


def number_or_null(value: Column) -> Column:
    """Plain decimal text as double, anything else as NULL.

    The pattern is needed beside ``try_cast``, which also takes '1.5d', 'NaN' and 'Infinity'.
    """
    return F.when(value.rlike(_NUMBER), F.trim(value).try_cast("double"))


def after_first(text: Column, mark: str) -> Column:
    """Text behind the first ``mark``; the whole text if there is none."""
    return F.right(text, F.length(text) - F.instr(text, mark))


def path_depth(path: Column, separator: str = "\\") -> Column:
    """Number of steps in a separated path."""
    bare = F.replace(path, F.lit(separator), F.lit(""))
    return F.length(path) - F.length(bare) + 1


def activity_label(flag: Column) -> Column:
    return F.when(flag == 1, F.lit("ACTIVE")).otherwise(F.lit("INACTIVE"))


def split_rows(df: DataFrame, column: str, into: str, position: str = "position") -> DataFrame:
    """One row per comma-separated item, numbered from 1."""
    items = F.posexplode_outer(F.split(F.col(column), ",")).alias("_at", into)
    return df.select("*", items).withColumn(position, F.col("_at") + 1).drop("_at")


def paired_rows(df: DataFrame, left: str, right: str, into: tuple[str, str]) -> DataFrame:
    """Items of two comma-separated columns, paired by position; a missing partner drops the item."""
    zipped = F.arrays_zip(
        F.split(F.col(left), ",").alias("l"), F.split(F.col(right), ",").alias("r")
    )
    rows = df.select("*", F.posexplode(zipped).alias("_at", "_pair"))
    rows = rows.select(
        *df.columns,
        (F.col("_at") + 1).alias("position"),
        F.col("_pair.l").alias(into[0]),
        F.col("_pair.r").alias(into[1]),
    )
    return rows.where(F.col(into[0]).isNotNull() & F.col(into[1]).isNotNull())
