"""Run status over time: next-row lookups and stopped intervals without hot groups.

A sensor may own a large share of all rows, so nothing here gathers a whole sensor:
rows are grouped by sensor and time slot, and only one summary row per slot crosses
from slot to slot.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import clock, text
from ..sources.tables import settle

SENSOR = ["ElementAttributeID", "ElementID"]
_KEY = ["_sensor", "_element"]
SLOT_MINUTES = 15
HOT_ROWS = 2_000_000


def with_sensor_key(rows: DataFrame) -> DataFrame:
    """Both IDs folded: spellings that differ in case are one sensor."""
    return rows.withColumns({key: text.fold(F.col(column)) for key, column in zip(_KEY, SENSOR)})


def time_slot(ts: Column, minutes: int = SLOT_MINUTES) -> Column:
    return F.floor(clock.minute_number(ts) / minutes)


def with_next(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, str],
              slot: Column) -> DataFrame:
    """Add each row's following values within its key, in ``order``.

    ``values`` maps a column to the name its following value gets. ``slot`` must not
    decrease with ``order``. The first row of the next slot is added to every slot as
    a closing row, so the window needs to see one slot only.
    """
    marked = rows.withColumn("_slot", slot)
    needed = list(dict.fromkeys([*order, *values]))
    firsts = marked.groupBy(*keys, "_slot").agg(F.min(F.struct(*needed)).alias("_first"))
    over_slots = Window.partitionBy(*keys).orderBy("_slot")
    closing = (
        firsts.withColumn("_first", F.lead("_first").over(over_slots))
        .where(F.col("_first").isNotNull())
        .select(*keys, "_slot", *[F.col(f"_first.{c}").alias(c) for c in needed],
                F.lit(1).alias("_closing"))
    )
    both = marked.withColumn("_closing", F.lit(0)).unionByName(closing, allowMissingColumns=True)
    within = Window.partitionBy(*keys, "_slot").orderBy("_closing", *order)
    following = {new: F.lead(column).over(within) for column, new in values.items()}
    has_next = F.lead("_closing").over(within).isNotNull()
    found = both.withColumns({**following, "_has_next": has_next}).where(F.col("_closing") == 0)
    return found.drop("_slot", "_closing")


def status_switches(readings: DataFrame, slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """Run-status rows with the time and text of the next one; '0' stands for no next status.

    Equal times are ordered by their text.
    """
    rows = readings.where(text.is_run_status(F.col("CategoryName"))).select(
        *SENSOR, F.col("Time").alias("InitialStatusTime"), F.col("Value").alias("InitialStatus")
    )
    rows = with_next(
        with_sensor_key(rows), _KEY, ["InitialStatusTime", "InitialStatus"],
        {"InitialStatusTime": "NextStatusTime", "InitialStatus": "NextStatus"},
        time_slot(F.col("InitialStatusTime"), slot_minutes),
    )
    next_status = F.when(F.col("_has_next"), F.col("NextStatus")).otherwise(F.lit("0"))
    return rows.withColumn("NextStatus", next_status).drop("_has_next", *_KEY)


def _slots(marked: DataFrame) -> DataFrame:
    """One row per sensor and occupied slot: last switch, number of switches, number of rows.

    All rows are only counted, in a hash aggregate; the largest (time, text) pair, which
    Spark has to sort for, is taken over the few status rows.
    """
    group = [*_KEY, "_slot"]
    counts = marked.groupBy(*group).agg(
        F.count(F.when(F.col("_is_status"), 1)).alias("_n"), F.count(F.lit(1)).alias("_rows")
    )
    lasts = marked.where("_is_status").groupBy(*group).agg(F.max(F.struct("Time", "Value")).alias("_last"))
    return counts.join(lasts, group, "left")


def _carried(slots: DataFrame) -> DataFrame:
    """Each slot with the switch carried into it and its sensor's switch count and last switch."""
    sensor = Window.partitionBy(*_KEY)
    before = sensor.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return slots.select(
        *_KEY, "_slot", "_rows",
        F.last("_last", ignorenulls=True).over(before).alias("_carry"),
        F.sum("_n").over(sensor).alias("_switches"),
        F.max("_last.Time").over(sensor).alias("_last_switch"),
    )


def flag_readings(readings: DataFrame, close_open_off: bool = False, dedupe: bool = False,
                  slot_minutes: int = SLOT_MINUTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Measurements with ``_stopped`` (1 inside a stopped interval) and ``_weight``.

    Matching a measurement with each of its sensor's K switches yields K copies, of
    which at most one is stopped: the one of the latest switch strictly before it, if
    that is a stop and a later switch ends it. The copies are counted in ``_weight``
    instead of being made; ``dedupe`` counts each measurement once. With
    ``close_open_off`` a last stop needs no later switch.

    A sensor's slot is one group, led by a row that carries the state into it. Groups
    of more than ``hot_rows`` rows are split further, their switches copied to each
    part. The slots are written once: the leads and the list of hot groups read them,
    and Spark knows the size of that list when it joins it.
    """
    marked = with_sensor_key(readings).select(
        *readings.columns, *_KEY, time_slot(F.col("Time"), slot_minutes).alias("_slot"),
        text.is_run_status(F.col("CategoryName")).alias("_is_status"),
    ).where(F.col("_is_status").isNotNull())
    slots = settle(_slots(marked))
    parts = F.ceil(F.col("_rows") / hot_rows)
    hot = slots.where(F.col("_rows") > hot_rows).select(
        *[F.col(c).alias(f"_hot{c}") for c in [*_KEY, "_slot"]], parts.alias("_parts")
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_hot{c}")) for c in [*_KEY, "_slot"]])
    count = F.coalesce(F.col("_parts"), F.lit(1))
    # The partition number keeps copies of one reading apart and is the same when a task is repeated.
    scattered = F.pmod(F.xxhash64("Time", "Attribute", "Value", F.spark_partition_id()), count)
    part = F.when(F.col("_is_status"), F.sequence(F.lit(0), count - 1)).otherwise(F.array(scattered))
    rows = marked.join(hot, same, "left").select(
        *marked.columns, F.explode(part).alias("_part"),
        F.when(F.col("_is_status"), F.lit(2)).otherwise(F.lit(1)).alias("_order"),
    )
    leads = _carried(slots).select(
        *_KEY, "_slot", "_carry", "_switches", "_last_switch", F.lit(0).alias("_order"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"),
    )
    # A lead has no time and so comes first; a measurement comes before a switch of the same time.
    group = Window.partitionBy(*_KEY, "_slot", "_part").orderBy("Time", "_order", "Value")
    so_far = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    switch = F.when(F.col("_order") == 0, F.col("_carry")).when(
        F.col("_order") == 2, F.struct("Time", "Value")
    )
    seen = rows.unionByName(leads, allowMissingColumns=True).withColumns({
        "_state": F.last(switch, ignorenulls=True).over(so_far),
        "_switches": F.first("_switches").over(so_far),
        "_last_switch": F.first("_last_switch").over(so_far),
    }).where(F.col("_order") == 1)
    known = reduce(and_, [F.col(c).isNotNull() for c in _KEY])
    off = known & (text.fold(F.col("_state.Value")) == text.STATUS_OFF)
    if not close_open_off:
        off = off & (F.col("Time") <= F.col("_last_switch"))
    copies = F.when(known & (F.col("_switches") > 0), F.col("_switches")).otherwise(F.lit(1))
    return seen.select(
        *readings.columns,
        F.when(off, F.lit(1)).otherwise(F.lit(0)).alias("_stopped"),
        (F.lit(1) if dedupe else copies).cast("bigint").alias("_weight"),
    )
