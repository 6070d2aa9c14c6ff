"""Left join to the versions of a key whose range holds a moment, without a product for keys of many versions.

An equi-join on the key meets every version of it and filters afterwards, which is fine while a key has few
versions. The versions and source rows of other keys are put in one stream, ordered by time and cut into
slots; each version carries itself and those started before it, a row looks at the ones carried by the
last version before it, and a slot opens with what the slots before it carry over. A version that many
later ones start within is not carried but listed with its key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from ..sources.tables import settle

#: Versions of a key up to which rows are joined to all of them.
MANY = 64
#: Versions that a row looks at, and versions of a key that may be listed instead.
DEPTH, LISTED = 4, 16
#: Rows and versions of a key in a slot, if they are spread evenly.
SLOT_ROWS = 100_000


def _seconds(moment: Column, kind: DataType) -> Column:
    """A number that never falls as the moment rises."""
    if isinstance(kind, TimestampType):
        return F.unix_seconds(moment)
    day = F.unix_date(moment.cast("date")).cast("long") * 86_400
    if isinstance(kind, DateType):
        return day
    return day + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def _on(left: list[str], right: list[str]) -> Column:
    return reduce(and_, [F.col(a) == F.col(b) for a, b in zip(left, right)])


def join_versions(source: DataFrame, versions: DataFrame, mine: dict[str, Column], theirs: dict[str, Column], at: str,
                  start: str, end: str, many: int = MANY, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``source`` with the columns of each of its versions: those with its key that ``at`` lies in, both ends included.

    ``mine`` and ``theirs`` are the key by the same new names. A row without a version appears once, with nulls; so
    does one with a null key or moment. Overlapping versions all match. The keys of many versions are
    looked for in ``versions`` alone, by one small job when this is called; without any, this is a plain join.
    """
    keys = list(mine)
    others = [f"{k}_v" for k in keys]
    inside = F.col(at).between(F.col(start), F.col(end))
    rows = source.withColumns(mine)
    side = versions.withColumns(dict(zip(others, theirs.values())))

    def plain(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, _on(keys, others) & inside, "left").drop(*keys, *others)

    kind = source.schema[at].dataType
    alike = all(rows.schema[k].dataType == side.schema[o].dataType for k, o in zip(keys, others))
    timed = isinstance(kind, (DateType, TimestampType, TimestampNTZType))
    if not (alike and timed and versions.schema[start].dataType == versions.schema[end].dataType == kind):
        return plain(rows, side)
    counts = side.groupBy(*others).agg(F.count("*").alias("_count")).where(F.col("_count") > many)
    if counts.isEmpty():
        return plain(rows, side)

    packed = F.struct(*[F.col(f"`{c}`") for c in versions.columns])
    order = Window.partitionBy(*others).orderBy("_start", "_end", "_version")
    crowded = side.join(counts.drop("_count"), others, "left_semi").where(F.col(start) <= F.col(end)).select(
        *others, F.col(start).alias("_start"), F.col(end).alias("_end"), packed.alias("_version")
    )
    crowded = settle(crowded.withColumn("_long", F.coalesce(F.lead("_start", DEPTH).over(order) <= F.col("_end"), F.lit(False))))
    stats = crowded.groupBy(*others).agg(
        F.sum(F.col("_long").cast("int")).alias("_listed"), F.count("*").alias("_n"),
        F.min("_start").alias("_low"), F.max("_start").alias("_high"),
    ).where(F.col("_listed") <= LISTED)
    own = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    listed = crowded.where("_long").groupBy(*others).agg(F.collect_list("_version").alias("_always"))
    slots = F.greatest(F.lit(1), F.ceil((F.col("_n") + F.coalesce("_rows", F.lit(0))) / slot_rows)).cast("long")
    span = _seconds(F.col("_high"), kind) - _seconds(F.col("_low"), kind) + 1
    info = stats.join(own, _on(others, keys), "left").drop(*keys).join(listed, others, "left").select(
        *others, "_always", slots.alias("_slots"), _seconds(F.col("_low"), kind).alias("_zero"), span.alias("_span"),
    )
    info = settle(info)
    place = F.floor((_seconds(F.col("_t"), kind) - F.col("_zero")) * F.col("_slots") / F.col("_span")).cast("long")
    slot = F.coalesce(F.greatest(F.lit(0), F.least(place, F.col("_slots") - 1)), F.lit(0)).alias("_slot")

    short = crowded.where("NOT _long").withColumn("_n", F.row_number().over(order))
    seen = F.array_compact(F.array(*[F.lag("_version", k).over(order) for k in range(DEPTH)]))
    started = short.withColumn("_seen", seen).withColumnRenamed("_start", "_t").join(info, others)
    started = settle(started.select(*others, slot, "_t", F.lit(1).alias("_kind"), "_n", "_seen"))
    latest = started.groupBy(*others, "_slot").agg(F.max_by("_seen", "_n").alias("_seen"))
    every = info.select(*others, F.explode(F.sequence(F.lit(0), F.col("_slots") - 1)).alias("_slot"))
    before = Window.partitionBy(*others).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(latest, [*others, "_slot"], "left").withColumn("_seen", F.last("_seen", True).over(before))
    nothing = F.lit(None).cast(kind)
    lead = carried.select(*others, "_slot", nothing.alias("_t"), F.lit(0).alias("_kind"), F.lit(0).alias("_n"), "_seen")

    row = F.struct(*[F.col(f"`{c}`") for c in source.columns])
    asked = rows.select(*keys, F.col(at).alias("_t"), row.alias("_row")).join(info, _on(keys, others))
    asked = asked.select(*others, slot, "_t", F.lit(2).alias("_kind"), F.lit(0).alias("_n"), "_row", "_always")
    stream = asked.unionByName(lead.unionByName(started), allowMissingColumns=True)
    passed = Window.partitionBy(*others, "_slot").orderBy("_t", "_kind", "_n").rowsBetween(Window.unboundedPreceding, 0)
    stream = stream.withColumn("_seen", F.last("_seen", True).over(passed)).where("_kind = 2")
    none = F.array().cast(stream.schema["_seen"].dataType)
    both = F.concat(F.coalesce("_seen", none), F.coalesce("_always", none))
    hits = F.filter(both, lambda v: (v[start] <= F.col("_t")) & (F.col("_t") <= v[end]))
    found = stream.select("_row", F.explode_outer(hits).alias("_version")).select("_row.*", "_version.*")

    rest = plain(rows.join(info.select(*others), _on(keys, others), "left_anti"), side.join(info.select(*others), others, "left_anti"))
    return rest.unionByName(found)
