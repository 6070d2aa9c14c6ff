"""Surrogate keys without an identity column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_PER_CHUNK = 100_000


def highest_key(target: DataFrame, key: str) -> Column:
    """Largest key in use, 0 for an empty table, as a scalar subquery."""
    return target.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("k")).scalar()


def row_digest(columns: list[str]) -> Column:
    """MD5 over the text of ``columns``; NULL and empty text differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def assign_keys(rows: DataFrame, key: str, digest_columns: list[str], after: Column) -> DataFrame:
    """Number ``rows`` ``after + 1, after + 2, ...`` in the order of their digest.

    The order is a function of the row alone, so a task that runs again hands out
    the same numbers. Rows are numbered inside the 4,096 groups of the first three
    digest digits, which the digest fills evenly, and every group starts where the
    ones before it end; no window spans more than a group or the 4,096 group sizes.
    Exact copies collapse into a count before the shuffle and are spread out again
    in chunks afterwards.
    """
    plain = [c for c in rows.columns if c != key]
    digested = rows.select(*plain, row_digest(digest_columns).alias("_digest"))
    digested = digested.withColumn("_group", F.substring("_digest", 1, 3))

    sizes = digested.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))

    counted = digested.groupBy("_group", "_digest", *plain).agg(F.count(F.lit(1)).alias("_copies"))
    inside = Window.partitionBy("_group").orderBy("_digest", *plain)
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_ahead", F.coalesce(F.sum("_copies").over(ahead), F.lit(0)))
    placed = placed.join(starts, "_group").withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / _PER_CHUNK)))
    )
    chunk_first = F.col("_chunk") * _PER_CHUNK
    chunk_last = F.least(chunk_first + _PER_CHUNK, F.col("_copies")) - 1
    placed = placed.withColumn("_copy", F.explode(F.sequence(chunk_first, chunk_last)))
    number = after + F.col("_start") + F.col("_ahead") + F.col("_copy") + 1
    return placed.select(number.alias(key), *plain).select(*rows.columns)
