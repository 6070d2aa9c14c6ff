"""Reading and writing Parquet tables.

No writer overwrites files that its own plan still reads: a whole table goes to a
new version folder, and a partitioned table is replaced partition by partition,
which Spark stages and moves into place at commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A Parquet path if ``source`` looks like one, else a catalog table or view."""
    if "/" in source:
        return spark.read.parquet(source)
    return spark.table(source)


def inline_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, which the driver and all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def new_name() -> str:
    return uuid.uuid4().hex


def settle(rows: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared folder and read it from there.

    For a source that several joins read: it is computed once, outlives a lost
    executor, and Spark knows its true size and can skip its columns.
    """
    path = f"{shared_folder(rows.sparkSession)}/settled/{new_name()}"
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def append(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Plain insert. An insert-only merge needs no more than this for its new rows."""
    writer = rows.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def reload(rows: DataFrame, path: str) -> None:
    """Empty the table and fill it again. ``rows`` must not read ``path``."""
    rows.write.mode("overwrite").parquet(path)


def touched_partitions(target: DataFrame, source: DataFrame, columns: list[str]) -> DataFrame:
    """The target rows in partitions that ``source`` also has, the one of NULL included."""
    wanted = source.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(columns)]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(columns)])
    return target.join(wanted, same, "left_semi")


def replace_partitions(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Overwrite only the partitions that occur in ``rows``.

    The rebalance hint groups rows by partition and lets Spark split a large one
    over several writers.
    """
    (
        rows.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def merge_partitions(path: str, source: DataFrame, columns: list[str], merge) -> None:
    """Merge ``source`` into the partitioned table at ``path``, of which only touched partitions are read and written.

    ``merge`` gets those rows of the target and gives the rows that replace them. Rows gone from
    the source are not looked for in partitions that the source does not have.
    """
    target = source.sparkSession.read.parquet(path)
    replace_partitions(merge(touched_partitions(target, source, columns)), path, columns)


def forget_settled(spark: SparkSession, *settled: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    root = f"{shared_folder(spark)}/settled/"
    for rows in settled:
        for path in {file.rsplit("/", 1)[0] for file in rows.inputFiles()}:
            if "/settled/" not in path:
                raise ValueError(f"{path} is not a settled table under {root}")
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear(spark: SparkSession, path: str) -> None:
    """Leave an empty table with the same columns. Call it after the load has been written."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
