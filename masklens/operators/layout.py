"""Table layouts that later queries profit from.

Silver tables bucketed and sorted by object join without a shuffle: a bucket of
one side meets the bucket of the other. Tables laid out by day are read by the
days that the calendar leaves: a filter on the calendar reaches the scan as a
dynamic partition filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masklens.operators import joins
from masklens.operators.calendar import DIM_COLUMNS

BUCKETS = 64
DAY = "load_day"


def write_bucketed(df: DataFrame, name: str, keys: list[str], path: str, buckets: int = BUCKETS, fmt: str = "parquet") -> None:
    """Overwrite table ``name`` at ``path``, bucketed and sorted by ``keys``.

    Rows are shuffled by the keys once, when they are written, into one file a bucket.
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").format(fmt).option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def colocated(spark: SparkSession) -> None:
    """Let joins on more keys use tables bucketed by some of them, for this session."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")


def own_config_colocated(spark: SparkSession, ops_table: str, config_table: str) -> DataFrame:
    """J4 over tables bucketed by ``object_id``: no exchange above the scans."""
    colocated(spark)
    return joins.ops_own_config(spark.table(ops_table), spark.table(config_table).hint("merge"))


def config_join_colocated(spark: SparkSession, ops_table: str, config_table: str) -> DataFrame:
    """J1 over tables bucketed by ``object_id``: no exchange above the scans."""
    colocated(spark)
    return joins.ops_config_join(spark.table(ops_table), spark.table(config_table).hint("merge"))


def write_by_day(df: DataFrame, path: str, time_col: str, day_col: str = DAY, fmt: str = "parquet") -> None:
    """Overwrite a table folder partitioned by the day of ``time_col`` (rows without one in a partition of their own).

    AQE's rebalance by day gives a day few files, and splits a hot one.
    """
    daily = df.withColumn(day_col, F.to_date(F.col(time_col)))
    daily.hint("rebalance", F.col(day_col)).write.mode("overwrite").format(fmt).partitionBy(day_col).save(path)


def days_of(fact: DataFrame, calendar: DataFrame, condition, day_col: str = DAY) -> DataFrame:
    """J2 over a table laid out by day: its rows on the calendar's days that meet ``condition``, with the calendar's columns.

    ``calendar`` is best a stored dimension (D1). Only the partitions of the days left are read.
    """
    days = calendar.where(condition).select(*DIM_COLUMNS)
    return fact.join(days, fact[day_col] == days["Date"])
