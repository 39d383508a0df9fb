"""Answers that stay right as loads arrive, without reading what was loaded before.

Distinct counts keep one exact bitmap per bucket of 32,768 ids and load; loads
are merged by OR, so an id that comes again counts once. The date rollup keeps
its partial sums of every level; a load's own rollup is merged into them. A
load that is applied twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masklens.operators.batches import Ledger, check_batch
from masklens.operators.calendar import date_attributes

ROLLUP_KEYS = ["Year", "QuarterNo", "MonthNo", "Day"]


def object_bitmaps(rows: DataFrame, object_col: str = "object_id") -> DataFrame:
    """A1: the distinct ids of ``rows`` as (``bucket``, ``bitmap``), one 4 KB bitmap per bucket that has any.

    Ids are whole numbers of any sign; nulls count for nothing, as in ``count(distinct)``. Bitmaps are
    filled in every task before the shuffle, so a load moves at most tasks x buckets of them.
    """
    ids = rows.where(F.col(object_col).isNotNull()).select(F.col(object_col).cast("long").alias("id"))
    return ids.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))


def add_load_bitmaps(rows: DataFrame, path: str, load_id: str, object_col: str = "object_id") -> None:
    """Store a load's bitmaps in a folder of its own; adding a load again replaces it."""
    object_bitmaps(rows, object_col).write.mode("overwrite").parquet(f"{path}/load_id={check_batch(load_id)}")


def distinct_over_loads(spark: SparkSession, path: str) -> DataFrame:
    """A1 after each load: ``load_id`` (by name) and ``n_objects`` of all loads up to it, from the stored bitmaps alone.

    Loads are ranked by name; a load's bitmaps go to every later total, and totals are ORed before they are counted.
    """
    stored = spark.read.option("basePath", path).parquet(path).withColumn("load_id", F.col("load_id").cast("string"))
    names = stored.select("load_id").distinct().select(F.col("load_id").alias("total"))
    totals = stored.join(names, F.col("load_id") <= F.col("total")).groupBy("total", "bucket").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap"))
    return totals.groupBy(F.col("total").alias("load_id")).agg(F.sum(F.bitmap_count("bitmap")).alias("n_objects"))


def rollup_partials(rows: DataFrame, time_col: str, sums: dict[str, str]) -> DataFrame:
    """A6's levels as partial sums: ``level``, the keys (null where rolled up), ``n`` and ``sums`` (name -> column).

    Days are summed first; the rollup's expansion sees one row per day. ``level`` is ``grouping_id()``, which tells a key that is
    rolled up from that of rows without a date.
    """
    day = F.to_date(F.col(time_col))
    daily = rows.groupBy(day.alias("_day")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(name) for name, c in sums.items()])
    return daily.select("*", *date_attributes(F.col("_day"))).rollup(*ROLLUP_KEYS).agg(F.grouping_id().cast("int").alias("level"), F.sum("n").alias("n"),
                                          *[F.sum(name).alias(name) for name in sums])


class RollupTable:
    """The stored rollup of all loads applied so far, in versions; the ledger names the one that is complete."""

    def __init__(self, spark: SparkSession, path: str, sums: dict[str, str]):
        self.spark, self.path, self.sums, self.ledger = spark, path.rstrip("/"), sums, Ledger(spark, path)

    def _versions(self) -> list[str]:
        found = self.ledger.rows().where(F.col("sink") == "rollup").select("batch_id").collect()
        return sorted(r["batch_id"] for r in found)

    def rows(self) -> DataFrame:
        """The rollup's rows as of the last applied load; before the first one, none."""
        versions = self._versions()
        if versions:
            return self.spark.read.parquet(f"{self.path}/versions/{versions[-1]}")
        empty = self.spark.createDataFrame([], f"_t date, {', '.join(f'`{c}` double' for c in set(self.sums.values()))}")
        return rollup_partials(empty, "_t", self.sums).limit(0)

    def apply(self, load: DataFrame, time_col: str, load_id: str) -> bool:
        """Merge a load into the rollup; false if it was applied before. Late days add to the levels they belong to.

        Reads the load and the stored rollup (one row per day and level), and writes a new version beside the last one. A run
        that was cut off leaves a version that the ledger does not name, and the next one replaces it.
        """
        versions = self._versions()
        if any(v.split(".", 1)[1] == check_batch(load_id) for v in versions):
            return False
        merged = (self.rows().unionByName(rollup_partials(load, time_col, self.sums)).groupBy("level", *ROLLUP_KEYS)
                  .agg(F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in self.sums]))
        version = f"{len(versions):08d}.{load_id}"
        merged.coalesce(8).write.mode("overwrite").parquet(f"{self.path}/versions/{version}")
        self.ledger.commit("rollup", version)
        return True
