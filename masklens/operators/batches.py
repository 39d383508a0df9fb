"""Repeatable batch appends (K2, K3, K4, K6, K7): a rerun writes each row once.

The original appends, so a run that is repeated after a failure duplicates
what it had already written. Here a load is a batch with a name. Every table
holds a batch in a partition of its own, which a rerun overwrites, and a
ledger records each batch and table once its write has been committed:

* a write that was cut off is not in the ledger, and its partition is replaced;
* a write that is in the ledger is not repeated;
* readers that go by the ledger (:func:`committed`) see whole batches only.

Gold tables are partitioned by batch too; the copy takes every batch that is
committed in Silver and not yet in Gold, and replaces those partitions only
(dynamic partition overwrite).
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from masklens import schemas
from masklens.operators import config, contract, sinks

BRONZE, SILVER_OPS, SILVER_CONFIG = "bronze/masking_data", "silver/masking_logs_results", "silver/masking_config_results"
LEDGER = "ledger"
STAGES = ("bronze", "silver", "gold")
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")
_LEDGER_SCHEMA = "committed_at timestamp, sink string, batch_id string"


def check_batch(batch_id: str) -> str:
    """A batch's name is a folder name."""
    if not _NAME.fullmatch(batch_id):
        raise ValueError(f"{batch_id!r} is not a batch name")
    return batch_id


class Ledger:
    """Committed (sink, batch) pairs: one small file each, so that committing twice changes nothing."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{LEDGER}"

    def rows(self) -> DataFrame:
        """``sink``, ``batch_id``, ``committed_at`` of every committed write."""
        try:
            return self.spark.read.schema(_LEDGER_SCHEMA).parquet(self.path).select("sink", "batch_id", "committed_at")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], "sink string, batch_id string, committed_at timestamp")

    def has(self, sink: str, batch_id: str) -> bool:
        return bool(self.rows().where((F.col("sink") == sink) & (F.col("batch_id") == batch_id)).limit(1).count())

    def commit(self, sink: str, batch_id: str) -> None:
        (self.spark.range(1).select(F.current_timestamp().alias("committed_at")).write.mode("overwrite")
         .parquet(f"{self.path}/sink={sink}/batch_id={check_batch(batch_id)}"))


def sink_name(path: str) -> str:
    return path.replace("/", ".")


def write_batch(df: DataFrame, ledger: Ledger, root: str, table: str, batch_id: str, fmt: str = "parquet") -> bool:
    """Write a batch to its own folder of a table and commit it; false if it was committed before."""
    if ledger.has(sink_name(table), batch_id):
        return False
    sinks.overwrite_path(df, f"{root}/{table}/batch_id={check_batch(batch_id)}", fmt)
    ledger.commit(sink_name(table), batch_id)
    return True


def committed(spark: SparkSession, ledger: Ledger, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A batch table's rows of committed batches, with ``batch_id``. Partitions of other batches are not read: the ledger's
    batches prune them when the query runs."""
    rows = (spark.read.format(fmt).option("basePath", f"{root}/{table}").load(f"{root}/{table}")
            .withColumn("batch_id", F.col("batch_id").cast("string")))
    done = ledger.rows().where(F.col("sink") == sink_name(table)).select("batch_id")
    return rows.join(done, "batch_id", "left_semi")


def create_gold_batches(spark: SparkSession, database: str = sinks.GOLD_DB, location: str | None = None,
                        fmt: str = "parquet") -> None:
    """K9 with batches: the two Gold tables, partitioned by ``batch_id``, if missing."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    for name, schema in ((sinks.GOLD_LOGS, schemas.SILVER_OPS), (sinks.GOLD_CONFIG, schemas.SILVER_CONFIG)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}, batch_id string) USING {fmt} PARTITIONED BY (batch_id)")


def copy_batches_to_gold(spark: SparkSession, ledger: Ledger, root: str, database: str = sinks.GOLD_DB) -> dict:
    """K6, K7: every batch that is committed in Silver and not in Gold, in one write a table. The second copy runs whether or
    not the first failed. Returns {table: None or the error text}; the driver holds the names of the new batches."""
    result: dict = {}
    for source, name, schema in ((SILVER_OPS, sinks.GOLD_LOGS, schemas.SILVER_OPS), (SILVER_CONFIG, sinks.GOLD_CONFIG, schemas.SILVER_CONFIG)):
        sink = f"{database}.{name}"
        target = StructType([*schema.fields, StructField("batch_id", StringType())])
        told = ledger.rows()
        new = (told.where(F.col("sink") == sink_name(source)).select("batch_id")
               .exceptAll(told.where(F.col("sink") == sink).select("batch_id")))
        batches = sorted(r["batch_id"] for r in new.collect())
        try:
            if batches:
                rows = committed(spark, ledger, root, source).where(F.col("batch_id").isin(batches))
                _replace_partitions(spark, sinks.conform(rows, target), sink, batches)
                for batch_id in batches:
                    ledger.commit(sink, batch_id)
            result[name] = None
        except Exception as exc:  # one copy failing does not stop the other
            result[name] = str(exc)
    return result


def _replace_partitions(spark: SparkSession, rows: DataFrame, table: str, batches: list[str]) -> None:
    # a batch without rows has no partition to overwrite: what a cut-off run left of it goes first
    gone = ", ".join(f"PARTITION (batch_id = '{check_batch(b)}')" for b in batches)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {gone}")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.hint("rebalance").write.mode("overwrite").insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def run_batch(spark: SparkSession, load: DataFrame, batch_id: str, root: str, database: str = sinks.GOLD_DB,
              processed_time=None, until: str = STAGES[-1]) -> dict:
    """One load through Bronze, Silver and Gold; may be repeated at any time with the same load, and after any failure.

    ``load`` has Bronze rows. Stages read what the stage before has written. ``until`` stops the run after a stage.
    Returns what the Gold copy returns (empty if it was not reached).
    """
    if until not in STAGES:
        raise ValueError(f"{until!r} is no stage")
    ledger = Ledger(spark, root)
    write_batch(load.select(*[f.name for f in schemas.BRONZE.fields]), ledger, root, BRONZE, batch_id)
    if until == "bronze":
        return {}
    bronze = spark.read.schema(schemas.BRONZE).parquet(f"{root}/{BRONZE}/batch_id={batch_id}")
    write_batch(contract.silver_operations(bronze, processed_time=processed_time), ledger, root, SILVER_OPS, batch_id)
    write_batch(config.flatten_config(bronze), ledger, root, SILVER_CONFIG, batch_id)
    return {} if until == "silver" else copy_batches_to_gold(spark, ledger, root, database)
