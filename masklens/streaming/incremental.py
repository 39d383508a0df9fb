"""Bronze -> Silver as an incremental Structured Streaming job (Q13).

The original re-reads the whole Bronze table on every run and appends, so a
rerun duplicates Silver rows. Here Bronze files are a streaming source; each
trigger picks up only files not seen before (tracked in the checkpoint), and
each micro-batch runs the same batch operators. A Bronze row holds a whole
document, so parsing needs no state between micro-batches.

Writes are idempotent: every micro-batch overwrites its own ``batch_id=N``
folder as a whole, so a batch replayed after a failure replaces what it wrote
before, also when it has no rows any more. The checkpoint belongs to the
Silver root, and no Bronze file is too old to be picked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masklens import schemas
from masklens.operators import config, contract

# The file source forgets files older than this against the newest one it has
# seen; by default seven days, after which late or copied files are lost.
MAX_FILE_AGE = "100000d"


def _write_batch(df: DataFrame, path: str, batch_id: int, fmt: str) -> None:
    # the batch's own folder: a dynamic overwrite would leave it alone when df is empty
    df.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")


def process_batch(bronze: DataFrame, batch_id: int, silver_root: str, fmt: str = "parquet",
                  processed_by: str = contract.DEFAULT_PROCESSED_BY) -> None:
    """One micro-batch: Silver operations, Silver config and quarantine rows."""
    bronze = bronze.persist()
    ops = contract.parse_masking_logs(bronze).persist()  # parsed once for both writes
    try:
        _write_batch(contract.conform_operations(ops, processed_by=processed_by),
                     f"{silver_root}/masking_logs_results", batch_id, fmt)
        _write_batch(config.flatten_config(bronze), f"{silver_root}/masking_config_results", batch_id, fmt)
        quarantined = contract.quarantine_documents(bronze, ops).withColumn(
            "source", F.lit("log")).unionByName(
            config.config_quarantine(bronze).withColumn("source", F.lit("config"))
            .withColumn("load_date", F.lit(None).cast("timestamp")))
        _write_batch(quarantined, f"{silver_root}/quarantine", batch_id, fmt)
    finally:
        ops.unpersist()
        bronze.unpersist()


def run_incremental(spark: SparkSession, bronze_path: str, silver_root: str,
                    checkpoint: str | None = None, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> None:
    """Process every Bronze file not processed yet, then stop (availableNow).

    ``fmt`` is a file format. The checkpoint defaults to a folder of the Silver
    root, so that another session goes on where the last one stopped.
    """
    if checkpoint is None:
        checkpoint = f"{silver_root.rstrip('/')}/_incremental_checkpoint"
    reader = spark.readStream.schema(schemas.BRONZE).format(fmt).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(bronze_path)
    query = (stream.writeStream
             .foreachBatch(lambda df, bid: process_batch(df, bid, silver_root, fmt))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
