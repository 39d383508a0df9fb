"""Incremental Bronze -> Silver: each Bronze file is processed once."""

from __future__ import annotations

import datetime as dt
import os
import time

from masklens.streaming.incremental import process_batch, run_incremental

LOG = ("01/01/2024 10:00:00 :: COLUMN : C1 Mask Started\n"
       "01/01/2024 10:05:00 :: COLUMN : C1 Mask Finished")
CFG = '{"S": {"T": [{"column_name": "C1", "data_type": "V", "data_length": "1", "pattern_name": "p",' \
      ' "Result": "r", "parameter": "x"}]}}'


def test_incremental_runs_process_new_files_only(spark, tmp_path):
    bronze, silver, ckpt = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ckpt")
    schema = "object_id string, config string, masking_log string, load_date timestamp"
    spark.createDataFrame([("1", CFG, LOG, dt.datetime(2024, 1, 2))], schema).write.mode("append").parquet(bronze)
    run_incremental(spark, bronze, silver, ckpt)
    run_incremental(spark, bronze, silver, ckpt)  # nothing new: no duplicates
    assert spark.read.parquet(f"{silver}/masking_logs_results").count() == 1
    spark.createDataFrame([("2", CFG, LOG, dt.datetime(2024, 1, 3)), ("3", None, None, dt.datetime(2024, 1, 3))],
                          schema).write.mode("append").parquet(bronze)
    run_incremental(spark, bronze, silver, ckpt)
    ops = spark.read.parquet(f"{silver}/masking_logs_results")
    assert sorted(r["object_id"] for r in ops.collect()) == [1, 2]
    assert spark.read.parquet(f"{silver}/masking_config_results").count() == 2
    q = spark.read.parquet(f"{silver}/quarantine").collect()
    assert sorted((r["source"], r["object_id"]) for r in q) == [("config", "3"), ("log", "3")]


def test_old_files_second_session_and_replay(spark, tmp_path):
    """No file is too old; the checkpoint goes with the Silver root; an empty replay clears its batch."""
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    schema = "object_id string, config string, masking_log string, load_date timestamp"
    spark.createDataFrame([("1", CFG, LOG, dt.datetime(2024, 1, 2))], schema).write.mode("append").parquet(bronze)
    run_incremental(spark, bronze, silver)
    before = {p.name for p in (tmp_path / "bronze").glob("*.parquet")}
    spark.createDataFrame([("2", CFG, LOG, dt.datetime(2024, 1, 3))], schema).coalesce(1).write.mode("append").parquet(bronze)
    old = time.time() - 40 * 86400
    for p in (tmp_path / "bronze").glob("*.parquet"):
        if p.name not in before:
            os.utime(p, (old, old))
    run_incremental(spark.newSession(), bronze, silver)
    ops = f"{silver}/masking_logs_results"
    assert sorted(r["object_id"] for r in spark.read.parquet(ops).collect()) == [1, 2]
    process_batch(spark.createDataFrame([], schema), 1, silver)
    assert [r["object_id"] for r in spark.read.parquet(ops).collect()] == [1]
