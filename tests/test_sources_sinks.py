"""Readers of landed files, feed pages and the CSV model; Gold conforming."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from masklens import schemas
from masklens.operators import contract, sinks
from masklens.sources import csv_v1, feed, landed

LOAD = dt.datetime(2024, 2, 1)


def test_manifest_and_landed_files_from_disk(spark, tmp_path):
    (tmp_path / "manifest.json").write_text(json.dumps([
        {"objectID": 1, "Results": "http://h/1/r", "Logs": "http://h/1/l"},
        {"objectID": 2, "Results": "http://h/2/r", "Logs": "http://h/2/l"},
        {"objectID": 3, "Results": "http://h/3/r", "Logs": "http://h/3/l"},
    ], indent=2))
    cfg_dir, log_dir = tmp_path / "configs", tmp_path / "logs"
    cfg_dir.mkdir()
    log_dir.mkdir()
    (cfg_dir / "1_config.json").write_text('{"S": {"T": []}}')
    (cfg_dir / "3_config.json").write_text('{"S": {}}')
    (log_dir / "1_logs.txt").write_text("01/01/2024 10:00:00 :: MASKING HAS STARTED\nline two\n")
    (log_dir / "2_logs.txt").write_text("x")
    manifest = landed.read_manifest(spark, str(tmp_path / "manifest.json"))
    configs = landed.read_landed_files(spark, str(cfg_dir))
    logs = landed.read_landed_files(spark, str(log_dir))
    bronze = landed.bronze_documents(manifest, configs, logs, load_date=LOAD).collect()
    assert [(r["object_id"], r["config"], r["masking_log"]) for r in bronze] == [
        ("1", '{"S": {"T": []}}', "01/01/2024 10:00:00 :: MASKING HAS STARTED\nline two\n")]
    c, lg = landed.landed_halves(manifest, configs, logs)
    assert sorted(r["filename"] for r in c.collect()) == ["1_config.json", "3_config.json"]
    assert sorted(r["filename"] for r in lg.collect()) == ["1_logs.txt", "2_logs.txt"]


def test_feed_pages_flattened_and_mapped(spark, tmp_path):
    pages = tmp_path / "feed"
    pages.mkdir()
    (pages / "page1.json").write_text(json.dumps([
        {"post_id": 7, "time": "2024-01-01", "user": {"user_id": 3, "display_name": "Ann",
                                                       "geo": {"city": "Oslo"}}, "tags": ["a"]},
    ]))
    df = feed.read_feed_pages(spark, str(pages), "post_id long, time string, user struct<user_id: long, display_name: string, "
                                                 "geo: struct<city: string>>, tags array<string>")
    flat = feed.flatten(df)
    assert set(flat.columns) == {"post_id", "time", "user.user_id", "user.display_name", "user.geo.city"}
    rows = feed.feed_rows(df, [("post_id", "post_id"), ("user.user_id", "user_id"),
                               ("user.geo.city", "city")]).collect()
    assert rows[0].asDict() == {**{k: None for k in schemas.FEED_FIELDS},
                                "post_id": "7", "user_id": "3", "city": "Oslo"}


def test_csv_model_file_selection(spark, tmp_path):
    fact = spark.createDataFrame(
        [(1, "S", "T", "12", 3, "C", "Passed", dt.datetime(2024, 1, 1, 1), None, 60, 1.0, None, 4, "a.csv"),
         (1, "S", "T", "x", 3, "C", "Failed", dt.datetime(2024, 1, 1, 2), None, 0, 0.0, "é", 9,
          "LMS_LMSDM_Logs_3_Cycles.csv")],
        "cycle long, schema string, table string, row_count string, distinct_row_count long, `column` string,"
        " status string, start_time timestamp, end_time timestamp, `duration(s)` long, `duration(min)` double,"
        " error string, line_number long, file_name string")
    folder = str(tmp_path / "csv")
    csv_v1.write_ops_csv(fact, folder)
    got = csv_v1.read_selected(spark, folder, "LMS_LMSDM_Logs_3_Cycles.csv").collect()
    assert len(got) == 1
    r = got[0]
    assert (r["row_count"], r["status"], r["error"], r["end_time"], r["line_number"]) == (None, "Failed", "é", None, 9)
    assert all("LMS_LMSDM" in f for f in csv_v1.read_selected(spark, folder).inputFiles())
    try:
        csv_v1.read_selected(spark, folder, "other.csv")
        raise AssertionError("expected a rejected file name")
    except ValueError:
        pass


def test_gold_conform_cuts_text_and_casts(spark):
    df = spark.createDataFrame([("x" * 9000, "12", "1.5")], "schema string, object_id string, row_count string")
    out = sinks.conform(df, schemas.SILVER_OPS)
    assert out.columns == [f.name for f in schemas.SILVER_OPS]
    r = out.first()
    assert len(r["schema"]) == 8000 and r["object_id"] == 12 and r["row_count"] == 1.5 and r["cycle"] is None


def test_gold_tables_created_and_copied(spark, tmp_path):
    sinks.create_gold(spark, location=str(tmp_path / "gold"))
    for name in (sinks.GOLD_LOGS, sinks.GOLD_CONFIG):
        sinks.drop_table(spark, f"{sinks.GOLD_DB}.{name}")
    sinks.create_gold(spark)
    ops = spark.createDataFrame([(1, "S")], "cycle int, schema string")
    cfg = spark.createDataFrame([(1, "S", "T")], "object_id int, schema string, table string")
    assert sinks.copy_to_gold(spark, ops, cfg) == {sinks.GOLD_LOGS: None, sinks.GOLD_CONFIG: None}
    assert spark.table(f"{sinks.GOLD_DB}.{sinks.GOLD_LOGS}").count() == 1
    assert sinks.preview(spark.table(f"{sinks.GOLD_DB}.{sinks.GOLD_CONFIG}")).count() == 1


def test_csv_named_file_in_plain_folder(spark, tmp_path):
    header = "cycle,schema,table,row_count,distinct_row_count,column,status,start_time,end_time,duration(s),duration(min),error,line_number\n"
    (tmp_path / "LMS_LMSDM_Logs_3_Cycles.csv").write_bytes(
        (header + "1,S,T,12,3,C,Passed,2024-01-01 10:00:00,2024-01-01 10:01:00,60,1.0,café,4\n").encode("cp1252"))
    (tmp_path / "execution_log_azure_mssql.csv").write_bytes(
        (header + "1,S,T,x,3,C,Failed,,,0,0,,9\n").encode("cp1252"))
    rows = csv_v1.read_named_file(spark, str(tmp_path), "LMS_LMSDM_Logs_3_Cycles.csv").collect()
    assert [(r["row_count"], r["error"], r["duration(s)"], r["start_time"]) for r in rows] == [
        (12, "café", 60, dt.datetime(2024, 1, 1, 10, 0))]
    other = csv_v1.read_named_file(spark, str(tmp_path), "execution_log_azure_mssql.csv").collect()
    assert [(r["row_count"], r["status"], r["end_time"], r["error"]) for r in other] == [(None, "Failed", None, "")]


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    names = [f.name for f in schemas.OPS_CSV_V1.fields]
    values = {**{n: "" for n in names}, "cycle": "3", "schema": "S", "table": "T", "start_time": "2024-01-01T10:00:00"}
    mixed = sorted(names)
    (tmp_path / csv_v1.DEFAULT_FILE).write_text(",".join(mixed) + "\n" + ",".join(values[n] for n in mixed) + "\n")
    r = csv_v1.read_named_file(spark, str(tmp_path)).first()
    assert (r["cycle"], r["schema"], r["table"], r["start_time"]) == (3, "S", "T", dt.datetime(2024, 1, 1, 10))
    (tmp_path / "abcd").write_text("cycle,schema\n1,S\n")
    with pytest.raises(ValueError, match="lacks table"):
        csv_v1.read_named_file(spark, str(tmp_path), "abcd")


def test_feed_pages_as_lines_and_arrays(spark, tmp_path):
    records = [{"post_id": str(i), "city": "Oslo"} for i in range(5)]
    for mode, text in (("lines", "\n".join(map(json.dumps, records))), ("array", json.dumps(records, indent=1))):
        folder = tmp_path / mode
        folder.mkdir()
        (folder / "page.json").write_text(text)
        rows = feed.feed_rows(feed.read_feed_pages(spark, str(folder), mode=mode)).collect()
        assert sorted(r["post_id"] for r in rows) == list("01234") and {r["city"] for r in rows} == {"Oslo"}
    with pytest.raises(ValueError):
        feed.read_feed_pages(spark, str(tmp_path), mode="both")


def test_gold_text_is_cut_between_characters(spark):
    texts = ["", None, "abc", "a\u00e9", "\u00e9\u00e9", "a\u20ac\u20ac", "\U0001f600\U0001f600", "abc\U0001f600"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (1, 2, 3, 4, 5, 6):
        for t, cut in df.select("t", sinks.cut_bytes(F.col("t"), n)).collect():
            assert cut == (None if t is None else t.encode()[:n].decode("utf-8", "ignore")), (t, n)


def test_log_files_larger_than_a_split(spark, tmp_path):
    """One file read in several splits gives its lines in order, and the same operations as the whole text."""


    text = "\n".join(
        f"01/01/2024 {h:02d}:{m:02d}:{s:02d} :: COLUMN : C{s % 7} Mask {'Started' if s % 2 == 0 else 'Finished'}"
        for h in range(4) for m in range(60) for s in range(60))
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "5_logs.txt").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        lines = landed.read_log_lines(spark, str(tmp_path / "logs"))
        assert lines.select("split_start").distinct().count() > 5
        assert [r["line"] for r in lines.orderBy(*landed.LINE_ORDER).collect()] == text.split("\n")
        ops = contract.parse_landed_lines(lines, landed.LINE_ORDER, ident=("filename",)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = spark.createDataFrame([("5", text, LOAD)], "object_id string, masking_log string, load_date timestamp")
    fields = ("column", "status", "start_time", "end_time", "duration_secs")
    expected = [tuple(r[f] for f in fields) for r in contract.parse_masking_logs(whole).collect()]
    assert len(expected) == 7200
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r[f] for f in fields)) for r in ops)


def test_two_log_files_of_one_object_keep_their_own_state(spark, tmp_path):
    """The file is part of a log's identity: a column that one file starts is not finished by the other."""
    folder = tmp_path / "logs" / "object_id=7"
    folder.mkdir(parents=True)
    stamp = "01/02/2024 00:00:0%d :: %s\n"
    (folder / "a.txt").write_text(stamp % (1, "COLUMN : A Mask Started") + stamp % (2, "COLUMN : A Mask Finished"))
    (folder / "b.txt").write_text(stamp % (3, "COLUMN : B Mask Started") + stamp % (4, "MASKING HAS STARTED"))
    lines = landed.read_log_lines(spark, str(tmp_path / "logs")).withColumns(
        {"object_id": F.col("object_id").cast("string"), "load_date": F.lit("2024-02-01").cast("timestamp")})
    ops = contract.parse_landed_lines(lines, landed.LINE_ORDER, ident=("object_id", "load_date", "filename"))
    got = {(r.column, r.status, r.cycle) for r in contract.conform_operations(ops).collect()}
    assert got == {("A", "Passed", 0), ("B", "Failed", 1)}
