"""Stand-in inputs built from the driver's tables (see FIXTURES.md).

These builders only produce rows in the schemas the jobs expect (Bronze
documents, landed files, CSV files, feed pages). They do none of the jobs'
work: every query parses, flattens and joins the produced text with the
library's own operators, exactly as it would real landed data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Fixed load stamp of fixture Bronze rows, so results are repeatable.
FIXTURE_LOAD_DATE = _dt.datetime(2024, 2, 1, 0, 0, 0)


# Configured columns per F-CFG object; below 2 * 3 * 5, so that an object's
# (schema, table, column) are all different.
CONFIG_COLUMNS = 13


def _log_message(event_id: Column, event_type: Column) -> Column:
    """F-LOG message of one event (table in FIXTURES.md section 2)."""
    e = event_id
    return (
        F.when(event_type == "signup", F.format_string("COLUMN : C%d Mask Started", e % 5))
        .when(event_type == "purchase", F.format_string("COLUMN : C%d Mask Finished", e % 5))
        .when((event_type == "view") & ((e % 4 == 0) | (e % 4 == 2)),
              F.format_string("TABLE : T%d Mask Started", e % 3))
        .when((event_type == "view") & (e % 4 == 1), F.format_string("TABLE : T%d Mask Ended", e % 3))
        .when((event_type == "view") & (e % 4 == 3), F.lit("Post-mask operations"))
        .when((event_type == "click") & (e % 4 == 0),
              F.format_string("CALCULATED the Row Count for table T = %d", e % 1000))
        .when((event_type == "click") & (e % 4 == 1),
              F.format_string("CALCULATED Distinct Row Count = %d", e % 100))
        .when((event_type == "click") & (e % 4 == 2), F.format_string("CONNECTED to db Schema: S%d", e % 2))
        .when((event_type == "click") & (e % 4 == 3), F.lit("MASKING HAS STARTED"))
        .when((event_type == "error") & (e % 6 == 0), F.format_string("ERROR in step %d", e))
        .when((event_type == "error") & (e % 6 == 1), F.lit("Could not mask value"))
        .when((event_type == "error") & (e % 6 == 2), F.lit("NO Data found"))
        .when((event_type == "error") & (e % 12 == 3), F.lit("pymysql.err.OperationalError"))
        .when((event_type == "error") & (e % 12 == 9), F.lit("lookup.php NOT FOUND"))
        .when((event_type == "error") & (e % 6 == 4), F.lit("ERROR Could Not Enable trigger"))
    )


def f_log_lines(events: DataFrame) -> DataFrame:
    """One log line per event: (object_id, ts, event_id, line)."""
    e, t = F.col("event_id"), F.col("event_type")
    text = F.concat(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"), F.lit(" :: "), _log_message(e, t))
    line = F.when((t == "error") & (e % 6 == 5), F.format_string("garbage line %d", e)).otherwise(text)
    return events.select(F.col("user_id").cast("string").alias("object_id"), "ts", "event_id",
                         line.alias("line"))


# Parts that each F-LOG log is landed in.
LOG_PARTS = 3


def f_log_parts(events: DataFrame, load_date: _dt.datetime = FIXTURE_LOAD_DATE) -> DataFrame:
    """F-LOG as logs that grow: its lines with their number in the log and the part they land in (a third of a log each)."""
    log = Window.partitionBy("object_id")
    numbered = f_log_lines(events).withColumns({
        "line_no": F.row_number().over(log.orderBy("ts", "event_id")).cast("long") - 1, "_n": F.count(F.lit(1)).over(log)})
    return numbered.select("object_id", F.lit(load_date).cast("timestamp").alias("load_date"),
                           F.floor(F.col("line_no") * LOG_PARTS / F.col("_n")).alias("part"), "line_no", "line")


def land_log_files(events: DataFrame, folder: str) -> None:
    """F-LOG as landed text files, one folder ``object_id=...`` with one file per log, lines in log order."""
    (f_log_lines(events).repartition("object_id").sortWithinPartitions("object_id", "ts", "event_id")
     .select("object_id", "line").write.partitionBy("object_id").option("lineSep", "\n").text(folder))


def f_log_bronze(events: DataFrame, load_date: _dt.datetime = FIXTURE_LOAD_DATE) -> DataFrame:
    """F-LOG as Bronze ``masking_data`` rows: one log document per user.

    The lines of a user are ordered by (ts, event_id) and joined by newlines.
    Each document is one text cell, as landed log files are.
    """
    lines = f_log_lines(events)
    docs = lines.groupBy("object_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "line"))),
                        lambda x: x["line"]),
            "\n").alias("masking_log"))
    return docs.select(
        "object_id", F.lit(None).cast("string").alias("config"), "masking_log",
        F.lit(load_date).cast("timestamp").alias("load_date"),
    )


def f_cfg_bronze(part: DataFrame, load_date: _dt.datetime = FIXTURE_LOAD_DATE) -> DataFrame:
    """F-CFG as Bronze rows: one config document per object (``floor(p_partkey / 13)``).

    The objects grow with the table and cover F-LOG's ids; a document has at
    most 13 columns at any size, each with its own (schema, table, column).
    Every part is one configured column; ``lookup`` is present for
    ``p_partkey % 4 < 2``; documents of even objects have every quote doubled.
    """
    k = F.col("p_partkey")
    element = F.map_filter(
        F.create_map(
            F.lit("column_name"), F.concat(F.lit("C"), (k % 5).cast("string")),
            F.lit("data_type"), F.lit("VARCHAR"),
            F.lit("data_length"), F.col("p_size").cast("string"),
            F.lit("pattern_name"), F.col("p_brand"),
            F.lit("Result"), F.col("p_type"),
            F.lit("lookup"), F.when(k % 4 < 2, F.col("p_name")),
            F.lit("parameter"), k.cast("string"),
        ),
        lambda _k, v: v.isNotNull())
    rows = part.select(
        F.floor(k / CONFIG_COLUMNS).alias("oid"),
        F.concat(F.lit("S"), (k % 2).cast("string")).alias("schema"),
        F.concat(F.lit("T"), (k % 3).cast("string")).alias("table"),
        k.alias("key"), element.alias("element"))
    tables = rows.groupBy("oid", "schema", "table").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("key", "element")),
                         lambda a, b: F.signum(a["key"] - b["key"]).cast("int")),
            lambda x: x["element"]).alias("cols"))
    schemas_ = tables.groupBy("oid", "schema").agg(
        F.map_from_entries(F.collect_list(F.struct("table", "cols"))).alias("tables"))
    docs = schemas_.groupBy("oid").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("schema", "tables")))).alias("json"))
    text = F.when(F.col("oid") % 2 == 0, F.replace(F.col("json"), F.lit('"'), F.lit('""'))).otherwise(
        F.col("json"))
    return docs.select(
        F.col("oid").cast("string").alias("object_id"), text.alias("config"),
        F.lit(None).cast("string").alias("masking_log"),
        F.lit(load_date).cast("timestamp").alias("load_date"),
    )


def f_man(pages: DataFrame, documents_: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """F-MAN: (manifest, landed config files, landed log files), from whole tables.

    Every page is landed as a config file (its html) and every document as a
    log file (its text); the manifest lists every page id and document id.
    Ids present in only one table have only one file landed, so the
    "both files present" rule (F3) keeps some manifest rows and drops others.
    """
    ids = pages.select(F.col("page_id").alias("oid")).union(
        documents_.select(F.col("doc_id").alias("oid"))).distinct()
    manifest = ids.select(
        F.col("oid").cast("string").alias("objectID"),
        F.concat(F.lit("landing/"), F.col("oid").cast("string"), F.lit("/results")).alias("Results"),
        F.concat(F.lit("landing/"), F.col("oid").cast("string"), F.lit("/logs")).alias("Logs"))
    configs = pages.select(
        F.concat(F.col("page_id").cast("string"), F.lit("_config.json")).alias("filename"),
        F.col("html").alias("content"))
    logs = documents_.select(
        F.concat(F.col("doc_id").cast("string"), F.lit("_logs.txt")).alias("filename"),
        F.col("text").alias("content"))
    return manifest, configs, logs


# Runs per landed manifest file.
MANIFEST_RUNS = 1000


def land_manifest(manifest: DataFrame, folder: str) -> None:
    """F-MAN's manifest as landed files, each one JSON array of about 1,000 runs."""
    run = F.struct(*manifest.columns)
    (manifest.select(F.floor(F.col("objectID").cast("long") / MANIFEST_RUNS).alias("part"), run.alias("run"))
     .groupBy("part").agg(F.to_json(F.collect_list("run")).alias("value"))
     .write.partitionBy("part").text(folder))


def f_feed_pages(events: DataFrame, customer: DataFrame) -> DataFrame:
    """F-FEED: feed records with the user fields nested in a struct."""
    e = events.alias("e")
    c = customer.alias("c")
    j = e.join(c, F.col("e.user_id") == F.col("c.c_custkey"), "left")
    return j.select(
        F.col("e.event_id").alias("post_id"),
        F.date_format(F.col("e.ts"), "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.struct(F.col("e.user_id").alias("user_id"), F.col("c.c_name").alias("display_name"),
                 F.col("c.c_mktsegment").alias("city")).alias("user"),
        F.col("e.event_type").alias("response_status"),
        F.format_string("%.2f", F.col("e.value")).alias("time_spent"),
        F.array(F.col("e.props")).alias("tags"),
    )


# Records per landed feed page.
FEED_PAGE_RECORDS = 1000


def land_feed_arrays(pages: DataFrame, folder: str) -> None:
    """F-FEED as landed pages: files that hold one JSON array of at most 1,000 records each."""
    record = F.struct(*pages.columns)
    (pages.select(F.floor(F.col("post_id") / FEED_PAGE_RECORDS).alias("page"), record.alias("record"))
     .groupBy("page").agg(F.to_json(F.collect_list("record")).alias("value"))
     .write.partitionBy("page").text(folder))


# F-CHAIN: the feed as linked pages. Seven feeds (``post_id % 7``) of pages of ten records, addressed by a hash, so that
# names tell nothing about the order. Of feed 5 every 40th page has not landed; feed 6 leads back to its first page.
CHAIN_FEEDS, CHAIN_RECORDS = 7, 10
CHAIN_ADDRESS = "https://feed.example/posts?cursor="


def f_linked_pages(pages: DataFrame) -> DataFrame:
    """F-CHAIN pages (page, link, records) from F-FEED records."""
    records = pages.withColumns({
        "_feed": F.col("post_id") % CHAIN_FEEDS, "_k": F.floor(F.col("post_id") / (CHAIN_FEEDS * CHAIN_RECORDS))})

    def address(feed: Column, k: Column) -> Column:
        return F.concat(F.lit(CHAIN_ADDRESS), F.md5(F.concat_ws("-", feed, k)))

    def link(target: Column, rel: str) -> Column:
        return F.concat(F.lit("<"), target, F.lit(f'>; rel="{rel}"'))

    last = records.groupBy("_feed").agg(F.max("_k").alias("_last"))
    grouped = records.groupBy("_feed", "_k").agg(
        F.array_sort(F.collect_list(F.struct(*pages.columns))).alias("records")).join(last, "_feed")
    landed_ = grouped.where(~((F.col("_feed") == 5) & (F.col("_k") % 40 == 17)))
    feed, k = F.col("_feed"), F.col("_k")
    follower = F.when(k < F.col("_last"), address(feed, k + 1)).when(feed == 6, address(feed, F.lit(0)))
    return landed_.select(
        address(feed, k).alias("page"),
        F.concat_ws(", ", F.when(k > 0, link(address(feed, k - 1), "prev")), link(follower, "next")).alias("link"), "records")


# Mapping of the flattened fixture pages onto the feed table.
F_FEED_MAPPING = [
    ("post_id", "post_id"), ("time", "time"), ("user.user_id", "user_id"),
    ("user.display_name", "display_name"), ("response_status", "response_status"),
    ("time_spent", "time_spent"), ("user.city", "city"),
]

# F-CSV: operations go to one of two files by object parity; every 97th line
# number carries a count that is not a number.
F_CSV_FILES = ("LMS_LMSDM_Logs_3_Cycles.csv", "execution_log_azure_mssql.csv")


def f_csv_fact(v1: DataFrame) -> DataFrame:
    """F-CSV rows: the v1 fact with a ``file_name`` and some bad counts."""
    bad = F.col("line_number") % 97 == 7
    return v1.withColumn("row_count", F.when(bad, F.lit("n/a")).otherwise(F.col("row_count").cast("string"))) \
        .withColumn("file_name", F.when(F.col("object_id_num") % 2 == 0, F.lit(F_CSV_FILES[0]))
                    .otherwise(F.lit(F_CSV_FILES[1])))


# F-BAD: faults injected by object id into F-LOG and F-CFG documents.
BAD_LOG_SHORT = "01/02/2024 00:00:00 :: CALCULATED Row for = x"
BAD_LOG_COUNT = ("01/02/2024 00:00:01 :: COLUMN : Q Mask Started\n"
                 "01/02/2024 00:00:02 :: CALCULATED Distinct Row Count = 1,000\n"
                 "01/02/2024 00:00:03 :: COLUMN : Q Mask Finished")


def f_bad_logs(flog: DataFrame) -> DataFrame:
    """F-LOG Bronze with faults: ``object_id % 10`` = 1 short line, 2 bad count,
    3 null log, 4 id that is not an integer; other documents unchanged."""
    oid = F.col("object_id").cast("long")
    log = (F.when(oid % 10 == 1, F.concat_ws("\n", F.col("masking_log"), F.lit(BAD_LOG_SHORT)))
           .when(oid % 10 == 2, F.concat_ws("\n", F.col("masking_log"), F.lit(BAD_LOG_COUNT)))
           .when(oid % 10 == 3, F.lit(None).cast("string"))
           .otherwise(F.col("masking_log")))
    obj = F.when(oid % 10 == 4, F.concat(F.lit("obj-"), F.col("object_id"))).otherwise(F.col("object_id"))
    return flog.select(obj.alias("object_id"), "config", log.alias("masking_log"), "load_date")


def f_bad_configs(fcfg: DataFrame) -> DataFrame:
    """F-CFG Bronze with faults by ``object_id % 7``: 1 malformed, 2 array at the
    top, 3 object where an array belongs, 4 element without ``parameter``,
    5 trailing text, 6 null config; 0 unchanged (quotes stay doubled where
    they were)."""
    oid = F.col("object_id").cast("long")
    q = F.when(oid % 2 == 0, F.lit('""')).otherwise(F.lit('"'))
    c = F.col("config")
    param = F.concat(F.lit(","), q, F.lit("parameter"), q, F.lit(":"), q, F.lit("[0-9]+"), q)
    text = (F.when(oid % 7 == 1, F.expr("substring(config, 1, length(config) - 1)"))
            .when(oid % 7 == 2, F.concat(F.lit("["), c, F.lit("]")))
            .when(oid % 7 == 3, F.replace(F.replace(c, F.lit("["), F.concat(F.lit("{"), q, F.lit("x"), q, F.lit(":["))),
                                          F.lit("]"), F.lit("]}")))
            .when(oid % 7 == 4, F.regexp_replace(c, param, F.lit("")))
            .when(oid % 7 == 5, F.concat(c, F.lit(" x")))
            .when(oid % 7 == 6, F.lit(None).cast("string"))
            .otherwise(c))
    return fcfg.select("object_id", text.alias("config"), "masking_log", "load_date")
