"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (or data Spark derives from them) and
runs the library's operators over all of it.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masklens.operators import batches, calendar, config, contract, joins, layout, loads, measures, sinks
from masklens.operators.loglines import documents, log_lines
from masklens.plans import fixtures
from masklens.session import ensure_checkpoint_dir
from masklens.sources import csv_v1, feed, landed
from masklens.streaming import growing

# Fixed processing stamp of registered queries, so results are repeatable.
PROCESSED_TIME = _dt.datetime(2024, 2, 1, 0, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flog_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.f_log_bronze(table(spark, sf_dir, "events"))


def q_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid lines of every F-LOG document with their parts."""
    lines = log_lines(documents(flog_bronze(spark, sf_dir)))
    return lines.select("object_id", "line_no", "log_time", "message",
                        F.size("tokens").alias("n_tokens"))


def q_masking_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every masking operation of every F-LOG document."""
    ops = contract.parse_masking_logs(flog_bronze(spark, sf_dir))
    ops = contract.expand_copies(ops.where(F.col("bad_reason").isNull()))
    return ops.select("object_id", "line_no", "cycle", "schema", "table", "row_count",
                      "distinct_row_count", "column", "status", "start_time", "end_time",
                      "duration_secs", "duration_mins", "error")


def q_masking_ops_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver operations table (15 typed columns)."""
    return contract.silver_operations(flog_bronze(spark, sf_dir), processed_time=PROCESSED_TIME)


def q_masking_ops_landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1-R14 on F-LOG landed one line per row (no log assembled anywhere).

    Same Silver rows as ``masking_ops_contract``; each log is cut into chunks
    by a global sort, and state is carried between chunks.
    """
    lines = fixtures.f_log_lines(table(spark, sf_dir, "events")).withColumn(
        "load_date", F.lit(fixtures.FIXTURE_LOAD_DATE).cast("timestamp"))
    ops = contract.parse_landed_lines(lines, ["ts", "event_id"])
    return contract.conform_operations(ops, processed_time=PROCESSED_TIME)


def q_masking_ops_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2, R1-R14 on F-LOG landed as text files, read by splits and never as whole files.

    Same Silver rows as ``masking_ops_contract``.
    """
    folder = scratch_folder(spark, "log-files")
    fixtures.land_log_files(table(spark, sf_dir, "events"), folder)
    lines = landed.read_log_lines(spark, folder).withColumns({
        "object_id": F.col("object_id").cast("string"),
        "load_date": F.lit(fixtures.FIXTURE_LOAD_DATE).cast("timestamp")})
    # a log is a file: two files of one object keep their own state
    ops = contract.parse_landed_lines(lines, landed.LINE_ORDER, ident=("object_id", "load_date", "filename"))
    return contract.conform_operations(ops, processed_time=PROCESSED_TIME)


def fcfg_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.f_cfg_bronze(table(spark, sf_dir, "part"))


def q_config_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every configured column of every F-CFG document (10 columns)."""
    return config.flatten_config(fcfg_bronze(spark, sf_dir))


def q_config_nine_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine-column form."""
    return config.config_nine_columns(fcfg_bronze(spark, sf_dir))


def q_config_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine- and ten-column appends as one union by name."""
    return config.config_union(fcfg_bronze(spark, sf_dir))


def q_config_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: count(distinct object_id) over the flattened config."""
    return config.distinct_objects(config.flatten_config(fcfg_bronze(spark, sf_dir)))


def q_ops_config_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver operations joined to Silver config on object_id."""
    ops = contract.silver_operations(flog_bronze(spark, sf_dir), processed_time=PROCESSED_TIME)
    return joins.ops_config_join(ops, config.flatten_config(fcfg_bronze(spark, sf_dir)))


def q_ops_own_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each operation with the config row of its own column."""
    ops = contract.silver_operations(flog_bronze(spark, sf_dir), processed_time=PROCESSED_TIME)
    return joins.ops_own_config(ops, config.flatten_config(fcfg_bronze(spark, sf_dir)))


def q_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the years of ``o_orderdate``."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("_day")).distinct()
    return calendar.date_dimension(days, "_day")


def q_fact_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 x2: line items by the quarter of their order date and of their ship date."""
    orders = table(spark, sf_dir, "orders")
    items = table(spark, sf_dir, "lineitem")
    fact = items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
    # partial sums per (start day, end day) before relating the two calendars
    daily = fact.groupBy(F.to_date("o_orderdate").alias("_start"),
                         F.to_date("l_shipdate").alias("_end")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"),
        F.sum("l_extendedprice").alias("price"))
    rel = calendar.relate_dates(daily, calendar.date_dimension(daily, "_start"), "_start", "start_")
    rel = calendar.relate_dates(rel, calendar.date_dimension(daily, "_end"), "_end", "end_")
    return rel.groupBy("start_Year", "start_QuarterNo", "end_Year", "end_QuarterNo").agg(
        F.sum("n").alias("n_lines"), F.sum("qty").alias("sum_qty"),
        F.round(F.sum("price"), 2).alias("revenue"))


def q_date_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders summed over Year > Quarter > Month > Day with subtotals."""
    orders = table(spark, sf_dir, "orders")
    daily = orders.groupBy(F.to_date("o_orderdate").alias("_day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("price"))
    rel = calendar.relate_dates(daily, calendar.date_dimension(daily, "_day"), "_day", "")
    out = calendar.drilldown(rel, {"n_orders": F.sum("n"),
                                   "total_price": F.round(F.sum("price"), 2)})
    return out.withColumn("level", F.col("level").cast("int"))


def q_default_sums_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4: the Gold model's default sums by schema, table and status."""
    ops = contract.silver_operations(flog_bronze(spark, sf_dir), processed_time=PROCESSED_TIME)
    return measures.default_sums_gold(ops, ["schema", "table", "status"])


def q_default_sums_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, A4: the first model's default sums by status, over the v1 fact."""
    ops = contract.parse_masking_logs(flog_bronze(spark, sf_dir))
    return measures.default_sums_v1(measures.v1_fact(ops), ["status"])


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_default_sums_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4: the Gold config model's default sum (object_id) by schema and table."""
    return measures.default_sums_config(config.flatten_config(fcfg_bronze(spark, sf_dir)), ["schema", "table"])


def q_ops_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 x2 on the operations fact: start and end dates related to their calendars.

    As the dashboard model relates ``start_time`` and ``end_time`` (date part)
    to two role-playing calendars: operations and summed durations per start
    month and end month.
    """
    ops = contract.parse_masking_logs(flog_bronze(spark, sf_dir))
    fact = measures.v1_fact(ops)
    daily = fact.groupBy(F.to_date("start_time").alias("_s"), F.to_date("end_time").alias("_e")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration(s)").alias("secs"))
    rel = calendar.relate_dates(daily, calendar.date_dimension(daily, "_s"), "_s", "start_")
    rel = calendar.relate_dates(rel, calendar.date_dimension(daily, "_e"), "_e", "end_")
    return rel.groupBy("start_Year", "start_MonthNo", "start_Month", "end_Year", "end_MonthNo",
                       "end_Month").agg(F.sum("n").alias("n_ops"), F.sum("secs").alias("duration_secs"))


def q_manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows for manifest objects with both files landed."""
    manifest, configs, logs = fixtures.f_man(table(spark, sf_dir, "pages"),
                                             table(spark, sf_dir, "documents"))
    return landed.bronze_documents(manifest, configs, logs, load_date=fixtures.FIXTURE_LOAD_DATE)


def q_manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a manifest that has landed as JSON files."""
    manifest, configs, logs = fixtures.f_man(table(spark, sf_dir, "pages"),
                                             table(spark, sf_dir, "documents"))
    folder = scratch_folder(spark, "manifest")
    fixtures.land_manifest(manifest, folder)
    return landed.bronze_documents(landed.read_manifest(spark, folder), configs, logs, load_date=fixtures.FIXTURE_LOAD_DATE)


def q_activity_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested feed records flattened onto the sixteen feed columns."""
    pages = fixtures.f_feed_pages(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"))
    return feed.feed_rows(pages, fixtures.F_FEED_MAPPING)


def q_csv_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v1 operations written as two CSV files; one read back by name."""
    ops = contract.parse_masking_logs(flog_bronze(spark, sf_dir))
    v1 = measures.v1_fact(ops, extra=(F.col("object_id").cast("long").alias("object_id_num"),))
    folder = scratch_folder(spark, "ops-csv")
    csv_v1.write_ops_csv(fixtures.f_csv_fact(v1), folder)
    return csv_v1.read_selected(spark, folder, csv_v1.DEFAULT_FILE)


def q_gold_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver operations conformed to the Gold logs table (the rows the K6 copy writes)."""
    ops = contract.silver_operations(flog_bronze(spark, sf_dir), processed_time=PROCESSED_TIME)
    return sinks.gold_logs(ops)


def q_gold_config_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver config conformed to the Gold config table (the rows the K7 copy writes)."""
    return sinks.gold_config(config.flatten_config(fcfg_bronze(spark, sf_dir)))


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty log and config documents with the reason."""
    bad_logs = fixtures.f_bad_logs(flog_bronze(spark, sf_dir))
    ops = contract.parse_masking_logs(bad_logs)
    logs_q = contract.quarantine_documents(bad_logs, ops).select(
        F.lit("log").alias("source"), "object_id", "reason")
    cfg_q = config.config_quarantine(fixtures.f_bad_configs(fcfg_bronze(spark, sf_dir))).select(
        F.lit("config").alias("source"), "object_id", "reason")
    return logs_q.unionByName(cfg_q)


def q_quarantine_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good documents of the faulty input come out unchanged."""
    bad_logs = fixtures.f_bad_logs(flog_bronze(spark, sf_dir))
    return contract.silver_operations(bad_logs, processed_time=PROCESSED_TIME)


def q_config_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Config rows of the faulty input's good documents."""
    return config.flatten_config(fixtures.f_bad_configs(fcfg_bronze(spark, sf_dir)))


def _lifecycle(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """K1-K10 (K4 as one ten-column append, Q14), S4-S7: land, Bronze, Silver, join, feed, Gold; the written tables.

    Every stage is written and the next stage reads the written table. Gold goes to a database of this run
    alone, so no other table is touched.
    """
    base = scratch_folder(spark, "lifecycle")
    flog, fcfg = flog_bronze(spark, sf_dir), fcfg_bronze(spark, sf_dir)
    manifest = flog.select(F.col("object_id").alias("objectID"))
    cfg_files = fcfg.select(landed.config_file_name(F.col("object_id")).alias("filename"),
                            F.col("config").alias("content"))
    log_files = flog.select(landed.log_file_name(F.col("object_id")).alias("filename"),
                            F.col("masking_log").alias("content"))
    c_half, l_half = landed.landed_halves(manifest, cfg_files, log_files)
    sinks.append_path(c_half, f"{base}/landing/configs")                       # K1
    sinks.append_path(l_half, f"{base}/landing/logs")
    configs = spark.read.parquet(f"{base}/landing/configs")
    logs = spark.read.parquet(f"{base}/landing/logs")
    sinks.append_path(landed.bronze_documents(manifest, configs, logs, fixtures.FIXTURE_LOAD_DATE),
                      f"{base}/bronze/masking_data")                            # K2
    bronze = spark.read.parquet(f"{base}/bronze/masking_data")                  # S4
    sinks.append_path(contract.silver_operations(bronze, processed_time=PROCESSED_TIME),
                      f"{base}/silver/masking_logs_results")                    # K3
    sinks.append_path(config.flatten_config(bronze), f"{base}/silver/masking_config_results")  # K4
    ops = spark.read.parquet(f"{base}/silver/masking_logs_results")             # S5
    cfg = spark.read.parquet(f"{base}/silver/masking_config_results")
    sinks.overwrite_path(joins.ops_config_join(ops, cfg), f"{base}/silver/joined_masking_results")  # K5
    feed_rows = feed.feed_rows(fixtures.f_feed_pages(table(spark, sf_dir, "events"),
                                                     table(spark, sf_dir, "customer")),
                               fixtures.F_FEED_MAPPING)
    sinks.append_path(feed_rows, f"{base}/landing/activity_feed")               # K8
    gold = f"{sinks.GOLD_DB}_{uuid.uuid4().hex}"
    sinks.create_gold(spark, location=f"{base}/gold", database=gold)            # K9
    for name in (sinks.GOLD_LOGS, sinks.GOLD_CONFIG):
        sinks.drop_table(spark, f"{gold}.{name}")                               # K10
    sinks.create_gold(spark, database=gold)
    errors = sinks.copy_to_gold(spark, ops, cfg, database=gold)                 # K6, K7
    failed = {k: v for k, v in errors.items() if v}
    if failed:
        raise RuntimeError(f"Gold copy failed: {failed}")
    return {"gold_logs": spark.table(f"{gold}.{sinks.GOLD_LOGS}"),              # S6, S11
            "gold_config": spark.table(f"{gold}.{sinks.GOLD_CONFIG}"),
            "join": spark.read.parquet(f"{base}/silver/joined_masking_results"),
            "feed": spark.read.parquet(f"{base}/landing/activity_feed")}


def q_table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold logs table after a whole lifecycle."""
    return _lifecycle(spark, sf_dir)["gold_logs"]


def q_lifecycle_gold_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold config table after a whole lifecycle."""
    return _lifecycle(spark, sf_dir)["gold_config"]


def q_lifecycle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the written join of operations and config, read back."""
    return _lifecycle(spark, sf_dir)["join"]


def q_lifecycle_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: the written activity feed, read back."""
    return _lifecycle(spark, sf_dir)["feed"]


def q_feed_page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed pages landed as JSON files (one record per line), read by the page reader and mapped."""
    pages = fixtures.f_feed_pages(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"))
    folder = scratch_folder(spark, "feed-pages")
    pages.write.json(folder)
    return feed.feed_rows(feed.read_feed_pages(spark, folder, pages.schema, mode="lines"), fixtures.F_FEED_MAPPING)


def q_feed_page_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed pages landed as JSON files (one array per file), read by the page reader and mapped."""
    pages = fixtures.f_feed_pages(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"))
    folder = scratch_folder(spark, "feed-arrays")
    fixtures.land_feed_arrays(pages, folder)
    return feed.feed_rows(feed.read_feed_pages(spark, folder, pages.schema, mode="array"), fixtures.F_FEED_MAPPING)


def _landed_chain(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Linked pages landed as JSON lines and read back, and where each stands in its chain."""
    records = fixtures.f_feed_pages(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"))
    folder = scratch_folder(spark, "feed-chain")
    fixtures.f_linked_pages(records).write.json(folder)
    pages = feed.read_feed_pages(spark, folder, feed.linked_page_schema(records.schema), mode="lines")
    return pages, feed.page_chains(pages.select("page", feed.next_link(F.col("link")).alias("next")))


def q_feed_page_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of linked feed pages with their place in the chain of ``next`` links."""
    pages, chains = _landed_chain(spark, sf_dir)
    return feed.chain_records(pages, chains, fixtures.F_FEED_MAPPING)


def q_feed_chain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chains of linked feed pages, with those that are broken or cyclic."""
    return feed.chain_report(_landed_chain(spark, sf_dir)[1])


def q_default_sums_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4: the Gold model's default sums by every one of its group columns, in one scan."""
    ops = contract.silver_operations(flog_bronze(spark, sf_dir), processed_time=PROCESSED_TIME)
    return measures.sums_by_every_column(ops, measures.GOLD_GROUPING, measures.GOLD_SUMMED)


def q_default_sums_v1_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, A4: the first model's default sums by every one of its group columns, in one scan."""
    fact = measures.v1_fact(contract.parse_masking_logs(flog_bronze(spark, sf_dir)))
    return measures.sums_by_every_column(fact, measures.V1_GROUPING, measures.V1_SUMMED)


def q_join_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + A3: the sums of the operations-config join by schema, table and status, without the join's rows."""
    ops = contract.silver_operations(flog_bronze(spark, sf_dir), processed_time=PROCESSED_TIME)
    return measures.join_sums(ops, config.flatten_config(fcfg_bronze(spark, sf_dir)), ["schema", "table", "status"], [])


def q_join_sums_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + A3: the same by the operations' status and the config's pattern."""
    ops = contract.silver_operations(flog_bronze(spark, sf_dir), processed_time=PROCESSED_TIME)
    return measures.join_sums(ops, config.flatten_config(fcfg_bronze(spark, sf_dir)), ["status"], ["pattern_name"])


def q_repeatable_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2-K4, K6, K7, K9: three loads, each cut off on the way and run again; the Gold logs table with its batches.

    A load is cut off between its writes and once more inside one: a partition is there without its ledger entry.
    """
    base = scratch_folder(spark, "batches")
    logs, configs = flog_bronze(spark, sf_dir), fcfg_bronze(spark, sf_dir)
    loads = logs.drop("config").join(configs.select("object_id", "config"), "object_id")
    gold = f"{sinks.GOLD_DB}_{uuid.uuid4().hex}"
    batches.create_gold_batches(spark, gold, location=f"{base}/gold")
    for k, until in enumerate(("bronze", "silver", "gold")):
        load, name = loads.where(F.col("object_id").cast("long") % 3 == k), f"load-{k}"
        batches.run_batch(spark, load, name, base, gold, PROCESSED_TIME, until=until)
        if until == "bronze":  # ended while it wrote Silver
            sinks.overwrite_path(contract.silver_operations(load, processed_time=PROCESSED_TIME),
                                 f"{base}/{batches.SILVER_OPS}/batch_id={name}")
        errors = batches.run_batch(spark, load, name, base, gold, PROCESSED_TIME)
        if any(errors.values()):
            raise RuntimeError(f"Gold copy failed: {errors}")
    return spark.table(f"{gold}.{sinks.GOLD_LOGS}")


def q_objects_over_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: distinct config objects after each of four loads that overlap, negative ids among them, from stored bitmaps."""
    path = scratch_folder(spark, "object-bitmaps")
    rows = config.flatten_config(fcfg_bronze(spark, sf_dir))
    # every object comes with the load of its number, and every third one in the next load again
    moved = rows.select((F.col("object_id") - 50).alias("object_id"), F.col("object_id").alias("n"))
    for k in range(4):
        load = moved.where((F.col("n") % 4 == k) | ((F.col("n") % 3 == 0) & (F.col("n") % 4 == (k + 3) % 4)))
        loads.add_load_bitmaps(load, path, f"load-{k}")
    return loads.distinct_over_loads(spark, path)


def q_drilldown_by_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date drill-down of orders kept up to date over three loads, each with days that the others have too."""
    orders = table(spark, sf_dir, "orders")
    stored = loads.RollupTable(spark, scratch_folder(spark, "rollup"), {"price": "o_totalprice"})
    for k in (0, 1, 2, 1):  # the second load comes twice
        stored.apply(orders.where(F.col("o_orderkey") % 3 == k), "o_orderdate", f"load-{k}")
    return stored.rows().select(*loads.ROLLUP_KEYS, "level", F.col("n").alias("n_orders"), F.round("price", 2).alias("total_price"))


def _bucketed_silver(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Silver operations and config written as bucketed tables in a database of this run."""
    base, db = scratch_folder(spark, "bucketed"), f"silver_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{base}/db'")
    ops = contract.silver_operations(flog_bronze(spark, sf_dir), processed_time=PROCESSED_TIME)
    layout.write_bucketed(ops, f"{db}.ops", ["object_id"], f"{base}/ops", buckets=16)
    layout.write_bucketed(config.flatten_config(fcfg_bronze(spark, sf_dir)), f"{db}.cfg", ["object_id"], f"{base}/cfg", buckets=16)
    return f"{db}.ops", f"{db}.cfg"


def q_own_config_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each operation with its own config row, over bucketed Silver tables, without an exchange."""
    return layout.own_config_colocated(spark, *_bucketed_silver(spark, sf_dir))


def q_config_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operations-config join over bucketed Silver tables, without an exchange."""
    return layout.config_join_colocated(spark, *_bucketed_silver(spark, sf_dir))


def q_quarter_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders laid out by day; months and days of the first quarter of 1995, read from that quarter's files."""
    base = scratch_folder(spark, "by-day")
    layout.write_by_day(table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice"), f"{base}/orders", "o_orderdate")
    fact = spark.read.parquet(f"{base}/orders")
    dates = calendar.date_dimension(fact.select(layout.DAY).distinct(), layout.DAY)
    dates.write.parquet(f"{base}/calendar")
    rows = layout.days_of(fact, spark.read.parquet(f"{base}/calendar"), (F.col("Year") == 1995) & (F.col("QuarterNo") == 1))
    out = calendar.drilldown(rows, {"n_orders": F.count(F.lit(1)), "total_price": F.round(F.sum("o_totalprice"), 2)})
    return out.withColumn("level", F.col("level").cast("int"))


def q_masking_ops_growing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-LOG landed in three parts, each parsed in a run of its own from the state of the one before.

    Same Silver rows as ``masking_ops_contract``.
    """
    base = scratch_folder(spark, "growing")
    fixtures.f_log_parts(table(spark, sf_dir, "events")).write.partitionBy("part").parquet(f"{base}/landed")
    parts = spark.read.parquet(f"{base}/landed").withColumn("part", F.col("part").cast("long"))
    for k in range(fixtures.LOG_PARTS):
        growing.process_parts(parts.where(F.col("part") == k), k, f"{base}/silver")
    return growing.grown_operations(spark, f"{base}/silver", processed_time=PROCESSED_TIME)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "log_lines": q_log_lines,
    "masking_ops": q_masking_ops,
    "masking_ops_contract": q_masking_ops_contract,
    "masking_ops_landed_lines": q_masking_ops_landed_lines,
    "masking_ops_log_files": q_masking_ops_log_files,
    "config_flatten": q_config_flatten,
    "config_nine_columns": q_config_nine_columns,
    "config_union": q_config_union,
    "config_objects": q_config_objects,
    "ops_config_join": q_ops_config_join,
    "ops_own_config": q_ops_own_config,
    "date_dim": q_date_dim,
    "fact_by_date": q_fact_by_date,
    "date_drilldown": q_date_drilldown,
    "default_sums_gold": q_default_sums_gold,
    "default_sums_v1": q_default_sums_v1,
    "default_sums_config": q_default_sums_config,
    "ops_by_date": q_ops_by_date,
    "manifest_documents": q_manifest_documents,
    "manifest_files": q_manifest_files,
    "activity_feed": q_activity_feed,
    "csv_selected": q_csv_selected,
    "gold_conform": q_gold_conform,
    "gold_config_conform": q_gold_config_conform,
    "quarantine": q_quarantine,
    "quarantine_survivors": q_quarantine_survivors,
    "config_survivors": q_config_survivors,
    "table_lifecycle": q_table_lifecycle,
    "lifecycle_gold_config": q_lifecycle_gold_config,
    "lifecycle_join": q_lifecycle_join,
    "lifecycle_feed": q_lifecycle_feed,
    "feed_page_files": q_feed_page_files,
    "feed_page_arrays": q_feed_page_arrays,
    "feed_page_chain": q_feed_page_chain,
    "feed_chain_report": q_feed_chain_report,
    "default_sums_by_column": q_default_sums_by_column,
    "default_sums_v1_by_column": q_default_sums_v1_by_column,
    "join_sums": q_join_sums,
    "join_sums_by_pattern": q_join_sums_by_pattern,
    "repeatable_batches": q_repeatable_batches,
    "masking_ops_growing": q_masking_ops_growing,
    "objects_over_loads": q_objects_over_loads,
    "drilldown_by_loads": q_drilldown_by_loads,
    "own_config_bucketed": q_own_config_bucketed,
    "config_join_bucketed": q_config_join_bucketed,
    "quarter_drilldown": q_quarter_drilldown,
}
