"""Logs that grow between runs: each run parses the new part of a log only.

The state of the parser at the end of a log's last part (the values set so far,
whether an operation is running, its counts, error and failure, the carried
status) is one row of a state table. The next part starts from it, exactly as a
chunk of a long log starts from the chunk before, so a log landed in any number
of parts over any number of runs gives the rows of one run over the whole of it.

A run is a micro-batch of a file stream, or a call of :func:`process_parts`. It
writes the batch's own folders, state included, and reads state of earlier
batches only, so a batch that is replayed replaces what it wrote. A part that
comes again, or after a later one, is not parsed again. A log that turns out bad
(a line too short, a count that is not a number) is left out as a whole when
Silver is read, whatever its earlier parts gave.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masklens.operators import contract
from masklens.operators.loglines import DOC_KEY, document_key, parse_lines, valid_lines
from masklens.operators.maskops import _finish, _last_by, _layer1, _layer2, _layer3, _live_event, rule_lines
from masklens.streaming.incremental import MAX_FILE_AGE

IDENT = ("object_id", "load_date")
# A landed part of a log, line by line; parts of a log are numbered in landing order.
PART_LINES = "object_id string, load_date timestamp, part long, line_no long, line string"
ORDER = "line_at"
_FAIL = "struct<v: struct<kind: string, col: string, tab: string>>"
# What a part inherits: carried value -> type.
CARRIED = {"cycle": "int", "cycle_count": "long", "schema": "string", "table": "string", "column": "string", "start": "timestamp_ntz",
           "live": "boolean", "_e_rows": "struct<v: string>", "_e_dist": "struct<v: string>", "_e_err": "struct<v: string>",
           "_e_fail": _FAIL, "status": "string"}
BAD = {"short": "boolean", "bad_num": "boolean"}
STATE = (", ".join(f"{k} {'long' if k == 'doc_id' else 'int'}" for k in DOC_KEY) + ", object_id string, load_date timestamp, last_part long, "
         + ", ".join(f"s_{n} {t}" for n, t in {**CARRIED, **BAD}.items()))


def _carry(name: str) -> str:
    """The name that the parser's layers give a carried value."""
    return f"c{name}" if name.startswith("_e_") else f"c_{name}"


def _scan(parts: DataFrame, state: DataFrame, no_data_status: bool = False, cycle_index: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rule lines of new parts (``PART_LINES``) with the parser's values at each, given ``state`` (``STATE``, one row a log), and
    the logs that have a new part with what they inherit. Lines are parsed where they are read; only the values that rules take
    are shuffled by log, once, and a log's part streams through the window scans of one task."""
    order = F.struct("part", "line_no").alias(ORDER)
    keyed = parts.select(*IDENT, "part", order, "line", *document_key(IDENT))
    known = state.select(*[F.col(k).alias(f"_k_{k}") for k in DOC_KEY], "last_part", *[F.col(f"s_{n}").alias(_carry(n)) for n in CARRIED],
                         *[F.col(f"s_{n}").alias(f"was_{n}") for n in BAD])

    def new(rows: DataFrame) -> DataFrame:
        same = [rows[k] == known[f"_k_{k}"] for k in DOC_KEY]
        return (rows.join(known, same, "left").where(F.col("last_part").isNull() | (F.col("part") > F.col("last_part")))
                .drop(*[f"_k_{k}" for k in DOC_KEY]))

    found = new(rule_lines(valid_lines(parse_lines(keyed)), (*DOC_KEY, *IDENT, ORDER, "part")))
    found = found.withColumns({"c_short_doc": F.lit(False), "c_last_line": F.lit(None).cast(found.schema[ORDER].dataType),
                               "c_bad_num_doc": F.lit(None).cast("boolean")})
    l2 = _layer2(_layer1(found, DOC_KEY, ORDER, cycle_index, chunked=True), DOC_KEY, ORDER, chunked=True)
    l3 = _layer3(l2, DOC_KEY, ORDER, no_data_status, chunked=True)
    touched = new(keyed.groupBy(*DOC_KEY).agg(*[F.first(c).alias(c) for c in IDENT], F.max("part").alias("part")))
    return l3.drop(*[c for c in l3.columns if c.startswith("v_")], "f_kind", "f_rec", "last_fail"), touched


def _operations(l3: DataFrame) -> DataFrame:
    return _finish(l3.withColumn("copies", F.lit(1).cast("long")), list(DOC_KEY), (*IDENT, "copies"), ORDER)


def _state_after(l3: DataFrame, touched: DataFrame) -> DataFrame:
    at_end = lambda c: F.max_by(F.col(c), F.col(ORDER))
    ended = {"cycle": at_end("cycle"), "schema": at_end("schema"), "table": at_end("table"), "column": at_end("column"),
             "start": at_end("start_time"), "status": at_end("status"),
             "cycle_count": F.sum(F.col("r1").cast("long")) + F.coalesce(F.first("c_cycle_count"), F.lit(0)),
             "live": F.coalesce(_last_by(_live_event(), ORDER), F.first("c_live")),
             **{e: F.coalesce(_last_by(F.col(e), ORDER), F.first(f"c{e}")) for e in CARRIED if e.startswith("_e_")}}
    after = l3.groupBy(*DOC_KEY).agg(*[ended[n].alias(f"n_{n}") for n in CARRIED], F.max("short").alias("n_short"),
                                     F.max("_bad_num").alias("n_bad_num"))
    # a log whose new part has no rule line keeps its values
    joined = touched.drop("last_part").withColumnRenamed("part", "last_part").join(after.withColumn("_parsed", F.lit(True)), list(DOC_KEY), "left")

    def now(n: str) -> Column:
        return F.when(F.col("_parsed"), F.col(f"n_{n}")).otherwise(F.col(_carry(n))).cast(CARRIED[n]).alias(f"s_{n}")

    bad = [(F.coalesce(F.col(f"was_{n}"), F.lit(False)) | F.coalesce(F.col(f"n_{n}"), F.lit(False))).alias(f"s_{n}") for n in BAD]
    return joined.select(*DOC_KEY, *IDENT, "last_part", *[now(n) for n in CARRIED], *bad)


def resume(parts: DataFrame, state: DataFrame, no_data_status: bool = False, cycle_index: bool = False) -> tuple[DataFrame, DataFrame]:
    """Raw operations of new parts (``PART_LINES``) given ``state`` (``STATE``, one row a log), and the state of the logs they
    belong to afterwards."""
    l3, touched = _scan(parts, state, no_data_status, cycle_index)
    return _operations(l3), _state_after(l3, touched)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of batches with ``batch_id``; no rows before the first one."""
    try:
        return spark.read.schema(f"{schema}, batch_id long").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, batch_id long")


def state_of(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The latest state of every log, of batches before ``before`` (all of them by default)."""
    rows = _stored(spark, f"{root}/state", STATE)
    if before is not None:
        rows = rows.where(F.col("batch_id") < before)
    fields = [c for c in rows.columns if c not in (*DOC_KEY, "batch_id")]
    return (rows.groupBy(*DOC_KEY).agg(F.max_by(F.struct(*fields), "batch_id").alias("at"))
            .select(*DOC_KEY, *[F.col("at")[c].alias(c) for c in fields]))


def process_parts(parts: DataFrame, batch_id: int, root: str, **options) -> None:
    """One run: the operations of a batch's new parts, and the state after them. A replayed batch gives the same folders."""
    spark = parts.sparkSession
    l3, touched = _scan(parts, state_of(spark, root, before=batch_id), **options)
    l3 = l3.persist()  # scanned once, for the operations and for the state
    try:
        _operations(l3).drop("line_no").write.mode("overwrite").parquet(f"{root}/operations/batch_id={batch_id}")
        _state_after(l3, touched).write.mode("overwrite").parquet(f"{root}/state/batch_id={batch_id}")
    finally:
        l3.unpersist()


def grown_operations(spark: SparkSession, root: str, processed_time=None) -> DataFrame:
    """The Silver rows of all parts so far: those that one run over the whole logs gives."""
    ops = spark.read.option("basePath", f"{root}/operations").parquet(f"{root}/operations").drop("batch_id", "bad_reason")
    bad = state_of(spark, root).where("s_short or s_bad_num").select(*DOC_KEY)
    good = ops.join(bad, list(DOC_KEY), "left_anti").withColumn("bad_reason", F.lit(None).cast("string"))
    return contract.conform_operations(good, processed_time)


def grown_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The logs that are left out so far, with the reason."""
    return state_of(spark, root).where("s_short or s_bad_num").select(
        "object_id", "load_date",
        F.when(F.col("s_short"), "line too short for its token").otherwise("count is not a number").alias("reason"))


def run_growing(spark: SparkSession, landed: str, root: str, max_files_per_trigger: int | None = None) -> None:
    """Process the parts (Parquet files of ``PART_LINES``) that landed since the last run, then stop. Files of one micro-batch may
    hold several parts of a log; the checkpoint belongs to the root."""
    reader = spark.readStream.schema(PART_LINES).format("parquet").option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (reader.load(landed).writeStream.foreachBatch(lambda df, batch_id: process_parts(df, batch_id, root))
             .option("checkpointLocation", f"{root.rstrip('/')}/_checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
