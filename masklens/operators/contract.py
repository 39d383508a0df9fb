"""Silver contract of the operations table (F8, F10-F13) and its quarantine.

Reference defaults before the typed write: missing cycle, counts, durations
and ids become 0; missing times become ''; times are rendered as
``yyyy-MM-dd HH:mm:ss``; the processing stamp is the run's time and a fixed
name. Documents that the original would have crashed on (line too short for
a token, count that is not a number, id that is not an integer, no log at all)
go to a quarantine table instead; the other documents are unaffected.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masklens import schemas
from masklens.functions.text import py_float
from masklens.session import ensure_checkpoint_dir
from masklens.operators.loglines import (
    DOC_KEY, document_key, documents, log_lines, parse_lines, valid_lines,
)
from masklens.operators.maskops import chunked_mask_operations, collapse_copies, mask_operations, rule_lines

# Fixed value: the name stamped into ``processed_by`` by the original job.
DEFAULT_PROCESSED_BY = "YourName"
TIME_FMT = "yyyy-MM-dd HH:mm:ss"


def render_time(c: Column) -> Column:
    """Timestamp -> ``yyyy-MM-dd HH:mm:ss`` text, '' when missing."""
    return F.coalesce(F.date_format(c, TIME_FMT), F.lit(""))


def render_now(c: Column) -> Column:
    """Python ``str(datetime)``: microseconds shown only when non-zero."""
    return F.regexp_replace(F.date_format(c, TIME_FMT + ".SSSSSS"), r"\.000000$", "")


def _stamp(value) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, (_dt.datetime, str)):
        return F.lit(value).cast("timestamp")
    return value


def parse_masking_logs(bronze: DataFrame, log_col: str = "masking_log",
                       no_data_status: bool = False, cycle_index: bool = False,
                       chunk_lines: int | None = None) -> DataFrame:
    """Bronze documents -> raw operations (with ``copies`` and ``bad_reason``).

    Lines are parsed where the Bronze row is read, lines without a rule are left out, copies are added up, and
    the extracted values are shuffled by document for the scans. With ``chunk_lines`` every document is instead
    scanned in chunks of so many lines, each in a task of its own; the caller decides, and the result is the same.
    """
    docs = documents(bronze.where(F.col(log_col).isNotNull()), log_col)
    ident = ("object_id", "load_date")
    found = collapse_copies(rule_lines(log_lines(docs, log_col, ident), (*DOC_KEY, *ident, "line_no")))
    opts = dict(no_data_status=no_data_status, cycle_index=cycle_index)
    if chunk_lines is None:
        return mask_operations(found, **opts)
    found = found.withColumn("chunk", F.floor(F.col("line_no") / F.lit(chunk_lines)))
    return chunked_mask_operations(found.repartition(*DOC_KEY, "chunk"), **opts)


def conform_operations(ops: DataFrame, processed_time=None,
                       processed_by: str = DEFAULT_PROCESSED_BY, expand: bool = True) -> DataFrame:
    """Raw operations -> the 15 Silver columns, in contract order.

    Rows of quarantined documents are left out (see :func:`quarantine_documents`).
    ``expand`` repeats the operations of a document stored several times,
    as the original emits them once per stored copy.
    """
    good = ops.where(F.col("bad_reason").isNull() & _object_id_ok(F.col("object_id")))
    if expand:
        good = expand_copies(good)
    stamp = render_now(_stamp(processed_time))
    return good.select(
        F.coalesce(F.col("cycle"), F.lit(0)).cast("int").alias("cycle"),
        F.col("schema"),
        F.col("table"),
        F.coalesce(py_float(F.col("row_count")), F.lit(0.0)).cast("float").alias("row_count"),
        F.coalesce(py_float(F.col("distinct_row_count")), F.lit(0.0)).cast("float")
        .alias("distinct_row_count"),
        F.col("column"),
        F.col("status"),
        render_time(F.col("start_time")).alias("start_time"),
        render_time(F.col("end_time")).alias("end_time"),
        F.coalesce(F.col("duration_secs"), F.lit(0.0)).cast("float").alias("duration_secs"),
        F.coalesce(F.col("duration_mins"), F.lit(0.0)).cast("float").alias("duration_mins"),
        F.col("error"),
        F.coalesce(F.col("object_id").try_cast("int"), F.lit(0)).alias("object_id"),
        stamp.alias("processed_time"),
        F.lit(processed_by).alias("processed_by"),
    )


def expand_copies(ops: DataFrame) -> DataFrame:
    """Repeat each operation once per stored copy of its document."""
    return ops.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop(
        "_copy")


def _object_id_ok(c: Column) -> Column:
    return c.isNull() | c.try_cast("int").isNotNull()


def quarantine_documents(bronze: DataFrame, ops: DataFrame, log_col: str = "masking_log") -> DataFrame:
    """One row per quarantined document (per stored copy) with the reason.

    ``ops`` is :func:`parse_masking_logs` of ``bronze``. Columns:
    ``object_id``, ``load_date``, ``reason``.
    """
    no_log = bronze.where(F.col(log_col).isNull()).select(
        "object_id", "load_date", F.lit("log is null").alias("reason"))
    bad_ops = ops.where(F.col("bad_reason").isNotNull() | ~_object_id_ok(F.col("object_id")))
    per_doc = bad_ops.groupBy(*DOC_KEY).agg(
        F.any_value("object_id").alias("object_id"),
        F.any_value("load_date").alias("load_date"),
        F.any_value("copies").alias("copies"),
        # a parse failure is the reason; a bad id only when the parse was fine
        F.coalesce(F.max("bad_reason"), F.lit("object_id is not an integer")).alias("reason"))
    bad = expand_copies(per_doc)
    return no_log.unionByName(bad.select("object_id", "load_date", "reason"))


def parse_landed_lines(lines: DataFrame, order_cols: list[str], line_col: str = "line",
                       ident: tuple[str, ...] = ("object_id", "load_date"),
                       no_data_status: bool = False, cycle_index: bool = False) -> DataFrame:
    """Logs landed one line per row -> raw operations.

    ``lines`` has the identity columns of a log (``ident``), its line order
    (``order_cols``) and the line text. No log is ever assembled in one row
    or one task: a global sort by (log, order) range-partitions the lines
    (sampled bounds split a hot log over many partitions), an order-preserving
    id numbers them, each sorted partition is a chunk, and the chunked scan
    carries state between the chunks of a log.

    Lines are parsed first; only rule lines, as extracted values, are sorted. The numbered ones are
    checkpointed (reliable checkpoint, in the session's ``spark.checkpoint.dir``) before the chunked rounds read
    them: the range bounds come from sampling, and every round must see the same numbering, also after a lost
    executor. This runs when the operator is called.
    """
    order = [f"_order{k}" for k in range(len(order_cols))]
    keyed = lines.select(
        *ident, *[F.col(c).alias(o) for c, o in zip(order_cols, order)], F.col(line_col).alias("line"),
        *document_key(ident))
    found = rule_lines(valid_lines(parse_lines(keyed)), (*DOC_KEY, *ident, *order))
    numbered = found.orderBy(*DOC_KEY, *order).drop(*order).withColumns({
        "copies": F.lit(1).cast("long"), "line_no": F.monotonically_increasing_id()})
    numbered = numbered.withColumn("chunk", F.shiftright(F.col("line_no"), 33))
    ensure_checkpoint_dir(lines.sparkSession)
    numbered = numbered.checkpoint(eager=True)
    return chunked_mask_operations(numbered.repartition(*DOC_KEY, "chunk"), keep=(*ident, "copies"),
                                   no_data_status=no_data_status, cycle_index=cycle_index)


def only_new_documents(bronze: DataFrame, processed: DataFrame,
                       ident: tuple[str, ...] = ("object_id", "load_date")) -> DataFrame:
    """Q13 (batch form): Bronze rows whose (object id, load date) was not processed yet.

    ``processed`` holds the identity columns of documents already parsed (for
    example the quarantine and a processed-documents table). A left anti join,
    null-safe on every identity column; Spark chooses broadcast or shuffle from
    the sizes.
    """
    seen = processed.select(*[F.col(c).alias(f"_seen_{c}") for c in ident]).distinct()
    cond = [bronze[c].eqNullSafe(seen[f"_seen_{c}"]) for c in ident]
    return bronze.join(seen, cond, "left_anti")


def silver_operations(bronze: DataFrame, processed_time=None,
                      processed_by: str = DEFAULT_PROCESSED_BY, **kw) -> DataFrame:
    """Bronze -> Silver ``masking_logs_results`` rows (the good documents)."""
    return conform_operations(parse_masking_logs(bronze, **kw), processed_time, processed_by)


SILVER_OPS_COLUMNS = [f.name for f in schemas.SILVER_OPS.fields]
