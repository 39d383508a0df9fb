"""Masking log lines -> one row per column-masking operation.

The original reads each log top to bottom with a hand-written state machine.
Here the same state is carried by window scans over the lines of a document
(``partitionBy(doc).orderBy(line)``):

* "last value set so far" (schema, table, column, start, cycle) is
  ``last(value, ignorenulls)`` over the rows up to the current one;
* values that are cleared when an operation ends (row counts, error, the
  failure list) are scanned as structs: a clearing line contributes
  ``struct(null)``, a setting line ``struct(value)``; ``last(struct,
  ignorenulls)`` over the rows *before* the line then gives the state the line
  starts from;
* the status that a "No Data" finish carries over is the last assigned status.

The rules themselves need no state, so they run where a line is read. Lines on
which none fires change nothing and go no further; of the others only the
extracted values move on (:func:`rule_lines`), never the text. All scans share
one partitioning and one sort order; no Python runs per row.

Rules, evaluated on every valid line in this order (case-sensitive substring
tests on the message, token positions 0-based):

R1  MASKING, HAS, STARTED                      cycle = 1
R2  CONNECTED, Schema:                         schema = token 4
R3  TABLE, Mask Started                        table = token 2
R4  COLUMN, Mask Started                       column = token 2, live, start = time
R5  CALCULATED, Row, for, =                    rows = token 8
R6  NO Data or No Data                         error, distinct = 0, failure 'No Data'
R7  CALCULATED, Distinct, Count, =             distinct = token 5
R8  (Could & not) or (Could & Not & Mask & Column), not Could Not Enable
R9  ERROR, not Could Not Enable
R10 pymysql.err
R11 NOT FOUND or .php or .py                   R8-R11: error, failure 'Exception'
R12 Post-mask                                  no visible effect (nothing to compute)
R13 COLUMN, Mask Finished                      emit with a status, then clear
R14 live and (TABLE & Mask & Ended, or R1)     emit 'Failed', then clear (failures kept)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masklens.functions.text import is_py_float, token
from masklens.operators.loglines import DOC_KEY

# The substrings and outcomes the log rules test for.
S_MASKING, S_HAS, S_STARTED = "MASKING", "HAS", "STARTED"
S_CONNECTED, S_SCHEMA = "CONNECTED", "Schema:"
S_TABLE, S_COLUMN = "TABLE", "COLUMN"
S_MASK_STARTED, S_MASK_FINISHED = "Mask Started", "Mask Finished"
S_CALCULATED, S_ROW, S_FOR, S_EQ = "CALCULATED", "Row", "for", "="
S_DISTINCT, S_COUNT = "Distinct", "Count"
S_NO_DATA = ("NO Data", "No Data")
S_COULD, S_NOT_LOWER, S_NOT, S_MASK, S_COLUMN_WORD = "Could", "not", "Not", "Mask", "Column"
S_COULD_NOT_ENABLE = "Could Not Enable"
S_ERROR = "ERROR"
S_PYMYSQL = "pymysql.err"
S_NOT_FOUND_ANY = ("NOT FOUND", ".php", ".py")
S_ENDED = "Ended"
STATUS_PASSED, STATUS_FAILED, STATUS_EXCEPTION, STATUS_NO_DATA = "Passed", "Failed", "Exception", "No Data"

_FAIL_T = "struct<kind:string,col:string,tab:string>"


def _all(m: Column, *subs: str) -> Column:
    return reduce(lambda a, b: a & b, [m.contains(s) for s in subs])


def _any(m: Column, *subs: str) -> Column:
    return reduce(lambda a, b: a | b, [m.contains(s) for s in subs])


def rule_columns(message: Column, tokens: Column, log_time: Column) -> dict[str, Column]:
    """Per-line rule flags and the values each rule would set (no state)."""
    m = message
    r1 = _all(m, S_MASKING, S_HAS, S_STARTED)
    r2 = _all(m, S_CONNECTED, S_SCHEMA)
    r3 = _all(m, S_TABLE, S_MASK_STARTED)
    r4 = _all(m, S_COLUMN, S_MASK_STARTED)
    r5 = _all(m, S_CALCULATED, S_ROW, S_FOR, S_EQ)
    r6 = _any(m, *S_NO_DATA)
    r7 = _all(m, S_CALCULATED, S_DISTINCT, S_COUNT, S_EQ)
    not_enable = ~m.contains(S_COULD_NOT_ENABLE)
    r8 = (_all(m, S_COULD, S_NOT_LOWER) | _all(m, S_COULD, S_NOT, S_MASK, S_COLUMN_WORD)) & not_enable
    r9 = m.contains(S_ERROR) & not_enable
    r10 = m.contains(S_PYMYSQL)
    r11 = _any(m, *S_NOT_FOUND_ANY)
    exc = r8 | r9 | r10 | r11
    fin = _all(m, S_COLUMN, S_MASK_FINISHED)
    endc = _all(m, S_TABLE, S_MASK, S_ENDED) | r1
    n = F.size(tokens)
    short = (r2 & (n < 5)) | (r3 & (n < 3)) | (r4 & (n < 3)) | (r5 & (n < 9)) | (r7 & (n < 6))
    return {
        "r1": r1, "r4": r4, "fin": fin, "endc": endc, "short": short,
        "v_schema": F.when(r2, token(tokens, 4)),
        "v_table": F.when(r3, token(tokens, 2)),
        "v_column": F.when(r4, token(tokens, 2)),
        "v_start": F.when(r4, log_time),
        "v_rows": F.when(r5, token(tokens, 8)),
        # R7 runs after R6 on the same line, so its count wins
        "v_dist": F.when(r7, token(tokens, 5)).when(r6, F.lit("0")),
        "v_err": F.when(r6 | exc, message),
        # R8-R11 append after R6 on the same line, so 'Exception' is the last
        "f_kind": F.when(exc, F.lit(STATUS_EXCEPTION)).when(r6, F.lit(STATUS_NO_DATA)),
    }


def _cleared_event(value: str, clear: Column) -> Column:
    """struct(null) on a clearing line, struct(value) on a setting line, else null."""
    return F.when(clear, F.struct(F.lit(None).cast("string").alias("v"))).when(
        F.col(value).isNotNull(), F.struct(F.col(value).alias("v")))


def _carried(c: Column, carry: str | None) -> Column:
    return c if carry is None else F.coalesce(c, F.col(carry))


def _windows(key: tuple[str, ...], order_col: str):
    d = Window.partitionBy(*key).orderBy(order_col)
    return (d.rowsBetween(Window.unboundedPreceding, Window.currentRow),
            d.rowsBetween(Window.unboundedPreceding, -1),
            d.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def rule_lines(lines: DataFrame, key_cols: tuple[str, ...]) -> DataFrame:
    """Valid lines -> the lines on which a rule fires: ``key_cols``, the time and the rules' flags and values.

    The rules are the input of a one-element generator, so that the filter on their outcome cannot be pushed
    below it and test every substring twice. A message is kept only where a rule stores it (``v_err``).
    """
    rc = rule_columns(F.col("message"), F.col("tokens"), F.col("log_time"))
    found = lines.select(*key_cols, "log_time", F.inline(F.array(F.struct(*[c.alias(k) for k, c in rc.items()]))))
    values = F.coalesce(*[F.col(v) for v in ("v_schema", "v_table", "v_column", "v_rows", "v_dist", "v_err")])
    return found.where(_any_of("r1", "r4", "fin", "endc", "short") | values.isNotNull())


def _any_of(*flags: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f) for f in flags])


def collapse_copies(found: DataFrame) -> DataFrame:
    """One row per rule line of every distinct document, with the number of ``copies`` of the document.

    Grouped by all columns (the identity columns among them), so equal lines are added up before they are
    shuffled, and the lines of a document with very many copies, or of a very long one, spread over all tasks.
    """
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("copies"))


def _live_event() -> Column:
    return F.when(F.col("fin") | F.col("endc"), F.lit(False)).when(F.col("r4"), F.lit(True))


def _layer1(df: DataFrame, key: tuple[str, ...], order_col: str, cycle_index: bool,
            chunked: bool) -> DataFrame:
    """Values set so far, live flag, ending lines and the cleared-scan events."""
    upto, before, whole = _windows(key, order_col)
    cc = (lambda name: f"c_{name}") if chunked else (lambda name: None)
    if cycle_index:
        running = F.sum(F.col("r1").cast("long")).over(upto)
        if chunked:
            running = running + F.coalesce(F.col("c_cycle_count"), F.lit(0))
        cycle = F.when(running > 0, running)
    else:
        cycle = _carried(F.last(F.when(F.col("r1"), F.lit(1)), True).over(upto), cc("cycle"))
    if chunked:
        short_doc, last = F.col("c_short_doc"), F.col(order_col) == F.col("c_last_line")
    else:
        short_doc = F.max(F.col("short")).over(whole)
        last = F.col(order_col) == F.max(order_col).over(whole)
    l1 = df.select(
        "*",
        cycle.alias("cycle"),
        _carried(F.last("v_schema", True).over(upto), cc("schema")).alias("schema"),
        _carried(F.last("v_table", True).over(upto), cc("table")).alias("table"),
        _carried(F.last("v_column", True).over(upto), cc("column")).alias("column"),
        _carried(F.last("v_start", True).over(upto), cc("start")).alias("start_time"),
        _carried(F.last(_live_event(), True).over(before), cc("live")).alias("_live_before"),
        short_doc.alias("_short_doc"),
        last.alias("_last"),
    )
    live = F.col("r4") | F.coalesce(F.col("_live_before"), F.lit(False))
    f_rec = F.when(F.col("f_kind").isNotNull(), F.struct(
        F.col("f_kind").alias("kind"), F.col("column").alias("col"), F.col("table").alias("tab")))
    l1 = l1.withColumns({"fail_fired": live & ~F.col("fin") & F.col("endc"), "f_rec": f_rec})
    reset = F.col("fin") | F.col("fail_fired")
    ev_fail = F.when(F.col("fin"), F.struct(F.lit(None).cast(_FAIL_T).alias("v"))).when(
        F.col("f_rec").isNotNull(), F.struct(F.col("f_rec").alias("v")))
    return l1.select("*", _cleared_event("v_rows", reset).alias("_e_rows"),
                     _cleared_event("v_dist", reset).alias("_e_dist"),
                     _cleared_event("v_err", reset).alias("_e_err"), ev_fail.alias("_e_fail"))


def _layer2(df: DataFrame, key: tuple[str, ...], order_col: str, chunked: bool) -> DataFrame:
    """Row counts, error and the last failure of the running operation."""
    _, before, _ = _windows(key, order_col)

    def state(ev: str) -> Column:
        c = F.last(ev, True).over(before)
        return (F.coalesce(c, F.col(f"c{ev}")) if chunked else c)["v"]

    lf = F.col("last_fail")
    l2 = df.select(
        "*",
        F.coalesce(F.col("v_rows"), state("_e_rows")).alias("row_count"),
        F.coalesce(F.col("v_dist"), state("_e_dist")).alias("distinct_row_count"),
        F.coalesce(F.col("v_err"), state("_e_err")).alias("error"),
        F.coalesce(F.col("f_rec"), state("_e_fail")).alias("last_fail"),
    )
    emit = F.coalesce(
        F.col("fail_fired") | (F.col("fin") & (lf.isNotNull() | F.col("column").isNotNull())), F.lit(False))
    return l2.withColumns({
        "is_op": emit,
        "_bad_num": emit & (~is_py_float(F.col("row_count")) | ~is_py_float(F.col("distinct_row_count"))),
    })


def _assigned(no_data_status: bool) -> Column:
    lf = F.col("last_fail")
    same = F.col("column").eqNullSafe(lf["col"]) & F.col("table").eqNullSafe(lf["tab"])
    assigned = (
        F.when(F.col("fail_fired"), F.lit(STATUS_FAILED))
        .when(F.col("fin") & (lf["kind"] == STATUS_EXCEPTION),
              F.when(same, F.lit(STATUS_EXCEPTION)).otherwise(F.lit(STATUS_PASSED)))
    )
    if no_data_status:
        assigned = assigned.when(F.col("fin") & (lf["kind"] == STATUS_NO_DATA), F.lit(STATUS_NO_DATA))
    return assigned.when(F.col("fin") & lf.isNull() & F.col("column").isNotNull(), F.lit(STATUS_PASSED))


def _layer3(df: DataFrame, key: tuple[str, ...], order_col: str, no_data_status: bool,
            chunked: bool) -> DataFrame:
    """The status each ending line assigns, and the carried status."""
    upto, _, whole = _windows(key, order_col)
    assigned = _assigned(no_data_status)
    status = F.last(assigned, True).over(upto)
    bad_num_doc = F.max("_bad_num").over(whole)  # the whole document, or a document's only chunk
    if chunked:
        bad_num_doc = F.coalesce(F.col("c_bad_num_doc"), bad_num_doc)
    return df.select("*", _carried(status, "c_status" if chunked else None).alias("status"),
                     bad_num_doc.alias("_bad_num_doc"))


def _finish(l3: DataFrame, key_cols: list[str], keep: tuple[str, ...], order_col: str) -> DataFrame:
    # a document with a short line keeps one marker row (its last line) even
    # when it emits nothing, so that it still reaches the quarantine
    secs = F.when(F.col("start_time").isNotNull(),
                  F.expr("timestampdiff(SECOND, start_time, log_time)").cast("double"))
    ops = l3.where(F.col("is_op") | (F.col("_short_doc") & F.col("_last")))
    return ops.select(
        *key_cols, *keep, "is_op", F.col(order_col).alias("line_no"),
        "cycle", "schema", "table", "row_count", "distinct_row_count", "column", "status",
        "start_time", F.col("log_time").alias("end_time"),
        secs.alias("duration_secs"),
        F.when(secs != 0, F.round(secs / 60.0, 2)).alias("duration_mins"),
        "error",
        F.when(F.col("_short_doc"), F.lit("line too short for its token"))
        .when(F.col("_bad_num_doc"), F.lit("count is not a number")).alias("bad_reason"),
    )


def mask_operations(lines: DataFrame, doc_key: tuple[str, ...] = DOC_KEY, order_col: str = "line_no",
                    keep: tuple[str, ...] = ("object_id", "load_date", "copies"), no_data_status: bool = False,
                    cycle_index: bool = False) -> DataFrame:
    """Emitted operations of every document.

    ``lines`` holds the rule lines (:func:`rule_lines`) with ``keep`` and ``order_col``.
    Output, one row per emitted operation: the ``keep`` columns, ``doc_key``,
    ``line_no`` of the emitting line, ``cycle``, ``schema``, ``table``,
    ``row_count`` and ``distinct_row_count`` (the raw count tokens),
    ``column``, ``status``, ``start_time``, ``end_time`` (TIMESTAMP_NTZ),
    ``duration_secs``, ``duration_mins`` (DOUBLE), ``error``, and
    ``bad_reason``: null, or why the whole document must go to quarantine (a
    rule fired on a line too short for its token, or an emitted count is not
    a number). ``is_op`` is false only on the marker row kept for a document
    with a short line that emits nothing; such rows always have a
    ``bad_reason``, so consumers that keep ``bad_reason IS NULL`` see
    operations only. ``no_data_status`` reports 'No Data' instead of carrying
    the previous status; ``cycle_index`` numbers cycles instead of always 1.

    All windows share one partitioning (the document) and one order: one
    Exchange and one Sort. They stream through a document and spill, and a
    document here is one cell, at most 2 GB of text; larger logs are landed
    one line per row (:func:`masklens.operators.contract.parse_landed_lines`).
    """
    key_cols = list(doc_key)
    l1 = _layer1(lines, doc_key, order_col, cycle_index, chunked=False)
    l3 = _layer3(_layer2(l1, doc_key, order_col, chunked=False), doc_key, order_col,
                 no_data_status, chunked=False)
    return _finish(l3, key_cols, keep, order_col)


def _last_by(c: Column, order_col: str) -> Column:
    """Aggregate: the last non-null ``c`` in line order."""
    return F.max_by(c, F.when(c.isNotNull(), F.col(order_col)))


def chunked_mask_operations(lines: DataFrame, doc_key: tuple[str, ...] = DOC_KEY,
                            order_col: str = "line_no",
                            keep: tuple[str, ...] = ("object_id", "load_date", "copies"),
                            no_data_status: bool = False, cycle_index: bool = False) -> DataFrame:
    """:func:`mask_operations` for documents split into line chunks.

    ``lines`` holds rule lines with a ``chunk`` column (a contiguous range of lines of one
    document) and is hash-partitioned by (document, chunk), so one long
    document is spread over many tasks. Each chunk runs the same window
    scans; what a chunk inherits from the chunks before it is carried in:

    1. values set so far and the live flag: per-chunk last values, then a
       window over the chunks of each document (small data);
    2. the cleared values (counts, error, failure), whose clearing lines
       depend on (1);
    3. the carried status, which depends on (2).

    Every round reads the same Exchange of the lines (reused by Spark), and
    the per-chunk tables are tiny (one row per chunk). Results equal the
    single-pass scan whatever the chunk size.
    """
    key_cols = list(doc_key)
    # The keep columns depend on the document only. Making them part of the
    # chunk key changes no group, but keys are never pruned, so every round
    # reads the very same document and line shuffles (Spark reuses them).
    ck = (*doc_key, *keep, "chunk")
    base = lines
    dc = Window.partitionBy(*doc_key, *keep).orderBy("chunk")
    prev = dc.rowsBetween(Window.unboundedPreceding, -1)
    every = dc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    jk = (*doc_key, "chunk")  # never null (hashes, chunk number); the lines are partitioned by it

    def join_keys(df: DataFrame, other: DataFrame, how: str) -> DataFrame:
        """Equi-join on (document, chunk); the keep columns follow from the document."""
        o = other.select(*[F.col(k).alias(f"_ck_{k}") for k in jk],
                         *[k for k in other.columns if k not in ck])
        cond = reduce(lambda a, b: a & b, [df[k] == o[f"_ck_{k}"] for k in jk])
        return df.join(o, cond, how).drop(*[f"_ck_{k}" for k in jk])

    def with_carries(df: DataFrame, carries: DataFrame) -> DataFrame:
        # hash join built on the small carry table (one row per chunk): the line
        # side keeps its partitioning and order, so only the windows sort it
        return join_keys(df, carries.hint("shuffle_hash"), "left")

    # round 1: last values per chunk, carried over the chunks before
    s1 = base.groupBy(*ck).agg(
        _last_by(F.when(F.col("r1"), F.lit(1)), order_col).alias("s_cycle"),
        F.sum(F.col("r1").cast("long")).alias("s_r1"),
        *[_last_by(F.col(f"v_{n}"), order_col).alias(f"s_{n}")
          for n in ("schema", "table", "column", "start")],
        _last_by(_live_event(), order_col).alias("s_live"),
        F.max("short").alias("s_short"), F.max(order_col).alias("s_last_line"))
    c1 = s1.select(
        *ck, F.last("s_cycle", True).over(prev).alias("c_cycle"),
        F.sum("s_r1").over(prev).alias("c_cycle_count"),
        *[F.last(f"s_{n}", True).over(prev).alias(f"c_{n}")
          for n in ("schema", "table", "column", "start", "live")],
        F.max("s_short").over(every).alias("c_short_doc"),
        F.max("s_last_line").over(every).alias("c_last_line"),
        (F.count(F.lit(1)).over(every) > 1).alias("c_multi"))

    # rounds 2 and 3 only matter for documents spread over several chunks; a
    # single-chunk document inherits nothing, so its lines skip them
    def multi(df: DataFrame) -> DataFrame:
        return df.where(F.col("c_multi"))

    # round 2: cleared values, whose clearing lines need the live flag of round 1
    r2 = _layer1(multi(with_carries(base, c1)), ck, order_col, cycle_index, chunked=True)
    events = ("_e_rows", "_e_dist", "_e_err", "_e_fail")
    s2 = r2.groupBy(*ck).agg(*[_last_by(F.col(e), order_col).alias(f"s{e}") for e in events])
    c2 = s2.select(*ck, *[F.last(f"s{e}", True).over(prev).alias(f"c{e}") for e in events])
    c12 = join_keys(c1, c2, "left")

    # round 3: assigned statuses, which need the failures of round 2
    r3 = _layer2(_layer1(multi(with_carries(base, c12)), ck, order_col, cycle_index, chunked=True),
                 ck, order_col, chunked=True)
    r3 = r3.withColumn("_assigned", _assigned(no_data_status))
    s3 = r3.groupBy(*ck).agg(_last_by(F.col("_assigned"), order_col).alias("s_status"),
                             F.max("_bad_num").alias("s_bad"))
    c3 = s3.select(*ck, F.last("s_status", True).over(prev).alias("c_status"),
                   F.max("s_bad").over(every).alias("c_bad_num_doc"))
    c123 = join_keys(c12, c3, "left")

    final = _layer1(with_carries(base, c123), ck, order_col, cycle_index, chunked=True)
    final = _layer3(_layer2(final, ck, order_col, chunked=True), ck, order_col, no_data_status,
                    chunked=True)
    return _finish(final, key_cols, keep, order_col)
