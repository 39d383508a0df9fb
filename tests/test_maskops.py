"""Log parser: window formulation vs a brute-force Python fold on random logs."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from masklens.operators import contract
from tests.pyfold import ShortLine, fold

LOAD = dt.datetime(2024, 2, 1)

TEMPLATES = [
    "MASKING HAS STARTED",
    "CONNECTED to db Schema: {s}",
    "TABLE : {t} Mask Started",
    "COLUMN : {c} Mask Started",
    "CALCULATED the Row Count for table {t} = {n}",
    "NO Data found",
    "No Data for column {c}",
    "CALCULATED Distinct Row Count = {n}",
    "Could not mask value",
    "Could Not Mask Column {c}",
    "ERROR in step {n}",
    "ERROR Could Not Enable trigger",
    "pymysql.err.OperationalError",
    "lookup.php NOT FOUND",
    "helper.py failed",
    "Post-mask operations",
    "COLUMN : {c} Mask Finished",
    "COLUMN : {c} Mask Finished",
    "TABLE : {t} Mask Ended",
    # lines that fire several rules at once
    "COLUMN : TABLE_2 Mask Started",
    "TABLE : T2 COLUMN Mask Started Mask Finished ERROR No Data",
    "MASKING HAS STARTED COLUMN : C3 Mask Finished Could not",
    "COLUMN : TABLE_3 Mask Finished Ended No Data",
    "COLUMN : C9 Mask Started",
    "nothing to see",
]
SHORT = ["CALCULATED Row for = x", "CONNECTED Schema:", "CALCULATED Distinct Count ="]


def _stamp(rng: random.Random, t: dt.datetime) -> str:
    form = rng.random()
    if form < 0.75:
        return t.strftime("%d/%m/%Y %H:%M:%S")
    if form < 0.85:
        return f"{t.day}/{t.month}/{t.year} {t.hour}:{t.minute}:{t.second}"
    if form < 0.92:
        return t.strftime("%d/%m/%Y\t %H:%M:%S")
    return " " + t.strftime("%d/%m/%Y  %H:%M:%S") + " "


def random_log(rng: random.Random, n_lines: int, short_rate: float = 0.0, bad_num_rate: float = 0.0) -> str:
    t = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(10**6))
    lines = []
    for _ in range(n_lines):
        t += dt.timedelta(seconds=rng.randrange(-30, 4000))
        r = rng.random()
        if r < 0.04:
            lines.append("")
            continue
        if r < 0.07:
            lines.append(f"garbage line {rng.randrange(1000)}")
            continue
        if r < 0.09:
            lines.append(f"31/02/2024 10:00:00 :: COLUMN : C{rng.randrange(5)} Mask Started")
            continue
        if r < 0.10:
            lines.append("05/01/0000 10:00:00 :: MASKING HAS STARTED")
            continue
        if rng.random() < short_rate:
            msg = rng.choice(SHORT)
        else:
            msg = rng.choice(TEMPLATES).format(
                s=f"S{rng.randrange(3)}", t=f"T{rng.randrange(3)}", c=f"C{rng.randrange(5)}",
                n=("1,000" if rng.random() < bad_num_rate else str(rng.randrange(10**5))))
        end = "\r" if rng.random() < 0.05 else ""
        lines.append(f"{_stamp(rng, t)} :: {msg}{end}")
    return "\n".join(lines)


def _expected(text: str):
    """(ops, quarantined?) per the brute-force fold and the float() casts."""
    try:
        ops = fold(text)
    except ShortLine:
        return [], True
    for op in ops:
        for k in ("row_count", "distinct_row_count"):
            if op[k] is not None:
                try:
                    float(op[k])
                except ValueError:
                    return [], True
    return ops, False


def _key(op):
    return (op["line_no"], op["cycle"], op["schema"], op["table"], op["row_count"],
            op["distinct_row_count"], op["column"], op["status"], op["start_time"], op["end_time"],
            op["duration_secs"], op["duration_mins"], op["error"])


def _run(spark, texts, **kw):
    rows = [(str(i), None, t, LOAD) for i, t in enumerate(texts)]
    bronze = spark.createDataFrame(rows, "object_id string, config string, masking_log string, load_date timestamp")
    ops = contract.parse_masking_logs(bronze, **kw).collect()
    got, bad = {}, set()
    for r in ops:
        if r["bad_reason"] is not None:
            bad.add(r["object_id"])
            continue
        d = r.asDict()
        got.setdefault(r["object_id"], []).append(d)
    return got, bad


@pytest.mark.parametrize("seed,chunk_lines", [(7, None), (11, 1_000_000), (13, 7), (17, 3), (19, 1)])
def test_random_logs_match_fold(spark, seed, chunk_lines):
    """Single-pass (None / large) and chunked scans (tiny chunks) against the fold."""
    rng = random.Random(seed)
    texts = [random_log(rng, rng.randrange(1, 70), short_rate=0.01, bad_num_rate=0.02)
             for _ in range(400)]
    got, bad = _run(spark, texts, chunk_lines=chunk_lines)
    n_ops = 0
    for i, text in enumerate(texts):
        exp, quarantined = _expected(text)
        oid = str(i)
        assert (oid in bad) == quarantined, f"doc {i} quarantine mismatch"
        if quarantined:
            continue
        n_ops += len(exp)
        assert sorted(map(_key, got.get(oid, [])), key=repr) == sorted(map(_key, exp), key=repr), f"doc {i}"
    assert n_ops > 1000


def test_exact_copies_parse_once_and_repeat(spark):
    rng = random.Random(3)
    text = random_log(rng, 60)
    exp, _ = _expected(text)
    rows = [("5", None, text, LOAD)] * 3 + [("6", None, text, LOAD)]
    bronze = spark.createDataFrame(rows, "object_id string, config string, masking_log string, load_date timestamp")
    silver = contract.silver_operations(bronze, processed_time=LOAD)
    counts = {r["object_id"]: r["count"] for r in silver.groupBy("object_id").count().collect()}
    assert counts.get(5, 0) == 3 * len(exp)
    assert counts.get(6, 0) == len(exp)


def test_quarantine_reasons(spark):
    ok = "01/01/2024 10:00:00 :: COLUMN : C1 Mask Started\n01/01/2024 10:05:00 :: COLUMN : C1 Mask Finished"
    rows = [
        ("1", None, ok, LOAD),
        ("2", None, ok + "\n01/01/2024 11:00:00 :: CALCULATED Row for = x", LOAD),  # Q5, nothing after
        ("3", None, "01/01/2024 10:00:00 :: COLUMN : C1 Mask Started\n"
                    "01/01/2024 10:01:00 :: CALCULATED Distinct Row Count = 1,000\n"
                    "01/01/2024 10:05:00 :: COLUMN : C1 Mask Finished", LOAD),  # Q6
        ("4", None, None, LOAD),  # Q8
        ("x9", None, ok, LOAD),  # id is not an integer
        ("7", None, "no valid line at all", LOAD),  # Q7: nothing emitted, nothing fails
    ]
    bronze = spark.createDataFrame(rows, "object_id string, config string, masking_log string, load_date timestamp")
    ops = contract.parse_masking_logs(bronze)
    q = {r["object_id"]: r["reason"] for r in contract.quarantine_documents(bronze, ops).collect()}
    assert q == {"2": "line too short for its token", "3": "count is not a number",
                 "4": "log is null", "x9": "object_id is not an integer"}
    silver = contract.silver_operations(bronze, processed_time=LOAD).collect()
    assert [(r["object_id"], r["status"], r["duration_secs"], r["duration_mins"]) for r in silver] == [
        (1, "Passed", 300.0, 5.0)]


def test_contract_schema_and_defaults(spark):
    from masklens import schemas

    text = ("01/01/2024 10:00:00 :: MASKING HAS STARTED\n"
            "01/01/2024 10:00:00 :: ERROR x\n"
            "01/01/2024 10:00:01 :: COLUMN : C1 Mask Finished")  # no start, no counts
    bronze = spark.createDataFrame([("3", None, text, LOAD)],
                                   "object_id string, config string, masking_log string, load_date timestamp")
    silver = contract.silver_operations(bronze, processed_time=dt.datetime(2024, 3, 1, 8, 0, 0, 120))
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in schemas.SILVER_OPS]
    (r,) = silver.collect()
    assert (r["cycle"], r["row_count"], r["start_time"], r["end_time"], r["duration_secs"],
            r["duration_mins"], r["object_id"], r["processed_time"], r["processed_by"], r["status"],
            r["column"], r["error"]) == (
        1, 0.0, "", "2024-01-01 10:00:01", 0.0, 0.0, 3, "2024-03-01 08:00:00.000120", "YourName",
        "Exception", None, "ERROR x")


@pytest.mark.parametrize("chunk_lines", [None, 2])
def test_optional_status_and_cycle_numbering(spark, chunk_lines):
    text = "\n".join([
        "01/01/2024 10:00:00 :: MASKING HAS STARTED",
        "01/01/2024 10:00:01 :: COLUMN : C1 Mask Started",
        "01/01/2024 10:00:02 :: NO Data found",
        "01/01/2024 10:00:03 :: COLUMN : C1 Mask Finished",
        "01/01/2024 10:00:04 :: MASKING HAS STARTED",
        "01/01/2024 10:00:05 :: COLUMN : C2 Mask Started",
        "01/01/2024 10:00:06 :: COLUMN : C2 Mask Finished",
    ])
    bronze = spark.createDataFrame([("1", None, text, LOAD)],
                                   "object_id string, config string, masking_log string, load_date timestamp")
    plain = [(r["status"], r["cycle"]) for r in
             contract.parse_masking_logs(bronze, chunk_lines=chunk_lines).orderBy("line_no").collect()]
    assert plain == [(None, 1), ("Passed", 1)]
    opt = contract.parse_masking_logs(bronze, no_data_status=True, cycle_index=True, chunk_lines=chunk_lines)
    assert [(r["status"], r["cycle"]) for r in opt.orderBy("line_no").collect()] == [
        ("No Data", 1), ("Passed", 2)]


def test_parser_plan_moves_extracted_values_only(spark):
    """The text meets no shuffle, sort or aggregate, and the rule filter runs before the first shuffle."""
    bronze = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("user_id").cast("string").alias("object_id"), F.lit(None).cast("string").alias("config"),
        F.col("props").alias("masking_log"), F.lit(LOAD).alias("load_date"))
    plan = contract.parse_masking_logs(bronze)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2, plan  # copies added up, then by document
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("Sort [") == 1
    for line in plan.splitlines():
        if "Exchange" in line or "Aggregate" in line or "Sort [" in line:
            assert "masking_log" not in line and "props" not in line and " line#" not in line, line


def test_copies_of_a_hot_document_are_added_up_before_the_shuffle(spark):
    rng = random.Random(31)
    text = random_log(rng, 40)
    bronze = spark.range(0, 3000, 1, 4).select(
        F.lit("5").alias("object_id"), F.lit(None).cast("string").alias("config"),
        F.when(F.col("id") % 3 == 0, F.lit(text)).otherwise(F.concat(F.lit(text), F.lit("\nx"), "id"))
        .alias("masking_log"), F.lit(LOAD).cast("timestamp").alias("load_date"))
    ops = contract.parse_masking_logs(bronze)
    n = len(_expected(text)[0])
    assert n and sorted(r["copies"] for r in ops.where("copies > 1").collect()) == [1000] * n
    assert contract.expand_copies(ops).count() == 3000 * n


def test_chunked_plan_shuffles_lines_once(spark):
    """A long document is spread over tasks: one Exchange of its lines, reused by every round."""
    rng = random.Random(5)
    rows = [(str(i), None, random_log(rng, 50), LOAD) for i in range(4)]
    bronze = spark.createDataFrame(rows, "object_id string, config string, masking_log string, load_date timestamp")
    ops = contract.parse_masking_logs(bronze, chunk_lines=10)
    ops.collect()
    plan = ops._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "REPARTITION_BY_COL" in final
    # every round reads the one shuffle of the lines (AQE stage reuse)
    assert "ReusedExchange [doc_id" in final
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_landed_lines_match_fold(spark):
    """Logs landed one line per row: globally sorted, chunked by partition, same result."""
    rng = random.Random(23)
    texts = [random_log(rng, rng.randrange(1, 60)) for _ in range(150)]
    rows = [(str(i), LOAD, n, line) for i, t in enumerate(texts) for n, line in enumerate(t.split("\n"))]
    lines = spark.createDataFrame(rows, "object_id string, load_date timestamp, n int, line string")
    ops = contract.parse_landed_lines(lines.repartition(5), ["n"]).collect()
    got = {}
    for r in ops:
        assert r["bad_reason"] is None
        got.setdefault(r["object_id"], []).append(r)
    strip = lambda op: tuple(v for k, v in sorted(op.items()) if k != "line_no")
    for i, text in enumerate(texts):
        exp, _ = _expected(text)
        mine = [{k: r[k] for k in exp[0]} if exp else {} for r in got.get(str(i), [])]
        assert sorted(map(strip, mine), key=repr) == sorted(map(strip, exp), key=repr), f"doc {i}"


def test_only_new_documents(spark):
    schema = "object_id string, config string, masking_log string, load_date timestamp"
    bronze = spark.createDataFrame([("1", None, "a", LOAD), ("2", None, "b", LOAD), (None, None, "c", LOAD),
                                    ("1", None, "a", dt.datetime(2024, 3, 1))], schema)
    seen = spark.createDataFrame([("1", LOAD), (None, LOAD)], "object_id string, load_date timestamp")
    new = contract.only_new_documents(bronze, seen).collect()
    assert sorted((r["object_id"], r["load_date"]) for r in new) == [
        ("1", dt.datetime(2024, 3, 1)), ("2", LOAD)]


def test_parse_failure_outranks_bad_id(spark):
    text = "01/01/2024 10:00:00 :: COLUMN : C1 Mask Started\n01/01/2024 10:01:00 :: CALCULATED Row for = x\n" \
           "01/01/2024 10:05:00 :: COLUMN : C1 Mask Finished"
    bronze = spark.createDataFrame([("x1", None, text, LOAD)],
                                   "object_id string, config string, masking_log string, load_date timestamp")
    q = contract.quarantine_documents(bronze, contract.parse_masking_logs(bronze)).collect()
    assert [(r["object_id"], r["reason"]) for r in q] == [("x1", "line too short for its token")]


def test_chunked_scan_with_null_object_id(spark):
    rng = random.Random(29)
    texts = [random_log(rng, 40) for _ in range(6)]
    rows = [(None if i % 2 else str(i), None, t, LOAD) for i, t in enumerate(texts)]
    bronze = spark.createDataFrame(rows, "object_id string, config string, masking_log string, load_date timestamp")
    single = contract.parse_masking_logs(bronze, chunk_lines=None).drop("is_op")
    chunked = contract.parse_masking_logs(bronze, chunk_lines=4).drop("is_op")
    assert single.count() > 0
    assert sorted(map(repr, single.collect())) == sorted(map(repr, chunked.collect()))


def test_null_identity_columns_keep_logs_apart(spark):
    """('x', null) and (null, 'x') are two logs, though Spark's hashes skip nulls."""
    rows = [(a, b, i, text) for a, b in (("x", None), (None, "x")) for i, text in enumerate(
        ["01/01/2024 10:00:00 :: COLUMN : C1 Mask Started", "01/01/2024 10:05:00 :: COLUMN : C1 Mask Finished"])]
    lines = spark.createDataFrame(rows, "a string, b string, n int, line string")
    ops = contract.parse_landed_lines(lines, ["n"], ident=("a", "b")).collect()
    assert len(ops) == 2
