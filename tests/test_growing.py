"""Logs landed in parts over several runs give the rows of one run."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from masklens.operators import contract
from masklens.streaming import growing
from tests.test_maskops import LOAD, random_log

FIELDS = ("object_id", "cycle", "schema", "table", "column", "status", "row_count", "distinct_row_count", "start_time", "end_time",
          "duration_secs", "duration_mins", "error")


def rows_of(df):
    return sorted(repr(tuple(r[f] for f in FIELDS)) for r in df.collect())


def part_rows(spark, logs, cuts, part):
    """Lines of part ``part`` of each log: those between two of its cuts."""
    rows = []
    for oid, text in logs.items():
        lines, own = text.split("\n"), [0, *cuts[oid], 10 ** 9]
        if part + 1 < len(own):
            rows += [(oid, LOAD, part, k, line) for k, line in enumerate(lines) if own[part] <= k < own[part + 1]]
    return spark.createDataFrame(rows, growing.PART_LINES)


def whole(spark, logs):
    return contract.silver_operations(spark.createDataFrame(
        [(oid, text, LOAD) for oid, text in logs.items()], "object_id string, masking_log string, load_date timestamp"))


def test_every_cut_of_a_log_gives_the_rows_of_one_run(spark, tmp_path):
    """One log cut in two at every line, as so many objects."""
    text = random_log(random.Random(11), 40)
    logs = {str(k): text for k in range(42)}
    cuts = {str(k): [k] for k in range(42)}
    for part in (0, 1):
        growing.process_parts(part_rows(spark, logs, cuts, part), part, str(tmp_path / "r"))
    got, want = rows_of(growing.grown_operations(spark, str(tmp_path / "r"))), rows_of(whole(spark, logs))
    assert want and got == want


def test_random_logs_in_many_parts_with_bad_ones_and_replays(spark, tmp_path):
    rnd = random.Random(5)
    logs = {str(k): random_log(rnd, rnd.randint(1, 60), short_rate=0.004 * (k % 3 == 0), bad_num_rate=0.02 * (k % 4 == 0)) for k in range(40)}
    cuts = {k: sorted(rnd.sample(range(61), 3)) for k in logs}
    root = str(tmp_path / "r")
    for part in range(4):
        frame = part_rows(spark, logs, cuts, part)
        growing.process_parts(frame, part, root)
        if part == 1:  # replayed: it replaces itself
            growing.process_parts(frame, part, root)
    growing.process_parts(part_rows(spark, logs, cuts, 2), 4, root)  # a part that comes again
    assert rows_of(growing.grown_operations(spark, root)) == rows_of(whole(spark, logs))
    bronze = spark.createDataFrame([(oid, text, LOAD) for oid, text in logs.items()], "object_id string, masking_log string, load_date timestamp")
    want = {(r.object_id, r.reason) for r in contract.quarantine_documents(bronze, contract.parse_masking_logs(bronze)).collect()}
    assert {(r.object_id, r.reason) for r in growing.grown_quarantine(spark, root).collect()} == want and want


def test_stream_of_landed_parts(spark, tmp_path):
    """Files land between runs; several parts of a log may come in one micro-batch, in any file order."""
    rnd = random.Random(9)
    logs = {str(k): random_log(rnd, 30) for k in range(4)}
    cuts = {k: [7, 15, 22] for k in logs}
    landed, root = str(tmp_path / "landed"), str(tmp_path / "r")
    for run in ((0,), (2, 1), (3,)):
        for part in run:
            part_rows(spark, logs, cuts, part).coalesce(1).write.mode("append").parquet(landed)
        growing.run_growing(spark, landed, root)
        growing.run_growing(spark, landed, root)
    assert rows_of(growing.grown_operations(spark, root)) == rows_of(whole(spark, logs))


def test_a_run_parses_its_lines_once(spark, tmp_path, monkeypatch):
    """Parsed lines are counted: the operations and the state of a run come from one scan."""
    logs = {str(k): random_log(random.Random(k), 20) for k in range(5)}
    rows = part_rows(spark, logs, {k: [20] for k in logs}, 0)
    n, seen, parse = rows.count(), spark.sparkContext.accumulator(0), growing.parse_lines

    def counted(line: str) -> str:
        seen.add(1)
        return line

    monkeypatch.setattr(growing, "parse_lines", lambda lines: parse(lines.withColumn("line", F.udf(counted)("line"))))
    growing.process_parts(rows, 0, str(tmp_path / "r"))
    assert seen.value == n
