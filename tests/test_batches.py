import datetime as dt
import json
import uuid

import pytest

from masklens import schemas
from masklens.operators import batches, sinks

STAMP = dt.datetime(2024, 2, 1)
LOG = "01/02/2024 00:00:01 :: COLUMN : {c} Mask Started\n01/02/2024 00:00:05 :: COLUMN : {c} Mask Finished"
ELEMENT = {"column_name": "C", "data_type": "V", "data_length": "1", "pattern_name": "p", "Result": "r", "parameter": "x"}


def load(spark, ids):
    rows = [(str(i), json.dumps({"S": {"T": [ELEMENT]}}), LOG.format(c=f"C{i}"), STAMP) for i in ids]
    return spark.createDataFrame(rows, schemas.BRONZE)


@pytest.fixture
def gold(spark, tmp_path):
    name = f"gold_{uuid.uuid4().hex}"
    batches.create_gold_batches(spark, name, location=str(tmp_path / "gold"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def gold_rows(spark, gold):
    return (sorted((r.batch_id, r.object_id, r.column) for r in spark.table(f"{gold}.{sinks.GOLD_LOGS}").collect()),
            sorted((r.batch_id, r.object_id) for r in spark.table(f"{gold}.{sinks.GOLD_CONFIG}").collect()))


def expected(by_batch):
    return (sorted((b, i, f"C{i}") for b, ids in by_batch.items() for i in ids), sorted((b, i) for b, ids in by_batch.items() for i in ids))


def test_a_run_cut_off_between_any_two_writes_gives_each_row_once(spark, tmp_path, gold, monkeypatch):
    """The run is ended before and after each of its ledger entries; then it is repeated, the last one twice."""
    commit, seen = batches.Ledger.commit, []
    for k in range(10):
        root = str(tmp_path / f"root{k}")
        own = f"b{k}"
        left = [k // 2]

        def cut_off(self, sink, batch_id, left=left, late=k % 2):
            left[0] -= 1
            if left[0] < 0:
                if late:  # the entry was written, the run ended right after it
                    commit(self, sink, batch_id)
                raise KeyboardInterrupt
            commit(self, sink, batch_id)

        monkeypatch.setattr(batches.Ledger, "commit", cut_off)
        with pytest.raises(KeyboardInterrupt):
            batches.run_batch(spark, load(spark, [k, 100 + k]), own, root, gold, STAMP)
        monkeypatch.setattr(batches.Ledger, "commit", commit)
        for _ in range(1 + (k == 9)):
            assert batches.run_batch(spark, load(spark, [k, 100 + k]), own, root, gold, STAMP) == {sinks.GOLD_LOGS: None, sinks.GOLD_CONFIG: None}
        seen.append(k)
    assert gold_rows(spark, gold) == expected({f"b{j}": [j, 100 + j] for j in seen})


def test_batches_stand_side_by_side_and_empty_ones_leave_nothing(spark, tmp_path, gold):
    root = str(tmp_path / "root")
    batches.run_batch(spark, load(spark, [1, 2]), "a", root, gold, STAMP, until="silver")
    batches.run_batch(spark, load(spark, []), "none", root, gold, STAMP, until="silver")
    batches.run_batch(spark, load(spark, [3]), "b", root, gold, STAMP)  # copies all three
    assert gold_rows(spark, gold) == expected({"a": [1, 2], "b": [3]})
    ledger = batches.Ledger(spark, root)
    assert ledger.has(f"{gold}.{sinks.GOLD_LOGS}", "none") and not ledger.has(batches.sink_name(batches.BRONZE), "c")
    # what a cut-off run left without a ledger entry is not read
    sinks.overwrite_path(spark.read.parquet(f"{root}/{batches.SILVER_OPS}/batch_id=a"), f"{root}/{batches.SILVER_OPS}/batch_id=torn")
    got = batches.committed(spark, ledger, root, batches.SILVER_OPS)
    assert {r.batch_id for r in got.select("batch_id").distinct().collect()} == {"a", "b"}


def test_one_copy_fails_the_other_runs(spark, tmp_path, gold):
    root = str(tmp_path / "root")
    spark.sql(f"DROP TABLE {gold}.{sinks.GOLD_LOGS}")
    got = batches.run_batch(spark, load(spark, [1]), "a", root, gold, STAMP)
    assert got[sinks.GOLD_CONFIG] is None and got[sinks.GOLD_LOGS]
    batches.create_gold_batches(spark, gold)
    assert batches.run_batch(spark, load(spark, [1]), "a", root, gold, STAMP)[sinks.GOLD_LOGS] is None
    assert gold_rows(spark, gold) == expected({"a": [1]})


def test_odd_names_and_stages_are_rejected(spark, tmp_path):
    for name in ("", "a/b", "..", "x=y", "a'b"):
        with pytest.raises(ValueError):
            batches.run_batch(spark, load(spark, [1]), name, str(tmp_path / "r"))
    with pytest.raises(ValueError):
        batches.run_batch(spark, load(spark, [1]), "a", str(tmp_path / "r"), until="silvr")
