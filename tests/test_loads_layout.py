import collections
import datetime as dt
import random
import re

from pyspark.sql import functions as F

from masklens.operators import calendar, layout, loads
from masklens.operators.batches import Ledger


def test_bitmaps_count_distinct_objects_over_loads(spark, tmp_path):
    """Against sets: negative ids, nulls, repeated ids, a load that comes again with other rows, an empty one."""
    rnd, path, seen, want = random.Random(1), str(tmp_path / "b"), set(), {}
    own = {f"l{k}": [rnd.choice((None, 0, -1, -32768, -32767, 32768, 32769, rnd.randrange(-10 ** 6, 10 ** 6), rnd.randrange(5))) for _ in range(300)]
           for k in range(4)}
    own["l4"] = []
    loads.add_load_bitmaps(spark.createDataFrame([(1,), (10 ** 9,)], "object_id int"), path, "l2")  # replaced below
    for name, ids in own.items():
        loads.add_load_bitmaps(spark.createDataFrame([(i,) for i in ids], "object_id int"), path, name)
        seen |= {i for i in ids if i is not None}
        want[name] = len(seen)
    got = {r.load_id: r.n_objects for r in loads.distinct_over_loads(spark, path).collect()}
    del want["l4"]  # a load without ids has no bitmaps
    assert got == want


def rollup_of(rows):
    out = collections.Counter()
    for day, price in rows:
        keys = [None] * 4 if day is None else [day.year, (day.month + 2) // 3, day.month, day.day]
        for k in range(5):
            out[((1 << (4 - k)) - 1, *keys[:k], *[None] * (4 - k))] += price
    return dict(out)


def test_rollup_is_kept_up_to_date(spark, tmp_path):
    """Equal to the full rollup after each of several loads: late days, rows without a date, a load that comes twice, a torn version."""
    rnd, table = random.Random(2), loads.RollupTable(spark, str(tmp_path / "r"), {"price": "p"})
    rows, applied = [], []
    assert table.rows().count() == 0
    for k in range(5):
        own = [(rnd.choice((None, dt.date(2024, 1, 1) + dt.timedelta(rnd.randrange(400) - 100 * k))), rnd.randrange(100)) for _ in range(40)] if k != 3 else []
        load = spark.createDataFrame(own, "t date, p int")
        if k == 2:  # cut off before it was recorded
            load.write.parquet(str(tmp_path / "r" / "versions" / "00000002.load-2"))
        assert table.apply(load, "t", f"load-{k}") and not table.apply(load, "t", f"load-{k}")
        rows += own
        got = {(r.level, r.Year, r.QuarterNo, r.MonthNo, r.Day): r.price for r in table.rows().collect()}
        assert got == rollup_of(rows)
        applied.append(k)
    assert Ledger(spark, str(tmp_path / "r")).rows().count() == 5


def test_bucketed_joins_have_no_exchange(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS colocated_test")
    try:
        ops = [(i % 7 if i % 3 else 3, "S", "T", f"C{i % 4}", i) for i in range(200)] + [(None, "S", "T", "C1", 900)]
        cfg = [(i, "S", "T", f"C{c}", "V", "1", "p", "r", "", "x") for i in range(6) for c in range(3)]
        names = "object_id int, schema string, table string, column_name string, data_type string, data_length string, pattern_name string, result string, lookup string, parameter string"
        left = spark.createDataFrame(ops, "object_id int, schema string, table string, column string, n int")
        right = spark.createDataFrame(cfg, names)
        layout.write_bucketed(left, "colocated_test.ops", ["object_id"], str(tmp_path / "o"), buckets=4)
        layout.write_bucketed(right, "colocated_test.cfg", ["object_id"], str(tmp_path / "c"), buckets=4)
        from masklens.operators import joins

        for build, plain in ((layout.own_config_colocated, joins.ops_own_config), (layout.config_join_colocated, joins.ops_config_join)):
            df = build(spark, "colocated_test.ops", "colocated_test.cfg")
            got = sorted(map(str, df.collect()))
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert got == sorted(map(str, plain(left, right).collect()))
    finally:
        spark.sql("DROP DATABASE colocated_test CASCADE")


def test_a_quarter_reads_its_own_days(spark, tmp_path):
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(366)]
    rows = [(dt.datetime(d.year, d.month, d.day, k), k) for d in days[::5] for k in range(3)] + [(None, 9)]
    layout.write_by_day(spark.createDataFrame(rows, "t timestamp, n int"), str(tmp_path / "f"), "t")
    fact = spark.read.parquet(str(tmp_path / "f"))
    assert fact.count() == len(rows)
    calendar.date_dimension(fact.select(layout.DAY).distinct(), layout.DAY).write.parquet(str(tmp_path / "c"))
    dates = spark.read.parquet(str(tmp_path / "c"))
    df = layout.days_of(fact, dates, (F.col("Year") == 2024) & (F.col("QuarterNo") == 2))
    got = df.collect()
    want = [d for d in days[::5] if 4 <= d.month <= 6]
    assert sorted({r.Date for r in got}) == want and len(got) == 3 * len(want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan)
    named = layout.days_of(fact.withColumn("f", F.input_file_name()), dates, (F.col("Year") == 2024) & (F.col("QuarterNo") == 2)).collect()
    assert {re.search(r"load_day=([0-9-]+)", r.f)[1] for r in named} == {str(d) for d in want}
