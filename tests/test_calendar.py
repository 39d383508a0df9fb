"""Calendar attributes, role-playing relation and the date drill-down."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from masklens.operators import calendar


def test_calendar_attributes_and_bounds(spark):
    fact = spark.createDataFrame([(dt.datetime(2023, 5, 17, 10),), (dt.datetime(2024, 2, 29, 23),)], "t timestamp")
    rows = calendar.date_dimension(fact, "t").orderBy("Date").collect()
    assert len(rows) == 365 + 366
    first, last = rows[0], rows[-1]
    assert first["Date"] == dt.date(2023, 1, 1) and last["Date"] == dt.date(2024, 12, 31)
    r = [x for x in rows if x["Date"] == dt.date(2024, 2, 29)][0]
    assert (r["Year"], r["MonthNo"], r["Month"], r["QuarterNo"], r["Quarter"], r["Day"]) == (
        2024, 2, "February", 1, "Qtr 1", 29)


def test_relate_and_drilldown(spark):
    fact = spark.createDataFrame(
        [(dt.datetime(2024, 1, 5, 1), 1.0), (dt.datetime(2024, 1, 5, 9), 2.0), (dt.datetime(2024, 4, 1), 4.0)],
        "t timestamp, v double")
    daily = fact.groupBy(F.to_date("t").alias("_d")).agg(F.sum("v").alias("v"))
    rel = calendar.relate_dates(daily, calendar.date_dimension(daily, "_d"), "_d", "")
    out = calendar.drilldown(rel, {"v": F.sum("v")}).collect()
    by_level = {}
    for r in out:
        by_level.setdefault(r["level"], []).append(r)
    assert [r["v"] for r in by_level[15]] == [7.0]
    assert sorted((r["Quarter"], r["v"]) for r in by_level[3]) == [("Qtr 1", 3.0), ("Qtr 2", 4.0)]
    assert sorted((r["Month"], r["Day"], r["v"]) for r in by_level[0]) == [("April", 1, 4.0), ("January", 5, 3.0)]


def test_null_dates_have_no_bounds(spark):
    fact = spark.createDataFrame([(None, 1), (dt.datetime(2024, 1, 5), 2)], "t timestamp, v int")
    rel = calendar.relate_dates(fact, calendar.date_dimension(fact, "t"), "t", "")
    assert sorted((r["v"], r["Year"]) for r in rel.collect()) == [(1, None), (2, 2024)]
    none = fact.where("t is null")
    assert calendar.date_dimension(none, "t").count() == 0
    assert calendar.relate_dates(none, calendar.date_dimension(none, "t"), "t", "").count() == 1


def test_the_fact_is_read_once(spark):
    """Bounds, calendars and sums share one computation of the per-day sums."""
    from masklens.plans import catalog

    for name, reads in (("fact_by_date", 2), ("date_drilldown", 1), ("ops_by_date", 1)):
        df = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("FileScan parquet") == reads, (name, final)
