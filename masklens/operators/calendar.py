"""Date dimension, role-playing date relationships and the date drill-down.

D1-D7: a calendar from 1 January of the fact's first year to 31 December of
its last (A5), with Year, MonthNo, Month (en-US name), QuarterNo, Quarter
("Qtr n") and Day. J2 relates a fact's date part to it; A6 sums a fact over
Year > Quarter > Month > Day with subtotals (rollup), sorted by the number
columns (O1).

Scale: the fact is first summed per day (partial aggregation before the
shuffle), and everything here, the calendar's bounds included, works on those
sums, so the fact is read once and no job runs while a query is built. How the
calendar is joined is left to Catalyst and AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIM_COLUMNS = ["Date", "Year", "MonthNo", "Month", "QuarterNo", "Quarter", "Day"]


def date_attributes(d: Column) -> list[Column]:
    """D2-D7 for a DATE column, named as the model names them."""
    return [
        F.year(d).cast("long").alias("Year"),
        F.month(d).cast("long").alias("MonthNo"),
        F.date_format(d, "MMMM").alias("Month"),
        F.quarter(d).cast("long").alias("QuarterNo"),
        F.concat(F.lit("Qtr "), F.quarter(d).cast("string")).alias("Quarter"),
        F.dayofmonth(d).cast("long").alias("Day"),
    ]


def year_bounds(daily: DataFrame, date_col: str) -> DataFrame:
    """A5: one row (y0, y1) = first and last year of ``date_col``.

    The years are compared together with the row they stand in. The first field decides, so the result is that
    of the years alone, but every column stays in use: the plan below is the very one that ``daily`` has
    elsewhere in the query, and Spark runs it once (a reused exchange).
    """
    y = F.year(F.to_date(F.col(date_col)))
    row = F.when(y.isNotNull(), F.struct(y.alias("_year"), *[F.col(f"`{c}`") for c in daily.columns]))
    return daily.agg(F.min(row)["_year"].alias("y0"), F.max(row)["_year"].alias("y1"))


def calendar(bounds: DataFrame) -> DataFrame:
    """Every day from 1 Jan of y0 to 31 Dec of y1, with D2-D7 attributes."""
    days = bounds.where(F.col("y0").isNotNull()).select(F.explode(F.sequence(
        F.make_date(F.col("y0"), F.lit(1), F.lit(1)),
        F.make_date(F.col("y1"), F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("Date"))
    return days.select("Date", *date_attributes(F.col("Date")))


def date_dimension(daily: DataFrame, date_col: str) -> DataFrame:
    """Calendar over the years of ``date_col``, as part of the plan it is used in.

    ``daily`` is best a fact's sums per day; its columns must be orderable.
    """
    return calendar(year_bounds(daily, date_col))


def relate_dates(fact: DataFrame, dim: DataFrame, date_col: str, role: str) -> DataFrame:
    """Fact LEFT JOIN calendar on the date part of ``date_col``.

    The calendar's columns get the ``role`` prefix (role-playing dimension).
    """
    renamed = dim.select(*[F.col(c).alias(f"{role}{c}") for c in DIM_COLUMNS])
    return fact.join(renamed, F.to_date(F.col(date_col)) == F.col(f"{role}Date"), "left")


def drilldown(daily: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """A6 + O1: rollup Year > Quarter > Month > Day over per-day partial sums.

    ``daily`` has the dimension columns (Year, QuarterNo, MonthNo, Day) and
    the per-day partial measures; ``measures`` maps output names to the
    re-aggregation (e.g. ``F.sum("n")``). ``level`` is ``grouping_id()``: 0
    for days, 1 months, 3 quarters, 7 years, 15 the grand total.
    """
    keys = ["Year", "QuarterNo", "MonthNo", "Day"]
    agg = daily.rollup(*keys).agg(
        *[c.alias(n) for n, c in measures.items()], F.grouping_id().alias("level"))
    month_name = F.date_format(F.make_date(F.lit(2000), F.col("MonthNo").cast("int"), F.lit(1)), "MMMM")
    return agg.select(
        "Year", "QuarterNo",
        F.when(F.col("QuarterNo").isNotNull(),
               F.concat(F.lit("Qtr "), F.col("QuarterNo").cast("string"))).alias("Quarter"),
        "MonthNo", F.when(F.col("MonthNo").isNotNull(), month_name).alias("Month"),
        "Day", "level", *measures.keys(),
    ).orderBy(*[F.col(k).asc_nulls_last() for k in keys])
