"""Default summaries of the two dashboard models (A2-A4).

Number columns are summed (``summarizeBy: sum``), text and time columns only
group. Sums are partial aggregates before the shuffle on the group keys.

Sums over the operations-config join (J1) never build it: the join pairs every
operation of an object with every configured column of it, so a sum over the
pairs is the operations' sum of an object times the number of its columns, and
the other way round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masklens.functions.text import py_float

# The summed columns of each model.
GOLD_SUMMED = ["cycle", "row_count", "distinct_row_count", "duration_secs", "duration_mins",
               "object_id"]
V1_SUMMED = ["row_count", "distinct_row_count", "duration(s)", "duration(min)", "cycle",
             "line_number"]


# The columns of each model that only group, in model order.
GOLD_GROUPING = ["schema", "table", "column", "status", "start_time", "end_time", "error", "processed_time", "processed_by"]
V1_GROUPING = ["schema", "table", "column", "status", "start_time", "end_time", "error"]
# Sums of 32-bit floats and fractions are rounded, as the order of the additions shows in their last digits.
ROUNDED = {"row_count", "distinct_row_count", "duration_secs", "duration_mins", "duration(min)"}


def _sum(c: str):
    return F.sum(F.col(f"`{c}`"))


def default_sums_gold(ops: DataFrame, by: list[str]) -> DataFrame:
    """A3: Gold operations summed by the grouping columns (A4)."""
    aggs = []
    for c in GOLD_SUMMED:
        s = _sum(c)
        aggs.append((F.round(s, 2) if c in ("row_count", "distinct_row_count", "duration_secs",
                                           "duration_mins") else s).alias(c))
    return ops.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n_ops"))


def v1_fact(ops: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Raw operations in the first model's names and types (13 columns).

    ``extra`` columns of ``ops`` are kept after the 13.
    """
    secs = F.coalesce(F.col("duration_secs"), F.lit(0.0))
    from masklens.operators.contract import expand_copies

    return expand_copies(ops.where(F.col("bad_reason").isNull())).select(
        F.coalesce(F.col("cycle"), F.lit(0)).cast("long").alias("cycle"),
        "schema", "table",
        F.coalesce(py_float(F.col("row_count")), F.lit(0.0)).cast("long").alias("row_count"),
        F.coalesce(py_float(F.col("distinct_row_count")), F.lit(0.0)).cast("long")
        .alias("distinct_row_count"),
        "column", "status",
        F.col("start_time").cast("timestamp").alias("start_time"),
        F.col("end_time").cast("timestamp").alias("end_time"),
        secs.cast("long").alias("duration(s)"),
        F.coalesce(F.col("duration_mins"), F.lit(0.0)).alias("duration(min)"),
        "error",
        F.col("line_no").cast("long").alias("line_number"),
        *extra,
    )


def default_sums_v1(fact: DataFrame, by: list[str]) -> DataFrame:
    """A2: the v1 fact summed by the grouping columns (A4)."""
    aggs = [(F.round(_sum(c), 2) if c == "duration(min)" else _sum(c)).alias(c) for c in V1_SUMMED]
    return fact.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n_ops"))


def default_sums_config(config_rows: DataFrame, by: list[str]) -> DataFrame:
    """A3 (config table): ``object_id`` is the only summed column."""
    return config_rows.groupBy(*by).agg(F.sum("object_id").alias("object_id"),
                                        F.count(F.lit(1)).alias("n_columns"))


def sums_by_every_column(rows: DataFrame, grouping: list[str], summed: list[str]) -> DataFrame:
    """A2-A4 for every group column of a model at once: ``column`` (its name), ``value`` (as text), the sums and ``n_ops``.

    One scan: rows are summed by all group columns together, and those sums again by GROUPING SETS of one column each. The
    groups of a column with few values are small in every task before the one shuffle.
    """
    ops = rows.groupBy(*grouping).agg(*[_sum(c).alias(c) for c in summed], F.count(F.lit(1)).alias("n_ops"))
    sets = ops.groupingSets([[F.col(f"`{c}`")] for c in grouping], *[F.col(f"`{c}`") for c in grouping]).agg(
        F.grouping_id().alias("_set"), *[(F.round(_sum(c), 2) if c in ROUNDED else _sum(c)).alias(c) for c in summed],
        F.sum("n_ops").alias("n_ops"))
    # the bit of a column is 0 where it groups; the first column has the highest bit
    every = (1 << len(grouping)) - 1
    at = [(every ^ (1 << (len(grouping) - 1 - k)), c) for k, c in enumerate(grouping)]
    name = F.coalesce(*[F.when(F.col("_set") == bits, F.lit(c)) for bits, c in at])
    value = F.coalesce(*[F.when(F.col("_set") == bits, F.col(f"`{c}`").cast("string")) for bits, c in at])
    return sets.select(name.alias("group_column"), value.alias("group_value"), *[F.col(f"`{c}`") for c in summed], "n_ops")


def join_sums(ops: DataFrame, config_rows: DataFrame, ops_by: list[str], config_by: list[str]) -> DataFrame:
    """A3 over J1: the Gold sums of all (operation, configured column) pairs of an object, by columns of either side, without the pairs.

    Columns of the config side are named ``config_<column>`` in the result. Each side is summed by object and its own group
    columns first, so a row that meets others is a group of an object, and with the columns of one side only there is
    one row an object on the other; no step has more rows than its input or the result's groups of an object. Rows without an
    object id pair with nothing, as in the join.
    """
    summed = [c for c in GOLD_SUMMED if c != "object_id"]
    left = (ops.where(F.col("object_id").isNotNull()).groupBy("object_id", *ops_by)
            .agg(*[_sum(c).alias(c) for c in summed], F.count(F.lit(1)).alias("_ops")))
    right = (config_rows.where(F.col("object_id").isNotNull()).select("object_id", *[F.col(c).alias(f"config_{c}") for c in config_by])
             .groupBy("object_id", *[f"config_{c}" for c in config_by]).agg(F.count(F.lit(1)).alias("_columns")))
    pairs = left.join(right, "object_id")
    times = lambda c: F.sum(F.col(c) * F.col("_columns"))
    return pairs.groupBy(*ops_by, *[f"config_{c}" for c in config_by]).agg(
        *[(F.round(times(c), 2) if c in ROUNDED else times(c)).alias(c) for c in summed],
        F.sum(F.col("object_id").cast("long") * F.col("_ops") * F.col("_columns")).alias("object_id"),
        F.sum(F.col("_ops") * F.col("_columns")).alias("n_pairs"))
