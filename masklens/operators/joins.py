"""Operations joined to configuration rows.

Both are equi-joins on keys, left to Catalyst: a sort-merge join on the key
hash, turned into a broadcast join by AQE at run time only when a side is
measured small, and with AQE skew-join splitting when one object id carries a
large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ops_config_join(ops: DataFrame, config: DataFrame) -> DataFrame:
    """Every operation of an object with every configured column of it.

    Both inputs carry ``schema`` and ``table``; the config side's are renamed
    ``config_schema`` / ``config_table`` so the result can be written.
    """
    cfg = config.withColumnRenamed("schema", "config_schema").withColumnRenamed(
        "table", "config_table")
    return ops.join(cfg, on="object_id", how="inner")


def ops_own_config(ops: DataFrame, config: DataFrame) -> DataFrame:
    """Each operation with the config row of its own column (left join).

    Key: object, schema, table and ``column`` = ``column_name``; operations
    without a configured column keep null config fields.
    """
    cfg = config.select(
        F.col("object_id").alias("_oid"), F.col("schema").alias("_sch"),
        F.col("table").alias("_tbl"), "column_name", "data_type", "data_length",
        "pattern_name", "result", "lookup", "parameter")
    cond = ((ops["object_id"] == cfg["_oid"]) & (ops["schema"] == cfg["_sch"])
            & (ops["table"] == cfg["_tbl"]) & (ops["column"] == cfg["column_name"]))
    return ops.join(cfg, cond, "left").drop("_oid", "_sch", "_tbl")
