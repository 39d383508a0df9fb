"""Table writes and the Gold copy.

Writes are plain DataFrame writes (parquet by default; pass ``fmt="delta"``
where the Delta package is installed). One write per batch, never per row.
Before a write the rows are rebalanced by AQE (``REBALANCE`` hint), which
splits skewed partitions and merges small ones into sensible file sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from masklens import schemas

GOLD_DB = "LogsAndConfigs"
GOLD_LOGS = "masking_logs_results"
GOLD_CONFIG = "masking_config_results"


def cut_bytes(c: Column, max_bytes: int) -> Column:
    """Text cut to at most ``max_bytes`` bytes of UTF-8, between two characters."""
    raw = F.encode(c, "UTF-8")

    def begins(at: int) -> Column:  # the byte after the first ``at`` ones is not inside a character
        return ~F.hex(F.substring(raw, at + 1, 1)).between("80", "BF")

    ends = [max_bytes - k for k in range(3) if max_bytes > k]
    cut = F.lit(max(max_bytes - 3, 0))  # a character has at most four bytes
    for at in reversed(ends):
        cut = F.when(begins(at), F.lit(at)).otherwise(cut)
    return F.when(F.octet_length(c) <= max_bytes, c).otherwise(
        F.decode(F.substring(raw, F.lit(1), cut), "UTF-8"))


def conform(df: DataFrame, target: StructType, max_text: int = schemas.GOLD_VARCHAR) -> DataFrame:
    """cast every column to the target type (null when it does not fit),
    cut text to ``max_text`` bytes of UTF-8, keep the target's column order."""
    cols = []
    present = set(df.columns)
    for f in target.fields:
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{f.name}`").try_cast(f.dataType)
        if isinstance(f.dataType, StringType):
            c = cut_bytes(c, max_text)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def gold_logs(silver_ops: DataFrame) -> DataFrame:
    """K6 rows: Silver operations conformed to the Gold logs table."""
    return conform(silver_ops, schemas.SILVER_OPS)


def gold_config(silver_config: DataFrame) -> DataFrame:
    """K7 rows: Silver config conformed to the Gold config table."""
    return conform(silver_config, schemas.SILVER_CONFIG)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_gold(spark: SparkSession, location: str | None = None, fmt: str = "parquet",
                database: str = GOLD_DB) -> None:
    """K9: ``CREATE SCHEMA`` and the two Gold tables, if missing."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    for name, schema in ((GOLD_LOGS, schemas.SILVER_OPS), (GOLD_CONFIG, schemas.SILVER_CONFIG)):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_ddl(schema)}) USING {fmt}")


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def append_table(df: DataFrame, name: str) -> None:
    """K6/K7/K8 into a catalog table: ``INSERT INTO`` by position after conforming."""
    df.hint("rebalance").write.insertInto(name)


def append_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K1-K4, K8: append a batch to a table folder (an empty batch adds nothing)."""
    df.hint("rebalance").write.mode("append").format(fmt).save(path)


def overwrite_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K5: overwrite a table folder."""
    df.hint("rebalance").write.mode("overwrite").format(fmt).save(path)


def copy_to_gold(spark: SparkSession, silver_ops: DataFrame, silver_config: DataFrame,
                 database: str = GOLD_DB) -> dict:
    """K6 then K7: the config copy runs after the logs copy, whether or not it failed.

    Returns {table: None or the error text}.
    """
    result = {}
    for name, rows in ((GOLD_LOGS, gold_logs(silver_ops)), (GOLD_CONFIG, gold_config(silver_config))):
        try:
            append_table(rows, f"{database}.{name}")
            result[name] = None
        except Exception as exc:  # one copy failing does not stop the other
            result[name] = str(exc)
    return result


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, as ``show()`` displays them."""
    return df.limit(n)
