"""Operations CSV of the first dashboard model.

The model picks one file by name from a folder (a required parameter with a
list of allowed values), reads it as comma-separated text in code page 1252
with quotes not special, promotes the header and retypes the columns, where a
value that does not convert becomes null. Columns are bound by the names in
the chosen file's own header, in whatever order they stand there. The folder
holds plain files, or folders ``file_name=...`` as Spark writes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from masklens import schemas

# The parameter's allowed files and its default.
ALLOWED_FILES = [
    "LMS_CMSDM_Logs_3_Cycles.csv",
    "LMS_CLMDM_Logs_3_Cycles.csv",
    "execution_log_azure_mssql.csv",
    "execution_log_oracle_peoplesoft_multiple_cycles.csv",
    "LMS_LMSDM_Logs_3_Cycles.csv",
    "abcd",
]
DEFAULT_FILE = "LMS_LMSDM_Logs_3_Cycles.csv"
CSV_OPTIONS = {"sep": ",", "quote": "", "encoding": "windows-1252", "header": "true"}
TEXT_TIME_FMT = "yyyy-MM-dd HH:mm:ss"


def check_file_name(name: str) -> str:
    """The parameter must be one of the allowed values."""
    if name not in ALLOWED_FILES:
        raise ValueError(f"file {name!r} is not one of the allowed files")
    return name


def write_ops_csv(fact: DataFrame, folder: str, file_col: str = "file_name") -> None:
    """Write v1 operations as CSV text partitioned by ``file_col`` (fixture side)."""
    text = fact.select(
        *[F.col(f"`{f.name}`").cast("string").alias(f.name) if f.name not in ("start_time", "end_time")
          else F.date_format(F.col(f.name), TEXT_TIME_FMT).alias(f.name)
          for f in schemas.OPS_CSV_V1.fields],
        F.col(file_col))
    (text.write.mode("overwrite").partitionBy(file_col)
     .option("sep", ",").option("quote", "").option("encoding", "windows-1252")
     .option("header", "true").csv(folder))


def _retype(raw: DataFrame) -> DataFrame:
    """Promoted header columns retyped; a value that does not convert is null."""
    missing = [f.name for f in schemas.OPS_CSV_V1.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"the file's header lacks {', '.join(missing)}")
    out = []
    for f in schemas.OPS_CSV_V1.fields:
        c = F.col(f"`{f.name}`")
        if f.name in ("start_time", "end_time"):
            # the text format first, then whatever else Spark reads as a date and time
            known = F.try_to_timestamp(c, F.lit(TEXT_TIME_FMT)).cast("timestamp_ntz")
            out.append(F.coalesce(known, c.try_cast("timestamp_ntz")).alias(f.name))
        elif isinstance(f.dataType, StringType):
            # an empty field is empty text (unquoted CSV cannot tell it from null)
            out.append(F.coalesce(c, F.lit("")).alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    return raw.select(*out)


def read_named_file(spark: SparkSession, folder: str, file_name: str = DEFAULT_FILE) -> DataFrame:
    """S9 + S10 + S12 for a folder of plain CSV files: the one named ``file_name``.

    The name is matched exactly (glob characters escaped), so only that
    file is listed and read.
    """
    check_file_name(file_name)
    exact = "".join(f"[{ch}]" if ch in "*?[]{}\\" else ch for ch in file_name)
    raw = (spark.read.options(**CSV_OPTIONS).option("pathGlobFilter", exact)
           .option("recursiveFileLookup", "false").csv(folder))
    return _retype(raw)


def read_selected(spark: SparkSession, folder: str, file_name: str = DEFAULT_FILE) -> DataFrame:
    """S9 + S10 + S12: the chosen file's rows, typed; bad values become null.

    Only the chosen file's folder is listed and read, by its own header.
    """
    check_file_name(file_name)
    return _retype(spark.read.options(**CSV_OPTIONS).csv(f"{folder}/file_name={file_name}"))
