"""Manifest of runs and the documents landed for them.

The original loops over the manifest on the driver and fetches two URLs per
object. Here the documents are files already landed in two folders (one per
kind); loading them is one distributed scan per folder, and matching them to
the manifest is an equi-join on the file name derived from the object id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masklens import schemas

# Landed file names are the object id plus these suffixes.
CONFIG_SUFFIX = "_config.json"
LOG_SUFFIX = "_logs.txt"

LINE_ORDER = ["split_start", "split_line"]


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """S1 + F1: multi-line JSON array of runs -> (objectID, Results, Logs)."""
    return spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(path).select(
        "objectID", "Results", "Logs")


def read_landed_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """Landed files of one folder -> (filename, content), one row per file."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(folder, wholetext=True).select(
        F.col("_metadata.file_name").alias("filename"), F.col("value").alias("content"))


def read_log_lines(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """S2 for logs of any size: landed text files line by line, a file's splits read by different tasks.

    Columns: the folder's partition columns, ``filename`` (the file's path), ``split_start`` and ``split_line``
    (together the order of the lines in their file) and ``line``. Lines end at a newline only (L1).
    :data:`LINE_ORDER` is the order that ``contract.parse_landed_lines`` asks for.
    """
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text(folder)
    return text.select(
        *[c for c in text.columns if c != "value"], F.col("_metadata.file_path").alias("filename"),
        F.col("_metadata.file_block_start").alias("split_start"),
        # grows along a split, since one task reads it from its start to its end
        F.monotonically_increasing_id().alias("split_line"), F.col("value").alias("line"))


def config_file_name(object_id: Column) -> Column:
    """``{objectID}_config.json``."""
    return F.concat(object_id.cast("string"), F.lit(CONFIG_SUFFIX))


def log_file_name(object_id: Column) -> Column:
    """``{objectID}_logs.txt``."""
    return F.concat(object_id.cast("string"), F.lit(LOG_SUFFIX))


def bronze_documents(manifest: DataFrame, configs: DataFrame, logs: DataFrame,
                     load_date=None) -> DataFrame:
    """S2 + J3 + F3 + F13: a Bronze row only where *both* files landed.

    ``load_date`` defaults to the batch's ``current_timestamp()``.
    """
    stamp = F.current_timestamp() if load_date is None else F.lit(load_date).cast("timestamp")
    m = manifest.select(F.col("objectID").cast("string").alias("object_id"))
    cfg = configs.select(F.col("filename").alias("_cf"), F.col("content").alias("config"))
    log = logs.select(F.col("filename").alias("_lf"), F.col("content").alias("masking_log"))
    both = (m.join(cfg, config_file_name(m["object_id"]) == cfg["_cf"], "inner")
             .join(log, log_file_name(m["object_id"]) == log["_lf"], "inner"))
    return both.select("object_id", "config", "masking_log", stamp.alias("load_date"))


def landed_halves(manifest: DataFrame, configs: DataFrame, logs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3 + K1: the config files and the log files of manifest objects, each on its own."""
    m = manifest.select(F.col("objectID").cast("string").alias("_oid"))
    c = configs.join(m, configs["filename"] == config_file_name(m["_oid"]), "left_semi")
    lg = logs.join(m, logs["filename"] == log_file_name(m["_oid"]), "left_semi")
    return c, lg

