"""Fixed schemas of the masking-log data model (names and order are contract)."""

from pyspark.sql.types import (
    DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampType,
)


def _struct(*fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# Bronze document table: one row per landed (config, log) pair.
BRONZE = _struct(
    ("object_id", StringType()),
    ("config", StringType()),
    ("masking_log", StringType()),
    ("load_date", TimestampType()),
)

# Landed file table: one row per downloaded file.
LANDED_FILE = _struct(("filename", StringType()), ("content", StringType()))

# Manifest of runs (inferred in the original; fixed here).
MANIFEST = _struct(("objectID", StringType()), ("Results", StringType()), ("Logs", StringType()))

# Silver operations; order matters for appends.
SILVER_OPS = _struct(
    ("cycle", IntegerType()),
    ("schema", StringType()),
    ("table", StringType()),
    ("row_count", FloatType()),
    ("distinct_row_count", FloatType()),
    ("column", StringType()),
    ("status", StringType()),
    ("start_time", StringType()),
    ("end_time", StringType()),
    ("duration_secs", FloatType()),
    ("duration_mins", FloatType()),
    ("error", StringType()),
    ("object_id", IntegerType()),
    ("processed_time", StringType()),
    ("processed_by", StringType()),
)

# Silver config, ten-column form (the nine-column form drops ``lookup``).
SILVER_CONFIG = _struct(
    ("object_id", IntegerType()),
    ("schema", StringType()),
    ("table", StringType()),
    ("column_name", StringType()),
    ("data_type", StringType()),
    ("data_length", StringType()),
    ("pattern_name", StringType()),
    ("result", StringType()),
    ("lookup", StringType()),
    ("parameter", StringType()),
)
SILVER_CONFIG_9 = StructType([f for f in SILVER_CONFIG.fields if f.name != "lookup"])

# Operations CSV of the first dashboard model, in its typing order.
OPS_CSV_V1 = _struct(
    ("cycle", LongType()),
    ("schema", StringType()),
    ("table", StringType()),
    ("row_count", LongType()),
    ("distinct_row_count", LongType()),
    ("column", StringType()),
    ("status", StringType()),
    ("start_time", TimestampType()),
    ("end_time", TimestampType()),
    ("duration(s)", LongType()),
    ("duration(min)", DoubleType()),
    ("error", StringType()),
    ("line_number", LongType()),
)

# Activity feed: sixteen text fields, fixed values of the copy mapping.
FEED_FIELDS = [
    "post_id", "post_title", "permalink", "time", "user_id", "display_name", "ip_address",
    "response_status", "referer", "time_spent", "city", "user_email", "username", "post_slug",
    "post_type", "user_role",
]
FEED = _struct(*[(name, StringType()) for name in FEED_FIELDS])

# Gold keeps Silver's columns; text is cut to this many characters.
GOLD_VARCHAR = 8000
