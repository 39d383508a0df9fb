"""Masking configuration documents -> one row per configured column.

A config is JSON ``{schema: {table: [{column_name, data_type, data_length,
pattern_name, Result, lookup?, parameter}, ...]}}``, possibly with every quote
doubled. The original un-doubles quotes, parses with Python's json module,
walks the dict on the driver and dies on a missing key. Here parsing is
``from_json`` into nested maps, the walk is three ``explode``s, and every
document is validated in its own row (higher-order functions over the parsed
maps, no shuffle) so a bad document goes to quarantine alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONFIG_TYPE = "map<string,map<string,array<map<string,string>>>>"
# Python's json rejects single quotes; Spark's reader allows them by default.
JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNumericLeadingZeros": "false",
                "allowUnquotedFieldNames": "false", "allowComments": "false"}

# Required element keys in output order, with output names.
REQUIRED_KEYS = [
    ("column_name", "column_name"),
    ("data_type", "data_type"),
    ("data_length", "data_length"),
    ("pattern_name", "pattern_name"),
    ("Result", "result"),
    ("parameter", "parameter"),
]
OPTIONAL_KEY, OPTIONAL_DEFAULT = "lookup", ""


def undouble_quotes(c: Column) -> Column:
    """``""`` -> ``"`` left to right."""
    return F.replace(c, F.lit('""'), F.lit('"'))


def _dedup(m: Column) -> Column:
    """Duplicate JSON keys keep the last value (needs mapKeyDedupPolicy=LAST_WIN)."""
    return F.map_from_entries(F.map_entries(m))


def _last_key_wins(df: DataFrame) -> None:
    # map_from_entries resolves duplicate keys by this session setting
    df.sparkSession.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")


def _parse_text(text: Column) -> Column:
    parsed = F.from_json(text, CONFIG_TYPE, JSON_OPTIONS)
    # trailing JSON whitespace; the lookbehind keeps the match linear
    ends_ok = F.regexp_replace(text, r"(?<![ \t\n\r])[ \t\n\r]+$", "").endswith("}")
    # one value and nothing after it: the only element of an array, and the only member of an object. A text that
    # closes the bracket around it and opens another one can do so for one of the two kinds only.
    alone = ((F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1)
             & (F.size(F.json_object_keys(F.concat(F.lit('{"k":'), text, F.lit("}")))) == 1))
    return F.when(ends_ok & alone, parsed)


def parse_config(c: Column, raw_first: bool = False) -> Column:
    """Config text -> nested maps, duplicate keys resolved as Python does.

    Null when the text is not JSON of the expected shape, or when text follows
    the closing brace. The original always un-doubles quotes first, which
    breaks a normally quoted config holding an empty string (Q9); with
    ``raw_first`` the text is parsed as it is and un-doubled only if that fails.
    """
    parsed = _parse_text(undouble_quotes(c))
    if raw_first:
        parsed = F.coalesce(_parse_text(c), parsed)
    return F.transform_values(
        _dedup(parsed),
        lambda _s, tables: F.transform_values(
            _dedup(tables),
            lambda _t, cols: F.transform(cols, lambda e: F.when(e.isNotNull(), _dedup(e)))))


def config_problem(parsed: Column, raw: Column) -> Column:
    """Why a config document cannot be flattened, or null when it can."""
    def bad_element(e):
        missing = F.lit(False)
        for key, _ in REQUIRED_KEYS:
            missing = missing | ~F.map_contains_key(e, key)
        return e.isNull() | missing

    bad_shape = F.exists(
        F.map_values(parsed),
        lambda tables: tables.isNull() | F.exists(
            F.map_values(tables),
            lambda cols: cols.isNull() | F.exists(cols, bad_element)))
    return (
        F.when(raw.isNull(), F.lit("config is null"))
        .when(parsed.isNull(), F.lit("config is not JSON of the expected shape"))
        .when(bad_shape, F.lit("config element lacks a required key"))
    )


def flatten_config(bronze: DataFrame, config_col: str = "config", with_lookup: bool = True,
                   keep_problem: bool = False, raw_first: bool = False) -> DataFrame:
    """C3-C7 (+F13): one row per configured column, Silver config schema.

    ``object_id`` is cast to int; with ``with_lookup`` the optional ``lookup``
    is '' when absent and null when given as null (ten-column form), else the
    nine-column form (C8). Documents with a problem are left out unless
    ``keep_problem`` (then a ``problem`` column tells which). ``raw_first``:
    see :func:`parse_config`.
    """
    _last_key_wins(bronze)
    raw = F.col(config_col)
    docs = bronze.select("object_id", raw.alias("_raw"), parse_config(raw, raw_first).alias("_cfg"))
    docs = docs.select("object_id", "_cfg", F.coalesce(
        config_problem(F.col("_cfg"), F.col("_raw")),
        F.when(F.col("object_id").isNotNull() & F.col("object_id").try_cast("int").isNull(),
               F.lit("object_id is not an integer"))).alias("problem"))
    # explode_outer + a filter on the generated column: a filter on ``_cfg``
    # itself would be pushed below the projection and parse the JSON twice.
    cfg = F.col("_cfg") if keep_problem else F.when(F.col("problem").isNull(), F.col("_cfg"))
    s = docs.select("object_id", "problem", F.explode_outer(cfg).alias("schema", "_tables"))
    if not keep_problem:
        s = s.where(F.col("schema").isNotNull())
    t = s.select("object_id", "problem", "schema", F.explode("_tables").alias("table", "_cols"))
    e = t.select("object_id", "problem", "schema", "table", F.explode("_cols").alias("_e"))
    el = F.col("_e")
    out = [
        F.col("object_id").try_cast("int").alias("object_id"),
        F.col("schema"), F.col("table"),
    ]
    fields = [el[k].alias(name) for k, name in REQUIRED_KEYS]
    if with_lookup:
        lookup = F.when(~F.map_contains_key(el, OPTIONAL_KEY), F.lit(OPTIONAL_DEFAULT)).otherwise(
            el[OPTIONAL_KEY]).alias("lookup")
        fields = fields[:5] + [lookup] + fields[5:]
    cols = out + fields + ([F.col("problem")] if keep_problem else [])
    return e.select(*cols)


def config_nine_columns(bronze: DataFrame, config_col: str = "config") -> DataFrame:
    """The first notebook cell's nine-column form (no ``lookup``)."""
    return flatten_config(bronze, config_col, with_lookup=False)


def config_union(bronze: DataFrame, config_col: str = "config") -> DataFrame:
    """Both appends of one run as a single union by name.

    The nine-column rows get a null ``lookup``, as the shared table would.
    Each configured column is parsed once and emitted in both forms (a
    two-element explode), instead of parsing every document twice.
    """
    rows = flatten_config(bronze, config_col)
    both = rows.select("*", F.explode(F.array(F.lit(9), F.lit(10))).alias("_form"))
    return both.withColumn("lookup", F.when(F.col("_form") == 10, F.col("lookup"))).drop("_form")


def config_quarantine(bronze: DataFrame, config_col: str = "config", raw_first: bool = False) -> DataFrame:
    """Config documents that cannot be flattened, with the reason.

    ``raw_first`` must be the one given to :func:`flatten_config`.
    """
    _last_key_wins(bronze)
    raw = F.col(config_col)
    parsed = parse_config(raw, raw_first)
    problem = F.coalesce(config_problem(parsed, raw), F.when(
        F.col("object_id").isNotNull() & F.col("object_id").try_cast("int").isNull(),
        F.lit("object_id is not an integer")))
    return bronze.select("object_id", problem.alias("reason")).where(F.col("reason").isNotNull())


def distinct_objects(config_rows: DataFrame) -> DataFrame:
    """A1: ``count(distinct object_id)`` of the flattened config."""
    return config_rows.agg(F.countDistinct("object_id").alias("n_objects"))
