"""Python string semantics reproduced with JVM functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from masklens.functions.text import parse_log_time, py_float, py_split, py_strip

STRINGS = [
    "", " ", "abc", "  a b  ", "\ta\tb\r", " x y　", "\x1cz\x1f", "a​b",
    "x\x85y", " \r\n ", "1 2  3", " q ",
]
TIMES = [
    "01/02/2024 10:00:00", "1/2/2024 3:4:5", " 01/02/2024\t10:00:00 ", "01/02/2024  10:00:00",
    "31/02/2024 10:00:00", "01/13/2024 10:00:00", "01/02/0000 10:00:00", "01/02/24 10:00:00",
    "01/02/2024 24:00:00", "01/02/2024 10:60:00", "01/02/2024 10:00:60", "01/02/2024T10:00:00",
    "001/02/2024 10:00:00", "01/02/2024 10:00", "29/02/2024 23:59:59", "x", "",
]
FLOATS = ["1", "1.5", "-2", "+3.", ".5", "1e3", "1E-2", "1_000", "1,000", "1__0", "_1", "1.5f", "inf",
          "-Infinity", "nan", "0x10", "", " 7 ", "1e", "abc", "12.30"]


def _py_time(s):
    try:
        return dt.datetime.strptime(s.strip(), "%d/%m/%Y %H:%M:%S")
    except ValueError:
        return None


def _py_float(s):
    try:
        return float(s)
    except ValueError:
        return None


def test_strip_and_split(spark):
    df = spark.createDataFrame([(s,) for s in STRINGS], "s string")
    got = df.select(py_strip(F.col("s")).alias("t"), py_split(py_strip(F.col("s"))).alias("k")).collect()
    for s, r in zip(STRINGS, got):
        assert r["t"] == s.strip(), repr(s)
        assert r["k"] == s.split(), repr(s)


def test_log_time_like_strptime(spark):
    df = spark.createDataFrame([(s,) for s in TIMES], "s string")
    got = [r[0] for r in df.select(parse_log_time(F.col("s"))).collect()]
    assert got == [_py_time(s) for s in TIMES]


def test_float_like_python(spark):
    df = spark.createDataFrame([(s,) for s in FLOATS], "s string")
    got = [r[0] for r in df.select(py_float(F.col("s"))).collect()]
    for s, g in zip(FLOATS, got):
        e = _py_float(s)
        if e is None or g is None:
            assert g is None and e is None, repr(s)
        elif e != e:
            assert g != g
        else:
            assert g == e, repr(s)


def test_a_time_extracts_its_groups_once(spark):
    from masklens.functions.text import parse_log_time

    plan = spark.range(1).select(parse_log_time(F.col("id").cast("string")).alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1
