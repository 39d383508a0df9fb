"""Config flattening: round trip, doubled quotes, optional key, faults."""

from __future__ import annotations

import datetime as dt
import json

from masklens.operators import config

LOAD = dt.datetime(2024, 2, 1)
EL = {"column_name": "NAME", "data_type": "VARCHAR", "data_length": "40", "pattern_name": "p",
      "Result": "r", "parameter": "x"}


def _bronze(spark, docs):
    return spark.createDataFrame([(oid, text, None, LOAD) for oid, text in docs],
                                 "object_id string, config string, masking_log string, load_date timestamp")


def test_round_trip_and_doubled_quotes(spark):
    doc = {"HR": {"EMP": [dict(EL, lookup="l"), dict(EL, column_name="SAL")]}, "FIN": {"GL": [EL]}}
    text = json.dumps(doc)
    rows = config.flatten_config(_bronze(spark, [("1", text), ("2", text.replace('"', '""'))])).collect()
    got = sorted((r["object_id"], r["schema"], r["table"], r["column_name"], r["lookup"], r["result"]) for r in rows)
    exp = sorted((oid, s, t, e["column_name"], e.get("lookup", ""), e["Result"])
                 for oid in (1, 2) for s, ts in doc.items() for t, es in ts.items() for e in es)
    assert got == exp


def test_lookup_absent_vs_null_and_values_as_text(spark):
    docs = [("1", json.dumps({"S": {"T": [EL, dict(EL, lookup=None), dict(EL, data_length=40)]}}))]
    rows = config.flatten_config(_bronze(spark, docs)).collect()
    assert sorted((r["lookup"] is None, r["lookup"], r["data_length"]) for r in rows) == [
        (False, "", "40"), (False, "", "40"), (True, None, "40")]


def test_duplicate_keys_last_wins(spark):
    text = ('{"S": {"T": [{"column_name": "A", "column_name": "B", "data_type": "t", "data_length": "1",'
            ' "pattern_name": "p", "Result": "r", "parameter": "x"}]}, "S": {"U": []}}')
    rows = config.flatten_config(_bronze(spark, [("1", text)])).collect()
    assert rows == []  # the second "S" replaces the first, and it has no columns
    text2 = text.replace(', "S": {"U": []}', "")
    (r,) = config.flatten_config(_bronze(spark, [("1", text2)])).collect()
    assert r["column_name"] == "B"


def test_faults_go_to_quarantine_and_good_docs_stay(spark):
    good = json.dumps({"S": {"T": [EL]}})
    docs = [
        ("1", good),
        ("2", good[:-1]),                                   # malformed
        ("3", "[" + good + "]"),                            # array at the top
        ("4", json.dumps({"S": {"T": EL}})),                # object where an array belongs
        ("5", json.dumps({"S": {"T": [{k: v for k, v in EL.items() if k != "Result"}]}})),
        ("6", good + " trailing"),                          # text after the JSON
        ("7", None),                                        # no config
        ("8", json.dumps({"S": {"T": [EL]}}).replace('"', "'")),  # single quotes: not JSON
        ("9", json.dumps({"S": {"T": [dict(EL, pattern_name="")]}})),  # Q9: "" breaks un-doubling
        ("x", good),                                        # id is not an integer
    ]
    b = _bronze(spark, docs)
    q = {r["object_id"]: r["reason"] for r in config.config_quarantine(b).collect()}
    assert set(q) == {"2", "3", "4", "5", "6", "7", "8", "9", "x"}
    assert q["5"] == "config element lacks a required key"
    assert q["7"] == "config is null"
    assert q["x"] == "object_id is not an integer"
    rows = config.flatten_config(b).collect()
    assert [(r["object_id"], r["column_name"]) for r in rows] == [(1, "NAME")]


def test_nine_columns_union_and_distinct(spark):
    b = _bronze(spark, [("1", json.dumps({"S": {"T": [EL, EL]}})), ("2", json.dumps({"S": {"T": [EL]}}))])
    nine = config.config_nine_columns(b)
    assert "lookup" not in nine.columns and len(nine.columns) == 9
    u = config.config_union(b).collect()
    assert len(u) == 6 and sum(r["lookup"] is None for r in u) == 3
    assert config.distinct_objects(config.flatten_config(b)).first()["n_objects"] == 2


def test_config_plan_parses_each_document_once(spark):
    b = _bronze(spark, [("1", json.dumps({"S": {"T": [EL]}}))])
    plan = config.flatten_config(b)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_raw_first_keeps_empty_strings(spark):
    text = json.dumps({"S": {"T": [dict(EL, pattern_name="")]}})
    b = _bronze(spark, [("1", text), ("2", text.replace('"', '""').replace('""""', '""'))])
    assert config.flatten_config(b).count() == 0  # the original loses both
    rows = config.flatten_config(b, raw_first=True).collect()
    assert [(r["object_id"], r["pattern_name"]) for r in rows] == [(1, "")]


def test_text_after_the_config_is_rejected(spark):
    good = '{"S": {"T": [{"column_name": "C", "data_type": "V", "data_length": "1", "pattern_name": "p", "Result": "r", "parameter": "x"}]}}'
    rows = [("1", good), ("2", good + good), ("3", good + " junk }"), ("4", good + "  ")]
    df = spark.createDataFrame([(i, c, None, None) for i, c in rows],
                               "object_id string, config string, masking_log string, load_date timestamp")
    assert sorted(r["object_id"] for r in config.flatten_config(df).collect()) == [1, 4]
    assert sorted(r["object_id"] for r in config.config_quarantine(df).collect()) == ["2", "3"]


def test_text_that_closes_a_wrapping_bracket_is_rejected(spark):
    one = '{"S": {"T": []}}'
    texts = [one, one + "],[" + one, one + ',"x":' + one, one + "}," + one, "{}", '{"S": {}}']
    b = _bronze(spark, [(str(i), t) for i, t in enumerate(texts)])
    assert {r.object_id for r in config.config_quarantine(b).collect()} == {"1", "2", "3"}


def test_raw_first_and_quarantine_agree(spark):
    """A config that raw_first keeps is not quarantined as well."""
    full = ('{"S": {"T": [{"column_name": "", "data_type": "d", "data_length": "1", "pattern_name": "p", "Result": "r", '
            '"parameter": "x"}]}}')
    b = _bronze(spark, [("1", full), ("2", "{")])
    kept = {r.object_id for r in config.flatten_config(b, raw_first=True).collect()}
    bad = {r.object_id for r in config.config_quarantine(b, raw_first=True).collect()}
    assert (kept, bad) == ({1}, {"2"})
    assert {r.object_id for r in config.config_quarantine(b).collect()} == {"1", "2"}
