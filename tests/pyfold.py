"""Brute-force checker for the log parser: a plain line-by-line fold in Python.

Written from the rule table (R1-R14) for tests only; it shares nothing with
the window formulation it checks.
"""

from __future__ import annotations

import datetime as dt


def parse_line(line: str):
    if "::" not in line:
        return None
    left, msg = line.split("::", 1)
    try:
        ts = dt.datetime.strptime(left.strip(), "%d/%m/%Y %H:%M:%S")
    except ValueError:
        return None
    return ts, msg.strip()


class ShortLine(Exception):
    pass


def fold(text: str):
    """Operations of one document, as dicts; raises ShortLine like an IndexError."""
    st = dict(cycle=None, schema=None, table=None, column=None, live=False, start=None,
              rows=None, dist=None, err=None, status=None)
    failures = []
    out = []

    def tok(toks, i):
        if i >= len(toks):
            raise ShortLine()
        return toks[i]

    def emit(end, status):
        secs = (end - st["start"]).total_seconds() if st["start"] is not None else None
        out.append(dict(cycle=st["cycle"], schema=st["schema"], table=st["table"],
                        row_count=st["rows"], distinct_row_count=st["dist"], column=st["column"],
                        status=status, start_time=st["start"], end_time=end, duration_secs=secs,
                        duration_mins=round(secs / 60, 2) if secs else None, error=st["err"]))

    for line_no, line in enumerate(text.split("\n")):
        p = parse_line(line)
        if p is None:
            continue
        ts, m = p
        toks = m.split()
        has = lambda *w: all(x in m for x in w)
        if has("MASKING", "HAS", "STARTED"):
            st["cycle"] = 1
        if has("CONNECTED", "Schema:"):
            st["schema"] = tok(toks, 4)
        if has("TABLE", "Mask Started"):
            st["table"] = tok(toks, 2)
        if has("COLUMN", "Mask Started"):
            st["column"] = tok(toks, 2)
            st["live"] = True
            st["start"] = ts
        if has("CALCULATED", "Row", "for", "="):
            st["rows"] = tok(toks, 8)
        if "NO Data" in m or "No Data" in m:
            st["err"] = m
            st["dist"] = "0"
            failures.append(("No Data", st["column"], st["table"]))
        if has("CALCULATED", "Distinct", "Count", "="):
            st["dist"] = tok(toks, 5)
        enable = "Could Not Enable" in m
        exc_rules = [
            (has("Could", "not") or has("Could", "Not", "Mask", "Column")) and not enable,
            "ERROR" in m and not enable,
            "pymysql.err" in m,
            "NOT FOUND" in m or ".php" in m or ".py" in m,
        ]
        for fired in exc_rules:
            if fired:
                st["err"] = m
                failures.append(("Exception", st["column"], st["table"]))
        if has("COLUMN", "Mask Finished"):
            if failures:
                kind, col, tab = failures[-1]
                if kind == "Exception":
                    st["status"] = "Exception" if (st["column"] == col and st["table"] == tab) else "Passed"
                emit(ts, st["status"])
                failures.clear()
            elif st["column"] is not None:
                st["status"] = "Passed"
                emit(ts, st["status"])
            st["live"] = False
            st["rows"] = st["dist"] = st["err"] = None
        if st["live"] and (has("TABLE", "Mask", "Ended") or has("MASKING", "HAS", "STARTED")):
            st["status"] = "Failed"
            emit(ts, st["status"])
            st["live"] = False
            st["rows"] = st["dist"] = st["err"] = None
        if out and "line_no" not in out[-1]:
            out[-1]["line_no"] = line_no
    return out
