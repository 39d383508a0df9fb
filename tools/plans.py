"""Dump, per registered query, what its physical plan does: exchanges, sorts,
join strategies, Python evaluation and the columns each scan reads.

Usage: python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, "/root/repo")


def summarize(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/([a-z_]+)\.parquet\]"
                       r".*?PushedFilters: \[([^\]]*)\]", plan)
    return {
        "exchanges": plan.count("Exchange "),
        "sorts": plan.count("Sort ["),
        "windows": plan.count("Window ["),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "shj": plan.count("ShuffledHashJoin"),
        "python": sum(plan.count(k) for k in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython",
                                             "FlatMapGroupsInPandas", "MapInPandas")),
        "scans": sorted({(t, cols.replace("#", "").strip(), f) for cols, t, f in scans}),
    }


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    from masklens.plans.catalog import QUERIES
    from masklens.session import local_session

    spark = local_session(app="plans")
    print(f"# Physical plans of the registered queries ({sf_dir})\n")
    print("Counts are over the initial physical plan (before AQE re-planning); exchanges that")
    print("appear in several branches of one plan are computed once (AQE stage reuse).\n")
    print("| Query | Exchanges | Sorts | Windows | SMJ | BHJ | SHJ | Python nodes |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    details = []
    for name, fn in QUERIES.items():
        if name in ("table_lifecycle", "csv_selected"):
            continue  # these write files while they are built
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | {s['exchanges']} | {s['sorts']} | {s['windows']} | {s['smj']} | {s['bhj']} | "
              f"{s['shj']} | {s['python']} |")
        details.append((name, s["scans"]))
    print("\n## Columns read and filters pushed per scan\n")
    for name, scans in details:
        print(f"- **{name}**: " + "; ".join(
            f"`{t}` [{re.sub(r'[0-9]+', '', cols)}]" + (f" filters [{f}]" if f else "") for t, cols, f in scans))

    # the flagship's physical plan as explain("formatted") prints it (operator tree part)
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES["masking_ops"](spark, sf_dir).explain("formatted")
    tree = buf.getvalue().split("\n\n\n")[0]
    print("\n## Flagship plan (`masking_ops`, explain formatted, operator tree)\n")
    print("```")
    print("\n".join(line[:160] for line in tree.splitlines()))
    print("```")


if __name__ == "__main__":
    main(*sys.argv[1:])
