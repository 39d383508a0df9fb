import collections
import random
import re

from masklens import schemas
from masklens.operators import joins, measures


def ops(spark, n=400, seed=2):
    rnd = random.Random(seed)
    rows = [(rnd.choice((0, 1)), rnd.choice(("S0", None)), f"T{rnd.randrange(3)}", float(rnd.randrange(99)), float(rnd.randrange(9)), f"C{rnd.randrange(4)}",
             rnd.choice(("Passed", "Failed", None)), f"2024-01-0{rnd.randrange(1, 4)} 00:00:00", "", float(rnd.randrange(50)), rnd.randrange(9) / 4,
             None, 7 if rnd.random() < 0.3 else rnd.randrange(20), "2024-02-01 00:00:00", "x") for _ in range(n)]
    return spark.createDataFrame(rows, schemas.SILVER_OPS)


def configs(spark, seed=3):
    rnd = random.Random(seed)
    rows = [(7 if rnd.random() < 0.3 else rnd.randrange(25), "S", "T", "C", "V", "1", rnd.choice(("p", "q", None)), "r", "", "x") for _ in range(150)]
    return spark.createDataFrame([*rows, (None, *rows[0][1:])], schemas.SILVER_CONFIG)


def test_sums_by_every_column_equal_one_query_a_column(spark):
    rows = ops(spark)
    got = collections.defaultdict(dict)
    for r in measures.sums_by_every_column(rows, measures.GOLD_GROUPING, measures.GOLD_SUMMED).collect():
        got[r["group_column"]][r["group_value"]] = tuple(r[c] for c in [*measures.GOLD_SUMMED, "n_ops"])
    for c in measures.GOLD_GROUPING:
        want = {r[c]: tuple(r[x] for x in [*measures.GOLD_SUMMED, "n_ops"]) for r in measures.default_sums_gold(rows, [c]).collect()}
        assert got[c] == want, c
    assert set(got) == set(measures.GOLD_GROUPING)
    assert measures.sums_by_every_column(rows.limit(0), ["schema"], ["cycle"]).count() == 0


def test_sums_by_every_column_scan_once(spark, tmp_path):
    ops(spark).write.parquet(str(tmp_path / "ops"))
    df = measures.sums_by_every_column(spark.read.parquet(str(tmp_path / "ops")), measures.GOLD_GROUPING, measures.GOLD_SUMMED)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"FileScan", plan)) == 1 and plan.count("Expand") == 1


def test_join_sums_equal_the_materialised_join(spark):
    left, right = ops(spark), configs(spark)
    summed = [c for c in measures.GOLD_SUMMED if c != "object_id"]
    for ops_by, config_by in ((["schema", "status"], []), ([], ["pattern_name"]), (["table"], ["pattern_name", "schema"]), ([], [])):
        by = [*ops_by, *[f"config_{c}" for c in config_by]]
        named = right
        for c in config_by:
            named = named.withColumnRenamed(c, f"config_{c}")
        keep = ["object_id", *[f"config_{c}" for c in config_by]]
        pairs = left.join(named.select(*keep), "object_id").collect()
        want = collections.defaultdict(lambda: [0] * 7)
        for r in pairs:
            own = want[tuple(r[c] for c in by)]
            for k, c in enumerate([*summed, "object_id"]):
                own[k] += r[c]
            own[6] += 1
        got = {tuple(r[c] for c in by): [r[c] for c in [*summed, "object_id", "n_pairs"]] for r in measures.join_sums(left, right, ops_by, config_by).collect()}
        assert {k: [round(x, 2) for x in v] for k, v in got.items()} == {k: [round(x, 2) for x in v] for k, v in want.items()}
    assert joins.ops_config_join(left, right).count() == got[()][6]


def test_join_sums_emit_no_pairs(spark):
    """No step between the scans and the result has more rows than its input, with one object in a third of both sides."""
    left, right = ops(spark, 3000), configs(spark)
    df = measures.join_sums(left, right, ["status"], [])
    assert df.collect() and "Join" in (plan := df._jdf.queryExecution().executedPlan().toString()) and "Cartesian" not in plan
    aggregated = left.groupBy("object_id", "status").count().count()
    joined = left.groupBy("object_id", "status").count().join(right.groupBy("object_id").count().withColumnRenamed("count", "n"), "object_id")
    assert joined.count() <= aggregated < left.count() < joins.ops_config_join(left, right).count()
