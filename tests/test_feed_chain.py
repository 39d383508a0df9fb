import random

from pyspark.sql import functions as F

from masklens.sources import feed


def chains(spark, rows):
    df = spark.createDataFrame([(p, n, "x") for p, n in rows], "page string, next string, status string")
    return {r.page: (r.chain, r.page_rank, r.status, r.missing) for r in feed.page_chains(df).collect()}


def test_next_link_forms(spark):
    headers = {
        '<u?page=2>; rel="next"': "u?page=2", '<a>; rel="prev", <b,c>; rel="next"': "b,c", '<a>;rel=next': "a", "<a>; rel=nextish": None,
        '<a>; title="x"; rel="last next"': "a", '<a>; REL="Next", <b>; rel="next"': "a", '<a>; rel="first"': None, "": None, None: None,
        "no link": None, "<a>": None}
    df = spark.createDataFrame([(h,) for h in headers], "h string")
    assert {r.h: r.n for r in df.select("h", feed.next_link(F.col("h")).alias("n")).collect()} == headers


def test_complete_broken_and_cyclic_chains(spark):
    rows = [("b", "d"), ("d", "a"), ("a", None), ("x", "gone"), ("w", "x"), ("s", "s"), ("m", "o"), ("o", "n"), ("n", "m"), ("alone", None)]
    assert chains(spark, rows) == {
        "b": ("b", 0, "complete", None), "d": ("b", 1, "complete", None), "a": ("b", 2, "complete", None),
        "w": ("w", 0, "broken", "gone"), "x": ("w", 1, "broken", "gone"), "s": ("s", None, "cyclic", None),
        **{p: ("m", None, "cyclic", None) for p in "mno"}, "alone": ("alone", 0, "complete", None)}


def test_merged_repeated_and_odd_pages(spark):
    # two ways into c; a tail into a cycle; a page landed twice, first without its link; a row without an address
    rows = [("a", "b"), ("b", "c"), ("z", "c"), ("c", None), ("t", "q"), ("q", "p"), ("p", "q"), ("r", None), ("r", "r2"), ("r2", None), (None, "a")]
    got = chains(spark, rows)
    assert [got[p][:3] for p in "abzc"] == [("a", 0, "merged"), ("a", 1, "merged"), ("a", 1, "merged"), ("a", 2, "merged")]
    assert {got[p][0] for p in "tpq"} == {"p"} and got["t"][2] == "cyclic"
    assert got["r"] == ("r", 0, "complete", None) and got["r2"][1] == 1 and None not in got
    assert chains(spark, []) == {}


def test_long_chains_equal_a_walk(spark):
    rnd, rows, want = random.Random(6), [], {}
    for size in (1, 2, 3, 64, 65, 1000):
        names = [f"p{size}-{x}" for x in rnd.sample(range(10 ** 6), size)]
        rows += list(zip(names, [*names[1:], None]))
        want |= {p: (names[0], k, "complete", None) for k, p in enumerate(names)}
    rnd.shuffle(rows)
    assert chains(spark, rows) == want


def test_records_come_in_chain_order(spark, tmp_path):
    """Pages landed as JSON lines, read with their links, give their records in feed order."""
    record = "struct<post_id: long, user: struct<user_id: long>, tags: array<string>>"
    pages = [("p2", None, [(3, (1,), []), (4, None, None)]), ("p1", '<p2>; rel="next"', [(1, (7,), ["x"]), (2, (8,), [])]), ("p0", '<p1>; rel="next"', [])]
    spark.createDataFrame(pages, f"page string, link string, records array<{record}>").write.json(str(tmp_path / "f"))
    schema = spark.createDataFrame([], record[7:-1].replace("user: struct<user_id: long>", "user struct<user_id: long>")
                                   .replace("post_id: long", "post_id long").replace("tags: array", "tags array")).schema
    landed = feed.read_feed_pages(spark, str(tmp_path / "f"), feed.linked_page_schema(schema), mode="lines")
    where = feed.page_chains(landed.select("page", feed.next_link(F.col("link")).alias("next")))
    got = feed.chain_records(landed, where, [("post_id", "post_id"), ("user.user_id", "user_id")])
    rows = got.orderBy("chain", "page_rank", "position").collect()
    assert [(r.chain, r.page_rank, r.position, r.post_id, r.user_id) for r in rows] == [
        ("p0", 1, 0, "1", "7"), ("p0", 1, 1, "2", "8"), ("p0", 2, 0, "3", "1"), ("p0", 2, 1, "4", None)]
    assert "post_title" in got.columns and feed.chain_report(where).collect() == [("p0", "complete", None, 3)]


def test_rounds_do_not_add_partitions(spark, monkeypatch):
    """A long chain and a cycle with a tail: every round's stored rows have as many partitions as a join has, one row a page."""
    rows = [(f"p{k * 7919 % 3000:04d}", f"p{(k + 1) * 7919 % 3000:04d}" if k < 2999 else None) for k in range(3000)]
    rows += [(f"t{k:03d}", f"t{k + 1:03d}" if k < 299 else "t250") for k in range(300)]
    frame, stored = type(spark.range(1)), []
    checkpoint = frame.checkpoint

    def watched(self, *args, **kw):
        out = checkpoint(self, *args, **kw)
        stored.append((out.rdd.getNumPartitions(), out.count()))
        return out

    monkeypatch.setattr(frame, "checkpoint", watched)
    got = chains(spark, rows)
    assert len(stored) > 10 and max(n for n, _ in stored) <= 8 and {c for _, c in stored} == {3300}
    assert [got[f"p{k * 7919 % 3000:04d}"][:3] for k in range(3000)] == [("p0000", k, "complete") for k in range(3000)]
    assert {got[f"t{k:03d}"] for k in range(300)} == {("t250", None, "cyclic", None)}
