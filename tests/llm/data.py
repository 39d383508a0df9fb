"""Small tables with the odd cases: nulls, empty and long texts, ties, repeated rows, extra columns."""

import random

LONG = " ".join(f"w{i}" for i in range(30_000))


def documents(spark, rows=None):
    rnd = random.Random(4)
    words = [f"{a}{b}" for a in "lorem ipsum dolor sit amet".split() for b in "abcdefgh"]
    if rows is None:
        base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 80))) for _ in range(40)]
        rows = [(i, t, f"s{i % 4}") for i, t in enumerate(base)]
        rows += [(100 + i, base[i] + " tail", "s0") for i in range(10)]  # near copies
        rows += [(200 + i, base[0], None) for i in range(5)]  # exact copies, no source
        rows += [(300, None, "s1"), (301, "", "s1"), (302, " \t\n", None), (303, "one two", "s2"), (303, "one two", "s2"),
                 (304, LONG, "s3"), (305, LONG + " x", "s3"), (None, base[1], "s1"), (306, "ÄÖ ünï 漢字 ́ ß", "s2")]
    full = [(i, t, "en", s, len(t) if t is not None else None, 7, "x", i) for i, t, s in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "size int, target string, row long")
