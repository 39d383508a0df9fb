import collections
import random
import re
import zlib

import numpy as np

from masklens.llm import spelling


def edit(a, b):
    """Whether exactly one inserted, deleted or replaced letter parts a and b, by trying all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_brute_force(rows):
    seen = collections.Counter()
    for row, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if row is None else row}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            seen[word] += 1
    n = {w: c for w, c in seen.items() if len(w) >= 7 and c >= 2}
    out = {}
    for w in n:
        near = sorted((x for x in n if edit(w, x)), key=lambda x: (-n[x], x))
        form = near[0] if near and n[near[0]] >= 10 * n[w] else None
        out[w] = [form, None, n[w], len(near), n[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def corpus(seed=5):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdeistn") for _ in range(rnd.randint(6, 11))) for _ in range(25)]
    base += ["ÀÉîçè÷×ÿ", "àéîçè÷×ÿ", "Straßenfest", "STRASSENFEST", "a" * 5000, "a" * 5001, "ab" * 2500]
    words = []
    for k, w in enumerate(base):
        words += [w] * (120 if k % 3 == 0 else 14 if k % 3 == 1 else 2)
        for _ in range(3):
            at = rnd.randrange(len(w))
            words += [w[:at] + rnd.choice("xyzé") + w[at + rnd.randint(0, 1):]] * rnd.choice((1, 2, 11))
            words += [w[:at] + w[at + 1:]] * rnd.choice((2, 3))
    words += ["kettenwort"] * 2000 + ["kettenwart"] * 90 + ["kettenwarz"] * 5  # a chain of forms
    rnd.shuffle(words)
    texts = [rnd.choice((" ", "1", "_", "-")).join(words[i:i + 40]) for i in range(0, len(words), 40)]
    return [(i % 17 if i % 5 else None, t) for i, t in enumerate(texts)] + [(1, None), (2, ""), (3, "ab 12"), (4, texts[0]), (4, texts[0])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 3) for i, t in rows], "doc_id long, text string, word string, n int")


def test_variant_groups_equal_brute_force(spark, tmp_path):
    rows = corpus()
    want = by_brute_force(rows)
    got = spelling.variant_groups(frame(spark, rows), str(tmp_path / "a")).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(got) == len(want)
    assert any(v[0] for v in want.values()) and any(v[1] != (v[0] or w) for w, v in want.items())
    assert spelling.variant_groups(frame(spark, rows).limit(0), str(tmp_path / "b")).count() == 0
    assert spelling.variant_groups(frame(spark, [(1, "one two")]), str(tmp_path / "c")).count() == 0


def test_parts_of_a_block_meet(spark, tmp_path, monkeypatch):
    """Blocks cut into many parts lose no pair."""
    rows = corpus(9)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 2)
    monkeypatch.setattr(spelling, "TOGETHER", 3)
    got = spelling.variant_groups(frame(spark, rows), str(tmp_path / "a")).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == by_brute_force(rows)


def test_near_pairs_of_all_short_words():
    import itertools

    words = {n: ["".join(w) for w in itertools.product("aéÿ", repeat=n)] for n in (3, 4)}
    codes = {n: np.frombuffer("".join(w).encode("latin-1"), dtype=np.uint8).reshape(-1, n) for n, w in words.items()}
    for n, m in ((3, 3), (3, 4), (4, 4)):
        i, j = spelling.near_pairs(codes[n], codes[m], n == m)
        want = {(p, q) for p, a in enumerate(words[n]) for q, b in enumerate(words[m]) if edit(a, b) and (n != m or p < q)}
        assert set(zip(i.tolist(), j.tolist())) == want


def test_one_edit_is_one_step_between_classes(spark):
    """Words one edit apart are in blocks that meet."""
    rnd, steps = random.Random(2), {(n, tuple(s)) for n, s in spelling.neighbour_steps()}
    pairs = []
    for _ in range(300):
        w = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzàÿ") for _ in range(8))
        at = rnd.randrange(8)
        pairs += [(w, w[:at] + rnd.choice("abcxyzé") + w[at + rnd.randint(0, 1):])]
    got = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", spelling.class_counts(spelling.F.col("a")).alias("x"), spelling.class_counts(spelling.F.col("b")).alias("y")).collect()
    for r in got:
        n, step = len(r.b) - len(r.a), tuple(q - p for p, q in zip(r.x, r.y))
        assert (n, step) in steps or (n == 0 and (0, tuple(-s for s in step)) in steps)
