import itertools
import random
import zlib

import numpy as np
import pytest

from masklens.llm import language
from masklens.llm.common import table as load

SYLLABLES = {"xx": "ba be bi bo bu ban ber".split(), "yy": "ste sta sto schi rke lte".split(), "ru": "бе ста ро ни ко ла".split()}


def prose(rnd, lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    out = [(i, prose(rnd, lang, rnd.randint(5, 60)), lang) for i, lang in enumerate(["xx"] * 60 + ["yy"] * 50 + ["ru"] * 40)]
    out += [(1000, None, "xx"), (1001, "", "yy"), (1002, "12 _ 34 ½ Ⅻ", "yy"), (1003, prose(rnd, "xx", 200), None), (None, prose(rnd, "yy", 9), "xx"),
            (1004, prose(rnd, "xx", 40) + " " + prose(rnd, "ru", 90), "xx"), (1005, prose(rnd, "yy", 30_000), "yy"), (1006, "漢字仮名", "xx"),
            (1007, "x" * 100_000, "yy"), (1008, prose(rnd, "xx", 30) + " " + prose(rnd, "yy", 50) + " " + prose(rnd, "xx", 5), "yy")]
    return out + out[:3]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, 0.5, 3) for i, t, g in rows], "doc_id long, text string, lang string, score double, row int")


def test_identify(spark, rows, tmp_path):
    got = language.identify_documents(frame(spark, rows), str(tmp_path / "a")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, _, lang in rows[:150]:
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and by[i].lang_pred == lang
    assert [(by[i].lang_pred, by[i].score, by[i].spans) for i in (1000, 1001, 1002)] == [("und", 0.0, [])] * 3
    assert by[1003].lang_pred == "xx" and by[None].lang_pred == "yy" and by[None].held_out is False and by[1005].lang_pred == "yy"
    assert by[1006].lang_pred in SYLLABLES and by[1006].score == 0 and by[1007].lang_pred in SYLLABLES
    assert [(s.first, s.words, s.lang) for s in by[1004].spans] == [(0, 40, "xx"), (40, 90, "ru")] and by[1004].lang_pred == "ru"
    spans = by[1008].spans
    assert [s.lang for s in spans] == ["xx", "yy", "xx"] and [s.words for s in spans] == pytest.approx([30, 50, 5], abs=2)
    assert by[1008].lang_pred == "yy" and 0.4 < by[1008].score < 0.8 and all(0 <= r.score <= 1 for r in got)


def test_empty_and_unlabelled(spark, rows, tmp_path):
    assert language.identify_documents(frame(spark, rows).limit(0), str(tmp_path / "a")).count() == 0
    got = language.identify_documents(frame(spark, [(i, t, None) for i, t, _ in rows[:9]]), str(tmp_path / "b")).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    one = language.identify_documents(frame(spark, [(i, t, "xx") for i, t, _ in rows[:60]]), str(tmp_path / "c")).collect()
    assert {r.lang_pred for r in one} == {"xx"} and min(r.score for r in one) > 0


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark, rows, tmp_path):
    other = [(i, t, "yy" if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else g) for i, t, g in rows]
    key = lambda got: sorted((str(r.doc_id), r.lang_pred, r.score) for r in got)
    a = language.identify_documents(frame(spark, rows), str(tmp_path / "a")).collect()
    b = language.identify_documents(frame(spark, other).repartition(3), str(tmp_path / "b")).collect()
    assert key(a) == key(b)


def test_viterbi_equals_brute_force():
    rnd = np.random.default_rng(4)
    for k, switch in itertools.product((1, 2, 3), (0.5, 2.0)):
        lengths = [int(n) for n in rnd.integers(1, 7, 12)]
        scores = rnd.normal(size=(sum(lengths), k)).astype(np.float32)
        got, at = language.viterbi(scores, lengths, switch), 0
        value = lambda path, s: sum(s[i, x] for i, x in enumerate(path)) - switch * sum(x != y for x, y in zip(path, path[1:]))
        for n in lengths:
            own = scores[at:at + n].astype(float)
            best = max(value(p, own) for p in itertools.product(range(k), repeat=n))
            assert value(list(got[at:at + n]), own) == pytest.approx(best, abs=1e-5)
            at += n


def test_word_scores_equal_brute_force():
    """Gram log-probabilities summed one by one, and scripts that leave the candidates."""
    counts = {"a": {"abba": 5, "bab": 2}, "b": {"cac": 4, "abc": 1}, "g": {"αβγ": 3}}
    names, tables = sorted(counts), np.zeros((3, language.ORDERS, language.BUCKETS))
    scripts = np.zeros((3, len(language.SCRIPT_NAMES)))
    for i, name in enumerate(names):
        for word, n in counts[name].items():
            told = language.grams([word])
            assert [len(b) for b in told.buckets] == [len(word) + 2 - k for k in range(3)]
            for k, own in enumerate(told.buckets):
                np.add.at(tables[i, k], own, n)
            scripts[i, told.scripts[0]] += n * len(word)
    model = language.Model(names, tables, scripts)
    words = ["abba", "c", "αβ", "жук"]
    got, letters, known = model.score(words)
    assert letters.tolist() == [4, 1, 2, 3] and known.tolist() == [True, True, True, False] and not got[3].any()
    for w, row in zip(words[:2], got):
        told, want = language.grams([w]), []
        for i in range(2):
            want.append(sum(np.log((tables[i, k][g] + .5) / (tables[i, k].sum() + .5 * language.BUCKETS)) / 3
                            for k in range(3) for g in told.buckets[k]))
        assert row[:2] == pytest.approx(np.array(want) - max(want), abs=1e-4) and row[2] == language.FOREIGN
    assert got[2].tolist() == [language.FOREIGN, language.FOREIGN, 0]


def test_held_out_accuracy(spark, tmp_path):
    """On the given documents, labels never learned from are predicted."""
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    got = language.identify_documents(docs, str(tmp_path / "a")).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
