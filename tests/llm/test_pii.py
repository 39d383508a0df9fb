import datetime as dt
import random
import re

import pytest

from masklens.llm import pii


def ways(rnd):
    """(kind, what the value is, ways of writing it) for random values of every kind."""
    day = dt.date(1900, 1, 1) + dt.timedelta(rnd.randrange(73_000))
    y, m, d = day.year, day.month, day.day
    dates = [f"{y:04d}-{m:02d}-{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{d}.{m}.{y}", f"{m:02d}/{d:02d}/{y}", f"{m}/{d}/{y}", f"{m:02d}/{d}/{y}"]
    if d > 12:
        dates += [f"{d}/{m:02d}/{y}", f"{d}/{m}/{y}"]
    yield "date", day, dates
    n = "".join(rnd.choice("0123456789") for _ in range(10))
    phones = [f"+1{n}", f"+1 {n[:3]} {n[3:6]} {n[6:]}", f"+1 ({n[:3]}) {n[3:6]}-{n[6:]}", f"({n[:3]}) {n[3:6]}-{n[6:]}", f"{n[:3]}-{n[3:6]}-{n[6:]}",
              f"{n[:3]}.{n[3:6]}.{n[6:]}"]
    if n[0] >= "2" and n[3] >= "2":
        phones.append(n)
    yield "phone", n, phones
    body = rnd.choice("345") + "".join(rnd.choice("0123456789") for _ in range(14))
    card = body + str(pii.luhn_digit(body))
    yield "card", card, [card, " ".join(re.findall("....", card)), "-".join(re.findall("....", card))]
    yield "ip", None, [".".join(str(rnd.randrange(256)) for _ in range(4))]
    yield "ssn", None, [f"{rnd.randrange(1, 666):03d}-{rnd.randrange(1, 100):02d}-{rnd.randrange(1, 10_000):04d}"]
    yield "email", None, [f"{rnd.choice(('ann', 'Bo.b', 'x9'))}{rnd.randrange(999)}@mail.example.org"]


def read(kind, text):
    """The value that a way of writing stands for, read by other code than the operator's."""
    if kind == "date":
        a, b, c = map(int, re.split("[-/.]", text))
        if "-" in text:
            return dt.date(a, b, c)
        if "." in text:
            return dt.date(c, b, a)
        return dt.date(c, a, b) if a <= 12 else dt.date(c, b, a)
    return re.sub(r"\D", "", text)[-10:] if kind == "phone" else re.sub(r"\D", "", text)


def test_equal_values_stay_linked_in_every_format():
    """Random values in all their formats: the mold stays, images agree, differ for different values, and go back."""
    rnd, names, images = random.Random(4), pii.Pseudonyms(b"key"), {}
    for _ in range(400):
        for kind, value, texts in ways(rnd):
            for text in texts:
                found = pii.FOUND.fullmatch(text)
                assert found and found.lastgroup == kind, text
                new = names.image(kind, text)
                mold = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", s)))
                assert kind == "ip" or mold(new) == mold(text)
                assert pii.FOUND.fullmatch(new).lastgroup == kind and names.image(kind, new, undo=True) == text
                if value is not None:
                    assert images.setdefault((kind, value), read(kind, new)) == read(kind, new), (text, new)
    for kind in ("date", "phone", "card"):
        got = [v for (k, _), v in images.items() if k == kind]
        assert len(set(got)) == len(got) > 300


def test_every_day_has_its_own_image():
    names = pii.Pseudonyms(b"k")
    days = [dt.date.fromordinal(n) for n in range(pii.FIRST_DAY, pii.LAST_DAY + 1)]
    images = [dt.date.fromisoformat(names.image("date", f"{d:%Y-%m-%d}")) for d in days]
    assert sorted(images) == days and all(pii.day_class(a) == pii.day_class(b) for a, b in zip(days, images, strict=True))


@pytest.mark.parametrize("digits,size", [("17435553824", 1), ("442079460958", 2), ("35312345678", 3), ("79161234567", 1), ("", 3)])
def test_country_codes(digits, size):
    assert pii.country_code(digits) == size


def test_whole_texts_go_back(spark):
    """Pseudonymized and put back byte for byte: every kind, look-alikes, odd rows and a very long text."""
    rnd = random.Random(8)
    texts = []
    for _ in range(60):
        words = [t for _, _, own in ways(rnd) for t in own]
        words += ["31/02/2021", "300.1.1.1", "4785380592391138", "1700000000", "v1.2.3", "call", "me,", "ünï 漢字", "1234567890123"]
        rnd.shuffle(words)
        texts.append(" ".join(words))
    texts += [None, "", " ", "no data", "\n".join(texts[:50]) * 40, texts[0], texts[0]]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in enumerate(texts)], "doc_id long, text string, n_card int, kind string")
    there = pii.pseudonymize(df, b"secret")
    rows = {r.doc_id: r for r in there.collect()}
    assert all(rows[i].text != t for i, t in enumerate(texts) if t and "@" in t) and rows[0].text == rows[65].text == rows[66].text
    assert rows[64].n_card == 40 * sum(rows[i].n_card for i in range(50)) and "4785380592391138" in rows[64].text and "1700000000" in rows[0].text
    back = {r.doc_id: r.text for r in pii.pseudonymize(there, b"secret", undo=True).collect()}
    assert back == dict(enumerate(texts))
    other = {r.doc_id: r.text for r in pii.pseudonymize(there, b"another", undo=True).collect()}
    assert other[0] != texts[0]
