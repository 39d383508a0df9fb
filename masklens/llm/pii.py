"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

``pseudonymize`` finds card numbers, phone numbers, IPv4 addresses, calendar dates and e-mail addresses in
whole texts, validates each one, and replaces it by the image of a keyed permutation of its own format: a
card number stays a valid card number with its separators, a date a valid date, an address an address.
Equal values have equal images in every document and in every way of writing them, different values different
ones, and whoever holds the key can undo the permutation.

A kind has one permutation, whatever the format: what a format needs of a value (the width of a month or day, a day
above 12 where the day comes first, an area code) is kept by permuting among the values that have it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

ROUNDS = 10
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A value stands between characters that cannot continue it. The order decides where two kinds start together.
FOUND = re.compile(
    r"(?P<email>(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-]))"
    r"|(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d)(?!\.\d))"
    r"|(?P<date>(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-])(?!\.\d))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d)"
    r"|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\d-])"
    r"|(?<![\w.-])\d{3}\.\d{3}\.\d{4}(?![\w-])(?!\.\d)|(?<![\w.-])[2-9]\d{2}[2-9]\d{6}(?![\w-])(?!\.\d))"
    r"|(?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w]|-\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d))", re.ASCII)
KINDS = ("email", "ip", "date", "phone", "card", "ssn")
#: every value holds one of these; a text without them is passed on unread by the larger pattern
HINT = re.compile(r"[0-9@]")


class Feistel:
    """A keyed permutation of 0 .. size - 1 for any size: rounds that add a keyed hash of the other half.

    A value is split as ``left * b + right`` with ``a * b >= size``; each round adds a hash of one half to
    the other, modulo that half's size. Where ``a * b`` exceeds ``size``, the walk goes on until the image
    is inside (cycle walking), which keeps it a permutation.
    """

    def __init__(self, key: bytes, name: str, size: int):
        self.size = size
        self.b = max(1, int(size ** 0.5))
        while self.b * self.b < size:
            self.b += 1
        self.a = -(-size // self.b)
        self.keys = [hashlib.blake2b(f"{name}:{size}:{i}".encode(), key=key, digest_size=32).digest()
                     for i in range(ROUNDS)]

    def _f(self, i: int, half: int) -> int:
        raw = half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
        return int.from_bytes(hashlib.blake2b(raw, key=self.keys[i], digest_size=16).digest(), "big")

    def _pass(self, x: int, order, sign: int) -> int:
        left, right = divmod(x, self.b)
        for i in order:
            if i % 2:
                right = (right + sign * self._f(i, left)) % self.b
            else:
                left = (left + sign * self._f(i, right)) % self.a
        return left * self.b + right

    def apply(self, x: int) -> int:
        while True:
            x = self._pass(x, range(ROUNDS), 1)
            if x < self.size:
                return x

    def undo(self, x: int) -> int:
        while True:
            x = self._pass(x, reversed(range(ROUNDS)), -1)
            if x < self.size:
                return x


def luhn_digit(body: str) -> int:
    total = 0
    for i, ch in enumerate(reversed(body)):
        n = int(ch) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _fill(mold: str, digits: str) -> str:
    """``mold`` with its digits replaced in turn."""
    feed = iter(digits)
    return "".join(next(feed) if ch in DIGITS else ch for ch in mold)


def _date(value: str) -> tuple[dt.date, str] | None:
    """The day and its pattern; day/month/year with slashes is read month first where that is a date."""
    parts = [int(x) for x in re.split(r"[-/.]", value)]
    orders = {"-": ("ymd",), "/": ("mdy", "dmy"), ".": ("dmy",)}[re.search(r"[-/.]", value)[0]]
    for order in orders:
        part = dict(zip(order, parts, strict=True))
        try:
            day = dt.date(part["y"], part["m"], part["d"])
        except ValueError:
            continue
        if FIRST_DAY <= day.toordinal() <= LAST_DAY:
            return day, order
    return None


#: fixed values: country calling codes of one and of two digits; all others have three
CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 "
                  "94 95 98".split())


def country_code(digits: str) -> int:
    """How many leading digits of an international number are its country's code."""
    return 1 if digits[:1] in CODES else 2 if digits[:2] in CODES else 3


def day_class(day: dt.date) -> tuple[bool, int]:
    """What the ways of writing a date need of it: the widths of month and day, and a day that can't be a month."""
    return day.month < 10, 0 if day.day < 10 else 1 if day.day <= 12 else 2


def area_code(body: int) -> bool:
    """Whether a number of ten digits has an area code and an exchange, as one that is written without marks must."""
    return body // 10 ** 9 >= 2 and body // 10 ** 6 % 10 >= 2


class Pseudonyms:
    """The permutations under one key, made on demand; ``image`` is None for a value that is not valid."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.made: dict[tuple[str, int], Feistel] = {}
        self.days: dict[tuple[bool, int], list[int]] = {}
        for n in range(FIRST_DAY, LAST_DAY + 1):
            self.days.setdefault(day_class(dt.date.fromordinal(n)), []).append(n)

    def permutation(self, name: str, size: int) -> Feistel:
        if (name, size) not in self.made:
            self.made[name, size] = Feistel(self.key, name, size)
        return self.made[name, size]

    def image(self, kind: str, value: str, undo: bool = False) -> str | None:
        move = (lambda p, x: p.undo(x)) if undo else (lambda p, x: p.apply(x))
        digits = "".join(ch for ch in value if ch in DIGITS)
        if kind == "card":
            body = digits[1:-1]
            if luhn_digit(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
                return None
            new = digits[0] + str(move(self.permutation("card", 10 ** len(body)), int(body))).zfill(len(body))
            return _fill(value, new + str(luhn_digit(new)))
        if kind == "phone":
            # a country code stays; the national number is permuted, however it is written
            code = country_code(digits) if value[0] == "+" else 0
            body = digits[code:]
            if not 7 <= len(digits) <= 15 or len(body) < 4:
                return None
            new = self._phone(int(body), len(body), move)
            return _fill(value, digits[:code] + str(new).zfill(len(body)))
        if kind == "ip":
            parts = value.split(".")
            if any(int(x) > 255 or x != str(int(x)) for x in parts):
                return None
            number = int.from_bytes(bytes(int(x) for x in parts), "big")
            return ".".join(map(str, move(self.permutation("ip", 1 << 32), number).to_bytes(4, "big")))
        if kind == "ssn":
            if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000":
                return None
            area, group, serial = int(digits[:3]), int(digits[3:5]), int(digits[5:])
            rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
            rank, serial = divmod(move(self.permutation("ssn", 898 * 99 * 9999), rank), 9999)
            area, group = divmod(rank, 99)
            area += 1 + (area >= 665)
            return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"
        if kind == "date":
            if not (known := _date(value)):
                return None
            day, order = known
            alike = self.days[day_class(day)]
            p = self.permutation(f"date-{day_class(day)}", len(alike))
            new = dt.date.fromordinal(alike[move(p, bisect_left(alike, day.toordinal()))])
            parts = {"y": new.year, "m": new.month, "d": new.day}
            feed = iter(order)
            return re.sub(r"\d+", lambda m: str(parts[next(feed)]).zfill(len(m[0])), value)
        if kind == "email":
            local, _, domain = value.partition("@")
            return self._letters(local, domain.lower(), move) + "@" + domain
        raise ValueError(kind)

    def _phone(self, body: int, width: int, move: Callable) -> int:
        """Numbers of ten digits that have an area code are permuted among themselves (by cycle walking), and so are the others."""
        p = self.permutation("phone", 10 ** width)
        new = move(p, body)
        while width == 10 and area_code(new) != area_code(body):
            new = move(p, new)
        return new

    def _letters(self, local: str, tweak: str, move) -> str:
        """Letters and digits of ``local`` permuted together, each within its own class; the rest stays."""
        size, rank = 1, 0
        classes = [next((c for c in (DIGITS, LOWER, UPPER) if ch in c), "") for ch in local]
        for ch, c in zip(local, classes, strict=True):
            if c:
                rank = rank * len(c) + c.index(ch)
                size *= len(c)
        shape = "".join({DIGITS: "9", LOWER: "a", UPPER: "A", "": "-"}[c] for c in classes)
        rank = move(Feistel(self.key, f"email:{shape}:{tweak}", size), rank)
        out = []
        for ch, c in zip(reversed(local), reversed(classes), strict=True):
            if c:
                rank, at = divmod(rank, len(c))
                ch = c[at]
            out.append(ch)
        return "".join(reversed(out))


def replace_text(text: str, names: Pseudonyms, cache: dict, counts: dict, undo: bool = False) -> str:
    """One whole text with every validated value replaced, or put back; ``counts`` gains one per value."""
    def swap(m: re.Match) -> str:
        kind, value = m.lastgroup, m[0]
        if (kind, value) not in cache:
            if len(cache) > 200_000:
                cache.clear()
            cache[kind, value] = names.image(kind, value, undo)
        new = cache[kind, value]
        if new is None:
            return value
        counts[kind] = counts.get(kind, 0) + 1
        return new

    return FOUND.sub(swap, text) if HINT.search(text) else text


def pseudonymize(docs: DataFrame, key: bytes, *, text: str = "text", undo: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, plus ``n_<kind>`` counts (long) for each kind. With ``undo`` and the same
    key, a pseudonymized text becomes the original one again.

    Whole texts are read, of any length. A null text stays null with counts 0; empty texts and texts
    without a valid value are unchanged byte for byte; repeated rows are treated alike; an empty table
    gives an empty result. All other columns pass through; columns already named ``n_<kind>`` are
    replaced. Invalid look-alikes (a card number with a wrong check digit, 31 February, 300.1.1.1) stay. Ten digits without
    any mark are a phone number if they begin as one does (area code and exchange from 2). The key is the caller's secret.

    Narrow: no shuffle; each row depends on its own text and the key only, so a retried task writes the
    same rows.
    """
    counted = [f"n_{k}" for k in KINDS]
    rest = docs.drop(*counted)
    schema = StructType([*rest.schema.fields, *[StructField(c, LongType()) for c in counted]])
    at = rest.columns.index(text)
    if not isinstance(rest.schema[text].dataType, StringType):
        raise TypeError(f"{text} is not a string column")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names, cache = Pseudonyms(key), {}
        for batch in batches:
            texts, tallies = [], {k: [] for k in KINDS}
            for value in batch.column(at).to_pylist():
                counts: dict[str, int] = {}
                texts.append(value if value is None else replace_text(value, names, cache, counts, undo))
                for k in KINDS:
                    tallies[k].append(counts.get(k, 0))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns + [pa.array(tallies[k], pa.int64()) for k in KINDS],
                                             names=[*batch.schema.names, *counted])

    return rest.mapInArrow(run, schema)

