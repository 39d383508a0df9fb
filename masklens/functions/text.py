"""Text helpers that reproduce Python ``str`` semantics with JVM-side functions.

The original parser is Python: ``str.strip()``/``str.split()`` treat every
Unicode whitespace character (plus the separators U+001C..U+001F) as space,
``datetime.strptime`` accepts one- or two-digit fields, and ``float()`` has its
own number grammar. These helpers keep those rules while staying inside
whole-stage codegen (no UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace set expressed as a Java regex class.
WS = r"(?U)[\s\x{1c}-\x{1f}]"
_WS_CLASS = r"[\s\x{1c}-\x{1f}]"

# ``%d/%m/%Y %H:%M:%S`` after strip(): the format's space matches any run of
# whitespace; day/month/hour/minute/second take one or two digits, year four.
# ASCII digits only (as before: non-ASCII digits never parsed), so that the
# extraction below finds exactly the six groups the shape check saw
_TIME_RE_PADDED = (r"(?U)^" + _WS_CLASS + r"*[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}" + _WS_CLASS
                   + r"+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}" + _WS_CLASS + r"*$")

# Python float() grammar: optional sign, digits with single underscores
# between them, optional fraction and exponent, or inf/infinity/nan.
_DIGITS = r"[0-9](?:_?[0-9])*"
_PY_FLOAT_RE = (
    r"^[+-]?(?:(?:" + _DIGITS + r"(?:\.(?:" + _DIGITS + r")?)?|\." + _DIGITS + r")"
    r"(?:[eE][+-]?" + _DIGITS + r")?|(?i:inf|infinity|nan))$"
)


def py_strip(c: Column) -> Column:
    """``str.strip()``: drop leading and trailing Python whitespace.

    The trailing run is matched only from its first character (lookbehind),
    so a long run inside the text costs linear, not quadratic, time.
    """
    t = F.trim(c)
    # trimmed of spaces, a text that begins and ends with a printable ASCII character is stripped
    plain = F.substring(t, 1, 1).between("!", "~") & F.substring(t, -1, 1).between("!", "~")
    return F.when(plain, t).otherwise(F.regexp_replace(
        c, r"(?U)^[\s\x{1c}-\x{1f}]+|(?<![\s\x{1c}-\x{1f}])[\s\x{1c}-\x{1f}]+$|^[\s\x{1c}-\x{1f}]+$", ""))


def py_split(c: Column) -> Column:
    """``str.split()`` of an already stripped string: runs of whitespace.

    Runs are first collapsed to one space (a compiled pattern), then split on
    that single character, which Java splits without compiling a pattern per row.
    """
    one_space = F.when(c.rlike(r"[^!-~ ]|  "), F.regexp_replace(c, WS + "+", " ")).otherwise(c)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(one_space, " ", -1))


def token(tokens: Column, index: int) -> Column:
    """0-based token access; null when the line is too short."""
    return F.try_element_at(tokens, F.lit(index + 1))


def parse_log_time(c: Column) -> Column:
    """``datetime.strptime(c.strip(), "%d/%m/%Y %H:%M:%S")`` or null.

    Returns TIMESTAMP_NTZ, like Python's naive datetime, so differences are
    wall-clock seconds whatever the session time zone. Two regex passes per
    value: the shape check (surrounding whitespace allowed, as strip() drops
    it) and one extraction of the six digit groups.
    """
    ok = c.rlike(_TIME_RE_PADDED)
    parts = F.regexp_extract_all(c, F.lit(r"([0-9]+)"), 1)

    def made(groups: Column) -> Column:
        day, month, year, hour, minute, second = (F.try_element_at(groups, F.lit(i)).cast("int") for i in range(1, 7))
        # make_timestamp would roll second 60 over to the next minute; strptime refuses it
        return F.when((year >= 1) & (second <= 59), F.try_make_timestamp_ntz(year, month, day, hour, minute, second))

    # a one-element transform: the groups are extracted once, not once for each of their uses
    return F.when(ok, F.transform(F.array(parts), made)[0])


def _float_strip(c: Column) -> Column:
    # float() trims Unicode White_Space only; unlike str.strip() it keeps U+001C..U+001F
    return F.regexp_replace(c, r"(?U)^\s+|(?<!\s)\s+$|^\s+$", "")


def py_float(c: Column) -> Column:
    """``float(c)`` as DOUBLE, null when Python would raise ValueError."""
    t = _float_strip(c)
    return F.when(t.rlike(_PY_FLOAT_RE), F.regexp_replace(t, "_", "").try_cast("double"))


def is_py_float(c: Column) -> Column:
    """True when ``float(c)`` succeeds (null input counts as missing, not bad)."""
    return c.isNull() | _float_strip(c).rlike(_PY_FLOAT_RE)
