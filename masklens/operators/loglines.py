"""Log documents -> one row per line, with the line's time, message and tokens.

A log line reads ``dd/MM/yyyy HH:mm:ss :: message``. The line is split at the
first ``::``; the left side must parse as a time, the right side (stripped) is
the message. Lines without ``::`` or with an unparsable time are not valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masklens.functions.text import parse_log_time, py_split, py_strip


# Document key: two independent hashes of the document's identity columns
# (96 bits together), deterministic under task retries.
DOC_KEY = ("doc_id", "doc_h2")


def document_key(cols) -> list[Column]:
    """The 96-bit key of some columns; their null flags count, since Spark's hashes skip nulls."""
    flags = [F.col(c).isNull() for c in cols]
    return [F.xxhash64(*cols, *flags).alias("doc_id"), F.hash(*cols, *flags).alias("doc_h2")]


def documents(bronze: DataFrame, log_col: str = "masking_log",
              ident: tuple[str, ...] = ("object_id", "load_date")) -> DataFrame:
    """Bronze rows with the 96-bit key of their identity columns and text.

    Exact copies (same identity columns and text) share the key; two different documents would share it with
    probability about n^2 / 2^97 (1e-11 for a billion documents). Nothing is shuffled: the text stays where it
    was read, and only what the rules take from it moves on (:func:`masklens.operators.maskops.rule_lines`).
    """
    cols = [*ident, log_col]
    return bronze.select(*cols, *document_key(cols))


def explode_lines(docs: DataFrame, log_col: str = "masking_log",
                  keep: tuple[str, ...] = ("object_id", "load_date")) -> DataFrame:
    """L1: one row per line of every row of :func:`documents`, ``line_no`` 0-based."""
    return docs.select(
        *DOC_KEY, *keep,
        F.posexplode(F.split(F.col(log_col), "\n", -1)).alias("line_no", "line"),
    )


def parse_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Add ``log_time``, ``message``, ``tokens`` and ``valid``."""
    line = F.col(line_col)
    at = F.instr(line, "::")
    has_sep = at > 0
    left = F.substring_index(line, "::", 1)
    right = F.expr(f"substr(`{line_col}`, instr(`{line_col}`, '::') + 2)")
    ts = F.when(has_sep, parse_log_time(left))
    msg = F.when(has_sep, py_strip(right))
    # The parse is the input of a one-element generator: a later filter on its
    # output cannot be pushed below it, so each line is parsed exactly once.
    parsed = F.inline_outer(F.array(F.struct(ts.alias("log_time"), msg.alias("message"))))
    valid = F.col("log_time").isNotNull() & F.col("message").isNotNull()
    return lines.select("*", parsed).withColumns(
        {"valid": valid, "tokens": F.when(valid, py_split(F.col("message")))})


def valid_lines(lines: DataFrame) -> DataFrame:
    """keep lines whose time and message both parsed."""
    return lines.where(F.col("valid"))


def log_lines(docs: DataFrame, log_col: str = "masking_log",
              keep: tuple[str, ...] = ("object_id", "load_date")) -> DataFrame:
    """L1-L6 + F4: valid lines of every document, with their number in it."""
    return valid_lines(parse_lines(explode_lines(docs, log_col, keep)))
