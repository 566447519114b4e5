"""Text keys and labels.

All functions return ``Column`` expressions built from Spark SQL functions,
so they run inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c: str | Column) -> Column:
    """Lower-case, every run of non ``[a-z0-9]`` becomes one space, trim; empty -> null.

    Makes ``'Booked '``, ``'Follow up 3 - No Response'`` and
    ``'follow up 3 no response'`` the same join key. Apply to both sides of a
    join (J9) as a precomputed column.
    """
    x = F.trim(F.regexp_replace(_lower(F.coalesce(_c(c), F.lit(""))), r"[^a-z0-9]+", " "))
    return F.nullif(x, F.lit(""))


def _lower(c: Column) -> Column:
    # Fixed value: Java lower-cases U+0130 (dotted capital I) to two code
    # points; PostgreSQL (glibc) and DuckDB give a plain 'i'. Map it first.
    return F.lower(F.translate(c, "\u0130", "I"))


def mentions(c: str | Column, word: str) -> Column:
    """Whether ``norm_text`` of a text contains ``word``, of letters a-z and digits alone; null is no match.

    Normalising parts words, it never joins them, so such a word is there before as after
    and a search finds it without the regular expression.
    """
    if not re.fullmatch("[a-z0-9]+", word):
        raise ValueError(word)
    return F.coalesce(_lower(_c(c)).contains(word), F.lit(False))


def blank_to_null(c: str | Column, trim: bool = True) -> Column:
    """``nullif(trim(x), '')`` (or ``nullif(x, '')`` with ``trim=False``)."""
    x = F.trim(_c(c)) if trim else _c(c)
    return F.nullif(x, F.lit(""))


def surrogate_key(*parts: str | Column, sep: str = ":") -> Column:
    """``a || ':' || b`` - null when any part is null (unlike ``concat_ws``)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_c(p).cast("string"))
    return F.concat(*cols)


def quote_of(job_number: str | Column) -> Column:
    """The quote number from ``<quote>-<seq>`` (``split_part(x, '-', 1)``)."""
    return F.split_part(_c(job_number), F.lit("-"), F.lit(1))


def compact_stamp(ts: str | Column) -> Column:
    """``yyyyMMddHHmmss`` of an instant in the (UTC-pinned) session zone."""
    return F.date_format(_c(ts), "yyyyMMddHHmmss")


def label_or_code(name: str | Column, code: str | Column, prefix: str = "status_") -> Column:
    """A known label, else ``status_<code>``; a null code stays null."""
    return F.coalesce(_c(name), F.concat(F.lit(prefix), _c(code).cast("string")))


def default_false(c: str | Column) -> Column:
    """Unknown flag counts as false."""
    return F.coalesce(_c(c), F.lit(False))


def default_true(c: str | Column) -> Column:
    """Unknown validity counts as valid (``coalesce(is_valid_lead, true)``)."""
    return F.coalesce(_c(c), F.lit(True))


# Fixed value: an e-mail address is a run of characters other than white
# space, angle brackets, comma, semicolon and double quote, around an '@'.
ADDRESS_PATTERN = r"""[^\s<>,;"]+@[^\s<>,;"]+"""


def addresses(*sources: str | Column) -> Column:
    """E-mail addresses found in several header values, lower-cased,
    de-duplicated keeping first-seen order. String and array-of-string inputs
    are both accepted (an array is joined with spaces first).
    """
    found = []
    for s in sources:
        c = F.coalesce(_c(s), F.lit(""))
        # the regex only runs on text that has an '@' at all (a cheap byte search first)
        hits = F.regexp_extract_all(F.lower(c), F.lit(ADDRESS_PATTERN), F.lit(0))
        found.append(F.when(c.contains("@"), hits).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.flatten(F.array(*found)))


def addresses_from_list(c: str | Column) -> Column:
    """X26 for an ``array<string>`` header: join, then extract."""
    return addresses(F.array_join(_c(c), " "))
