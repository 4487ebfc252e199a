"""Column -> Column helpers. All are Catalyst expressions (no Python UDF),
so they stay inside whole-stage codegen."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeframe.constants import WHITE_SPACE


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: str | Column, to: str = "float") -> Column:
    """Cast that yields null on malformed input instead of failing (ANSI)."""
    return _col(c).try_cast(to)


def normalize_text(c: str | Column) -> Column:
    """lower(trim(c)); trim removes spaces only."""
    return F.lower(F.trim(_col(c)))


def prefix_code(c: str | Column, length: int) -> Column:
    """First ``length`` characters, upper-cased (not a postal code)."""
    return F.upper(F.substring(_col(c), 1, length))


def strip_text(c: str | Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def is_truthy_text(c: str | Column) -> Column:
    """Python-style truthiness of a raw string value: null and '' are false."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def is_truthy_number(c: str | Column) -> Column:
    """Truthiness of a raw value that a typed reader has turned into text: null, ''
    and a numeric zero are false (the reader writes the number 0 as '0' or '0.0')."""
    c = _col(c)
    return is_truthy_text(c) & F.coalesce(c.try_cast("double") != F.lit(0.0), F.lit(True))


def _plus(acc: Column, x: Column) -> Column:
    return acc + x


def array_mean(arr: str | Column) -> Column:
    """Mean of an array of doubles, folded left from 0.0.

    A null array, an empty array, or any null element gives null (the sum
    is poisoned by the null element; the empty division is made safe with
    try_divide instead of raising under ANSI mode).
    """
    arr = _col(arr)
    total = F.aggregate(arr, F.lit(0.0).cast("double"), _plus)
    return F.try_divide(total, F.size(arr))


def _is_null(x: Column) -> Column:
    return x.isNull()


def count_nulls_in(arr: str | Column) -> Column:
    """Number of null elements of an array (null for a null array, whatever
    the legacy size-of-null setting)."""
    return F.array_size(F.filter(_col(arr), _is_null))


def threshold_ladder(
    c: str | Column,
    bands: Sequence[tuple[float, str]],
    below: str,
    missing: str,
) -> Column:
    """First band whose lower bound is met wins (bounds in descending order);
    non-null values under every band get ``below``; null gets ``missing``.
    NaN compares greater than any number, so it lands in the top band."""
    c = _col(c)
    expr = None
    for bound, label in bands:
        cond = c >= F.lit(bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    not_null = c.isNotNull()
    expr = F.when(not_null, below) if expr is None else expr.when(not_null, below)
    return expr.otherwise(missing)


def bucket_by_membership(
    c: str | Column,
    rules: Iterable[tuple[Sequence[str], str]],
    default: str,
) -> Column:
    """CASE WHEN c IN (...) THEN label ... ELSE default (null -> default)."""
    c = _col(c)
    expr = None
    for values, label in rules:
        cond = c.isin(list(values))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def date_part_strings(ts: str | Column, parts: Sequence[str] = ("year", "month", "day")) -> list[Column]:
    """Zero-padded string parts of a date/timestamp, for Hive-style layouts."""
    fmt = {"year": "yyyy", "month": "MM", "day": "dd"}
    return [F.date_format(_col(ts), fmt[p]).alias(p) for p in parts]


def object_key(path: str | Column, root: str) -> Column:
    """Key of a file below ``root`` (zones and ``k=v/`` folders kept), with ``\\``
    normalised to ``/``. Scheme and authority of either side don't matter; a file
    that isn't below the root has a null key."""
    below = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root.replace("\\", "/")).rstrip("/") + "/"
    whole = F.regexp_replace(F.regexp_replace(_col(path), r"\\", "/"), r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.when(whole.startswith(below), whole.substr(F.lit(len(below) + 1), F.length(whole)))
