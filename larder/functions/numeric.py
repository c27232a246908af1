"""Numeric cleaning and guarded arithmetic.

Spark 4 runs with ANSI mode on: a bad cast or a division by zero raises and would kill a
whole job for one dirty row.  These helpers return NULL (or a default) instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_bigint(col: Column | str, default: int | float = 0, text: bool = False) -> Column:
    """NULL, blank or not castable to BIGINT -> ``default``; else ``try_cast(x AS BIGINT)``.

    Text must be a whole number (surrounding spaces allowed): ``'3.7'``, ``'1e3'``, ``'abc'``
    and out-of-range values give the default.  A DOUBLE input is truncated (3.7 -> 3) and
    NaN gives the default.  An integer default keeps the BIGINT type.  ``text=True`` (set by
    ``clean_numeric_columns`` for string columns) checks the whole-number shape first, so
    the rule holds even in a session with ANSI mode off, where casts truncate decimals.
    """
    c = F.col(col) if isinstance(col, str) else col
    value = c.try_cast("bigint")
    if text:
        value = F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), value)
    return F.coalesce(value, F.lit(default))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as DOUBLE; NULL when ``den`` is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def strict_ratio(num: Column, den: Column, full: Column) -> Column:
    """Ratio for strict windows: ``num / den`` when the frame is ``full`` and ``den != 0``,
    else 0.0."""
    return F.when(full & (den != F.lit(0)), num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def grouped_number(col: Column | str) -> Column:
    """Number -> text with thousands separators and one decimal, as ``1,234.5``; NULL stays NULL."""
    return F.format_number(F.col(col) if isinstance(col, str) else col, 1)
