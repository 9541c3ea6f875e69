"""Money rounding and number-to-text rules."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column) -> Column:
    """Round to 2 places by the exact binary value, ties to even.

    ``F.round`` works on the shortest decimal text of the double, so it lifts 1.005 (stored
    as 1.00499...) to 1.01. ``format_number`` looks at the stored value and gives 1.00.
    """
    return F.call_function("format_number", c.cast("double"), F.lit("0.00")).cast("double")


def exact_sum(c: Column | str) -> Column:
    """A sum of money, as double, that doesn't depend on the order of rows: added as decimals of
    six places."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(24,6)")).cast("double")


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def number_text(c: Column, places: int = 0) -> Column:
    """A rounded double as text: always a decimal point, never an exponent ("12345678.0")."""
    keep = max(places, 1)
    text = F.round(c.cast("double"), places).cast(f"decimal(38,{keep})").cast("string")
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1") if keep > 1 else text


def fill(template: str, **values: Column) -> Column:
    """Put columns into a ``{name}`` template; null if any value is null."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if p]
    return F.concat(*pieces)
