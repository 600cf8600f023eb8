"""Column helpers for money, shares and scaled amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(amount: Column | str) -> Column:
    """Fixed-point amount: sums stay exact and do not depend on task order."""
    return _col(amount).cast("decimal(15,2)")


def proportion(num: Column | str, den: Column | str, as_text: bool = False) -> Column:
    """Share in percent with two decimals; NULL when the denominator is 0 or NULL."""
    share = F.round(F.try_divide(_col(num).cast("double"), _col(den).cast("double")) * 100, 2)
    return F.concat(share.cast("string"), F.lit("%")) if as_text else share


def in_ten_thousands(amount: Column | str) -> Column:
    """Whole ten-thousands; the remainder is cut off, not rounded."""
    return (_col(amount) / 10000).cast("long")


def magnitude_cell(value: Column | str, steps_per_octave: int = 1024) -> Column:
    """Monotone cell number on a logarithmic scale, for splitting long rankings.

    The number of cells depends on the range of the exponent only (at most about
    40k for amounts in cents), not on the number of rows.
    """
    v = _col(value).cast("double")
    cell = F.floor(F.log2(F.abs(v) + 1) * steps_per_octave).cast("long")
    return F.when(v < 0, -cell - 1).otherwise(cell)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
