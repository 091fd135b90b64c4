"""Deterministic decimal rounding of doubles for reported values.

Values computed from decimal data often sit exactly on a rounding midpoint
(0.69 / 96 = 0.0071875, 3.05^2 = 9.3025).  Which side such a value rounds to
then depends on the last bit of the double -- i.e. on summation order -- and on
how the double is printed.  Adding a tiny bounded nudge before rounding,
``min(max(1, |x|) * 10^-(d+3), 10^-(d+1))``, moves exact midpoints clear of
that noise while changing no value by more than a tenth of the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nudge(c: Column, digits: int = 6) -> Column:
    rel, cap = 10.0 ** -(digits + 3), 10.0 ** -(digits + 1)
    return c + F.least(F.greatest(F.abs(c), F.lit(1.0)) * F.lit(rel), F.lit(cap))


def rnd(c: Column | str, digits: int = 6) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(nudge(col, digits), digits)


def nudge_sql(expr: str, digits: int = 6) -> str:
    rel, cap = 10.0 ** -(digits + 3), 10.0 ** -(digits + 1)
    return f"(({expr}) + LEAST(GREATEST(ABS({expr}), 1.0) * {rel!r}, {cap!r}))"
