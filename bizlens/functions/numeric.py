"""Exact rounding of ratios of integers.

``ROUND(CAST(a AS DECIMAL) / b, 2)`` in the original SQL is an exact decimal
operation. Doing it in floating point and then rounding can land on the other
side of a tie (``107 / 40 = 2.675`` is stored as ``2.67499...``). These
helpers compute ``round(mult * num / den, digits)`` half away from zero with
integer (decimal(38,0)) arithmetic, and give the result as double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_round(num, den, digits: int = 2, mult: int = 1, long: bool = False) -> Column:
    """``round(mult * num / den, digits)`` for integer-valued ``num``/``den``;
    NULL when ``den`` is 0 or NULL. With ``long`` the arithmetic is that of 64-bit
    integers, for rows (not sums) whose ``2 * mult * 10^digits * num`` is known
    to fit; a value beyond ends the query with an error."""
    num, den = _col(num), _col(den)
    scale = 10 ** digits
    if long:
        n, d = F.abs(num).cast("long"), F.abs(F.nullif(den, F.lit(0))).cast("long")
        return F.signum(num) * F.signum(den) * F.call_function("div", n * F.lit(2 * mult * scale) + d, d * 2) / F.lit(scale)
    a = F.abs(num).cast("decimal(38,0)") * F.lit(2 * mult * scale) + F.abs(den).cast("decimal(38,0)")
    b = F.abs(den).cast("decimal(38,0)") * 2
    q = (a - F.pmod(a, b)) / b           # exact: a - a mod b is a multiple of b
    sign = F.signum(num) * F.signum(den)
    return F.when(den != 0, (sign * q / F.lit(scale)).cast("double"))


def ratio_round_sql(num: str, den: str, digits: int = 2, mult: int = 1) -> str:
    """The same rounding as SQL text (for the oracle)."""
    scale = 10 ** digits
    return (f"(CASE WHEN ({den}) <> 0 THEN sign({num}) * sign({den}) * "
            f"((abs({num})::HUGEINT * {2 * mult * scale} + abs({den})) // (2 * abs({den})::HUGEINT)) "
            f"/ {scale} END)")
