"""Ratio and text-format measures with the reference's numeric rules.

* ratios are NULL unless the denominator is positive (no division by zero
  under ANSI mode);
* results are stored at a declared decimal scale, which rounds half up;
* ``CAST(x * 100.0 / y AS INT)`` truncates toward zero;
* ``FORMAT(x, 'N0')`` rounds half away from zero and groups thousands.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den, dtype: str = "decimal(18,2)") -> Column:
    """``CASE WHEN den > 0 THEN num / den END`` stored as ``dtype``.

    Operands are widened to exact decimals so the division keeps enough
    scale before the final (half-up) rounding."""
    n, d = _c(num), _c(den)
    q = n.cast("decimal(28,8)") / d.cast("decimal(28,8)")
    return F.when(d > 0, q.cast(dtype))


def pct_int(num, den) -> Column:
    """``CAST(num * 100.0 / den AS INT)`` (truncates) when den > 0."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, (n.cast("decimal(28,8)") * 100 / d.cast("decimal(28,8)")).cast("int"))


def int_div_pct(num, den) -> Column:
    """Integer ``num * 100 / den`` (truncating division), NULL when den is 0."""
    n, d = _c(num), _c(den)
    return F.when(d != 0, ((n * 100).cast("decimal(38,0)") / d.cast("decimal(38,0)")).cast("bigint"))


def n0(x) -> Column:
    """``FORMAT(x, 'N0')``: half away from zero, thousands separators."""
    return F.format_number(F.round(_c(x), 0), 0)


def money_text(x) -> Column:
    """``'£' + FORMAT(x, 'N0')``; NULL stays NULL (``+`` propagates NULL)."""
    return F.concat(F.lit("£"), n0(x))


def pct2_text(x) -> Column:
    """``FORMAT(x * 100, 'N2') + '%'``."""
    return F.concat(F.format_number(F.round(_c(x).cast("decimal(38,8)") * 100, 2), 2), F.lit("%"))


def int_pct_text(x) -> Column:
    """``CAST(x AS NVARCHAR) + '%'``."""
    return F.concat(_c(x).cast("string"), F.lit("%"))
