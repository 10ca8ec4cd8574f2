"""Scalar column expressions (all Catalyst built-ins, no Python UDFs).

Each helper returns a ``Column`` so it composes into one projection and
stays inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- predicates with pandas semantics (NULL and NaN compare false) ---------

def gt(c: ColumnOrName, v: float) -> Column:
    """``c > v`` as a non-null boolean; NULL and NaN give false."""
    c = _c(c)
    return F.coalesce((c > F.lit(v)) & ~F.isnan(c), F.lit(False))


def eq(c: ColumnOrName, v) -> Column:
    """Null-safe equality (NULL never matches a literal)."""
    return _c(c).eqNullSafe(F.lit(v))


def in_set(c: ColumnOrName, values: Sequence) -> Column:
    return F.coalesce(_c(c).isin(list(values)), F.lit(False))


def flag(pred: Column) -> Column:
    """Boolean predicate -> 0/1 integer."""
    return pred.cast("int")


# --- dates -----------------------------------------------------------------

def parse_date(c: ColumnOrName, fmt: str = "d/M/yyyy", strict: bool = False) -> Column:
    """Day-first text -> date. Strict raises on bad input (ANSI); tolerant -> NULL."""
    if strict:
        return F.to_date(_c(c), fmt)
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("date")


def day_of_week(d: ColumnOrName) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(d))


def day_name(d: ColumnOrName) -> Column:
    """Full English day name."""
    return F.date_format(_c(d), "EEEE")


def timestamp_text(ts: ColumnOrName, fmt: str = "yyyyMMdd_HHmmss") -> Column:
    return F.date_format(_c(ts), fmt)


# --- numeric -----------------------------------------------------------------

def cyclical(c: ColumnOrName, period: float) -> tuple[Column, Column]:
    x = F.lit(2 * math.pi) * _c(c) / F.lit(float(period))
    return F.sin(x), F.cos(x)


def cut(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str],
        include_lowest: bool = True) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]``; the first edge included when
    ``include_lowest``. Out of range, NULL and NaN give NULL."""
    c = _c(c)
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        lo_ok = (c >= F.lit(lo)) if (i == 0 and include_lowest) else (c > F.lit(lo))
        cond = (lo_ok if not math.isinf(lo) else F.lit(True))
        if not math.isinf(hi):
            cond = cond & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(F.isnan(c), F.lit(None).cast("string")).otherwise(expr)


def equal_width_bin(c: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName, n: int) -> Column:
    """0-based index of ``n`` right-closed equal-width bins over ``[lo, hi]``:
    the number of inner edges ``lo + i*(hi-lo)/n`` (i = 1..n-1) below ``c``."""
    c, lo, hi = _c(c), _c(lo), _c(hi)
    width = (hi - lo) / F.lit(float(n))
    terms = [(c > lo + F.lit(float(i)) * width).cast("int") for i in range(1, n)]
    if not terms:
        return F.lit(0)
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def clip_round(c: ColumnOrName) -> Column:
    """``max(0, int(round(x)))`` with half-even rounding -> bigint."""
    return F.greatest(F.lit(0.0), F.bround(_c(c), 0)).cast("bigint")


def finite_or(c: ColumnOrName, default: float = 0.0) -> Column:
    """NULL, NaN and +-inf -> ``default``."""
    c = _c(c)
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(default)).otherwise(c)


def is_finite(c: ColumnOrName) -> Column:
    c = _c(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def error_terms(y: ColumnOrName, yhat: ColumnOrName) -> dict[str, Column]:
    """Residual, absolute, squared and percent error (percent NULL when y=0)."""
    y, yhat = _c(y), _c(yhat)
    e = y - yhat
    return {
        "residual": e,
        "abs_error": F.abs(e),
        "sq_error": e * e,
        "pct_error": F.abs(F.try_divide(e, y)) * F.lit(100.0),
    }


# --- text / maps ---------------------------------------------------------------

def slug(c: ColumnOrName) -> Column:
    """Lower case; spaces and hyphens -> underscores."""
    return F.lower(F.translate(_c(c), " -", "__"))


def path_leaf(c: ColumnOrName) -> Column:
    """Last path segment, trailing slashes removed."""
    return F.element_at(F.split(F.regexp_replace(_c(c), "/+$", ""), "/"), -1)


def map_get(m: ColumnOrName, key: str, default=None) -> Column:
    v = F.element_at(_c(m), F.lit(key))
    return v if default is None else F.coalesce(v, F.lit(default))


def alert_message(template: str, *values: ColumnOrName) -> Column:
    """printf-style text, e.g. ``'R² = %.4f'``."""
    return F.format_string(template, *[_c(v) for v in values])


def round_half_away(c: ColumnOrName, places: int) -> Column:
    """Round a double half away from zero in binary arithmetic:
    ``sign(v) * floor(|v| + 0.5) / 10^places`` with ``v = x * 10^places``.

    Unlike ``F.round`` (a BigDecimal per value) this stays in generated
    code, and it equals DuckDB's ``round(double, n)``. Values whose scaled
    magnitude is already integral (>= 2^52) and NaN/inf pass through."""
    c = _c(c)
    p = F.lit(float(10 ** places))
    v = c * p
    r = F.when(F.abs(v) >= F.lit(2.0 ** 52), v).otherwise(F.signum(v) * F.floor(F.abs(v) + F.lit(0.5)))
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c).otherwise(r / p)
