"""Scalar column expressions (JVM built-ins only, so they stay inside
whole-stage code generation)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def word_count(text) -> Column:
    """Number of whitespace-separated tokens; empty or blank text gives 0
    (``size(split(...))`` would give 1 for ``''``)."""
    return F.size(F.regexp_extract_all(_c(text), F.lit(r"\S+"), 0)).cast("int")


def mismatch_flag(a, b) -> Column:
    """0 when two values agree, else 1 (a NULL on either side counts as a mismatch)."""
    return F.when(_c(a) == _c(b), F.lit(0)).otherwise(F.lit(1))


def recode_cascade(col, rules: Sequence[tuple[Iterable, object]], default) -> Column:
    """Assign ``code`` where ``col`` is in ``values``; rules are applied in
    order and a later rule overwrites an earlier one (so it is tested first
    here). Unmatched and NULL values get ``default``."""
    expr = None
    for values, code in reversed(list(rules)):
        cond = _c(col).isin(list(values))
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def recode_map(col, mapping: Mapping) -> Column:
    """Dictionary lookup; unmatched values (and NULL) become NULL."""
    expr = None
    for k, v in mapping.items():
        cond = _c(col) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def matches_any(col, patterns: Sequence[str], case_insensitive: bool = True) -> Column:
    """True when any regex pattern matches somewhere in the value."""
    rx = "|".join(patterns)
    if case_insensitive:
        rx = "(?i)" + rx
    return _c(col).rlike(rx)


def money(col, digits: int = 2) -> Column:
    """``$%.2f`` text of a number."""
    return F.format_string(f"$%.{digits}f", _c(col))


def stamp(col, pattern: str = "dd/MM/yyyy HH:mm:ss") -> Column:
    return F.date_format(_c(col), pattern)


def half_even(col, digits: int) -> Column:
    """Python's ``round`` rule (banker's rounding)."""
    return F.bround(_c(col), digits)


def linspace(start, stop, num: int) -> Column:
    """Array of ``num`` evenly spaced values from ``start`` to ``stop``."""
    start, stop = _c(start) if not isinstance(start, (int, float)) else F.lit(float(start)), \
        _c(stop) if not isinstance(stop, (int, float)) else F.lit(float(stop))
    step = (stop - start) / F.lit(max(num - 1, 1))
    return F.transform(F.sequence(F.lit(0), F.lit(num - 1)),
                       lambda i: F.when(i == num - 1, stop).otherwise(start + i * step))


def logspace(start, stop, num: int, base: float = 10.0) -> Column:
    """Array of ``base ** e`` for ``num`` evenly spaced exponents."""
    return F.transform(linspace(start, stop, num), lambda e: F.pow(F.lit(base), e))


# fixed value: the wording of a message
def alert_text(name, items_array) -> Column:
    """``name update! a, b`` from an array of item names (sorted)."""
    return F.concat(_c(name), F.lit(" update! "), F.array_join(F.array_sort(_c(items_array)), ", "))
