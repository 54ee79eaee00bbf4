"""Key arithmetic: offsets, integer division, guards and defaults."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def offset_key(key: Column | str, offset: int) -> Column:
    """``key + offset``; NULL stays NULL."""
    return _col(key) + F.lit(offset)


def divided_key(
    key: Column | str, divisor: int, overrides: Mapping[int, int] | None = None
) -> Column:
    """``key`` divided and cut to a whole number, some keys being fixed by hand."""
    key = _col(key).cast("long")
    result = F.call_function("div", key, F.lit(divisor).cast("long"))
    for old, new in (overrides or {}).items():
        result = F.when(key == F.lit(old), F.lit(new).cast("long")).otherwise(result)
    return result


def guarded_key(key: Column | str, offset: int = 0, default: int | None = None) -> Column:
    """Positive keys get the offset; zero, negative and NULL keys get the default."""
    key = _col(key)
    return F.when(key > 0, key + F.lit(offset)).otherwise(F.lit(default))


def in_range(value: Column | str, low: int, high: int, result: Column | None = None) -> Column:
    """``result`` (or the value) when the value lies in low..high, otherwise NULL."""
    value = _col(value)
    return F.when(value.between(low, high), value if result is None else result)


def first_present(*values: Column | str) -> Column:
    return F.coalesce(*[_col(v) for v in values])


def or_default(value: Column | str, default: object) -> Column:
    """The value, with NULL replaced."""
    return F.coalesce(_col(value), F.lit(default))
