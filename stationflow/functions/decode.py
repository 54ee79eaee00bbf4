"""Code maps and the small decisions of the series tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.functions.keys import _col

_DENSE_SPAN = 1000


def decode(code: Column | str, mapping: Mapping) -> Column:
    """Look a code up in a small fixed map; unmapped and NULL codes give NULL.

    Whole-number codes in a narrow span become one array access per row; other
    codes use a literal map. Neither needs a join.
    """
    code = _col(code)
    keys = list(mapping)
    if all(type(k) is int for k in keys) and max(keys) - min(keys) < _DENSE_SPAN:
        low, high = min(keys), max(keys)
        slots = F.array(*[F.lit(mapping.get(k)) for k in range(low, high + 1)])
        position = F.when(code.between(low, high) & (code == code.cast("int")), (code - F.lit(low)).cast("int"))
        return F.get(slots, position)
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), code)


def decode_members(code: Column | str, members: Mapping[int, Iterable[int]]) -> Column:
    """Many-to-one map given as target -> codes; unlisted codes give NULL."""
    return decode(code, {k: target for target, keys in members.items() for k in keys})


def prefecture_division(prefecture: Column | str) -> Column:
    return decode(prefecture, values.PREFECTURE_DIVISIONS)


def is_one(flag: Column | str) -> Column:
    """1 is True; everything else, NULL included, is False."""
    return F.coalesce(_col(flag) == 1, F.lit(False))


def time_step(step: Column | str) -> Column:
    """Step 6 has no counterpart, step 7 is the target's step 6."""
    step = _col(step)
    return F.when(step == 7, F.lit(6)).otherwise(F.nullif(step, F.lit(6)))


def interval_type(variable_type: Column | str) -> Column:
    return decode(variable_type, values.INTERVAL_TYPES)


def nominal_offset_minutes(strict: Column | str) -> Column:
    return F.when(_col(strict), F.lit(0))


def nominal_offset_months(strict: Column | str, hydrological_year: Column | str) -> Column:
    """A strict series starts in month 0, or 9 when it follows the hydrological year."""
    months = F.when(_col(hydrological_year), F.lit(9)).otherwise(F.lit(0))
    return F.when(_col(strict), months)


def actual_offset_months(step: Column | str) -> Column:
    """Monthly series (step 4) 1, annual series (step 5) 12, others 0."""
    return F.coalesce(decode(step, {4: 1, 5: 12}), F.lit(0))


def series_kind(kind: Column | str, alternate: bool = False) -> Column:
    """Kind 1 is raw data; everything else, NULL included, is processed data."""
    language = int(alternate)
    return F.when(_col(kind) == 1, F.lit(values.RAW_KIND[language])).otherwise(
        F.lit(values.PROCESSED_KIND[language])
    )


def compass_degrees(value: Column | str) -> Column:
    """Compass name to degrees as text; unknown names give ''.

    Absent, empty and '0' values pass through unchanged.
    """
    value = _col(value)
    degrees = F.coalesce(decode(value, values.COMPASS_DEGREES).cast("string"), F.lit(""))
    return F.when(value.isNull() | value.isin("", "0"), value).otherwise(degrees)
