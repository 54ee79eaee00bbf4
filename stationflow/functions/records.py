"""Series records as text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.functions.keys import _col, or_default
from stationflow.functions.text import minute_text


def merged_flags(flag: Column | str, additional: Column | str) -> Column:
    """``flag additional`` when there is additional text other than '0'."""
    flag, additional = or_default(flag, ""), or_default(additional, "")
    return F.when(additional.isin("", "0"), flag).otherwise(
        F.concat(flag, F.lit(" "), additional)
    )


def record_line(moment: Column | str, value: Column, flags: Column) -> Column:
    """``date,value,flags``; absent values and flags are empty."""
    return F.concat(
        minute_text(moment), F.lit(","), or_default(value, ""), F.lit(","), or_default(flags, "")
    )


def slashed(*codes: Column | str) -> Column:
    """Codes between slashes, absent ones empty."""
    parts = []
    for code in codes:
        parts += [or_default(_col(code).cast("string"), ""), F.lit("/")]
    return F.concat(*parts[:-1])


def packed_clouds(layers: Sequence[Sequence[Column | str]]) -> Column:
    """``type/percentage/height`` of each layer, blanks between."""
    return F.concat_ws(" ", *[slashed(*layer) for layer in layers])


def phase_minutes(moment: Column | str, step_minutes: Column | int) -> Column:
    """Minutes since the month began, modulo the length of the step."""
    moment = _col(moment)
    minutes = (F.dayofmonth(moment) - 1) * 1440 + F.hour(moment) * 60 + F.minute(moment)
    return minutes % (F.lit(step_minutes) if isinstance(step_minutes, int) else step_minutes)


def is_month_start(moment: Column | str) -> Column:
    """Midnight of the first day, to the second."""
    moment = _col(moment)
    return (
        (F.dayofmonth(moment) == 1)
        & (F.hour(moment) == 0)
        & (F.minute(moment) == 0)
        & (F.floor(F.second(moment)) == 0)
    )
