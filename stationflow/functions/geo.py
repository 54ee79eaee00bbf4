"""Coordinates given as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.functions.keys import _col


def degrees_from_text(text: Column | str, trimmed: bool = False) -> Column:
    """``DD MM[ SS[.CC]]`` to decimal degrees.

    The fields sit at fixed positions: degrees 1-2, minutes 4-5, seconds 7-8 in
    texts longer than 5, hundredths of a second 10-11 in texts longer than 8.
    ``trimmed`` measures the second length without outer blanks. Text that is
    no number gives NULL.
    """
    text = _col(text)
    length = F.char_length(text)
    full_length = F.char_length(F.trim(text)) if trimmed else length

    def field(position: int) -> Column:
        return F.substring(text, position, 2).try_cast("double")

    return (
        field(1)
        + field(4) / 60
        + F.when(length > 5, field(7) / 3600).otherwise(0.0)
        + F.when(full_length > 8, field(10) / 360000).otherwise(0.0)
    )
