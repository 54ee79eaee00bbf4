"""Text building: remarks, names, paths, number and date formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.functions.decode import decode
from stationflow.functions.keys import _col, offset_key

def append_remark(remark: Column | str, label: str, value: Column | str) -> Column:
    """The remark, a line break and, when there is a value, ``label: value``.

    A NULL remark stays NULL; the line break stays also when the value is NULL.
    """
    value = _col(value)
    addition = F.coalesce(F.concat(F.lit(f"{label}: "), value), F.lit(""))
    return F.concat(_col(remark), F.lit("\n"), addition)


def truncated(value: Column | str, length: int) -> Column:
    """A cast to a bounded text type: the first ``length`` characters."""
    return F.left(_col(value), F.lit(length))


def word(value: Column | str, number: int) -> Column:
    """The ``number``-th blank-separated part, '' when there are fewer."""
    return F.split_part(_col(value), F.lit(" "), F.lit(number))


def minute_text(moment: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm``, read off the zone-free value so no session zone can shift it."""
    return F.left(_col(moment).cast("timestamp_ntz").cast("string"), F.lit(16))


def minute_stamp(text: Column | str) -> Column:
    """The inverse of ``minute_text``; an ISO ``T`` between date and time is accepted."""
    return F.left(_col(text), F.lit(16)).cast("timestamp_ntz")


def number_text(value: Column | str) -> Column:
    """A number in plain digits, whole numbers without a fraction.

    Spark writes an exponent outside 0.001 to 10,000,000; there the digits of its
    mantissa are moved to their places. Names such as NaN stay.
    """
    value = _col(value).cast("double")
    text = value.cast("string")
    sign = F.when(F.startswith(text, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.substring_index(F.ltrim(text, F.lit("-")), "E", 1)
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), r"(?<=\d)0+$", "")
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    point = exponent + 1
    moved = (
        F.when(exponent < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= F.length(digits), F.rpad(digits, point, "0"))
        .otherwise(F.concat(F.left(digits, point), F.lit("."), F.substr(digits, point + 1)))
    )
    return F.when(text.contains("E"), F.concat(sign, moved)).otherwise(F.regexp_replace(text, r"\.0$", ""))


def six_decimals(number: Column | str) -> Column:
    """A number as ``%f`` prints it: the exact binary value rounded to six decimals, ties to even.

    Below a million, the machine's product with a million is off by less than a
    thousandth, which settles all numbers but those near a tie. For these and larger
    ones the fraction times a million is rounded once by the machine, and its rounding
    error (exact from the halves of the factors) decides at a tie. Values from 2**63
    on, and names such as NaN, are left to the formatter.
    """
    number = _col(number).cast("double")
    size = F.abs(number)
    scaled = size * F.lit(1e6)
    settled = (size < F.lit(1e6)) & (F.abs(scaled - F.floor(scaled) - F.lit(0.5)) > F.lit(1e-3))
    millionths = F.floor(scaled + F.lit(0.5))
    plain = F.concat(
        F.call_function("div", millionths, F.lit(1000000)).cast("string"), F.lit("."),
        F.substring((millionths % 1000000 + 1000000).cast("string"), 2, 6),
    )
    minus = (number < 0) | ((number == 0) & F.startswith(number.cast("string"), F.lit("-")))  # also of a negative zero
    sign = F.when(minus, F.lit("-")).otherwise(F.lit(""))
    whole = F.floor(size)
    fraction = size - whole
    million = F.lit(1e6)
    product = fraction * million
    high = fraction * F.lit(134217729.0) - (fraction * F.lit(134217729.0) - fraction)  # the upper 26 bits
    error = (high * million - product) + (fraction - high) * million
    digits = F.floor(product)
    beyond = (product - digits - F.lit(0.5)) + error
    digits = digits + F.when((beyond > 0) | ((beyond == 0) & (digits % 2 == 1)), 1).otherwise(0)
    full = whole.cast("long") + F.when(digits >= 1000000, 1).otherwise(0)
    text = F.concat(full.cast("string"), F.lit("."), F.lpad((digits % 1000000).cast("string"), 6, "0"))
    exact = F.when(size < F.lit(float(1 << 63)), F.concat(sign, text)).otherwise(F.format_string("%f", number))
    return F.when(settled, F.concat(sign, plain)).otherwise(exact)


def point_line(*numbers: Column | str) -> Column:
    """Numbers with six decimals between commas; an absent number is an error."""
    numbers = [_col(n) for n in numbers]
    parts = []
    for n in numbers:
        parts += [F.lit(","), six_decimals(n)]
    absent = numbers[0].isNull()
    for n in numbers[1:]:
        absent = absent | n.isNull()
    failure = F.raise_error(F.lit("curve point without a number")).cast("string")
    return F.when(absent, failure).otherwise(F.concat(*parts[1:]))


def true_false(flag: Column | str) -> Column:
    """The words True and False; an absent flag is an error."""
    flag = _col(flag)
    return F.when(
        flag.isNull(), F.raise_error(F.lit("curve segment without a flag")).cast("string")
    ).otherwise(F.when(flag, F.lit("True")).otherwise(F.lit("False")))


def extension(file_type: Column | str) -> Column:
    return decode(file_type, values.FILE_EXTENSIONS)


def media_path(
    prefix: str, key: Column | str, number: Column | str, file_extension: Column, offset: int = 1000
) -> Column:
    """``prefix`` key+offset ``-`` number ``.`` extension; NULL if any part is NULL."""
    return F.concat(
        F.lit(prefix),
        offset_key(key, offset).cast("string"),
        F.lit("-"),
        _col(number).cast("string"),
        F.lit("."),
        file_extension,
    )


def drawing_path(prefix: str, key: Column | str, extension: str = "png") -> Column:
    return F.concat(F.lit(prefix), _col(key).cast("string"), F.lit(f".{extension}"))


def first_stamp(chunk: Column | str) -> Column:
    """The first comma field of the first line."""
    return F.substring_index(F.substring_index(_col(chunk), "\n", 1), ",", 1)


def id_from_file_name(name: Column | str) -> Column:
    """The whole number before the first dot of a file name."""
    return F.split_part(_col(name), F.lit("."), F.lit(1)).cast("long")
