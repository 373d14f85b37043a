"""Numeric clean-up and exact sums."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelline.functions.text import strip

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])$"


def plain_number(c: Column) -> Column:
    """Text as a double; anything that is not a plain number becomes null."""
    t = strip(c)
    return F.when(t.rlike(_NUMBER), t.try_cast("double"))


def numeric(c: Column) -> Column:
    """Text as a double after dropping dollar signs and thousands commas."""
    return plain_number(F.regexp_replace(c, "[$,]", ""))


def whole_number(c: Column) -> Column:
    """The part before the first point as a double, for counts kept as text."""
    return plain_number(F.substring_index(F.regexp_replace(c, "[$,]", ""), ".", 1))


def bytes_number(c: Column) -> Column:
    """Binary holding number text as a double; undecodable bytes are dropped first."""
    text = F.make_valid_utf8(c.cast("string"))
    return plain_number(F.replace(text, F.lit("\ufffd"), F.lit("")))


def no_nan(c: Column) -> Column:
    """NaN as null, so that sums and means skip it."""
    return F.when(~F.isnan(c), c)


# A double below 2^62 is the sum of whole numbers of these units.  Longs add up 2^24 values of that size, and 2^36 values below
# 2^50; sums beyond end with an error, never with a wrong number.
_GRID = 2.0**62
_HIGH = 24  # bits of the lower part of the whole number
_FIRST, _SECOND = 26, 27  # bits of the two parts of the fraction


def exact_parts(c: Column, where: Column | None = None) -> dict[str, Column]:
    """What exact_total needs the sums of: a value split without rounding; of rows that fail the test, nothing.

    NaN is skipped.  Splitting does not depend on the test, so that several tests of one value share it.
    """
    value = no_nan(c)
    fits = F.when(F.abs(value) < _GRID, value)
    whole = fits.cast("bigint")  # towards 0, so that the fraction is exact
    scaled = (fits - whole) * 2.0**_FIRST
    first = scaled.cast("bigint")
    rest = (scaled - first) * 2.0**_SECOND
    second = rest.cast("bigint")
    parts = {
        "high": F.shiftright(whole, _HIGH), "low": whole.bitwiseAND(F.lit((1 << _HIGH) - 1)), "first": first, "second": second,
        "tail": rest - second, "beyond": F.when(F.abs(value) >= _GRID, value),
    }
    return parts if where is None else {name: F.when(where, part) for name, part in parts.items()}


def exact_total(sums: dict[str, Column]) -> Column:
    """The sum of the values, put together once from the sums of their parts."""
    low_bits, first_bits, second_bits = ((1 << n) - 1 for n in (_HIGH, _FIRST, _SECOND))
    sum_first = sums["first"] + F.shiftright(sums["second"], _SECOND)
    sum_low = sums["low"] + F.shiftright(sum_first, _FIRST)
    sum_high = sums["high"] + F.shiftright(sum_low, _HIGH)
    units = sum_first.bitwiseAND(F.lit(first_bits)) * (1 << _SECOND) + sums["second"].bitwiseAND(F.lit(second_bits))
    # A negative sum is a whole number less a fraction, as a positive one is a whole number and a fraction.
    short = F.when((sum_high < 0) & (units > 0), 1).otherwise(0)
    units = units - F.lit(1 << (_FIRST + _SECOND)) * short
    integer = sum_high.cast("double") * float(1 << _HIGH) + (sum_low.bitwiseAND(F.lit(low_bits)) + short).cast("double")
    inside = integer + (units.cast("double") + sums["tail"]) / 2.0 ** (_FIRST + _SECOND)
    # `inside` stands once: twice, and the code of two sums is too long for the JVM to compile.
    some = sums["high"].isNotNull() | sums["beyond"].isNotNull()
    return F.when(some, F.coalesce(sums["beyond"], F.lit(0.0)) + F.coalesce(inside, F.lit(0.0)))


def exact_sum(c: Column, where: Column | None = None) -> Column:
    """Sum without loss, independent of the order of rows; NaN is skipped, and rows that fail the test.

    Only what does not fit is added as doubles: bits below 2^-53, infinite values and those from 2^62.
    """
    return exact_total({name: F.sum(part) for name, part in exact_parts(c, where).items()})


def exact_mean(c: Column, where: Column | None = None) -> Column:
    """Unweighted mean over the non-null values of rows that pass the test, independent of the order of rows."""
    n = F.count(c if where is None else F.when(where, c))
    return F.when(n > 0, exact_sum(c, where) / n)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, or 0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))
