"""Scalar and aggregate expressions over measures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


# Up to this many digits, the product with a power of ten and the cut of the last decimals move a value by far less than
# a thousandth of the last digit's unit, as long as its units are well below 2 to the 41st.
PLAIN_DIGITS, PLAIN_PART = 4, 2.0 ** -42


def half_up(value: Column | str, digits: int) -> Column:
    """Round half up on the decimal value, insensitive to summation-order noise.

    The last digits of a double differ from run to run with the order of a distributed sum. They are cut first: a rate,
    or whatever is below 1000, goes through twelve decimals, a larger figure through eight. NaN has no decimal value and
    gives null; a value of any size is kept.

    Only a value near the middle between two results needs its decimals. All others go to the nearest whole number of
    units, whose quotient is the same double, and cost no decimal numbers.
    """
    number = as_column(value).cast("double")
    steady = F.when(F.abs(number) < 1000, F.round(number, 12)).when(~F.isnan(number), F.round(number, 8))
    exact = F.round(steady, digits)
    if not 0 <= digits <= PLAIN_DIGITS:
        return exact
    units = number * F.lit(10.0 ** digits)
    whole = F.rint(units)
    plain = F.abs(units - whole) + F.abs(units) * F.lit(PLAIN_PART) < 0.499
    # Adding zero turns a negative zero into the positive one that decimals give.
    return F.when(plain, whole / F.lit(10.0 ** digits) + F.lit(0.0)).otherwise(exact)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, null when the denominator is zero or null."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def weighted_rate(flag: Column | str, weight: Column | str, nobody: float | None = 0.0) -> Column:
    """Percentage of the weight carried by flagged rows.

    ``nobody`` is the figure when no row is flagged; without any weight the rate is null.
    """
    flag, weight = as_column(flag), as_column(weight)
    passed = F.sum(F.when(flag, weight).otherwise(F.when(weight.isNotNull(), F.lit(nobody))))
    return safe_ratio(F.lit(100.0) * passed, F.sum(weight))


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    value, weight = as_column(value), as_column(weight)
    return safe_ratio(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def share(condition: Column, base: Column | None = None) -> Column:
    """Percentage of rows meeting ``condition`` among rows meeting ``base`` (all rows if absent)."""
    rows = F.count_if(base) if base is not None else F.count(F.lit(1))
    return safe_ratio(F.lit(100.0) * F.count_if(condition), rows)


def required_pace(gap: Column | str, cycle: Column | str, final_year: int) -> Column:
    """Points per cycle still needed to close ``gap`` by ``final_year``."""
    return half_up(safe_ratio(gap, F.lit(final_year) - as_column(cycle)), 2)


def cycles_to_target(first: Column | str, last: Column | str, target: Column | str,
                     elapsed: Column | str) -> Column:
    """Cycles until a straight line through first and last reaches the target.

    Zero if already there, null when the line does not rise.
    """
    first, last, target, elapsed = map(as_column, (first, last, target, elapsed))
    slope = safe_ratio(last - first, elapsed)
    return (
        F.when(last >= target, F.lit(0.0))
        .when((last > first) & (elapsed > 0), half_up(safe_ratio(target - last, slope), 1))
    )


def leading_code(code: Column | str, divisor: int) -> Column:
    """Parent code carried in the leading digits of a child code."""
    code = as_column(code).try_cast("bigint")
    return F.floor(code / F.lit(divisor)).cast("int")


def equal_width_bin(value: Column | str, low: Column, high: Column, bins: int) -> Column:
    """Zero-based bin of ``value`` among ``bins`` equal ones, the last closed on the right."""
    value = as_column(value)
    position = F.floor(safe_ratio((value - low) * F.lit(float(bins)), high - low))
    return F.least(F.lit(bins - 1), F.coalesce(position, F.lit(0))).cast("int")
