"""Scalar expressions and order-independent aggregate formulas.

Grades are summed as integer millionths, all the places they have, and divided once at the end, so a
result does not depend on the order in which partial sums meet.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BIG = "decimal(38,0)"
MS_PER_HOUR = 3600000.0
FIXED_POINT = 1e10
#: Parts of a grade point that are summed.
UNIT = 1_000_000


def micros(grade: str | Column) -> Column:
    """Grade as integer millionths; a seventh place is rounded half away from zero.

    A decimal, so that a sum of any number of rows holds: at 100 points, 10^20 rows.
    """
    grade = F.col(grade) if isinstance(grade, str) else grade
    return (grade.cast("decimal(18,6)") * UNIT).cast("decimal(18,0)")


def whole_division(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, denominator)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null when the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def avg_of_micros(total: Column, n: Column) -> Column:
    """Mean grade from summed millionths."""
    return ratio(total, n) / UNIT


def rounded_avg(total: Column, n: Column) -> Column:
    """Mean grade at two places, half away from zero, in integer arithmetic."""
    hundredth = UNIT // 100
    magnitude = whole_division(F.abs(total) * 2 + n * hundredth, F.nullif(n, F.lit(0)) * (2 * hundredth))
    return F.signum(total) * magnitude.cast("double") / 100


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Share of two counts at ``digits`` places, half up, in integer arithmetic."""
    unit = 10**digits
    denominator = F.nullif(denominator, F.lit(0))
    return whole_division(numerator * (2 * unit) + denominator, denominator * 2).cast("double") / unit


def rounded(value: Column, digits: int) -> Column:
    """Double to ``digits`` places through a decimal, half away from zero."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def stable_sum(value: Column) -> Column:
    """Sum of doubles held at 1e-10, exact and independent of input order; up to 1e10 each."""
    return F.sum(F.floor(value * FIXED_POINT + 0.5).cast("decimal(20,0)"))


def stable_mean(value: Column) -> Column:
    return ratio(stable_sum(value), F.count(value)) / FIXED_POINT


def _determinant(a: Column, b: Column, c: Column, d: Column) -> Column:
    """a * b - c * d as a double, from exact integers; where those have no room, from doubles."""
    exact = [x.cast(BIG) for x in (a, b, c, d)]
    near = [x.cast("double") for x in (a, b, c, d)]
    whole = F.try_subtract(F.try_multiply(*exact[:2]), F.try_multiply(*exact[2:])).cast("double")
    return F.coalesce(whole, near[0] * near[1] - near[2] * near[3])


def variance_numerator(n: Column, total: Column, squares: Column) -> Column:
    """n * sum(y^2) - sum(y)^2 over integer millionths, as a double that is never below 0.

    Exact up to 38 digits: at 100 points, some 10^11 rows in a group. Null where the squares have
    no room at all.
    """
    return F.when(squares.isNotNull(), F.greatest(_determinant(n, squares, total, total), F.lit(0.0)))


def stddev_pop_of_micros(n: Column, total: Column, squares: Column) -> Column:
    """Population standard deviation in grade points; 0 for one row, null for none."""
    n = F.nullif(n, F.lit(0))
    return F.sqrt(variance_numerator(n, total, squares)) / n / UNIT


def stddev_samp_of_micros(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation in grade points; null below two rows."""
    pairs = n.cast("double") * (n - 1).cast("double")
    spread = variance_numerator(n, total, squares) / F.nullif(pairs, F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread) / UNIT)


def slope_of_micros(n: Column, sx: Column, sy: Column, sxx: Column, sxy: Column) -> Column:
    """Least-squares slope in grade points per second, x in milliseconds, y in millionths.

    Exact up to 38 digits: at 100 points, some ten million rows of a group over half a year; beyond
    that doubles take over. Null when x is constant.
    """
    slope = _determinant(n, sxy, sx, sy) / F.nullif(_determinant(n, sxx, sx, sx), F.lit(0.0))
    return slope / (UNIT // 1000)


def finite_or_zero(value: Column) -> Column:
    """Null, NaN and infinities become 0."""
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(value.isNull() | F.isnan(value) | infinite, F.lit(0.0)).otherwise(value)


def week_start(ts: Column) -> Column:
    """Monday of the week as a date."""
    return F.to_date(F.date_trunc("week", ts))


def day_of_week(ts: Column) -> Column:
    """Sunday = 0 .. Saturday = 6."""
    return F.dayofweek(ts) - 1


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 3.6e9


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts) / 1e6


def within_last(ts: Column, latest: Column, hours: int) -> Column:
    """Inclusive recency test against the latest known moment."""
    return ts >= latest - F.make_dt_interval(F.lit(0), F.lit(hours))


def grade_bucket(value: Column) -> Column:
    """Ten equal buckets over 0..10: below is 0, 10 and above is 11, null stays null."""
    return F.width_bucket(value, F.lit(0.0), F.lit(10.0), F.lit(10))


def grade_bucket_label(bucket: Column) -> Column:
    span = F.concat((bucket - 1).cast("string"), F.lit("-"), bucket.cast("string"))
    return F.when(bucket == 11, F.lit("10")).otherwise(span)


def course_name_or_default(name: Column, course_id: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit("Course "), course_id.cast("string")))


def first_truthy(*values: Column) -> Column:
    """First value that is neither null nor 0, else 0."""
    return F.coalesce(*[F.nullif(v, F.lit(0)) for v in values], F.lit(0))


def activity_trend(last_day: Column, last_week: Column) -> Column:
    """Percent change of the last 24 hours against the daily mean of 7 days."""
    daily = F.nullif(last_week, F.lit(0)) / F.lit(7.0)
    return (last_day - daily) / daily * 100


def progress_rate(submissions: Column, students: Column, per_student: int = 20) -> Column:
    """Submissions per student as a percentage of the expected number, uncapped."""
    return submissions.cast("double") / first_truthy_or_one(students) / per_student * 100


def first_truthy_or_one(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit(0)), F.lit(1))


def capped(rate: Column, limit: float = 100.0) -> Column:
    return F.least(rate, F.lit(limit))
