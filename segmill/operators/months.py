"""Month ends of effective-dated rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_end_array(start: Column, end: Column) -> Column:
    """The month ends in ``[start, end]``, both ends included; empty if there are none."""
    start, end = F.to_date(start), F.to_date(end)
    # The last day of end's month lies in the range only if it is end itself.
    last = F.when(F.last_day(end) == end, end).otherwise(F.add_months(end, -1))
    first_month, last_month = F.trunc(start, "MM"), F.trunc(last, "MM")
    months = F.when(
        first_month <= last_month,
        F.sequence(first_month, last_month, F.expr("interval 1 month")),
    ).otherwise(F.array().cast("array<date>"))
    return F.transform(months, F.last_day)


def month_ends(
    df: DataFrame, start: str, end: str, out: str = "month_end",
    calendar: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per month end in ``[start, end]``; a row without any is dropped.

    ``calendar`` (first and last day, ISO) bounds open-ended ranges by the
    months that occur on the other side of the join (see ``value_range``).

    The planner reckons with as many rows as before.  They are hinted to be joined
    by a shuffle, or it might broadcast many times what it takes for small.
    """
    lo, hi = F.to_date(F.col(start)), F.to_date(F.col(end))
    if calendar:
        first, last = (F.lit(day).cast("date") for day in calendar)
        lo, hi = _clip(lo, F.greatest, first), _clip(hi, F.least, last)
    return df.withColumn(out, F.explode(month_end_array(lo, hi))).hint("merge")


def period_lookup(
    df: DataFrame, periods: DataFrame, on: Sequence[tuple[str, str]], at: str, start: str, end: str,
    take: Mapping[str, str], calendar: tuple[str, str], bin_months: int = 120,
) -> DataFrame:
    """Left lookup of the periods that contain the date ``at``, both ends included.

    The rows of ``month_ends`` and a join on the month, without a row per month:
    periods are dealt to bins of ``bin_months`` months, each row looks into the one
    bin of its date, and the exact test follows.  A period open to the end of time
    has as many bins as ``calendar`` (first and last day of ``at``, see
    ``value_range``), which is a few.  Several periods multiply the row; a NULL
    date or end matches nothing.
    """
    first, last = (F.lit(day).cast("date") for day in calendar)
    lo, hi = F.to_date(F.col(start)), F.to_date(F.col(end))
    bins = F.sequence(_bin(F.greatest(lo, first), bin_months), _bin(F.least(hi, last), bin_months))
    # Out of the calendar, and with a missing end, a period has no bin.
    bins = F.when((lo <= hi) & (lo <= last) & (hi >= first), bins)
    right = periods.select(
        *[F.col(r).alias(f"_key_{i}") for i, (_, r) in enumerate(on)],
        lo.alias("_start"), hi.alias("_end"), F.explode(bins).alias("_bin"),
        *[F.col(c).alias(name) for name, c in take.items()],
    )
    day = F.to_date(F.col(at))
    same = (_bin(day, bin_months) == F.col("_bin")) & day.between(F.col("_start"), F.col("_end"))
    for i, (left, _) in enumerate(on):
        same = same & (F.col(left) == F.col(f"_key_{i}"))
    return df.join(right, same, "left").drop("_bin", "_start", "_end", *[f"_key_{i}" for i in range(len(on))])


def _bin(day: Column, months: int) -> Column:
    return F.floor((F.year(day) * 12 + F.month(day) - 1) / months).cast("int")


def value_range(df: DataFrame, col: str) -> tuple[str, str]:
    """Smallest and largest date of a column, found by one pass; an empty range if it has none."""
    first, last = df.agg(F.min(col).cast("string"), F.max(col).cast("string")).first()
    return (first, last) if first else ("9999-12-31", "0001-01-01")


def _clip(value: Column, pick, bound: Column) -> Column:
    # greatest/least skip NULLs, but a range with a NULL end has no months.
    return F.when(value.isNotNull(), pick(value, bound))
