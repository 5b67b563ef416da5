"""Local calendar, report windows and exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Los_Angeles"
WEEK_HOURS = 168


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """The day in the local zone of a UTC timestamp: converted before it is cut."""
    return F.from_utc_timestamp(ts.cast("timestamp"), zone).cast("date")


def local_hour(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """The start of the local hour, as local wall time."""
    return F.date_trunc("hour", F.from_utc_timestamp(ts.cast("timestamp"), zone))


def in_range(c: Column, start: str, stop: str) -> Column:
    """start <= c < stop; an impossible date raises an error."""
    return (c >= F.to_timestamp(F.lit(start))) & (c < F.to_timestamp(F.lit(stop)))


def report_window(as_of: Column, zone: str = LOCAL_ZONE) -> dict[str, Column]:
    """Start and end of the current and the earlier report week, in UTC.

    A week is anchored on Monday 10:00 local time and ends with the last completed hour; the earlier one is the same
    stretch 168 elapsed hours before.
    """
    local = F.from_utc_timestamp(as_of, zone)
    monday = F.date_trunc("week", local) + F.expr("INTERVAL 10 HOURS")
    anchor = F.when(local < monday, monday - F.expr("INTERVAL 7 DAYS")).otherwise(monday)
    start = F.to_utc_timestamp(anchor, zone)
    stop = F.date_trunc("hour", as_of)
    back = F.expr(f"INTERVAL {WEEK_HOURS} HOURS")
    return {"window_start": start, "window_end": F.greatest(start, stop), "earlier_start": start - back, "earlier_end": F.greatest(start, stop) - back}


def money(c: Column) -> Column:
    return c.cast("decimal(20,9)")


def weighted(amount: Column, weight: Column) -> Column:
    """amount x weight, exact, rounded to nine places: operands are narrowed first so the product keeps its scale."""
    return F.round(amount.cast("decimal(20,9)") * weight.cast("decimal(17,9)"), 9).cast("decimal(38,9)")


def net_price(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """Price less discount, exact: sums do not depend on their order."""
    return F.col(price).cast("decimal(12,2)") * (F.lit(1).cast("decimal(4,2)") - F.col(discount).cast("decimal(4,2)"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return F.when(b != 0, a / b)
