"""Column-level helpers. All are built-in Spark expressions (codegen, no Python rows)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL (no ANSI divide-by-zero error)."""
    num, den = _c(num), _c(den)
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def pct1(num, den) -> Column:
    """ROUND(100 * num / den, 1) for non-negative integer counts, rounded half up on the
    exact rational value: (2000*num + den) div (2*den), over 10, in whole numbers."""
    num, den = _c(num).cast("bigint"), _c(den).cast("bigint")
    top, bottom = F.lit(2000) * num + den, F.lit(2) * den
    return F.when(den != 0, ((top - F.pmod(top, bottom)) / bottom) / F.lit(10.0))


def round_int(x) -> Column:
    """Round half away from zero to a whole number, as an INT-typed routine result."""
    return F.round(_c(x), 0).cast("bigint")


def money(x) -> Column:
    """Exact DECIMAL money value presented as DOUBLE (one correctly rounded conversion)."""
    return _c(x).cast("double")


def month_filter(ts, month: int, year: int | None = None) -> Column:
    """MONTH(ts) = month (all years, as written in the reference routines); with ``year``
    it becomes a half-open range on the raw column so Parquet can prune row groups."""
    ts = _c(ts)
    if year is None:
        return F.month(ts) == F.lit(month)
    lo = f"{year:04d}-{month:02d}-01 00:00:00"
    hi = f"{year + (month == 12):04d}-{month % 12 + 1:02d}-01 00:00:00"
    # string -> TIMESTAMP_NTZ literals do not depend on the session time zone
    return (ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz"))


def in_year(d, year: int) -> Column:
    """YEAR(d) = year written as a date range (pushed down to the scan)."""
    d = _c(d)
    return (d >= F.lit(dt.date(year, 1, 1))) & (d < F.lit(dt.date(year + 1, 1, 1)))
