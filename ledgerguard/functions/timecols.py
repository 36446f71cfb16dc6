"""Time helpers that do not depend on the session time zone.

Casting a TIMESTAMP_NTZ to TIMESTAMP goes through the session zone, so an
epoch built that way shifts across daylight-saving boundaries.  These helpers
read the wall-clock fields of the naive timestamp instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_SECOND = 1_000_000
US_PER_HOUR = 3_600 * US_PER_SECOND
US_PER_DAY = 86_400 * US_PER_SECOND


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_us(ts) -> Column:
    """Microseconds since 1970-01-01 of a naive timestamp, as BIGINT."""
    t = _c(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    return (days * F.lit(US_PER_DAY)
            + F.hour(t).cast("long") * F.lit(US_PER_HOUR)
            + F.minute(t).cast("long") * F.lit(60 * US_PER_SECOND)
            + (F.date_part(F.lit("SECOND"), t) * F.lit(US_PER_SECOND)).cast("long"))


def from_epoch_us(us) -> Column:
    """Naive timestamp (TIMESTAMP_NTZ) from microseconds since 1970-01-01."""
    return F.timestamp_add("MICROSECOND", _c(us), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
