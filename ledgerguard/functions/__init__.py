"""Column-level helpers: pure ``pyspark.sql.functions`` expressions."""

from ledgerguard.functions.timecols import epoch_us, from_epoch_us, US_PER_HOUR, US_PER_DAY, US_PER_SECOND
from ledgerguard.functions.geo import haversine_km
from ledgerguard.functions.money import to_minor

__all__ = ["epoch_us", "from_epoch_us", "haversine_km", "to_minor",
           "US_PER_HOUR", "US_PER_DAY", "US_PER_SECOND"]
