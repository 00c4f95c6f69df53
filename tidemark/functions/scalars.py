"""Column expressions: time, distance, and the features of a single transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the feature definition.
EARTH_RADIUS_KM = 6371.0
NIGHT_HOURS = [22, 23, 0, 1, 2, 3]
DAYS_PER_YEAR = 365.25
MICROS = 1_000_000


def epoch_us(time: Column) -> Column:
    """Microseconds since 1970 of a naive timestamp (session time zone is UTC)."""
    return F.unix_micros(time.cast("timestamp"))


def from_epoch_us(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a naive timestamp; null where the text is no timestamp."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def iso_time(time: Column) -> Column:
    """ISO-8601 text; a six-digit fraction appears only when it is not zero."""
    stamp = time.cast("timestamp")
    whole = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.pmod(F.unix_micros(stamp), F.lit(MICROS))
    return F.when(fraction == 0, whole).otherwise(
        F.concat(whole, F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))
    )


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.when(F.startswith(text, F.lit(prefix)), F.substring(text, len(prefix) + 1, 2**31 - 1)).otherwise(text)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; the argument of asin is clamped against rounding above one."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), 2.0) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_dlon), 2.0
    )
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def mask_tail(text: Column, keep: int = 4) -> Column:
    return F.concat(F.lit("..."), F.right(text, F.lit(keep)))


def ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """Division that yields null (or `default`) for an empty denominator instead of failing."""
    out = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def add_transaction_features(
    df: DataFrame,
    time: str = "trans_date_trans_time",
    amount: str = "amt",
    dob: str = "dob",
    home: tuple[str, str] = ("lat", "long"),
    merchant: tuple[str, str] = ("merch_lat", "merch_long"),
    population: str = "city_pop",
) -> DataFrame:
    """Features that need the row alone; their raw inputs are dropped afterwards."""
    hour = F.hour(F.col(time))
    return df.withColumns(
        {
            "log_amt": F.log1p(F.col(amount)),
            "hour": hour,
            "is_night": hour.isin(NIGHT_HOURS).cast("int"),
            "day_of_week": F.weekday(F.col(time)),
            "age_years": F.datediff(F.to_date(F.col(time)), F.col(dob)) / F.lit(DAYS_PER_YEAR),
            "distance_km": haversine_km(*(F.col(c) for c in (*home, *merchant))),
            "log_city_pop": F.log1p(F.col(population).cast("double")),
        }
    ).drop(dob, *home, *merchant, population)
