"""Column functions: time slots, parsing, calendar, solar geometry, display scaling. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' MINUTE")


def floor_slot(ts: Column | str, step: int = 30) -> Column:
    """The start of the step-minute slot that holds ts (wall clock; the day is divided into whole steps)."""
    ts = _col(ts)
    into = (F.hour(ts) * 60 + F.minute(ts)) % step
    return F.date_trunc("minute", ts).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), into)


def parse_utc(text: Column | str) -> Column:
    """ISO text to a timestamp in UTC; what does not parse is NULL."""
    return F.try_to_timestamp(_col(text))


def combine(date: Column | str, time: Column | str) -> Column:
    """A timestamp from a date and a time-of-day text; bad ones are NULL."""
    return F.try_to_timestamp(F.concat_ws(" ", _col(date), _col(time)))


def numeric(c: Column | str) -> Column:
    """A number stored as FLOAT; text that is no number, and NaN, become NULL."""
    n = _col(c).try_cast("float")
    return F.when(~F.isnan(n), n)


def slug(name: Column | str) -> Column:
    """Lower case with runs of other characters than letters and digits as one underscore, none at the ends."""
    return F.btrim(F.lower(F.regexp_replace(_col(name), "[^0-9A-Za-z]+", "_")), F.lit("_"))


def clip(c: Column, lo: float, hi: float) -> Column:
    """NULL stays NULL, unlike with greatest and least alone."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return F.timestamp_diff("SECOND", _col(earlier), _col(later)) / 3600.0


def calendar(ts: Column | str) -> dict[str, Column]:
    """hour, half_hour, dow (Monday 0), month, doy, is_weekend and the cyclic encodings of half-hour and day of year."""
    ts = _col(ts)
    half, doy = F.hour(ts) * 2 + F.floor(F.minute(ts) / 30).cast("int"), F.dayofyear(ts)
    turn = lambda x, period: 2 * F.pi() * x / period
    return {
        "hour": F.hour(ts).cast("short"),
        "half_hour": half.cast("short"),
        "dow": F.weekday(ts).cast("short"),
        "month": F.month(ts).cast("short"),
        "doy": doy.cast("short"),
        "is_weekend": (F.weekday(ts) >= 5).cast("byte"),
        "tod_sin": F.sin(turn(half, 48.0)),
        "tod_cos": F.cos(turn(half, 48.0)),
        "doy_sin": F.sin(turn(doy, 365.25)),
        "doy_cos": F.cos(turn(doy, 365.25)),
    }


# Fourier coefficients of the solar position approximation published by NOAA (cos and sin of 0, 1, 2, 3 turns).
EQUATION_OF_TIME = (229.18, [(0.000075, 0.0), (0.001868, -0.032077), (-0.014615, -0.040849)])
DECLINATION = (1.0, [(0.006918, 0.0), (-0.399912, 0.070257), (-0.006758, 0.000907), (-0.002697, 0.00148)])


def _series(angle: Column, spec) -> Column:
    scale, terms = spec
    parts = [F.lit(terms[0][0])] + [F.lit(a) * F.cos(k * angle) + F.lit(b) * F.sin(k * angle) for k, (a, b) in enumerate(terms) if k]
    return F.lit(scale) * reduce(Column.__add__, parts)


def solar_cosine(ts: Column | str, lat: Column, lon: Column) -> Column:
    """Cosine of the sun's zenith angle at ts (UTC; hour and minute count), in [-1, 1]."""
    ts = _col(ts)
    hour = F.hour(ts) + F.minute(ts) / 60.0
    angle = 2 * F.pi() / 365.0 * (F.dayofyear(ts) - 1 + (hour - 12) / 24.0)
    solar_minutes = hour * 60.0 + _series(angle, EQUATION_OF_TIME) + 4.0 * lon
    turn, tilt = F.radians(solar_minutes / 4.0 - 180.0), _series(angle, DECLINATION)
    phi = F.radians(lat)
    return clip(F.sin(phi) * F.sin(tilt) + F.cos(phi) * F.cos(tilt) * F.cos(turn), -1.0, 1.0)


def solar_elevation(cosine: Column) -> Column:
    return F.degrees(F.asin(cosine))


def clearsky_ghi(elevation: Column) -> Column:
    """Haurwitz clear-sky irradiance; 0 at night and for an unknown elevation."""
    cosz = clip(F.sin(F.radians(elevation)), 0.0, 1.0)
    return F.coalesce(F.when(cosz > 0, 1098.0 * cosz * F.exp(F.lit(-0.059) / cosz)), F.lit(0.0))


def display_int(c: Column, scale: float = 1.0, offset: float = 0.0) -> Column:
    """Scaled and rounded half to even, as an integer."""
    return F.bround(c * scale + offset).cast("long")
