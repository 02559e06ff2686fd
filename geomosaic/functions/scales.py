"""Pixel functions as Column to Column, usable on a value or over a block array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Valid pixel ranges (a 32-bit unsigned range, and the drainage family's).
VALID_LOW = 0.0
VALID_HIGH = 4294967295.0
HAND_VALID_HIGH = 1.0
# Amplitude digital numbers to power and decibel.
AMPLITUDE_POWER_DIVISOR = 199526231.0
AMPLITUDE_DB_OFFSET = 83.0


def valid(value: Column, low: float = VALID_LOW, high: float = VALID_HIGH) -> Column:
    """The value where it is a valid pixel, else null."""
    return F.when(value.between(F.lit(low), F.lit(high)), value)


def unscale_coherence(value: Column) -> Column:
    return value / F.lit(100.0)


def amplitude_power(dn: Column) -> Column:
    return dn * dn / F.lit(AMPLITUDE_POWER_DIVISOR)


def amplitude_db(dn: Column) -> Column:
    return F.when(dn > 0, F.lit(20.0) * F.log10(dn) - F.lit(AMPLITUDE_DB_OFFSET))


def power_view(power: Column) -> Column:
    return power


def power_amplitude(power: Column) -> Column:
    return F.when(power >= 0, F.sqrt(power))


def power_db(power: Column) -> Column:
    return F.when(power > 0, F.lit(10.0) * F.log10(power))


def water_blue(value: Column) -> Column:
    """Only water is shown."""
    return F.when(value == 1, F.lit(1))


def water_white_blue(value: Column) -> Column:
    """Water and land are shown, anything else is not."""
    return F.when(value.isin(0, 1), value)


def water_from_legacy(value: Column) -> Column:
    """Old maps mark land by NoData; inside the footprint that is 0."""
    return F.coalesce(value, F.lit(0))


def stretch(value: Column, low: Column, high: Column, out_max: float = 255.0) -> Column:
    """Linear stretch of ``low..high`` to ``0..out_max``, clipped; null stays null."""
    part = F.try_divide(value - low, high - low)
    scaled = F.lit(out_max) * F.least(F.lit(1.0), F.greatest(F.lit(0.0), part))
    return F.when(value.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(scaled, F.lit(0.0)))


PIXEL_FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    "unscaled_coherence": unscale_coherence,
    "amplitude_power": amplitude_power,
    "amplitude_db": amplitude_db,
    "rtc_power": power_view,
    "rtc_amplitude": power_amplitude,
    "rtc_db": power_db,
    "water_blue": water_blue,
    "water_white_blue": water_white_blue,
    "water_from_legacy": water_from_legacy,
}


def over_block(values: Column, function: Callable[[Column], Column]) -> Column:
    """Apply a pixel function to every cell of a block array."""
    return F.transform(values, function)
