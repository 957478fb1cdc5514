"""Angles in degrees and plain numeric rules, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """The number, or NULL for NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def parse_number(c: Column) -> Column:
    """Text to a finite number; blank or unreadable text gives NULL."""
    return finite(F.trim(c).try_cast("double"))


def wrap(c: Column) -> Column:
    """To [-180, 180)."""
    return F.pmod(c + 180.0, F.lit(360.0)) - 180.0


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def within(value: Column, limit: float) -> Column:
    """Inclusive threshold with room for the last digits of a computed value."""
    return value <= limit + 1e-9


def smoothstep(u: Column) -> Column:
    return u * u * (3.0 - 2.0 * u)


def nice_step(span: Column, lines: int = 8) -> Column:
    """Grid step of 1, 2 or 5 times a power of ten that gives at most ``lines`` lines over ``span``."""
    raw = span / lines
    base = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    part = raw / base
    return base * F.when(part <= 1, 1.0).when(part <= 2, 2.0).when(part <= 5, 5.0).otherwise(10.0)


RADIANS, DEGREES = math.pi / 180.0, 180.0 / math.pi
