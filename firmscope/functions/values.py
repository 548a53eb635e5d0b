"""Presence, fallbacks, bins and rounding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def filled(new: Column, old: Column) -> Column:
    """old where it is a non-blank string, else new."""
    return F.when(is_blank(old), new).otherwise(old)


def truthy_coalesce(*cols: Column) -> Column:
    """The first number that is neither null nor zero, else null."""
    return F.coalesce(*(F.when(c != 0, c) for c in cols))


def resolve(*pairs: tuple[str, Column]) -> Column:
    """struct(value, source): the first value that is not null, with the name of where it came from."""
    out = F.struct(F.lit(None).cast("double").alias("value"), F.lit("none").alias("source"))
    for name, c in reversed(pairs):
        out = F.when(c.isNotNull(), F.struct(c.cast("double").alias("value"), F.lit(name).alias("source"))).otherwise(out)
    return out


def bin_weight(value: Column, bins: list[float], weights: list[float], na: float = 0.5) -> Column:
    """Weight of the first bin whose limit the value does not exceed; above all limits the last; null gives na."""
    out = F.lit(float(weights[-1]))
    for limit, weight in reversed(list(zip(bins, weights, strict=True))):
        out = F.when(value <= limit, float(weight)).otherwise(out)
    return F.when(value.isNull(), float(na)).otherwise(out)


def bin_number(value: Column, limits: list[float]) -> Column:
    """How many limits the value exceeds, from 0."""
    return sum((F.when(value > x, 1).otherwise(0) for x in limits), F.lit(0))


def clamp01(value: Column, na: float = 0.5) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(na))))


def share(part: Column, whole: Column) -> Column:
    """part / whole as double, null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def mapped(key: Column, table: dict[str, float], default: float | None = None) -> Column:
    out = F.lit(default).cast("double")
    for k, v in table.items():
        out = F.when(key == k, float(v)).otherwise(out)
    return out


def weighted(parts: dict[str, float], invert: tuple[str, ...] = ()) -> Column:
    """Sum of weight times column; inverted columns count as one minus their value."""
    return sum((F.lit(w) * ((1 - F.col(c)) if c in invert else F.col(c)) for c, w in parts.items()), F.lit(0.0))


def band(value: Column, steps: list[tuple[float, str]], last: str) -> Column:
    """Name of the first step whose lower limit the value reaches."""
    out = F.lit(last)
    for limit, name in reversed(steps):
        out = F.when(value >= limit, name).otherwise(out)
    return out
