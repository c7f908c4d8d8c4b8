"""Small numeric and date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def gaussian_similarity(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """exp(-d^2 / 2) of the Euclidean distance of two points."""
    return F.exp(-(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2)) / F.lit(2.0))


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def binarise(x: Column, threshold: float = 0.0) -> Column:
    return F.when(x > threshold, F.lit(1.0)).otherwise(F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))


def normal_loop_time(text: Column) -> Column:
    """``yyyy-MM-dd:HH:mm:ss`` written with a blank after the day; other text is kept."""
    return F.when(F.substring(text, 11, 1) == ":", F.overlay(text, F.lit(" "), 11, 1)).otherwise(text)


def with_seconds(day: Column, clock: Column) -> Column:
    """``yyyy-MM-dd`` and ``HH:mm`` joined into ``yyyy-MM-dd HH:mm:ss``; null if not a time."""
    at = F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit("yyyy-MM-dd HH:mm"))
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def row_count(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)
