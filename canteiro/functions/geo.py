"""Coordinates and simple geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.numbers import to_double
from canteiro.functions.text import _col, strip, text_or_null


def wkt_point(latitude: Column | str, longitude: Column | str) -> Column:
    """``POINT(lon lat)``, longitude first; NULL unless both are numbers."""
    latitude = F.nanvl(_col(latitude), F.lit(None).cast("double"))
    longitude = F.nanvl(_col(longitude), F.lit(None).cast("double"))
    return F.concat(
        F.lit("POINT("), longitude.cast("string"), F.lit(" "), latitude.cast("string"), F.lit(")")
    )


def in_range(value: Column | str, limit: float) -> Column:
    """The coordinate when it lies within plus or minus ``limit``, else NULL."""
    number = _col(value)
    return F.when(number.between(-limit, limit), number)


def latitude_or_null(value: Column | str) -> Column:
    return in_range(value, 90.0)


def longitude_or_null(value: Column | str) -> Column:
    return in_range(value, 180.0)


def in_bounding_box(
    latitude: Column | str,
    longitude: Column | str,
    box: tuple[float, float, float, float] = vocab.BOUNDING_BOX,
) -> Column:
    south, north, west, east = box
    inside = _col(latitude).between(south, north) & _col(longitude).between(west, east)
    return F.coalesce(inside, F.lit(False))


_DEGREES_MINUTES_SECONDS = r"(\d+)(?:\D+(\d+))?(?:\D+(\d+))?"


def coordinate(text: Column | str) -> Column:
    """Decimal degrees, or degrees-minutes-seconds with a hemisphere letter (``22.21.21.S``)."""
    upper = F.upper(text_or_null(_col(text).cast("string"), vocab.NULL_TEXTS_LEGACY, ignore_case=True))

    def part(index: int) -> Column:
        return F.regexp_extract(upper, _DEGREES_MINUTES_SECONDS, index).try_cast("double")

    zero = F.lit(0.0)
    degrees = part(1) + F.coalesce(part(2), zero) / 60 + F.coalesce(part(3), zero) / 3600
    south_or_west = upper.rlike("^[^NSEW]*[SW]")
    sign = F.when(south_or_west, -1.0).otherwise(1.0)
    return F.when(upper.rlike("[NSEW]"), degrees * sign).otherwise(to_double(F.replace(upper, F.lit(","), F.lit("."))))


def point_from_text(text: Column | str) -> tuple[Column, Column]:
    """``lon,lat[,alt]`` to (latitude, longitude); both NULL unless both can be read."""
    parts = F.split(strip(text), ",")
    longitude, latitude = to_double(F.get(parts, F.lit(0))), to_double(F.get(parts, F.lit(1)))
    readable = longitude.isNotNull() & latitude.isNotNull()
    return F.when(readable, latitude), F.when(readable, longitude)


def perimeter_points(polygon: Column, multi_polygon: Column) -> Column:
    """Number of ring points of a polygon, or of all parts of a multi-polygon."""

    def count(rings: Column) -> Column:
        return F.aggregate(rings, F.lit(0).cast("bigint"), lambda total, ring: total + F.size(ring))

    return F.coalesce(count(F.flatten(multi_polygon)), count(polygon))
