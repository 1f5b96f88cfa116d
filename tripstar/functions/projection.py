"""Map coordinates to degrees: the inverse Lambert conformal conic projection as column expressions.

The formulas are those of the projection with two standard parallels; the latitude comes from the conformal
latitude by its series (terms to the eighth power of the eccentricity, well below a millimetre), so there is no
iteration and a vertex costs a handful of native functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import cos, log, pi, radians, sin, sqrt, tan

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripstar.functions.columns import GEOJSON_ENVELOPE, GEOJSON_MULTI, GEOJSON_POLYGON


@dataclass(frozen=True)
class LambertConic:
    """Degrees for angles; lengths in the unit of the coordinates."""

    first_parallel: float
    second_parallel: float
    origin_latitude: float
    origin_longitude: float
    false_easting: float
    false_northing: float
    semi_major: float
    inverse_flattening: float

    @property
    def eccentricity(self) -> float:
        f = 1 / self.inverse_flattening
        return sqrt(2 * f - f * f)

    def _m(self, latitude: float) -> float:
        return cos(latitude) / sqrt(1 - (self.eccentricity * sin(latitude)) ** 2)

    def _t(self, latitude: float) -> float:
        e = self.eccentricity
        return tan(pi / 4 - latitude / 2) / ((1 - e * sin(latitude)) / (1 + e * sin(latitude))) ** (e / 2)

    @property
    def constants(self) -> tuple[float, float, float]:
        """The cone's constant, the radius of t = 1 and the radius of the origin's parallel."""
        one, two, origin = map(radians, (self.first_parallel, self.second_parallel, self.origin_latitude))
        n = log(self._m(one) / self._m(two)) / log(self._t(one) / self._t(two)) if one != two else sin(one)
        scale = self.semi_major * self._m(one) / (n * self._t(one) ** n)
        return n, scale, scale * self._t(origin) ** n

    def series(self) -> list[float]:
        """Factors of sin 2x, sin 4x, sin 6x and sin 8x of the conformal latitude x."""
        e2 = self.eccentricity ** 2
        return [e2 / 2 + 5 * e2 ** 2 / 24 + e2 ** 3 / 12 + 13 * e2 ** 4 / 360, 7 * e2 ** 2 / 48 + 29 * e2 ** 3 / 240 + 811 * e2 ** 4 / 11520,
                7 * e2 ** 3 / 120 + 81 * e2 ** 4 / 1120, 4279 * e2 ** 4 / 161280]

    def degrees(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(longitude, latitude) of a point; null coordinates give nulls, the cone's apex its latitude of 90."""
        n, scale, origin = self.constants
        east, south = x - self.false_easting, F.lit(origin) - (y - self.false_northing)
        sign = 1.0 if n > 0 else -1.0
        t = F.pow(F.sqrt(east * east + south * south) / abs(scale), F.lit(1 / n))
        longitude = F.degrees(F.atan2(sign * east, sign * south) / n) + self.origin_longitude
        conformal = F.lit(pi / 2) - 2 * F.atan(t)
        latitude = conformal
        for k, factor in enumerate(self.series(), 1):
            latitude = latitude + factor * F.sin(2 * k * conformal)
        return longitude, F.degrees(latitude)


US_SURVEY_FOOT = 1200 / 3937  # metres

# NAD83 / New York Long Island in US survey feet (EPSG 2263), the published zone shapes' system.
NEW_YORK_LONG_ISLAND_FT = LambertConic(
    first_parallel=41 + 2 / 60, second_parallel=40 + 40 / 60, origin_latitude=40 + 10 / 60, origin_longitude=-74.0,
    false_easting=300_000 / US_SURVEY_FOOT, false_northing=0.0, semi_major=6_378_137 / US_SURVEY_FOOT, inverse_flattening=298.257222101)


def geojson_to_degrees(geojson: Column | str, projection: LambertConic) -> Column:
    """A GeoJSON Polygon / MultiPolygon text in map coordinates -> the same shape in degrees (longitude first).
    NULL for NULL, unparsable or other geometry types."""
    shape = F.from_json(F.col(geojson) if isinstance(geojson, str) else geojson, GEOJSON_ENVELOPE)

    def ring(points: Column) -> Column:
        return F.transform(points, lambda p: F.array(*projection.degrees(p[0], p[1])))

    def polygon(rings: Column) -> Column:
        return F.transform(rings, ring)

    one = F.to_json(F.struct(F.lit("Polygon").alias("type"), polygon(F.from_json(shape.coordinates, GEOJSON_POLYGON)).alias("coordinates")))
    many = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"),
                              F.transform(F.from_json(shape.coordinates, GEOJSON_MULTI), polygon).alias("coordinates")))
    parsed = F.when(shape.type == "Polygon", F.from_json(shape.coordinates, GEOJSON_POLYGON).isNotNull()).when(
        shape.type == "MultiPolygon", F.from_json(shape.coordinates, GEOJSON_MULTI).isNotNull())
    return F.when(parsed & (shape.type == "Polygon"), one).when(parsed, many)


# The inverse of :meth:`LambertConic.degrees` for single points, for tests and for laying out test shapes.
def map_point(projection: LambertConic, longitude: float, latitude: float) -> tuple[float, float]:
    n, scale, origin = projection.constants
    radius = scale * projection._t(radians(latitude)) ** n
    angle = n * radians(longitude - projection.origin_longitude)
    return projection.false_easting + radius * sin(angle), projection.false_northing + origin - radius * cos(angle)
