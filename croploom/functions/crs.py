"""Longitude/latitude to the European equal-area metre grid (EPSG:3035), closed form.

Ellipsoidal Lambert azimuthal equal-area after Snyder, "Map Projections: A Working Manual", ch. 24.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from croploom.functions.scalars import let

# GRS80 ellipsoid, origin 52 N 10 E, false easting and northing of EPSG:3035.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
LAT_ORIGIN = 52.0
LON_ORIGIN = 10.0
FALSE_EASTING = 4321000.0
FALSE_NORTHING = 3210000.0

_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)


def _q_number(sin_lat: float) -> float:
    return (1 - _E2) * (
        sin_lat / (1 - _E2 * sin_lat**2)
        - math.log((1 - _E * sin_lat) / (1 + _E * sin_lat)) / (2 * _E)
    )


_QP = _q_number(1.0)
_RQ = SEMI_MAJOR * math.sqrt(_QP / 2)
_SIN0 = math.sin(math.radians(LAT_ORIGIN))
_BETA0 = math.asin(_q_number(_SIN0) / _QP)
_M0 = math.cos(math.radians(LAT_ORIGIN)) / math.sqrt(1 - _E2 * _SIN0**2)
_D = SEMI_MAJOR * _M0 / (_RQ * math.cos(_BETA0))


def to_3035(lon: Column, lat: Column) -> Column:
    """``struct(x, y)`` in metres from degrees."""

    def project(beta, dlon):
        scale = F.sqrt(
            2 / (1 + math.sin(_BETA0) * F.sin(beta) + math.cos(_BETA0) * F.cos(beta) * F.cos(dlon))
        )
        return let(
            scale,
            lambda k: F.struct(
                (FALSE_EASTING + _RQ * k * _D * F.cos(beta) * F.sin(dlon)).alias("x"),
                (
                    FALSE_NORTHING
                    + (_RQ * k / _D)
                    * (
                        math.cos(_BETA0) * F.sin(beta)
                        - math.sin(_BETA0) * F.cos(beta) * F.cos(dlon)
                    )
                ).alias("y"),
            ),
        )

    def from_sine(s):
        q = (1 - _E2) * (s / (1 - _E2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
        beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / _QP)))
        return let(
            F.array(beta, F.radians(lon - F.lit(LON_ORIGIN))), lambda v: project(v[0], v[1])
        )

    return let(F.sin(F.radians(lat)), from_sine)


def geom_to_3035(geom: Column) -> Column:
    """Every point of a longitude/latitude geometry reprojected."""
    return F.transform(
        geom,
        lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda p: to_3035(p.x, p.y))),
    )
