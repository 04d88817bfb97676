"""Telemetry formulas as pure ``Column -> Column`` functions.

Everything stays inside whole-stage code generation; no function touches rows in Python.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS-84 ellipsoid, standard atmosphere, phase threshold, foot.
WGS84_A = 6378137.0
WGS84_E2 = 0.0066943799901413165
SEA_LEVEL_K = 288.15
LAPSE_K_PER_M = 0.0065
TROPOPAUSE_M = 11000.0
TROPOPAUSE_K = 216.65
HEAT_RATIO = 1.4
GAS_CONSTANT = 287.05
CLIMB_RATE = 2.5
FOOT_M = 0.3048


class Ecef(NamedTuple):
    x: Column
    y: Column
    z: Column


def prime_vertical_radius(lat_deg: Column) -> Column:
    """Radius of curvature of the ellipsoid across the meridian."""
    s = F.sin(F.radians(lat_deg))
    return WGS84_A / F.sqrt(1.0 - WGS84_E2 * (s * s))


def ecef(lat_deg: Column, lon_deg: Column, height: Column) -> Ecef:
    """Geodetic degrees and metres to earth-centred, earth-fixed metres."""
    n = prime_vertical_radius(lat_deg)
    lat, lon = F.radians(lat_deg), F.radians(lon_deg)
    to_axis = (n + height) * F.cos(lat)
    return Ecef(
        x=to_axis * F.cos(lon),
        y=to_axis * F.sin(lon),
        z=(n * (1.0 - WGS84_E2) + height) * F.sin(lat),
    )


def norm(x: Column, y: Column, z: Column) -> Column:
    """Length of a vector; for an ECEF position, the distance to the earth's centre."""
    return F.sqrt(x * x + y * y + z * z)


def distance(a: Ecef, b: Ecef) -> Column:
    """Straight-line distance between two ECEF positions.

    Written with ``pow`` so that each difference appears once: inside array functions
    Spark interprets expressions and does not share repeated ones.
    """
    return F.sqrt(F.pow(a.x - b.x, 2) + F.pow(a.y - b.y, 2) + F.pow(a.z - b.z, 2))


def isa_temperature(height: Column) -> Column:
    """Air temperature in kelvin: linear below the tropopause, constant from it upwards."""
    return F.when(height < TROPOPAUSE_M, SEA_LEVEL_K - LAPSE_K_PER_M * height).otherwise(TROPOPAUSE_K)


def speed_of_sound(height: Column) -> Column:
    return F.sqrt(HEAT_RATIO * GAS_CONSTANT * isa_temperature(height))


def mach(velocity: Column, height: Column) -> Column:
    return velocity / speed_of_sound(height)


def flight_phase(on_ground: Column, vertical_rate: Column, threshold: float = CLIMB_RATE) -> Column:
    """ground / climb / descent / cruise; a null ``on_ground`` counts as airborne and
    a rate of exactly the threshold as cruise."""
    return (
        F.when(on_ground, "ground")
        .when(vertical_rate > threshold, "climb")
        .when(vertical_rate < -threshold, "descent")
        .otherwise("cruise")
    )


def minute_bucket(epoch: Column) -> Column:
    """First second of the minute that holds ``epoch`` (floor, also before 1970)."""
    return epoch - F.pmod(epoch, F.lit(60))


def altitude(geometric: Column, barometric: Column) -> Column:
    """Geometric altitude, else barometric, else zero."""
    return F.coalesce(geometric, barometric, F.lit(0.0))


def feet_to_metres(feet: Column) -> Column:
    return F.round(feet * FOOT_M, 1)
