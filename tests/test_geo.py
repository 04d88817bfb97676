import math

import pytest
from pyspark.sql import functions as F

from trackmart.functions import geo


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def lit(x, kind="double"):
    return F.lit(x).cast(kind)


def test_ecef_on_the_equator_is_the_semi_major_axis(spark):
    x, y, z = spark.range(1).select(*geo.ecef(lit(0), lit(0), lit(0))).first()
    assert (x, y, z) == (6378137.0, 0.0, 0.0)


def test_ecef_at_the_pole(spark):
    x, y, z = spark.range(1).select(*geo.ecef(lit(90), lit(0), lit(0))).first()
    assert abs(x) < 1e-6 and y == 0
    assert z == pytest.approx(6356752.314, abs=1e-3)


def test_norm_grows_with_height(spark):
    p = geo.ecef(lit(0), lit(90), lit(1000))
    assert value(spark, geo.norm(*p)) == pytest.approx(6379137.0, abs=1e-6)


def test_mach_one_at_sea_level(spark):
    assert value(spark, geo.speed_of_sound(lit(0))) == pytest.approx(340.29, abs=0.01)
    assert value(spark, geo.mach(lit(340.29), lit(0))) == pytest.approx(1.0, abs=1e-4)


@pytest.mark.parametrize("height, kelvin", [(0, 288.15), (10999.9, 288.15 - 0.0065 * 10999.9), (11000, 216.65), (20000, 216.65)])
def test_isa_temperature(spark, height, kelvin):
    assert value(spark, geo.isa_temperature(lit(height))) == pytest.approx(kelvin, abs=1e-9)


@pytest.mark.parametrize(
    "on_ground, rate, phase",
    [
        (True, 9.0, "ground"),
        (False, 2.5, "cruise"),
        (False, 2.51, "climb"),
        (False, -2.5, "cruise"),
        (False, -2.51, "descent"),
        (None, 3.0, "climb"),
        (None, 0.0, "cruise"),
        (False, None, "cruise"),
    ],
)
def test_flight_phase(spark, on_ground, rate, phase):
    assert value(spark, geo.flight_phase(lit(on_ground, "boolean"), lit(rate))) == phase


@pytest.mark.parametrize("epoch, bucket", [(0, 0), (59, 0), (60, 60), (1704067219, 1704067200), (-61, -120)])
def test_minute_bucket(spark, epoch, bucket):
    assert value(spark, geo.minute_bucket(lit(epoch, "long"))) == bucket


def test_altitude_fallback(spark):
    assert value(spark, geo.altitude(lit(1.0), lit(2.0))) == 1.0
    assert value(spark, geo.altitude(lit(None), lit(2.0))) == 2.0
    assert value(spark, geo.altitude(lit(None), lit(None))) == 0.0


def test_feet(spark):
    assert value(spark, geo.feet_to_metres(lit(100))) == 30.5
    assert value(spark, geo.feet_to_metres(lit(-11))) == -3.4


def test_distance(spark):
    a = geo.Ecef(lit(0), lit(0), lit(0))
    b = geo.Ecef(lit(2), lit(3), lit(6))
    assert value(spark, geo.distance(a, b)) == 7.0 == math.dist((0, 0, 0), (2, 3, 6))
