"""Weather expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airsift.functions import constants as C


def circular_mean(angle: Column) -> Column:
    """Vector mean of an angle in degrees, in [0, 360)."""
    sine = F.avg(F.sin(F.radians(angle)))
    cosine = F.avg(F.cos(F.radians(angle)))
    return (F.degrees(F.atan2(sine, cosine)) + F.lit(360.0)) % F.lit(360.0)


def calm_hours(wind_speed: Column, below: float = C.CALM_WIND_BELOW) -> Column:
    return F.count_if(wind_speed < F.lit(below))


def inversion_risk(lowest_layer: Column, mean_wind: Column) -> Column:
    shallow = lowest_layer < F.lit(C.SHALLOW_LAYER_BELOW)
    return (shallow & (mean_wind < F.lit(C.CALM_WIND_BELOW))).cast("int")


def wet_scavenging(rain: Column) -> Column:
    return (rain > F.lit(C.WASHOUT_RAIN_ABOVE)).cast("int")


def wind_sector(direction: Column) -> Column:
    result = F.when(direction.isNull(), F.lit(C.UNKNOWN_WIND_SECTOR))
    for edge, label in C.WIND_SECTORS:
        result = result.when(direction < F.lit(edge), F.lit(label))
    return result.otherwise(F.lit(C.LAST_WIND_SECTOR))
