"""Air quality index, categories and health expressions over concentration columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from airsift.functions import constants as C


def piecewise_linear(value: Column, bands: Sequence[tuple[float, float, int, int]], above: int) -> Column:
    """Interpolate inside the first band whose upper edge is not exceeded; NULL stays NULL.

    A value in the gap between two bands falls to the upper band, whose line is
    extended down. All arithmetic is double.
    """
    result = F.when(value.isNull(), F.lit(None).cast("int"))
    for low, high, index_low, index_high in bands:
        slope = (index_high - index_low) / (high - low)
        line = F.lit(slope) * (value - F.lit(low)) + F.lit(float(index_low))
        result = result.when(value <= F.lit(high), F.round(line).cast("int"))
    return result.otherwise(F.lit(above))


def label_up_to(value: Column, edges: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first edge not exceeded, ``above`` past the last; NULL stays NULL."""
    result = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in edges:
        result = result.when(value <= F.lit(edge), F.lit(label))
    return result.otherwise(F.lit(above))


def label_from(value: Column, edges: Sequence[tuple[float, str]], below: str) -> Column:
    """Label of the first edge reached, edges given from high to low."""
    first, *rest = edges
    result = F.when(value >= F.lit(first[0]), F.lit(first[1]))
    for edge, label in rest:
        result = result.when(value >= F.lit(edge), F.lit(label))
    return result.otherwise(F.lit(below))


def aqi_pm25(concentration: Column) -> Column:
    return piecewise_linear(concentration, C.PM25_BANDS, C.AQI_CEILING)


def aqi_pm10(concentration: Column) -> Column:
    return piecewise_linear(concentration, C.PM10_BANDS, C.AQI_CEILING)


def aqi(parameter: Column, concentration: Column) -> Column:
    """AQI of the particulate parameters, NULL for every other one."""
    return F.when(parameter == "pm25", aqi_pm25(concentration)).when(
        parameter == "pm10", aqi_pm10(concentration)
    )


def forecast_aqi(concentration: Column) -> Column:
    """AQI of a forecast: a missing, NaN or negative value counts as 0."""
    unusable = concentration.isNull() | F.isnan(concentration) | (concentration < 0)
    return F.when(unusable, F.lit(0)).otherwise(aqi_pm25(concentration))


def _category_edges(bands: Sequence[tuple[float, float, int, int]], side: int) -> list[tuple[float, str]]:
    # Everything past the fifth band is the worst category.
    return [(band[side], label) for band, label in zip(bands[:-1], C.AQI_CATEGORIES)]


def pm25_category(concentration: Column) -> Column:
    return label_up_to(concentration, _category_edges(C.PM25_BANDS, 1), C.AQI_CATEGORIES[-1])


def aqi_category(parameter: Column, concentration: Column) -> Column:
    pm10 = label_up_to(concentration, _category_edges(C.PM10_BANDS, 1), C.AQI_CATEGORIES[-1])
    return F.when(parameter == "pm25", pm25_category(concentration)).when(parameter == "pm10", pm10)


def category_from_aqi(index: Column) -> Column:
    return label_up_to(index, _category_edges(C.PM25_BANDS, 3), C.AQI_CATEGORIES[-1])


def colour(category: Column) -> Column:
    palette = F.create_map(*[F.lit(part) for pair in C.AQI_COLOURS.items() for part in pair])
    return F.coalesce(F.try_element_at(palette, category), F.lit(C.UNKNOWN_COLOUR))


def above_limit(parameter: Column, concentration: Column, limit: float) -> Column:
    """Boolean exceedance of a PM2.5 limit, NULL for other parameters."""
    return F.when(parameter == "pm25", concentration > F.lit(limit))


def who_compliant(parameter: Column, concentration: Column) -> Column:
    return F.when(parameter == "pm25", (concentration <= F.lit(C.WHO_DAILY_LIMIT)).cast("int"))


def cigarettes(concentration: Column) -> Column:
    return F.round(concentration / F.lit(C.PM25_PER_CIGARETTE), 2)


def humidity_corrected(
    parameter: Column, sensor_type: Column, concentration: Column, humidity: Column
) -> Column:
    """Damped PM2.5 of low-cost optical sensors; reference monitors pass through."""
    fraction = F.coalesce(humidity, F.lit(C.FALLBACK_HUMIDITY)) / F.lit(100.0)
    damped = F.round(concentration / (F.lit(1.0) + F.lit(C.HUMIDITY_FACTOR) * fraction), 4)
    return F.when(
        parameter == "pm25", F.when(sensor_type == "low_cost", damped).otherwise(concentration)
    )


def pm_ratio(fine: Column, coarse: Column) -> Column:
    """Unrounded PM2.5/PM10, NULL when either is missing or the divisor is 0."""
    return F.try_divide(fine, coarse)


def particle_source(ratio: Column) -> Column:
    return (
        F.when(ratio.isNull(), F.lit(None).cast("string"))
        .when(ratio > F.lit(C.COMBUSTION_ABOVE), F.lit("combustion-dominated"))
        .when(ratio >= F.lit(C.MIXED_FROM), F.lit("mixed"))
        .otherwise(F.lit("crustal/dust"))
    )


def compliance_risk(percent: Column) -> Column:
    return label_from(percent, C.COMPLIANCE_RISK, C.WORST_RISK)
