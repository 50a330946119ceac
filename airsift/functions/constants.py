"""Published breakpoints, limits, labels and accepted codes.

They must equal the published or documented figures, so they stand here as plain
data in natural order.
"""

# US EPA 2024 breakpoints (concentration low, high, index low, high), ug/m3.
PM25_BANDS = [
    (0.0, 9.0, 0, 50),
    (9.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 125.4, 151, 200),
    (125.5, 225.4, 201, 300),
    (225.5, 325.4, 301, 500),
]
PM10_BANDS = [
    (0.0, 54.0, 0, 50),
    (55.0, 154.0, 51, 100),
    (155.0, 254.0, 101, 150),
    (255.0, 354.0, 151, 200),
    (355.0, 424.0, 201, 300),
    (425.0, 604.0, 301, 500),
]
AQI_CEILING = 500
AQI_CATEGORIES = [
    "Good",
    "Moderate",
    "Unhealthy for Sensitive Groups",
    "Unhealthy",
    "Very Unhealthy",
    "Hazardous",
]
AQI_COLOURS = {
    "Good": "#00e400",
    "Moderate": "#ffff00",
    "Unhealthy for Sensitive Groups": "#ff7e00",
    "Unhealthy": "#ff0000",
    "Very Unhealthy": "#8f3f97",
    "Hazardous": "#7e0023",
}
UNKNOWN_COLOUR = "#cccccc"
AQI_ALERT_ABOVE = 150

# Daily PM2.5 limits (ug/m3) and the cigarette equivalent.
WHO_DAILY_LIMIT = 15.0
NATIONAL_DAILY_LIMIT = 50.0
PM25_PER_CIGARETTE = 22.0

# Humidity heuristic of optical sensors (a candidate feature, not for health reporting).
HUMIDITY_FACTOR = 0.24
FALLBACK_HUMIDITY = 70.0

# Raw-zone rules.
SENTINEL = -999.0
PM25_CEILING = 500.0
KNOWN_STREAM_PARAMETERS = [
    "pm25", "pm10", "no2", "o3", "co", "so2", "temperature", "relativehumidity", "um003", "pm1",
]
KNOWN_STAGED_PARAMETERS = [
    "pm25", "pm10", "o3", "no2", "so2", "co", "bc", "relativehumidity", "temperature", "um003", "pm1",
]

# Weather thresholds.
CALM_WIND_BELOW = 2.0
SHALLOW_LAYER_BELOW = 500.0
WASHOUT_RAIN_ABOVE = 5.0

# Label tables of the marts and reports.
SEASONS = [
    ("NE Monsoon (Nov-Mar)", [11, 12, 1, 2, 3]),
    ("Transition (Apr-May)", [4, 5]),
    ("SW Monsoon (Jun-Sep)", [6, 7, 8, 9]),
]
OTHER_SEASON = "Transition (Oct)"
COMPLIANCE_RISK = [(80.0, "Low"), (50.0, "Moderate"), (20.0, "High")]
WORST_RISK = "Extreme"
WIND_SECTORS = [(90.0, "NE (0-90)"), (180.0, "SE (90-180)"), (270.0, "SW (180-270)")]
LAST_WIND_SECTOR = "NW (270-360)"
UNKNOWN_WIND_SECTOR = "Unknown"
COMBUSTION_ABOVE = 0.7
MIXED_FROM = 0.4

# Forecast job limits.
FORECAST_HORIZON = 7
HOLDOUT_DAYS = 30
MIN_TRAIN_ROWS = 60
MAX_STALENESS_DAYS = 90
WEEKLY_TERM_FROM_ROWS = 14
