"""Fixed values shared with the original pipeline.

These must equal the original's values for results to match; they are listed
here together, in the order the original states them.
"""

# --- fixed values -----------------------------------------------------------
# Topic the producer publishes forecast records to.
TOPIC = "weather_iceland_raw"
# Measurement of stored forecast points and of KPI output.
POINT_MEASUREMENT = "weather_forecast"
KPI_MEASUREMENT = "wind_kpi"
# Measurement read by the cluster dashboard (no writer exists for it).
CLUSTER_MEASUREMENT = "cluster"
# Extreme-gust threshold (units of the wind measures), inclusive.
EXTREME_GUST_THRESHOLD = 25.0
# KPI windows: (size, slide, series tag).
KPI_WINDOWS = (("3 hours", "10 minutes", "3h"), ("6 hours", "10 minutes", "6h"))
# Streaming watermark on event time.
WATERMARK = "1 hour"
# Hourly rows kept per location and poll.
HOURS_PER_POLL = 24
# Configured locations: name -> (latitude, longitude).
LOCATIONS = {
    "reykjavik": (64.13, -21.94),
    "akureyri": (65.68, -18.09),
    "keflavik": (63.99, -22.61),
}
# Hourly variables requested per location, in request order.
HOURLY_VARIABLES = (
    "wind_speed_10m",
    "wind_gusts_10m",
    "temperature_2m",
    "precipitation",
    "pressure_msl",
)
# Dashboard threshold steps: (lower bound, colour); None is the base step.
THRESHOLD_STEPS = ((None, "green"), (80.0, "red"))
# Dashboard ranges.
FORECAST_PANEL_RANGE = "6 hours"
CLUSTER_PANEL_RANGE = "1 hour"
# Case-insensitive pattern that marks an error line in service logs.
LOG_ERROR_PATTERN = "(?i) E! |error|unauthorized|failed to write"
# Log lines inspected by the health check.
LOG_TAIL_LINES = 80
# ---------------------------------------------------------------------------
