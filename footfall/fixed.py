"""Fixed values the results depend on, kept together.

These equal the original sensor-traffic job's behaviour and defaults; every
module takes them from here (most are also function arguments).
"""

# Noise filter: dwell time must be > MIN and <= MAX seconds.
MIN_DWELL_SECONDS = 0.0
MAX_DWELL_SECONDS = 3600.0

# Peak hours: hour of day in [PEAK_START_HOUR, PEAK_END_HOUR), UTC by default.
PEAK_START_HOUR = 9
PEAK_END_HOUR = 18

# Weekend: dayofweek values (1 = Sunday ... 7 = Saturday).
WEEKEND_DAYS = (1, 7)

# Sensor domains.
AGE_RANGES = ["under_18", "18-25", "26-35", "36-50", "over_50"]
GENDERS = ["male", "female", "unknown"]

# Streaming defaults: tumbling window, watermark delay, processing-time trigger.
WINDOW_DURATION = "5 minutes"
WATERMARK_DELAY = "10 minutes"
TRIGGER_INTERVAL = "5 seconds"
TRIGGER_MS = 5_000

# Target shares of the demographics, as the events' producer draws them.
TARGET_SHARES = {
    "age_range": {"under_18": 0.10, "18-25": 0.20, "26-35": 0.25, "36-50": 0.30, "over_50": 0.15},
    "gender": {"male": 0.48, "female": 0.48, "unknown": 0.04},
}

# 0.999 quantile of the chi-square distribution by degrees of freedom.
CHI_SQUARE_999 = {1: 10.828, 2: 13.816, 3: 16.266, 4: 18.467, 5: 20.515, 6: 22.458, 7: 24.322, 8: 26.124, 9: 27.877}
