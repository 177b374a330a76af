"""Fixed values of the hourly traffic model (GEN-5..10).

These values must equal the model's for expected visitor counts to agree;
they are stated here as plain data, in natural order.
"""

# --- fixed values -----------------------------------------------------------

# GEN-6: base visitors by hour of day, hours 0..23.
HOURLY_BASE = (
    50, 30, 20, 15, 15, 20, 50, 150, 400, 700, 900, 1100,
    1200, 1100, 950, 850, 900, 1100, 1200, 1000, 700, 400, 150, 80,
)

# GEN-7: weekday multiplier, Monday (0) .. Sunday (6).
WEEKDAY_FACTOR = (0.7, 0.75, 0.8, 0.85, 1.1, 1.5, 1.3)

# GEN-8: month multiplier, January (1) .. December (12).
MONTH_FACTOR = (0.6, 0.65, 0.8, 0.85, 0.9, 0.85, 0.7, 0.65, 0.85, 0.9, 1.1, 1.4)

# GEN-9: weather adjustments (exact condition text; temperature strictly above).
HEAVY_RAIN = "heavy rain"
HEAVY_RAIN_CUT = 0.3
HEAT_LIMIT_C = 35
HEAT_CUT = 0.2

# GEN-10: holiday adjustments; (month, day) of the closed days.
CLOSED_DAYS = ((12, 25), (1, 1))
CLOSED_DAY_FACTOR = 0.2
HOLIDAY_FACTOR = 1.4

# GEN-12: noise band half-width.
NOISE = 0.15

# GEN-5: record defaults when no weather or holiday is known.
DEFAULT_WEATHER = "sunny"
DEFAULT_TEMPERATURE_C = 22.0
DEFAULT_IS_HOLIDAY = False

# GEN-1: records per centre-day.
HOURS_PER_DAY = 24
