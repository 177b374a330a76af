"""Hourly traffic expectation model (GEN-1..13).

The model gives, for a centre-hour, an expected visitor count from the hour,
weekday and month of the timestamp, the weather and the holiday flag. Here it
is a set of column expressions (factor lookups are inline map literals, so
no join and no broadcast are involved) plus a calendar spine and a
missing-hour check, all applicable to any number of centres and days.

Arithmetic keeps the model's order and form - ``base - base * 0.3`` rather
than ``base * 0.7`` - because the result is truncated toward zero and the two
forms can differ in the last bit.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import factors as fx
from strata.functions.calendar import day_label, hour_bucket


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(values, key: Column, first_key: int) -> Column:
    pairs = []
    for i, v in enumerate(values):
        pairs += [F.lit(first_key + i), F.lit(v)]
    return F.element_at(F.create_map(*pairs), key)


def hourly_base(ts: Column | str) -> Column:
    """GEN-6: base visitors for the hour of ``ts`` (int)."""
    return _lookup(fx.HOURLY_BASE, F.hour(_col(ts)), 0)


def weekday_factor(ts: Column | str) -> Column:
    """GEN-7: weekday multiplier, Monday = 0 (``F.weekday`` numbering)."""
    return _lookup(fx.WEEKDAY_FACTOR, F.weekday(_col(ts)), 0)


def month_factor(ts: Column | str) -> Column:
    """GEN-8: month multiplier."""
    return _lookup(fx.MONTH_FACTOR, F.month(_col(ts)), 1)


def weather_adjusted(base: Column, condition: Column | str, temperature: Column | str) -> Column:
    """GEN-9: exactly 'heavy rain' cuts 30 %; otherwise above 35 degrees cuts
    20 %; never both."""
    cond, temp = _col(condition), _col(temperature)
    return (F.when(cond == F.lit(fx.HEAVY_RAIN), base - base * F.lit(fx.HEAVY_RAIN_CUT))
            .when(temp > F.lit(fx.HEAT_LIMIT_C), base - base * F.lit(fx.HEAT_CUT))
            .otherwise(base))


def holiday_adjusted(base: Column, is_holiday: Column | str, ts: Column | str) -> Column:
    """GEN-10: 25 December and 1 January scale by 0.2 whatever the flag;
    otherwise a holiday scales by 1.4."""
    t = _col(ts)
    closed = F.lit(False)
    for m, d in fx.CLOSED_DAYS:
        closed = closed | ((F.month(t) == m) & (F.dayofmonth(t) == d))
    return (F.when(closed, base * F.lit(fx.CLOSED_DAY_FACTOR))
            .when(_col(is_holiday), base * F.lit(fx.HOLIDAY_FACTOR))
            .otherwise(base))


def expected_raw(ts: Column | str, condition: Column | str, temperature: Column | str,
                 is_holiday: Column | str) -> Column:
    """GEN-6..10 before truncation (double)."""
    base = hourly_base(ts).cast("double")
    base = base * weekday_factor(ts)
    base = base * month_factor(ts)
    base = weather_adjusted(base, condition, temperature)
    return holiday_adjusted(base, is_holiday, ts)


def expected_visitors(ts: Column | str, condition: Column | str, temperature: Column | str,
                      is_holiday: Column | str) -> Column:
    """GEN-11: the expected count, truncated toward zero (int), as one column
    expression. Over many rows prefer ``add_expected``, which evaluates the
    same arithmetic stepwise."""
    return expected_raw(ts, condition, temperature, is_holiday).cast("int")


def noise_band(ts: Column | str, condition: Column | str, temperature: Column | str,
               is_holiday: Column | str) -> tuple[Column, Column]:
    """GEN-12: (lower, upper) integer bounds of a count drawn uniformly within
    +-15 % of the untruncated expectation and then truncated."""
    base = expected_raw(ts, condition, temperature, is_holiday)
    spread = base * F.lit(fx.NOISE)
    return (base - spread).cast("int"), (base + spread).cast("int")


def add_expected(df: DataFrame, ts: str = "event_timestamp", condition: str = "weather_condition",
                 temperature: str = "temperature_c", is_holiday: str = "is_holiday",
                 band: bool = False) -> DataFrame:
    """GEN-11 (and GEN-12 when ``band``) as columns ``expected_visitors``
    [, ``lower_bound``, ``upper_bound``].

    The model is evaluated one step per projection. In a single nested
    expression the running value appears in several CASE branches and the
    whole chain below it is re-evaluated for each occurrence (about 3x the
    work); a column referenced several times is kept as its own projection."""
    steps = ("__b0", "__b1", "__b2")
    out = df.withColumn(steps[0], hourly_base(ts).cast("double") * weekday_factor(ts)
                        * month_factor(ts))
    out = out.withColumn(steps[1], weather_adjusted(F.col(steps[0]), condition, temperature))
    out = out.withColumn(steps[2], holiday_adjusted(F.col(steps[1]), is_holiday, ts))
    b = F.col(steps[2])
    cols = {"expected_visitors": b.cast("int")}
    if band:
        spread = b * F.lit(fx.NOISE)
        cols.update({"lower_bound": (b - spread).cast("int"), "upper_bound": (b + spread).cast("int")})
    return out.withColumns(cols).drop(*steps)


def with_expectation(traffic: DataFrame, ts: str = "event_timestamp",
                     condition: str = "weather_condition", temperature: str = "temperature_c",
                     is_holiday: str = "is_holiday", observed: str = "visitors_count") -> DataFrame:
    """GEN-11/12 on curated traffic: expected count, band, in-band flag."""
    out = add_expected(traffic, ts, condition, temperature, is_holiday, band=True)
    return out.withColumn("in_band", F.col(observed).between(F.col("lower_bound"),
                                                             F.col("upper_bound")))


def check_range(start: date | str, end: date | str) -> None:
    """FLT-3: a range whose start is after its end is an error; equal is fine."""
    s = date.fromisoformat(start) if isinstance(start, str) else start
    e = date.fromisoformat(end) if isinstance(end, str) else end
    if s > e:
        raise ValueError(_REVERSED)


_REVERSED = "the range ends before it starts"


def reversed_ranges(ranges: DataFrame, from_col: str = "from_date", to_col: str = "to_date") -> DataFrame:
    """FLT-3 as a report: the ranges that a spine would refuse, with the reason
    as ``error``; check a batch of requests before it is expanded."""
    wrong = F.col(from_col).cast("date") > F.col(to_col).cast("date")
    return ranges.where(wrong).withColumn("error", F.lit(_REVERSED))


def day_spine(ranges: DataFrame, center_col: str = "center_id", from_col: str = "from_date",
              to_col: str = "to_date") -> DataFrame:
    """One row per (centre, day) of each (centre, from, to) range, both ends
    inclusive. A reversed range fails the job (FLT-3)."""
    start, end = F.col(from_col).cast("date"), F.col(to_col).cast("date")
    days = F.when(start > end, F.raise_error(F.lit(_REVERSED))).otherwise(F.sequence(start, end))
    return ranges.select(F.col(center_col).alias("center_id"), F.explode(days).alias("event_date"))


def _hours(days: DataFrame) -> DataFrame:
    """Expand (centre, day) rows to hourly rows on TIMESTAMP_NTZ (D10), with
    the calendar columns of GEN-1/GEN-4. The weekday label depends on the day
    only, so it is computed before the 24x expansion."""
    hours = F.sequence(F.lit(0), F.lit(fx.HOURS_PER_DAY - 1))
    labelled = days.withColumn("day_of_week", day_label("event_date"))
    rows = labelled.select("*", F.explode(hours).alias("hour"))
    ts = F.timestamp_add("HOUR", F.col("hour"), F.col("event_date").cast("timestamp_ntz"))
    rest = [c for c in labelled.columns if c not in ("center_id", "event_date", "day_of_week")]
    return rows.select("center_id", ts.alias("event_timestamp"), "event_date", "hour",
                       "day_of_week", *rest)


def hourly_spine(ranges: DataFrame, center_col: str = "center_id", from_col: str = "from_date",
                 to_col: str = "to_date") -> DataFrame:
    """GEN-1 / GEN-2: 24 hourly rows per day for each (centre, from, to)
    range, both ends inclusive, on TIMESTAMP_NTZ so a DST change never drops
    or doubles an hour (D10). A reversed range fails the job (FLT-3).

    Output: center_id, event_timestamp (NTZ), event_date, hour, day_of_week.
    Generated where the range row lives: no shuffle."""
    spine = _hours(day_spine(ranges, center_col, from_col, to_col))
    return spine.select("center_id", "event_timestamp", "event_date", "hour", "day_of_week")


def _on_the_hour(observed: DataFrame, keys: tuple[str, str], columns: tuple[str, ...] = ()) -> DataFrame:
    """(center_id, event_date, __hour, columns...) of the records exactly on the
    hour; others can't match a spine hour, as in an exact timestamp join."""
    center, ts = keys
    local = F.col(ts).cast("timestamp_ntz")
    return observed.where(local == hour_bucket(local)).select(
        F.col(center).alias("center_id"), F.to_date(local).alias("event_date"), F.hour(local).alias("__hour"), *columns)


def missing_hours(ranges: DataFrame, observed: DataFrame,
                  keys: tuple[str, str] = ("center_id", "event_timestamp"),
                  center_col: str = "center_id", from_col: str = "from_date",
                  to_col: str = "to_date") -> DataFrame:
    """GEN-13: the hours of each centre's spine (GEN-1 over ``ranges``) with
    no observed record at exactly that timestamp.

    Joined at day grain, expanded afterwards: the observed hours of a
    centre-day are the bits of one integer (repeated records change nothing, and
    partial aggregation leaves one integer of a hot centre-day for each task),
    joined to the day spine (unique keys on both sides, 24x fewer rows than the
    hourly spine); a day's rows are the bits that are not set, and the hourly
    spine is never shuffled."""
    days = day_spine(ranges, center_col, from_col, to_col)
    bit = F.expr("shiftleft(1, __hour)")
    seen = _on_the_hour(observed, keys).groupBy("center_id", "event_date").agg(F.bit_or(bit).alias("__seen"))
    joined = days.join(seen, ["center_id", "event_date"], "left")
    # a full day has no rows at all
    open_days = joined.where(F.coalesce(F.col("__seen"), F.lit(0)) != (1 << fx.HOURS_PER_DAY) - 1)
    hours = _hours(open_days)
    return hours.where(F.expr("(shiftright(coalesce(__seen, 0), hour) & 1) = 0")).select(
        "center_id", "event_timestamp", "event_date", "hour", "day_of_week")


def attach_observed(ranges: DataFrame, observed: DataFrame, columns: tuple[str, ...],
                    keys: tuple[str, str] = ("center_id", "event_timestamp"),
                    center_col: str = "center_id", from_col: str = "from_date",
                    to_col: str = "to_date") -> DataFrame:
    """GEN-1 spine over ``ranges`` with the observed ``columns`` of each hour
    when a record exists at exactly that timestamp (NULL otherwise).

    Same shape as ``missing_hours``: a centre-day is one row, the bits of the
    hours that it has and the observed values in the order of those hours (at
    most 24 of them; ``observed`` must be unique per timestamp, as a curated table
    is). After the day-grain join an hour's place among the values is the number
    of lower bits that are set."""
    days = day_spine(ranges, center_col, from_col, to_col)
    entry = F.struct("__hour", *[F.col(c) for c in columns])
    seen = _on_the_hour(observed, keys, columns).groupBy("center_id", "event_date").agg(
        F.bit_or(F.expr("shiftleft(1, __hour)")).alias("__seen"), F.array_sort(F.collect_list(entry)).alias("__values"))
    spine = _hours(days.join(seen, ["center_id", "event_date"], "left"))
    there = F.expr("(shiftright(__seen, hour) & 1) = 1")
    place = F.expr("bit_count(__seen & (shiftleft(1, hour) - 1))")
    value = F.when(there, F.get(F.col("__values"), place))
    found = spine.withColumn("__value", value)
    return found.select("center_id", "event_timestamp", "event_date", "hour", "day_of_week",
                        *[F.col("__value")[c].alias(c) for c in columns])


def with_defaults(records: DataFrame, condition: str = "weather_condition",
                  temperature: str = "temperature_c", is_holiday: str = "is_holiday") -> DataFrame:
    """GEN-5: fill unknown weather / temperature / holiday with the defaults."""
    return records.withColumns({
        condition: F.coalesce(F.col(condition), F.lit(fx.DEFAULT_WEATHER)),
        temperature: F.coalesce(F.col(temperature), F.lit(fx.DEFAULT_TEMPERATURE_C)),
        is_holiday: F.coalesce(F.col(is_holiday), F.lit(fx.DEFAULT_IS_HOLIDAY)),
    })


__all__ = [
    "add_expected", "attach_observed", "check_range", "day_label", "day_spine", "expected_raw",
    "expected_visitors", "holiday_adjusted", "hour_bucket", "hourly_base", "hourly_spine",
    "missing_hours", "month_factor", "reversed_ranges", "noise_band", "weather_adjusted", "weekday_factor",
    "with_defaults", "with_expectation",
]
