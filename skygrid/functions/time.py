"""Times parsed from file names, period labels and range normalisation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name patterns, tried in this order. The first one is greedy: of several
# stamps in a name it takes the last that is followed by an underscore.
SENTINEL_STAMP = r"S5P_\w+_\w+__\w+_+(\d{8}T\d{6})_"
MODIS_WITH_TIME = r"(?:MOD|MYD|MCD)\w*\.A(\d{7})\.(\d{4})\."
MODIS_DATE_ONLY = r"(?:MOD|MYD|MCD)\w*\.A(\d{7})\."
GEMS_STAMP = r"_(\d{8})_(\d{4})_"
EIGHT_DIGITS = r"(\d{8})"
ISO_DATE = r"(\d{4}-\d{2}-\d{2})"
SLICE_DATE = r"(20\d{6})"
L3_DATE = r"-(\d{8})-\d{8}\.nc$"

EPOCH = datetime(1970, 1, 1)


def _first(name: Column, *choices: tuple[str, Column]) -> Column:
    """Value of the first pattern found in ``name``, null if none is.

    The test comes before the parse, so names of another kind cost one failed match
    and no failed parse.
    """
    chain = None
    for pattern, value in choices:
        found = F.rlike(name, F.lit(pattern))
        chain = F.when(found, value) if chain is None else chain.when(found, value)
    return chain


def _parse(text: Column, fmt: str) -> Column:
    """Timestamp of a matched text, null where the date does not exist."""
    return F.try_to_timestamp(text, F.lit(fmt))


def _year_day(text: Column) -> Column:
    """Midnight of ``yyyyddd``; a day number past the year's end rolls over."""
    year, day = F.substring(text, 1, 4).cast("int"), F.substring(text, 5, 3).cast("int")
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day - 1).cast("timestamp")


def _gems(name: Column) -> Column:
    stamp = F.concat(F.regexp_extract(name, GEMS_STAMP, 1), F.regexp_extract(name, GEMS_STAMP, 2))
    return _parse(stamp, "yyyyMMddHHmm")


def gems_time(name: Column) -> Column:
    """Stamp between underscores, ``_yyyymmdd_hhmm_``."""
    return _first(name, (GEMS_STAMP, _gems(name)))


def granule_time(name: Column) -> Column:
    """Observation time (UTC) read from a file name, by the first pattern that fits.

    Stamps with a clock (``yyyymmdd_hhmmss``, ISO date-time) always contain the plain
    date tried before them, so they need no step of their own.
    """
    day = _year_day(F.regexp_extract(name, MODIS_DATE_ONLY, 1))
    clock = F.regexp_extract(name, MODIS_WITH_TIME, 2)
    minutes = F.substring(clock, 1, 2).cast("int") * 60 + F.substring(clock, 3, 2).cast("int")
    return _first(
        name,
        (SENTINEL_STAMP, _parse(F.regexp_extract(name, SENTINEL_STAMP, 1), "yyyyMMdd'T'HHmmss")),
        (MODIS_WITH_TIME, day + F.make_dt_interval(mins=minutes)),
        (MODIS_DATE_ONLY, day),
        (GEMS_STAMP, _gems(name)),
        (EIGHT_DIGITS, _parse(F.regexp_extract(name, EIGHT_DIGITS, 1), "yyyyMMdd")),
        (ISO_DATE, _parse(F.regexp_extract(name, ISO_DATE, 1), "yyyy-MM-dd")),
    )


def slice_date(name: Column) -> Column:
    """Date of a processed slice: eight digits that start with 20."""
    return _first(name, (SLICE_DATE, _parse(F.regexp_extract(name, SLICE_DATE, 1), "yyyyMMdd").cast("date")))


def l3_date(name: Column) -> Column:
    """Data date of a ready-made grid: the first of the two trailing dates, else any eight digits."""
    return _first(name, *[(p, _parse(F.regexp_extract(name, p, 1), "yyyyMMdd").cast("date")) for p in (L3_DATE, EIGHT_DIGITS)])


def to_local(ts: Column, tz: str = "Asia/Taipei") -> Column:
    """Wall-clock time in ``tz`` of a UTC timestamp."""
    return F.from_utc_timestamp(ts, tz)


def local_day_window(ts: Column, start: str, end: str, tz: str = "Asia/Taipei") -> Column:
    """Predicate: the local date lies in [start, end].

    Written as a range over the UTC column, so the scan can use it to skip files.
    """
    first = F.to_utc_timestamp(F.lit(start).cast("timestamp"), tz)
    past = F.to_utc_timestamp((F.lit(end).cast("date") + F.expr("interval 1 day")).cast("timestamp"), tz)
    return (ts >= first) & (ts < past)


def day_end(ts: Column) -> Column:
    """A bare date (midnight) as an upper bound means the end of that day."""
    return F.when(ts == F.date_trunc("day", ts), ts + F.expr("interval 23 hours 59 minutes 59 seconds")).otherwise(ts)


def in_date_range(ts: Column, start, end, end_at_midnight: bool = False) -> Column:
    """Inclusive range; ``end_at_midnight`` keeps a bare end date as it is."""
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return ts.between(lo, hi if end_at_midnight else day_end(hi))


def normalize_range(start: Column, end: Column, now: Column | None = None) -> tuple[Column, Column]:
    """End-of-day rule, clamp to ``now``, swap if reversed."""
    now = F.current_timestamp() if now is None else now
    lo, hi = F.least(start, now), F.least(day_end(end), now)
    return F.least(lo, hi), F.greatest(lo, hi)


def half_year_period(d: Column) -> tuple[Column, Column, Column]:
    """First day, last day and ``yyyymmdd-yyyymmdd`` label of the half year holding ``d``."""
    first_half = F.month(d) <= 6
    start = F.make_date(F.year(d), F.when(first_half, 1).otherwise(7), F.lit(1))
    end = F.make_date(F.year(d), F.when(first_half, 6).otherwise(12), F.when(first_half, 30).otherwise(31))
    label = F.concat_ws("-", F.date_format(start, "yyyyMMdd"), F.date_format(end, "yyyyMMdd"))
    return start, end, label


# Label format of each coverage granularity.
LABEL_FORMATS = {"per_file": "yyyy-MM-dd HH:mm", "daily": "yyyy-MM-dd", "monthly": "yyyy-MM", "yearly": "yyyy"}


def bucket_label(ts: Column, granularity: str) -> Column:
    if granularity not in LABEL_FORMATS:
        raise ValueError(f"granularity must be one of {sorted(LABEL_FORMATS)}")
    return F.date_format(ts, LABEL_FORMATS[granularity])


def period_start(ts: Column, period: str) -> Column:
    """First day of the day, fortnight, month, season (Dec-Feb, ...) or year holding ``ts``."""
    if period in ("day", "month", "year"):
        return F.to_date(F.date_trunc(period, ts))
    if period == "fortnight":
        days = F.unix_date(F.to_date(ts))
        return F.date_from_unix_date((days - F.pmod(days, F.lit(14))).cast("int"))
    if period == "season":
        return F.add_months(F.to_date(F.date_trunc("month", ts)), -F.pmod(F.month(ts), F.lit(3)))
    raise ValueError("period must be day, fortnight, month, season or year")
