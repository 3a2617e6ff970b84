"""Epoch times, timestamps and the lookbacks built on them.

Times of day are UTC: run with ``spark.sql.session.timeZone=UTC``.
"""

from pyspark.sql import functions as F

from skytally.functions.text import parse_number

# Spellings of the parts a time can be moved by.
_PARTS = {
    "hh": "HOUR",
    "hour": "HOUR",
    "minute": "MINUTE",
    "mi": "MINUTE",
    "second": "SECOND",
    "ss": "SECOND",
    "day": "DAY",
    "dd": "DAY",
}

# What a date-time has to look like before it is parsed. A parse that fails is slow.
_ISO = r"^\s*\d{4}-\d"
_MONTH_FIRST_24H_LIKE = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d\d:\d\d$"
_MONTH_FIRST_12H_LIKE = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d\d:\d\d [AP]M$"

# The month-first layouts, 24-hour and 12-hour.
_MONTH_FIRST_24H = "M/d/yyyy H:mm:ss"
_MONTH_FIRST_12H = "M/d/yyyy h:mm:ss a"


# Fixed value: the first second of the year 10000. Times must be nearer to 1970 than this.
END_OF_TIME = 253402300800


def _col(value):
    return F.col(value) if isinstance(value, str) else value


def usable_time(seconds):
    """Whether epoch seconds are a number that a timestamp can hold."""
    # NaN is larger than any number.
    return F.coalesce(F.abs(_col(seconds)) < END_OF_TIME, F.lit(False))


def scale_ms(seconds, to="ms"):
    """Seconds to milliseconds, or back with ``to='s'``."""
    return _col(seconds) * 1000.0 if to == "ms" else _col(seconds) / 1000.0


def event_time(now):
    """Epoch seconds as a timestamp, fraction cut off; null when there is no such time."""
    return F.timestamp_seconds(F.floor(F.when(usable_time(now), _col(now))))


def to_datetime(seconds):
    """Epoch seconds as a timestamp of millisecond precision."""
    return F.timestamp_millis(F.round(scale_ms(seconds)).cast("bigint"))


def to_epoch_ms(moment):
    return F.unix_millis(moment)


def date_add_part(part, count, moment):
    """``moment`` moved by ``count`` parts; a negative count moves it back."""
    count = F.lit(count) if isinstance(count, int) else _col(count)
    return F.timestamp_add(_PARTS[part.lower()], count, _col(moment))


def now_fn(as_of=None):
    """The current time, or the given moment so that a run can be repeated."""
    return F.current_timestamp() if as_of is None else _col(as_of)


def ago_epoch(part, count, as_of=None):
    """Whole epoch seconds ``count`` parts before now."""
    earlier = date_add_part(part, -count, now_fn(as_of))
    return F.round(scale_ms(to_epoch_ms(earlier), to="s")).cast("bigint")


def numeric_timestamp(text):
    """A timestamp given as text, as decimal epoch seconds.

    A number stays as it is, a date-time becomes whole seconds, the rest is null.
    """
    text = _col(text)
    # The layouts stay literals: one that varies by row is compiled for each row.
    moment = (
        F.when(text.rlike(_ISO), F.try_to_timestamp(text))
        .when(text.rlike(_MONTH_FIRST_12H_LIKE), F.try_to_timestamp(text, F.lit(_MONTH_FIRST_12H)))
        .when(text.rlike(_MONTH_FIRST_24H_LIKE), F.try_to_timestamp(text, F.lit(_MONTH_FIRST_24H)))
    )
    return F.coalesce(parse_number(text), F.unix_timestamp(moment).cast("decimal(20,6)"))
