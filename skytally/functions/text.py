"""String, number and cast functions.

A cast that fails costs Spark an exception per row, even in try_cast, and text such as
"ground" for an altitude is common. So text is matched first and only cast when it fits.
"""

from pyspark.sql import functions as F

_WHOLE = r"^\s*[+-]?\d{1,10}(\.0*)?\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?\s*$"
_PLAIN_NUMBER = r"^\s*[+-]?(\d[\d,]*\.?\d*|\.\d+)\s*$"


def _col(value):
    return F.col(value) if isinstance(value, str) else value


def _fitting(text, pattern, cast):
    return F.when(text.rlike(pattern), cast(text))


def whole_number(text):
    """Text as an int, or null. A fraction of zero is part of a whole number."""
    return _fitting(
        _col(text), _WHOLE, lambda t: F.substring_index(t, ".", 1).try_cast("int")
    )


def real_number(text):
    """Text as a double, or null."""
    return _fitting(_col(text), _NUMBER, lambda t: t.try_cast("double"))


def clean_callsign(flight):
    """Callsign without the blanks that pad it to eight characters."""
    return F.rtrim(flight)


def str_len(text):
    return F.length(text)


def plain_number(number):
    """A number as plain text: no exponent, no trailing zeros, at most six decimals.

    A cast of a double to text would give 1.634651003E9 for an epoch time.
    """
    digits = _col(number).try_cast("decimal(20,6)").cast("string")
    return F.rtrim(F.rtrim(digits, F.lit("0")), F.lit("."))


def sighting_id(now, flight):
    """``<now>-<callsign>``, the key of a sighting."""
    return F.concat(plain_number(now), F.lit("-"), clean_callsign(flight))


def squawk_num(squawk):
    """Transponder code as a number; null when it is not one."""
    return real_number(squawk)


def round_metres(metres):
    """Whole metres, halves away from zero."""
    return F.round(metres, 0)


def parse_number(text):
    """Text as a decimal, or null. Grouping commas are allowed, exponents are not."""
    return _fitting(
        _col(text), _PLAIN_NUMBER, lambda t: F.translate(t, ",", "").try_cast("decimal(20,6)")
    )
