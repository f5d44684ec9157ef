"""Event-time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units an epoch integer may be expressed in, as divisors to whole seconds.
EPOCH_UNITS = {"ms": 1000, "s": 1}

TEXT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(epoch: Column | str, unit: str = "ms") -> Column:
    """Whole seconds of an epoch integer, truncated toward zero.

    Integral ``div`` keeps long precision (no detour through a double).
    """
    if unit not in EPOCH_UNITS:
        raise ValueError(f"unit must be one of {sorted(EPOCH_UNITS)}, got {unit!r}")
    divisor = EPOCH_UNITS[unit]
    epoch = _col(epoch)
    return epoch if divisor == 1 else F.call_function("div", epoch, F.lit(divisor))


def epoch_to_text(epoch: Column | str, unit: str = "ms") -> Column:
    """Epoch integer -> ``yyyy-MM-dd HH:mm:ss`` text in the session time zone."""
    return F.from_unixtime(epoch_seconds(epoch, unit), TEXT_TIME_FORMAT)


def hour_bucket(text_time: Column | str) -> Column:
    """Start of the hour of a ``yyyy-MM-dd HH:mm:ss`` text, as a timestamp."""
    return F.date_trunc("hour", _col(text_time).cast("timestamp"))


def calendar_day_span(end_text: Column | str, start_text: Column | str) -> Column:
    """Calendar-date boundaries between two event-time texts (not 24h periods)."""
    return F.datediff(_col(end_text), _col(start_text))


# Texts of years 0000 to 9999 are the greatest (a digit is beyond + and -); their numbers start at _PLAIN plus or minus seconds.
_PLAIN, _REST, _YEARS = 10**17, 10**10, 11**6


def text_order(text_time: Column | str) -> Column:
    """A bigint in the order of the event-time texts, of any year.

    Years beyond 9999 are written with a plus and five or six digits, years
    before 0 with a minus. Such texts are few; their number is put together of the
    sign (``+`` is before ``-``), the year's digits filled up with what follows them in the text (a hyphen, which is
    before the digits) and the rest. All other texts are in the order of their time.
    """
    text = _col(text_time)
    year = F.translate(F.rpad(F.regexp_extract(text, "^.([0-9]+)", 1), 6, "-"), "-0123456789", "0123456789a")
    rest = F.translate(F.regexp_extract(text, "^.[0-9]+(.*)$", 1), "- :", "").cast("bigint")
    sign = F.when(text.startswith("+"), 0).otherwise(_YEARS).cast("bigint")
    odd = (sign + F.conv(year, 11, 10).cast("bigint")) * _REST + rest
    return F.when(text >= "0", F.unix_seconds(text.cast("timestamp")) + _PLAIN).otherwise(odd)


def text_of_order(number: Column) -> Column:
    """The event-time text of a number of :func:`text_order`."""
    div = lambda a, b: F.call_function("div", a, F.lit(b).cast("bigint"))
    years = div(number, _REST)
    year = F.translate(F.lower(F.lpad(F.conv((years % _YEARS).cast("string"), 10, 11), 6, "0")), "0123456789a", "-0123456789")
    rest = F.regexp_replace(F.lpad((number % _REST).cast("string"), 10, "0"), "(..)(..)(..)(..)(..)", "-$1-$2 $3:$4:$5")
    odd = F.concat(F.when(years < _YEARS, "+").otherwise("-"), F.rtrim(year, F.lit("-")), rest)
    return F.when(number > _PLAIN // 2, F.date_format(F.timestamp_seconds(number - _PLAIN), TEXT_TIME_FORMAT)).otherwise(odd)


def latest_text(text_time: Column | str) -> Column:
    """``max`` of event-time texts, aggregated as a number.

    A string ``max`` has a variable-width buffer and forces a sort-based
    aggregate (every partition sorted); a number's buffer keeps the
    aggregate hash-based, and the number has the order of the texts.
    """
    return text_of_order(F.max(text_order(text_time)))


def earliest_text(text_time: Column | str) -> Column:
    """``min`` counterpart of :func:`latest_text`."""
    return text_of_order(F.min(text_order(text_time)))
