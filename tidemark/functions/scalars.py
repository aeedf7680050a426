"""Column expressions. All of them are built-in functions, so they stay in codegen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def named(name: str) -> Column:
    """A top-level column, also when its name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


# Epoch seconds of the first and last moment of years 1 to 9999.
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799


def epoch_to_string(seconds: Column) -> Column:
    """Epoch seconds as UTC ``yyyy-MM-dd HH:mm:ss``, whatever the session zone is.

    Zone-less arithmetic followed by a cast prints whole seconds in exactly
    this form, and no daylight-saving gap can move the result. Seconds outside
    the calendar give NULL.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    moment = epoch + F.expr("INTERVAL '1' SECOND") * seconds
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), moment.cast("string"))


def load_stamp(as_of: datetime | str | None = None) -> Column:
    """The time of loading as a UTC string; ``as_of`` fixes it for repeatable runs."""
    if as_of is None:
        return epoch_to_string(F.unix_seconds(F.current_timestamp()))
    if isinstance(as_of, datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(as_of)


def _two_digits(number: Column) -> Column:
    digits = number.cast("string")
    return F.when(number < 10, F.concat(F.lit("0"), digits)).otherwise(digits)


def utc_offset_label(seconds: Column) -> Column:
    """Offset in seconds as ``UTC±HH:MM``; NULL for a NULL offset.

    The sign is that of the offset itself, so -1800 is ``UTC-00:30``.
    """
    size = F.abs(seconds)
    sign = F.when(seconds < 0, F.lit("-")).otherwise(F.lit("+"))
    hours = _two_digits((size / 3600).cast("int"))
    minutes = _two_digits((size % 3600 / 60).cast("int"))
    return F.concat(F.lit("UTC"), sign, hours, F.lit(":"), minutes)


#: An offset or a zone name at the end of a text, which then fixes the instant.
ZONED = r"([Zz]|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]{3,}(/\w+)*)\s*$"
EPOCH = "1970-01-01 00:00:00"


def instant_of(plain: Column) -> Column:
    """A zone-less time read as UTC. The time is named once, so no copy of how it was parsed
    ends up in a filter, and no zone of the session takes part."""
    since = plain - F.lit(EPOCH).cast("timestamp_ntz")
    seconds = since.cast("interval second").cast("decimal(20,6)")
    return F.timestamp_micros((seconds * 1_000_000).cast("bigint"))


def parse_plain_time(text: Column) -> Column:
    """UTC text without a zone to timestamp; NULL, not an error, when it is malformed."""
    return instant_of(text.try_cast("timestamp_ntz"))


def parse_event_time(text: Column) -> Column:
    """String to timestamp; NULL, not an error, when it is malformed.

    A text without a zone is UTC, whatever the session's zone is. The usual form, of 19
    characters with colons at their places, has none.
    """
    usual = (F.length(text) == 19) & (F.substring(text, 14, 1) == ":")
    usual = usual & (F.substring(text, 17, 1) == ":")
    has_zone = ~usual & F.substr(text, F.lit(11)).rlike(ZONED)
    return F.when(has_zone, F.try_to_timestamp(text)).otherwise(parse_plain_time(text))


def utc(instant: Column) -> Column:
    """An instant as zone-less UTC time, so that dates and parts do not follow the session."""
    epoch = F.lit(EPOCH).cast("timestamp_ntz")
    return epoch + F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(instant)


def hour_start(event_time: Column, width: str = "1 hour") -> Column:
    """Start of the epoch-aligned tumbling window; keeps the type of its input."""
    return F.window(event_time, width)["start"]


def hour_end(start: Column, width: str = "1 hour") -> Column:
    return start + F.expr(f"INTERVAL {width}")


def year_month(event_time: Column) -> dict[str, Column]:
    """Partition columns of the bronze table."""
    return {"year": F.year(event_time), "month": F.month(event_time)}


def fixed_point(value: Column, digits: int) -> Column:
    """``value`` as a whole number of 10^-digits units, exactly.

    Integer sums do not depend on the order in which partitions arrive, which
    sums of doubles do. A value with more decimals than ``digits`` raises
    rather than being rounded.
    """
    scaled = value.cast("double") * float(10**digits)
    units = F.rint(scaled)
    fits = F.abs(scaled - units) <= F.greatest(F.lit(1e-6), F.abs(scaled) * 1e-14)
    return (
        F.when(value.isNull(), F.lit(None).cast("bigint"))
        .when(fits, units.cast("bigint"))
        .otherwise(
            F.raise_error(
                F.format_string(f"%s has more than {digits} decimals", value.cast("string"))
            ).cast("bigint")
        )
    )


def fixed_point_mean(value: Column, digits: int) -> Column:
    """Average that is the same for every partitioning; an aggregate expression."""
    total = F.sum(fixed_point(value, digits)).cast("double") / float(10**digits)
    return total / F.nullif(F.count(value), F.lit(0))


# Strftime directives and the patterns that read the same text.
# One pattern letter reads one or two digits, as strptime does.
STRFTIME_PATTERNS = {
    "%Y": "yyyy",
    "%m": "M",
    "%d": "d",
    "%H": "H",
    "%I": "h",
    "%p": "a",
    "%M": "m",
    "%S": "s",
    "%j": "D",
    "%y": "yy",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%f": "[SSSSSS][SSSSS][SSSS][SSS][SS][S]",
    "%z": "XX",
    "%%": "'%'",
}


def strptime_pattern(strftime_format: str) -> str:
    """Translate a strftime format into a datetime pattern of Spark."""
    pattern, position = [], 0
    while position < len(strftime_format):
        char = strftime_format[position]
        if char == "%":
            directive = strftime_format[position : position + 2]
            if directive not in STRFTIME_PATTERNS:
                raise ValueError(f"unsupported strftime directive {directive!r}")
            pattern.append(STRFTIME_PATTERNS[directive])
            position += 2
            continue
        if char == "'":
            pattern.append("''")
        elif char.isalpha() or char in "[]{}#":
            pattern.append(f"'{char}'")
        else:
            pattern.append(char)
        position += 1
    return "".join(pattern)


def matches_strftime(text: Column, strftime_format: str) -> Column:
    return F.try_to_timestamp(text, F.lit(strptime_pattern(strftime_format))).isNotNull()
