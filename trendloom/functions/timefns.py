"""Time helpers. All of them assume the session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import _col

_ISO = r"^\d{4}-\d{2}"
_RFC822 = r"^(?:[A-Za-z]{3}, *)?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) *(.*)$"


def parse_published_at(c: Column | str) -> Column:
    """ISO-8601 (``Z``, offset or none) or RFC-822 text to a UTC timestamp, else null.

    The shape is tested first, so that a row meets only the parser that fits it.
    """
    c = _col(c)
    clock = F.regexp_extract(c, _RFC822, 1)
    zone = F.regexp_extract(c, _RFC822, 2)
    numeric = zone.rlike(r"^[+-]\d{4}$")
    offset = F.when(numeric, zone).otherwise(F.lit("+0000"))
    named = F.concat_ws(" ", clock, zone)
    return (
        F.when(c.rlike(_ISO), F.try_to_timestamp(c))
        .when(
            c.rlike(_RFC822) & (numeric | zone.isin("GMT", "UTC", "Z", "")),
            F.try_to_timestamp(F.concat_ws(" ", clock, offset), F.lit("d MMM yyyy HH:mm:ss xx")),
        )
        .when(c.rlike(_RFC822), F.try_to_timestamp(named, F.lit("d MMM yyyy HH:mm:ss z")))
    )


def iso_utc(ts: Column | str) -> Column:
    """Timestamp to ISO text with +00:00; microseconds only when there are any."""
    ts = _col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    frac = F.when(micros == 0, F.lit("")).otherwise(F.date_format(ts, ".SSSSSS"))
    return F.concat(whole, frac, F.lit("+00:00"))


def epoch_to_timestamp(c: Column | str) -> Column:
    return F.timestamp_seconds(_col(c))


def day_bounds(day: Column | str) -> tuple[Column, Column]:
    """Epoch seconds of 00:00:00 and of 23:59:59 of a day given as yyyy-MM-dd."""
    start = F.unix_timestamp(F.to_timestamp(F.to_date(_col(day))))
    return start, start + F.lit(86_399)


def week_start(ts: Column | str) -> Column:
    """Monday of the week as yyyy-MM-dd."""
    return F.date_format(F.date_trunc("week", _col(ts)), "yyyy-MM-dd")


def event_time(df, name: str = "published_at") -> Column:
    """The column as a timestamp: text, as records store it, is parsed; unknown and empty dates are null."""
    return parse_published_at(name) if dict(df.dtypes)[name] == "string" else F.col(name).cast("timestamp")
