"""Time expressions on wall-clock values (TIMESTAMP_NTZ), independent of the session time zone."""

import datetime

from pyspark.sql import functions as F

from hubbub.functions.text import strip_ws, ws_tokens

EPOCH_SENTINEL = "1970-01-01 00:00:00"
UNKNOWN_TIME = "Unknown"
HOME_ZONE = "Asia/Taipei"
HOME_OFFSET_HOURS = 8


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def sentinel():
    return F.lit(EPOCH_SENTINEL).cast("timestamp_ntz")


def parse_wall(c):
    """Text to wall-clock time; unreadable text gives NULL."""
    return _col(c).try_cast("timestamp_ntz")


def wall_text(c):
    """Wall-clock time as yyyy-MM-dd HH:mm:ss, cut to whole seconds."""
    return F.left(_col(c).cast("string"), F.lit(19))


def _at(year, month, day, hour=0, minute=0):
    parts = [year, month, day, hour, minute, 0]
    return F.try_make_timestamp_ntz(*[p if not isinstance(p, int) else F.lit(p) for p in parts])


def post_date(raw, year):
    """Read ' M/D' in an assumed year; anything else gives NULL."""
    parts = F.split(_col(raw), "/")
    year = F.lit(year) if isinstance(year, int) else _col(year)
    number = [strip_ws(F.get(parts, F.lit(i))).try_cast("int") for i in (0, 1)]
    return F.when(F.size(parts) == 2, _at(year, *number))


def previous_year_if_future(date, as_of, exempt):
    """Move a date after ``as_of`` one year back, except on exempt rows. Feb 29 becomes NULL."""
    date, as_of = _col(date), _col(as_of)
    moved = _at(F.year(date) - 1, F.month(date), F.dayofmonth(date))
    return F.when((date > as_of) & ~_col(exempt), moved).otherwise(date)


def last_two_tokens(c):
    """Date and time at the end of a stamp that may start with an address, else a marker."""
    tokens = ws_tokens(c)
    return F.when(F.size(tokens) >= 2, F.concat_ws(" ", F.slice(tokens, -2, 2))).otherwise(UNKNOWN_TIME)


def comment_time(raw, published, policy="month", has_header=None):
    """Add the missing year to 'MM/dd HH:mm'.

    ``month``: article year, next year when the month lies before the article's month; text that
    is no valid time in each year tried gives the 1970 sentinel. ``full``: next year when the
    whole time lies before the article's, only for articles with header lines; no sentinel.
    """
    raw, published = _col(raw), _col(published)
    # One shape test and one split serve all four numbers.
    parts = F.split(F.when(raw.rlike(r"^\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}$"), raw), "[/ :]")
    month, day, hour, minute = [F.get(parts, F.lit(i)).try_cast("int") for i in range(4)]
    year = F.year(published)
    same_year = _at(year, month, day, hour, minute)
    next_year = _at(year + 1, month, day, hour, minute)
    if policy == "month":
        inferred = F.when(month < F.month(published), next_year).otherwise(same_year)
        return F.coalesce(F.when(same_year.isNotNull(), inferred), sentinel())
    if policy == "full":
        late = published > same_year
        if has_header is not None:
            late = late & _col(has_header)
        return F.when(late, next_year).otherwise(same_year)
    raise ValueError(f"unknown policy {policy!r}")


def epoch_wall(seconds, zone=HOME_ZONE):
    """Epoch seconds to the wall clock of a zone."""
    start = F.lit(EPOCH_SENTINEL).cast("timestamp_ntz")
    utc = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _col(seconds).cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def url_epoch(url):
    """Epoch in a file name such as M.<epoch>.A.<id>.html, else NULL."""
    name = F.element_at(F.split(_col(url), "/"), -1)
    return F.get(F.split(name, r"\."), F.lit(1)).try_cast("bigint")


def iso_utc_wall(c, hours=HOME_OFFSET_HOURS):
    """'2024-12-29T10:00:00.000Z' moved by a fixed number of hours, else NULL."""
    shape = r"^(\d{4}-\d{1,2}-\d{1,2})T(\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6})Z$"
    c = _col(c)
    wall = F.concat_ws(" ", F.regexp_extract(c, shape, 1), F.regexp_extract(c, shape, 2)).try_cast("timestamp_ntz")
    return wall + F.expr(f"interval {int(hours)} hours")


def iso_offset_wall(c, hours=HOME_OFFSET_HOURS):
    """ISO time with 'Z', '+hh:mm', '+hhmm' or '+hh' moved to a fixed offset, else NULL."""
    c = _col(c)
    shape = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)(Z|[+-]\d{2}(?::?\d{2})?)$"
    wall = F.concat_ws(" ", F.regexp_extract(c, shape, 1), F.regexp_extract(c, shape, 2)).try_cast("timestamp_ntz")
    zone = F.regexp_extract(c, shape, 3)
    own = F.rpad(F.translate(F.substring(zone, 2, 5), ":", ""), 4, "0")
    minutes = F.substring(own, 1, 2).try_cast("int") * 60 + F.substring(own, 3, 2).try_cast("int")
    signed = F.when(zone == "Z", F.lit(0)).when(zone.startswith("-"), -minutes).otherwise(minutes)
    return wall + F.make_dt_interval(F.lit(0), F.lit(int(hours)), -signed, F.lit(0))


def date_parts(c, prefix):
    """Year, month and day columns of a time."""
    c = _col(c)
    return [
        F.year(c).alias(f"{prefix}_year"),
        F.month(c).alias(f"{prefix}_month"),
        F.dayofmonth(c).alias(f"{prefix}_day"),
    ]


def time_range(start, end, swap="early"):
    """Inclusive range from two dates (text), the end reaching 23:59:59.

    Reversed input is put in order: ``early`` orders the dates before the end is extended (the
    evident intent), ``late`` swaps after it, which loses most of both border days.
    """
    start, end = datetime.datetime.fromisoformat(start), datetime.datetime.fromisoformat(end)
    day_end = datetime.timedelta(hours=23, minutes=59, seconds=59)
    if swap == "early":
        start, end = min(start, end), max(start, end)
        return start, end + day_end
    if swap == "late":
        end = end + day_end
        return min(start, end), max(start, end)
    raise ValueError(f"unknown swap {swap!r}")


def in_range(c, start, end):
    """Inclusive at both ends; NULL times drop out."""
    bound = [F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (start, end)]
    return _col(c).between(*bound)
