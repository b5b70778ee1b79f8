import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hubbub.functions import times

NTZ = "timestamp_ntz"


def wall(text):
    return F.lit(text).cast(NTZ)


@pytest.mark.parametrize("published, raw, want", [
    ("2025-12-29", "01/02 10:00", "2026-01-02 10:00:00"),
    ("2025-12-29", "12/01 10:00", "2025-12-01 10:00:00"),
    ("2025-01-10", "02/29 10:00", "1970-01-01 00:00:00"),
    ("2024-03-05", "02/29 10:00", "1970-01-01 00:00:00"),
    ("2023-03-05", "02/29 10:00", "1970-01-01 00:00:00"),
    ("2024-01-05", "02/29 10:00", "2024-02-29 10:00:00"),
    ("2025-12-29", "Unknown", "1970-01-01 00:00:00"),
    ("2025-01-10", "2/9 1:05", "2025-02-09 01:05:00"),
    ("2025-01-10", "02/09 10:00:01", "1970-01-01 00:00:00"),
    ("2025-01-10", "13/09 10:00", "1970-01-01 00:00:00"),
    ("2025-01-10", "02/09 24:00", "1970-01-01 00:00:00"),
])
def test_comment_year(one, published, raw, want):
    assert one(times.wall_text(times.comment_time(F.lit(raw), wall(published))))[0] == want


def strptime_oracle(published, raw):
    try:
        t = dt.datetime.strptime(f"{published.year}/{raw}", "%Y/%m/%d %H:%M")
        return t.replace(year=published.year + 1) if t.month < published.month else t
    except ValueError:
        return dt.datetime(1970, 1, 1)


def test_comment_year_against_strptime(spark):
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        day = dt.datetime(rng.choice([2023, 2024, 2025, 2027, 2028]), 1, 1) + dt.timedelta(days=rng.randrange(366))
        month, dom = rng.randrange(0, 14), rng.choice([0, 1, 9, 28, 29, 30, 31, 32])
        clock = rng.choice(["10:00", "9:5", "23:59", "24:00", "1:60", "10:00:01", ""])
        pad = rng.choice(["{:02d}/{:02d} {}", "{}/{} {}"])
        rows.append((i, day, pad.format(month, dom, clock)))
    df = spark.createDataFrame(rows, "i int, p timestamp_ntz, raw string")
    got = {r.i: r.t for r in df.select("i", times.comment_time("raw", "p").alias("t")).collect()}
    assert got == {i: strptime_oracle(p, raw) for i, p, raw in rows}


def test_full_policy(one):
    p = wall("2025-12-29 12:00:00")
    row = one(*[times.wall_text(c) for c in (
        times.comment_time(F.lit("12/29 11:00"), p, "full"), times.comment_time(F.lit("12/29 13:00"), p, "full"),
        times.comment_time(F.lit("12/29 11:00"), p, "full", F.lit(False)), times.comment_time(F.lit("x"), p, "full"))])
    assert list(row) == ["2026-12-29 11:00:00", "2025-12-29 13:00:00", "2025-12-29 11:00:00", None]


def test_raw_time(one):
    row = one(*[times.last_two_tokens(F.lit(s)) for s in ("1.2.3.4 12/29 18:30", "12/29  18:30", "12/29", "", "　12/29　18:30\n")])
    assert list(row) == ["12/29 18:30", "12/29 18:30", "Unknown", "Unknown", "12/29 18:30"]


def test_epochs(one, spark):
    url = "https://f/bbs/x/M.1766998030.A.8C2.html"
    row = one(times.wall_text(times.epoch_wall(times.url_epoch(F.lit(url)))), times.url_epoch(F.lit("https://f/x")), times.url_epoch(F.lit("M.x.A")))
    assert list(row) == ["2025-12-29 16:47:10", None, None]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(times.wall_text(times.epoch_wall(times.url_epoch(F.lit(url)))))[0] == "2025-12-29 16:47:10"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_iso(one):
    row = one(*[times.wall_text(c) for c in (
        times.iso_utc_wall(F.lit("2024-12-29T20:00:00.000Z")), times.iso_utc_wall(F.lit("2024-12-29T20:00:00Z")),
        times.iso_utc_wall(F.lit("2024-13-29T20:00:00.0Z")), times.iso_offset_wall(F.lit("2024-12-29T20:00:00Z")),
        times.iso_offset_wall(F.lit("2024-12-29T20:00:00.5-05:30")), times.iso_offset_wall(F.lit("2024-12-29 20:00+08:00")),
        times.iso_offset_wall(F.lit("soon")), times.parse_wall(F.lit("x")))])
    assert list(row) == ["2024-12-30 04:00:00", None, None, "2024-12-30 04:00:00", "2024-12-30 09:30:00", "2024-12-29 20:00:00", None, None]


def test_post_date(one):
    row = one(*[times.post_date(F.lit(s), 2025) for s in (" 1/21", "12/05", "2/29", "x", "1/2/3", "　1 / 2 ", "")])
    d = dt.datetime
    assert list(row) == [d(2025, 1, 21), d(2025, 12, 5), None, None, None, d(2025, 1, 2), None]


def test_future_dates(one):
    as_of = wall("2024-06-01")
    row = one(
        times.previous_year_if_future(wall("2024-07-01"), as_of, F.lit(False)), times.previous_year_if_future(wall("2024-07-01"), as_of, F.lit(True)),
        times.previous_year_if_future(wall("2024-05-01"), as_of, F.lit(False)),
        times.previous_year_if_future(wall("2024-02-29"), wall("2024-01-01"), F.lit(False)))
    d = dt.datetime
    assert list(row) == [d(2023, 7, 1), d(2024, 7, 1), d(2024, 5, 1), None]


def test_ranges():
    d = dt.datetime
    assert times.time_range("2025-01-01", "2025-12-31") == (d(2025, 1, 1), d(2025, 12, 31, 23, 59, 59))
    assert times.time_range("2025-12-31", "2025-01-01") == (d(2025, 1, 1), d(2025, 12, 31, 23, 59, 59))
    assert times.time_range("2025-12-31", "2025-01-01", swap="late") == (d(2025, 1, 1, 23, 59, 59), d(2025, 12, 31))
    with pytest.raises(ValueError):
        times.time_range("2025-12-31", "2025-01-01", swap="x")
