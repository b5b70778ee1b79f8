import datetime
import random

import pytest
from pyspark.sql import functions as F

from hubbub.operators import rollup, volume


def rows(n, seed=1):
    pick = random.Random(seed)
    start = datetime.datetime(2024, 1, 1)
    return [(f"k{pick.randrange(2)}", start + datetime.timedelta(minutes=pick.randrange(60 * 24 * 90)), float(pick.randrange(1000)), pick.randrange(400)) for _ in range(n)]


def test_months_from_hours_as_from_rows(spark):
    data = rows(20_000) + [("k0", None, 1.0, 1), ("k1", datetime.datetime(2024, 2, 1), None, None)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v double, m long")
    cells = rollup.hour_cells(df, "t", "v", "m", ["k"])
    by_day = rollup.rolled_up(cells, "day", ["k"])
    got = {(r["k"], r["cell"].month): r for r in rollup.estimates(rollup.rolled_up(by_day, "month", ["k"]), (0.1, 0.5)).collect()}
    for (k, month), r in got.items():
        own = [d for d in data if d[0] == k and d[1] and d[1].month == month]
        values = sorted(v for _, _, v, _ in own if v is not None)
        assert r["n"] == len(own) and r["total"] == sum(values)
        exact = len({m for *_, m in own if m is not None})
        assert abs(r["distinct"] - exact) <= 0.06 * exact + 1
        for q, name in ((0.1, "q10"), (0.5, "q50")):
            assert sum(v < r[name] for v in values) / len(values) <= q + 0.02 and sum(v <= r[name] for v in values) / len(values) >= q - 0.02
    assert len(got) == 6


def test_no_rows(spark):
    cells = rollup.hour_cells(spark.createDataFrame([], "t timestamp_ntz, v double, m long"), "t", "v", "m")
    assert rollup.estimates(rollup.rolled_up(cells, "month")).collect() == []


def test_callers_aggregates(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, d, 5), d * 1.0) for d in (1, 1, 2, 3)], "publish_time timestamp_ntz, comment_count double")
    got = volume.volume_by_day(df, {"twice": lambda c: 2 * F.sum(c), "middle": "median"}).collect()
    assert [tuple(r) for r in got] == [(1, 4.0, 1.0), (2, 4.0, 2.0), (3, 6.0, 3.0)]
    assert [tuple(r) for r in volume.volume_by_day(df, F.max).collect()] == [(1, 1.0), (2, 2.0), (3, 3.0)]
    with pytest.raises(KeyError):
        volume.volume_by_day(df, "unknown")
