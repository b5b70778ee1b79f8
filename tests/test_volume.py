import datetime as dt

import pytest

from hubbub.functions.times import time_range
from hubbub.operators import volume


def hits(spark, *times):
    return spark.createDataFrame([(dt.datetime.fromisoformat(t), 1) for t in times], "publish_time timestamp_ntz, comment_count long")


GAPS = ("2025-01-01 01:00:00", "2025-01-01 02:30:00", "2025-01-01 02:00:00", "2025-01-02 01:59:59")


def test_full_heatmap(spark):
    rows = volume.heatmap(hits(spark, *GAPS)).collect()
    assert [str(r["date"]) for r in rows] == ["2025-01-02", "2025-01-01"]
    assert rows[0].asDict() == {"date": dt.date(2025, 1, 2), **{str(h): int(h == 1) for h in range(24)}}
    assert [rows[1][str(h)] for h in (0, 1, 2, 3)] == [0, 1, 2, 0]


def test_compat_gaps(spark):
    rows = volume.heatmap(hits(spark, *GAPS), fill="missing_hours").collect()
    assert rows[0]["2"] is None and rows[0]["1"] == 1
    assert all(r[str(h)] == 0 for r in rows for h in range(24) if h not in (1, 2))


def test_observed_hours(spark):
    table = volume.heatmap(hits(spark, *GAPS), hours="observed")
    assert table.columns == ["date", "1", "2"] and [tuple(r)[1:] for r in table.collect()] == [(1, 0), (1, 2)]
    with pytest.raises(ValueError):
        volume.heatmap(hits(spark, *GAPS), fill="some")


def test_empty_input_gives_empty_tables(spark):
    empty = hits(spark, *GAPS).where("false")
    assert volume.heatmap(empty).count() == 0 and len(volume.heatmap(empty).columns) == 25
    assert volume.volume_by_day(empty).count() == 0 and volume.heatmap_long(empty).count() == 0


def test_spine(spark):
    rows = volume.heatmap_long(hits(spark, "2025-01-01 01:00:00", "2025-01-03 01:00:00")).collect()
    assert len(rows) == 72 and sum(r.n for r in rows) == 2


def test_hits(spark):
    d = dt.datetime
    articles = spark.createDataFrame([
        (d(2025, 1, 1), "C++ rocks"), (d(2025, 1, 1, 23, 59, 59), "a.c"), (d(2025, 1, 2), "abc"), (None, "abc"), (d(2025, 1, 1), None),
    ], "publish_time timestamp_ntz, content_raw string")
    span = time_range("2025-01-01", "2025-01-01")
    assert volume.article_hits(articles, ["a.c", "rocks"], *span).count() == 2
    assert volume.article_hits(articles, ["C++"], *span, literal=True).count() == 1
    assert volume.article_hits(articles, ["ROCKS"], *span).count() == 0
    assert volume.article_hits(articles, ["a.c"], *time_range("2025-01-01", "2025-01-02")).count() == 2
    assert volume.article_hits(articles, ["a.c"], *time_range("2025-01-01", "2025-01-02"), literal=True).count() == 1
    for keywords in ([], [""]):
        with pytest.raises(ValueError):
            volume.article_hits(articles, keywords, *span)


def test_cells_add_up_to_hits(spark):
    from workload.heatmaps import thread_hits

    found = thread_hits(spark, "/root/testdata/sf0.001")
    table = volume.heatmap(found)
    assert sum(sum(tuple(r)[1:]) for r in table.collect()) == found.count()


def test_time_filter_reaches_the_scan(spark, capsys):
    from hubbub.functions.times import in_range

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where(in_range("ts", *time_range("2024-01-05", "2024-01-06")))
    events.select("ts").explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts" in plan and "ReadSchema: struct<ts:timestamp_ntz>" in plan
