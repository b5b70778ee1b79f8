import datetime as dt

from hubbub.operators import audit, listing

SCHEMA = "board string, page_seq int, pos int, title string, url string, date string, pinned boolean"


def entries(spark, *rows):
    return spark.createDataFrame([("b", *r) for r in rows], SCHEMA)


def tasks_of(spark, *rows, year=2025, as_of="2025-06-15", stop="2024-12-30", cap=100):
    tasks = listing.task_list(entries(spark, *rows), year, as_of, stop, cap)
    return [(r.title, r.seq) for r in tasks.orderBy("seq").collect()]


NEWEST = (0, 2, "n1", "u1", " 6/14", False)
OLDER = (0, 1, "n2", "u2", " 1/02", False)
LAST_YEAR = (1, 9, "n3", "u3", "12/31", False)
TOO_OLD = (1, 8, "n4", "u4", "12/29", False)
AFTER = (1, 7, "n5", "u5", "12/31", False)


def test_order_year_and_stop(spark):
    assert tasks_of(spark, TOO_OLD, AFTER, OLDER, LAST_YEAR, NEWEST) == [("n1", 0), ("n2", 1), ("n3", 2)]


def test_cap_comes_after_stop(spark):
    assert tasks_of(spark, NEWEST, OLDER, LAST_YEAR, cap=2) == [("n1", 0), ("n2", 1)]


def test_first_entry_is_never_moved(spark):
    future = (0, 9, "f", "uf", "12/01", False)
    dated = listing.date_entries(listing.valid_entries(entries(spark, future, NEWEST)), 2025, "2025-06-15")
    assert {r.title: r.parsed_date for r in dated.collect()} == {"f": dt.datetime(2025, 12, 1), "n1": dt.datetime(2025, 6, 14)}


def test_unreadable_dates_never_stop_and_deleted_posts_drop(spark):
    no_date = (0, 3, "x", "ux", "?", False)
    deleted = (0, 4, None, None, " 1/01", False)
    assert tasks_of(spark, no_date, deleted, NEWEST) == [("x", 0), ("n1", 1)]


def test_pinned_once_and_last(spark):
    pin = [(0, 10, "p1", "v1", " 1/01", True), (0, 11, "p2", "v2", " 1/01", True), (1, 10, "p1", "v1", " 1/01", True)]
    assert tasks_of(spark, NEWEST, OLDER, *pin) == [("n1", 0), ("n2", 1), ("p1", 2), ("p2", 3)]
    assert tasks_of(spark, *pin) == [("p1", 0), ("p2", 1)]


def test_totals(spark):
    pin = (0, 10, "p1", "v1", " 1/01", True)
    totals = audit.listing_totals(listing.task_list(entries(spark, NEWEST, OLDER, LAST_YEAR, pin), 2025, "2025-06-15", "2024-12-30", 9)).first()
    assert totals.asDict() == {"board": "b", "normal_count": 3, "pinned_count": 1, "last_title": "n3", "last_url": "u3", "last_page": 1}


def test_observed_counts_rows(spark):
    df, seen = audit.observed(entries(spark, NEWEST, OLDER), "in")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 2}


def test_flags(spark):
    df = spark.createDataFrame([("unknown", "t"), ("", "t"), ("a", "無標題"), ("a", "t"), ("a", "標題讀取失敗")], "article_author string, article_title string")
    assert df.where(audit.missing_meta()).count() == 4 and df.where(audit.missing_meta_compat()).count() == 2


def test_summaries_are_computed_once(spark, monkeypatch):
    """Few jobs while the plan is built, and the same rows where summaries are stored instead of sent."""
    from hubbub.operators import joins

    rows = [(f"b{k % 3}", k // 9, k % 9, f"t{k}", f"/u{k}", f"{1 + k % 12:2d}/{1 + k % 28:02d}", k % 7 == 0) for k in range(200)]
    board = spark.createDataFrame(rows, "board string, page_seq long, pos long, title string, url string, date string, pinned boolean")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    sent = listing.task_list(board, 2025, "2025-06-15", "2024-09-01", 20)
    jobs = len(tracker.getJobIdsForGroup("building"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = sorted(map(str, sent.collect()))
    assert jobs <= 6 and len(want) > 10
    monkeypatch.setattr(joins.computed_once, "__defaults__", (0,))
    assert sorted(map(str, listing.task_list(board, 2025, "2025-06-15", "2024-09-01", 20).collect())) == want
