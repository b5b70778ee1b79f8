import datetime as dt
import json

from hubbub.streaming import jobs


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def stream(spark, folder):
    return spark.readStream.schema("ts timestamp_ntz, word string, id string").option("maxFilesPerTrigger", 1).json(str(folder))


def test_late_rows_are_added_over_restarts(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    land(source, "1.json", {"ts": "2025-01-01T01:10:00", "word": "a"}, {"ts": "2025-01-01T02:10:00", "word": "b"})
    jobs.versions_to(jobs.hourly_volume(stream(spark, source), "ts", "2 hours"), out, state).awaitTermination()
    land(source, "2.json", {"ts": "2025-01-01T01:50:00", "word": "a"})
    jobs.versions_to(jobs.hourly_volume(stream(spark, source), "ts", "2 hours"), out, state).awaitTermination()
    got = {(r["date"], r["hour"]): r["n"] for r in jobs.latest(spark, out, ["date", "hour"]).collect()}
    assert got == {(dt.date(2025, 1, 1), 1): 2, (dt.date(2025, 1, 1), 2): 1}


def test_first_seen(spark, tmp_path):
    source = tmp_path / "in"
    land(source, "1.json", {"ts": "2025-01-01T01:00:00", "id": "x"}, {"ts": "2025-01-01T01:01:00", "id": "y"})
    land(source, "2.json", {"ts": "2025-01-01T01:30:00", "id": "x"}, {"ts": "2025-01-01T01:31:00", "id": "z"})
    out = str(tmp_path / "out")
    jobs.append_to(jobs.first_seen(stream(spark, source), "id", "ts", "1 hour"), out, str(tmp_path / "state")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["x", "y", "z"]


def test_wall_clock_windows_ignore_the_session_zone(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    land(source, "1.json", {"ts": "2025-01-01T23:30:00", "word": "a"})
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        jobs.versions_to(jobs.windowed_terms(stream(spark, source), "ts", "1 hour", "1 day"), out, str(tmp_path / "state")).awaitTermination()
        assert spark.read.parquet(out).first().window_start == dt.datetime(2025, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rolling_top(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    land(source, "1.json", *[{"ts": "2025-01-01T01:00:00", "word": w} for w in "aab"])
    land(source, "2.json", *[{"ts": "2025-01-01T02:00:00", "word": w} for w in "bbc"])
    jobs.versions_to(jobs.windowed_terms(stream(spark, source), "ts", "2 hours", "1 day"), out, str(tmp_path / "state")).awaitTermination()
    top = jobs.rolling_top(jobs.latest(spark, out, ["window_start", "word"]), 2).orderBy("rank")
    assert [(r.word, r.n) for r in top.collect()] == [("b", 3), ("a", 2)]


def test_article_files_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(json.dumps({"article_url": "u", "comments": [{"comment_content": "c"}]}, indent=2))
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        jobs.append_to(jobs.article_stream(spark, str(source)), out, str(tmp_path / "state")).awaitTermination()
    assert [r.article_url for r in spark.read.parquet(out).collect()] == ["u"]


def test_compaction_keeps_the_newest_version(spark, tmp_path):
    path = str(tmp_path / "out")
    def save(number, rows):
        spark.createDataFrame(rows, "k string, n long").write.parquet(f"{path}/batch={number}")
    def now():
        return sorted((r.k, r.n) for r in jobs.latest(spark, path, ["k"]).collect())
    save(0, [("a", 1), ("b", 1)]), save(1, [("a", 2)])
    assert now() == [("a", 2), ("b", 1)]
    jobs.compact(spark, path, ["k"])
    jobs.compact(spark, path, ["k"])
    assert now() == [("a", 2), ("b", 1)]
    save(2, [("b", 5), ("c", 1)])
    assert now() == [("a", 2), ("b", 5), ("c", 1)]
    jobs.compact(spark, path, ["k"])
    assert now() == [("a", 2), ("b", 5), ("c", 1)]


def test_late_rows_are_reported(spark, tmp_path):
    late = jobs.LateRows()
    spark.streams.addListener(late)
    try:
        for hours in ([20, 21], [1, 2, 20]):
            rows = [(h, dt.datetime(2024, 1, 1, h)) for h in hours]
            spark.createDataFrame(rows, "id long, ts timestamp_ntz").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            seen = jobs.first_seen(spark.readStream.schema("id long, ts timestamp_ntz").parquet(str(tmp_path / "in")), "id", "ts", "2 hours")
            jobs.append_to(seen, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(late)
    assert [r["dropped"] for r in late.audit_rows(spark).collect()] == [2]
