"""Streams over the given tables, run until everything available is handled."""

import uuid

from pyspark.sql import functions as F

from hubbub.session import shared_dir
from hubbub.sources.articles import article_json
from hubbub.streaming import jobs
from workload.base import query, table
from workload.pipeline import nested_documents


def _work(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _stream(spark, sf_dir, name):
    """A table as a stream, whether it is one file or a folder of files."""
    rows = table(spark, sf_dir, name)
    reader = spark.readStream.schema(rows.schema)
    if rows.inputFiles()[0].endswith(f"/{name}.parquet"):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(f"{sf_dir}/{name}.parquet")


@query("select ts::date as date, hour(ts)::bigint as hour, count(*) as n from events group by 1, 2")
def stream_hourly_volume(spark, sf_dir):
    work = _work(spark, "hourly")
    hours = jobs.hourly_volume(_stream(spark, sf_dir, "events"), "ts", "2 hours")
    jobs.versions_to(hours, f"{work}/out", f"{work}/state").awaitTermination()
    jobs.compact(spark, f"{work}/out", ["date", "hour"])
    return jobs.latest(spark, f"{work}/out", ["date", "hour"]).withColumn("hour", F.col("hour").cast("bigint"))


@query("select distinct user_id from events")
def stream_dedup(spark, sf_dir):
    """Users seen for the first time within the delay; all rows on hand are one batch, in which a user counts once."""
    work = _work(spark, "dedup")
    users = jobs.first_seen(_stream(spark, sf_dir, "events"), "user_id", "ts", "2 hours")
    jobs.append_to(users.select("user_id"), f"{work}/out", f"{work}/state").awaitTermination()
    return spark.read.parquet(f"{work}/out")


@query("""with w as (select event_type as word, date_trunc('day', ts) as window_start from events),
c as (select window_start, word, count(*) as n from w group by 1, 2)
select window_start, word, n, row_number() over (partition by window_start order by n desc, word) as rank from c qualify rank <= 3""")
def stream_top_terms(spark, sf_dir):
    """Top three event words per day."""
    work = _work(spark, "terms")
    words = _stream(spark, sf_dir, "events").select("ts", F.col("event_type").alias("word"))
    jobs.versions_to(jobs.windowed_terms(words, "ts", "2 hours", "1 day"), f"{work}/out", f"{work}/state").awaitTermination()
    top = jobs.rolling_top(jobs.latest(spark, f"{work}/out", ["window_start", "word"]), 3)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query("""select lang as article_category, count(*) as articles, sum(len(string_split(text, chr(10))) - 1)::bigint as comments
from documents group by 1""")
def stream_ingest(spark, sf_dir):
    """Articles landed as JSON lines are picked up by a file stream and stored as Parquet."""
    work = _work(spark, "ingest")
    article_json(nested_documents(spark, sf_dir)).write.json(f"{work}/in")
    stream = jobs.article_stream(spark, f"{work}/in", lines=True)
    jobs.append_to(stream, f"{work}/out", f"{work}/state").awaitTermination()
    stored = spark.read.parquet(f"{work}/out")
    return stored.groupBy("article_category").agg(
        F.count(F.lit(1)).alias("articles"), F.sum(F.size("comments")).cast("bigint").alias("comments"))


@query("""with e as (select *, max(ts) over () - interval 3 hour as edge from events)
select 'second' as run, count(*) as dropped from e where ts < edge""")
def stream_late_rows(spark, sf_dir):
    """Events that come in a second run, more than the delay behind the first one's last: each is reported as dropped."""
    work = _work(spark, "late")
    events = table(spark, sf_dir, "events")
    edge = F.lit(events.agg(F.max("ts")).first()[0]) - F.expr("interval 3 hours")
    late = jobs.LateRows()
    spark.streams.addListener(late)
    try:
        for run, part in (("first", F.col("ts") >= edge), ("second", F.col("ts") < edge)):
            events.where(part).write.mode("append").parquet(f"{work}/in")
            seen = jobs.first_seen(spark.readStream.schema(events.schema).parquet(f"{work}/in"), "event_id", "ts", "2 hours")
            sink = seen.writeStream.queryName(run).format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/state")
            sink.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(late)
    return late.audit_rows(spark).groupBy(F.col("name").alias("run")).agg(F.sum("dropped").alias("dropped"))
