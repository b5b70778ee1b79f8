"""Streaming jobs. State is bounded by watermarks; results go to files, not to the driver."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from hubbub.schemas import ARTICLE_JSON
from hubbub.sources.articles import GLOBS
from hubbub.sources.tasks import path_exists


def article_stream(spark, path, lines=False):
    """New article files of a folder as a stream; ``lines`` for many articles per file."""
    return (
        spark.readStream.schema(ARTICLE_JSON).option("multiLine", not lines)
        .option("pathGlobFilter", GLOBS[lines]).json(path)
    )


def first_seen(stream, key, time, delay):
    """One row per key within ``delay`` of event time; later copies are dropped."""
    return _event_time(stream, time, delay).dropDuplicatesWithinWatermark([key])


def hourly_volume(stream, time, delay, weight=None):
    """Hits per hour, late rows included up to ``delay``. Long form: pivot when reading."""
    value = F.lit(1) if weight is None else F.col(weight)
    hours = _event_time(stream, time, delay).groupBy(F.window(time, "1 hour")).agg(F.sum(value).cast("bigint").alias("n"))
    return hours.select(F.to_date(_window_start()).alias("date"), F.hour(_window_start()).alias("hour"), "n")


def windowed_terms(stream, time, delay, span):
    """Word counts per time window."""
    counts = _event_time(stream, time, delay).groupBy(F.window(time, span), "word").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(_window_start().alias("window_start"), "word", "n")


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _event_time(stream, time, delay):
    """Watermarks need an instant: a wall-clock time is carried as if it were UTC."""
    if stream.schema[time].dataType.simpleString() == "timestamp_ntz":
        stream = stream.withColumn(time, F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), F.col(time))))
    return stream.withWatermark(time, delay)


def _window_start():
    """Start of the window as wall-clock time, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros("window.start"), _epoch())


def append_to(stream, path, checkpoint):
    """Start an append-mode file sink that handles what is available and stops."""
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def versions_to(stream, path, checkpoint):
    """Start an update-mode sink: each batch's changed rows are saved under its batch number.

    A batch that is run again overwrites its own folder, so a lost driver or executor leaves no
    double counts. Read the result with ``latest``.
    """
    def save(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
        .outputMode("update").trigger(availableNow=True).start()
    )


def latest(spark, path, keys, value="n"):
    """Newest version of each key: the newest compaction, if there is one, and the batches saved after it."""
    saved = spark.read.parquet(path)
    folded = f"{path}-compacted"
    if path_exists(spark, folded):
        done = spark.read.parquet(folded)
        upto = done.agg(F.max("batch")).first()[0]
        # Both conditions are on folder names, so older files are not opened.
        saved = done.where(F.col("batch") == upto).unionByName(saved.where(F.col("batch") > upto))
    return saved.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))


def compact(spark, path, keys, value="n"):
    """Fold all batches saved so far into one, next to them; from then on ``latest`` reads that and newer ones.

    Folded batches may be removed by age at any time. A compaction that runs twice overwrites itself."""
    upto = spark.read.parquet(path).agg(F.max("batch")).first()[0]
    if upto is not None:
        latest(spark, path, keys, value).write.mode("overwrite").parquet(f"{path}-compacted/batch={upto}")


def rolling_top(counts, n):
    """Top n words per window from the newest counts."""
    order = Window.partitionBy("window_start").orderBy(F.col("n").desc(), F.col("word"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


class LateRows(StreamingQueryListener):
    """Turns rows that watermarks dropped into audit rows: one for each batch that lost any.

    Register it with ``spark.streams.addListener`` before a query starts. A windowed count drops what a task has
    already added up, so it reports groups of rows; deduplication reports single rows."""

    def __init__(self):
        self.found = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        done = event.progress
        dropped = sum(state.numRowsDroppedByWatermark for state in done.stateOperators)
        if dropped:
            self.found.append((str(done.id), done.name, done.batchId, dropped))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def audit_rows(self, spark):
        """(query_id, name, batch, dropped) of what was lost so far."""
        return spark.createDataFrame(self.found, "query_id string, name string, batch long, dropped long")
