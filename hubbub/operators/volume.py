"""Keyword hits in articles and comments, and their volume by day and hour."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.functions.times import in_range
from hubbub.operators.ranking import grouped_median

HOURS = list(range(24))

# "median" is handled apart: the built-in exact one holds a whole group in memory.
AGGREGATES = {
    "sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp, "len": F.count,
}


def keyword_pattern(keywords, literal=False):
    """One pattern that finds any keyword. Keywords are patterns themselves unless ``literal``."""
    keywords = [k for k in keywords if k]
    if not keywords:
        raise ValueError("give at least one keyword")
    if literal:
        keywords = [rf"\Q{k}\E" for k in keywords]
    return "|".join(keywords)


def contains_keyword(text, keywords, literal=False):
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.rlike(keyword_pattern(keywords, literal)), F.lit(False))


def _hits(df, text, time, keywords, start, end, literal):
    kept = df.where(in_range(time, start, end)).where(contains_keyword(text, keywords, literal))
    return kept.select(F.col(time).alias("publish_time"), F.lit(1).cast("bigint").alias("comment_count"))


def article_hits(articles, keywords, start, end, text="content_raw", time="publish_time", literal=False):
    """Articles in range whose text holds a keyword; each counts once."""
    return _hits(articles, text, time, keywords, start, end, literal)


def comment_hits(comments, keywords, start, end, text="comment_content", time="comment_time", literal=False):
    """Comments in range (their own time) whose text holds a keyword; each counts once."""
    return _hits(comments, text, time, keywords, start, end, literal)


def keyword_hits(articles, comments, keywords, start, end, literal=False):
    """Hits of both kinds in one table."""
    return article_hits(articles, keywords, start, end, literal=literal).unionByName(
        comment_hits(comments, keywords, start, end, literal=literal)
    )


def _aggregated(df, keys, names):
    """Aggregates of ``comment_count`` per group; ``names`` maps output columns to aggregates: names of built-in ones, or
    functions of a column that give an aggregate.

    All but the median share one pass over the data.
    """
    built_in = [(how if callable(how) else AGGREGATES[how])(F.col("comment_count")).alias(name) for name, how in names.items() if how != "median"]
    medians = [grouped_median(df, keys, "comment_count", name) for name, how in names.items() if how == "median"]
    parts = ([df.groupBy(*keys).agg(*built_in)] if built_in else []) + medians
    return reduce(lambda a, b: a.join(b, keys, "left"), parts).select(*keys, *names)


def volume_by_day(df, how="sum"):
    """Volume by day of month; a list of aggregates gives one column each, named after them, a map one for each entry."""
    days = df.withColumn("day", F.dayofmonth("publish_time"))
    names = {"comment_count": how} if isinstance(how, str) or callable(how) else how if isinstance(how, dict) else {h: h for h in how}
    return _aggregated(days, ["day"], names).orderBy("day")


def volume_cells(df, how="sum"):
    """Volume by date and hour, long form."""
    cells = df.withColumn("date", F.to_date("publish_time")).withColumn("hour", F.hour("publish_time"))
    return _aggregated(cells.where(F.col("date").isNotNull()), ["date", "hour"], {"n": how})


def heatmap(df, fill="all", hours="full", how="sum"):
    """Date by hour table, newest date first, hours ascending.

    ``hours='full'`` has columns 0..23, ``'observed'`` only hours that occur. ``fill='all'`` puts
    0 in every gap; ``'missing_hours'`` only in hours that occur on no date at all, leaving the
    other gaps NULL.
    """
    cells = volume_cells(df, how)
    if hours == "observed":
        columns = sorted(r["hour"] for r in cells.select("hour").distinct().collect())  # at most 24
    else:
        columns = HOURS
    # One row per date and hour by now: spread the hours over columns with a second small aggregate.
    table = cells.groupBy("date").agg(*[F.max(F.when(F.col("hour") == h, F.col("n"))).alias(str(h)) for h in columns])
    names = [str(h) for h in columns]
    if fill == "all":
        table = table.na.fill(0, names)
    elif fill == "missing_hours":
        # The table has one row per date by now, so one unpartitioned window is harmless.
        everywhere = Window.partitionBy()
        table = table.select("date", *[
            F.when(F.count(f"`{h}`").over(everywhere) == 0, F.lit(0)).otherwise(F.col(f"`{h}`")).alias(h) for h in names
        ])
    elif fill is not None:
        raise ValueError(f"unknown fill {fill!r}")
    return table.orderBy(F.col("date").desc())


def heatmap_long(df, spine=True, how="sum"):
    """Date, hour, n rows; with ``spine`` every hour of every date from first to last is present."""
    cells = volume_cells(df, how)
    if not spine:
        return cells
    # Cells are already aggregated to at most 24 rows per date.
    dates = cells.agg(F.explode(F.sequence(F.min("date"), F.max("date"))).alias("date"))
    grid = dates.select("date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    return grid.join(cells, ["date", "hour"], "left").na.fill(0, ["n"])
