"""Keyword volume by date and hour."""

from pyspark.sql import functions as F

from hubbub.functions.times import in_range, time_range
from hubbub.operators import rollup, volume
from workload.base import END, KEYWORDS, SQL_THREADS, START, query, table, thread_parts

_PATTERN = "|".join(KEYWORDS)
_BETWEEN = f"between timestamp '{START} 00:00:00' and timestamp '{END} 23:59:59'"
SQL_HITS = f"""
hits as (
  select ts from articles where ts {_BETWEEN} and regexp_matches(event_type, '{_PATTERN}')
  union all
  select ts from comments where ts {_BETWEEN} and regexp_matches(event_type, '{_PATTERN}'))
"""
_HOUR_COLUMNS = ", ".join(f"""count(*) filter (where hour(ts) = {h}) as "{h}\"""" for h in range(24))


def thread_hits(spark, sf_dir):
    articles, comments = thread_parts(spark, sf_dir)
    return volume.keyword_hits(articles, comments, KEYWORDS, *time_range(START, END))


def all_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("ts").alias("publish_time"), F.lit(1).cast("bigint").alias("comment_count"))


@query(f"with {SQL_THREADS}, {SQL_HITS} select ts::date as date, {_HOUR_COLUMNS} from hits group by 1")
def keyword_heatmap(spark, sf_dir):
    return volume.heatmap(thread_hits(spark, sf_dir))


@query(f"""with {SQL_THREADS}, {SQL_HITS},
cells as (select ts::date as date, hour(ts) as hour, count(*) as n from hits group by 1, 2),
days as (select unnest(generate_series(min(date)::timestamp, max(date)::timestamp, interval 1 day))::date as date from cells),
grid as (select date, unnest(range(24)) as hour from days)
select date, hour::bigint as hour, coalesce(n, 0)::bigint as n from grid left join cells using (date, hour)""")
def keyword_heatmap_long(spark, sf_dir):
    return volume.heatmap_long(thread_hits(spark, sf_dir)).select("date", F.col("hour").cast("bigint").alias("hour"), "n")


_COMPAT = ", ".join(
    f"""case when count(*) filter (where hour = {h}) > 0 then sum(n) filter (where hour = {h})
     when {h} in (select hour from cells) then null else 0 end::bigint as "{h}\"""" for h in range(24)
)


@query(f"""with {SQL_THREADS},
cells as (select ts::date as date, hour(ts) as hour, count(*) as n from articles
  where regexp_matches(event_type, '{_PATTERN}') and ts between timestamp '2024-01-01' and timestamp '2024-01-31 23:59:59' group by 1, 2)
select date, {_COMPAT} from cells group by date""")
def heatmap_gaps_compat(spark, sf_dir):
    articles, _ = thread_parts(spark, sf_dir)
    hits = volume.article_hits(articles, KEYWORDS, *time_range("2024-01-01", "2024-01-31"))
    return volume.heatmap(hits, fill="missing_hours")


@query(f"select ts::date as date, {_HOUR_COLUMNS} from events group by 1")
def heatmap_observed_hours(spark, sf_dir):
    return volume.heatmap(all_events(spark, sf_dir), hours="observed")


@query("select day(ts)::bigint as day, count(*)::bigint as comment_count from events group by 1")
def volume_by_day(spark, sf_dir):
    daily = volume.volume_by_day(all_events(spark, sf_dir))
    return daily.select(F.col("day").cast("bigint").alias("day"), "comment_count")


@query("""select day(ts)::bigint as day, round(sum(value), 3) as "sum", round(avg(value), 5) as "mean",
round(median(value), 4) as "median", round(max(value), 4) as "max", round(min(value), 4) as "min",
round(stddev_samp(value), 5) as "std", count(value) as "len" from events group by 1""")
def volume_aggs(spark, sf_dir):
    values = table(spark, sf_dir, "events").select(F.col("ts").alias("publish_time"), F.col("value").alias("comment_count"))
    daily = volume.volume_by_day(values, ["sum", "mean", "median", "max", "min", "std", "len"])
    digits = {"sum": 3, "mean": 5, "median": 4, "max": 4, "min": 4, "std": 5}
    return daily.select(F.col("day").cast("bigint").alias("day"), "len", *[F.round(c, n).alias(c) for c, n in digits.items()])


@query("""select day(ts)::bigint as day, round(sum(value * value), 2) as squares, count(*) filter (where value > 50) as large, round(median(value), 4) as middle
from events group by 1""")
def volume_by_caller(spark, sf_dir):
    """Aggregates that the caller brings, next to a built-in one."""
    values = table(spark, sf_dir, "events").select(F.col("ts").alias("publish_time"), F.col("value").alias("comment_count"))
    daily = volume.volume_by_day(values, {"squares": lambda c: F.sum(c * c), "large": lambda c: F.count_if(c > 50), "middle": "median"})
    return daily.select(F.col("day").cast("bigint").alias("day"), F.round("squares", 2).alias("squares"), "large", F.round("middle", 4).alias("middle"))


@query("""with m as (select date_trunc('month', o_orderdate)::timestamp as month, * from orders)
select month, count(*) as n, count(distinct o_custkey) as customers, true as distinct_close, true as middle_close from m group by 1""")
def rolled_up_months(spark, sf_dir):
    """Months merged from hour cells, held against the rows: different customers within 6 %, the median's rank within 2 %."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice", "o_custkey")
    cells = rollup.rolled_up(rollup.hour_cells(orders, "o_orderdate", "o_totalprice", "o_custkey"), "day")
    months = rollup.estimates(rollup.rolled_up(cells, "month")).select(F.col("cell").cast("timestamp_ntz").alias("month"), "n", "distinct", "q50")
    rows = orders.withColumn("month", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")).join(F.broadcast(months), "month")
    exact = rows.groupBy("month").agg(
        F.max("n").alias("n"), F.count_distinct("o_custkey").alias("customers"), F.max("distinct").alias("distinct"),
        F.avg((F.col("o_totalprice") < F.col("q50")).cast("double")).alias("below"), F.avg((F.col("o_totalprice") <= F.col("q50")).cast("double")).alias("upto"))
    close = F.abs(F.col("distinct") - F.col("customers")) <= 0.06 * F.col("customers") + 1
    return exact.select("month", "n", "customers", close.alias("distinct_close"), ((F.col("below") <= 0.52) & (F.col("upto") >= 0.48)).alias("middle_close"))


@query("select ts::date as date, hour(ts)::bigint as hour, 0::bigint as n from events where false")
def no_hits(spark, sf_dir):
    """Keywords that nobody said: a typed table without rows."""
    articles, comments = thread_parts(spark, sf_dir)
    cells = volume.volume_cells(volume.keyword_hits(articles, comments, ["nobody said this"], *time_range(START, END)))
    return cells.select("date", F.col("hour").cast("bigint").alias("hour"), F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


@query(f"""with {SQL_THREADS} select ts as publish_time, 1::bigint as comment_count from articles
where ts {_BETWEEN} and regexp_matches(event_type, '{_PATTERN}')""")
def article_hits(spark, sf_dir):
    articles, _ = thread_parts(spark, sf_dir)
    return volume.article_hits(articles, KEYWORDS, *time_range(START, END))


@query(f"""with {SQL_THREADS} select ts as publish_time, 1::bigint as comment_count from comments
where ts {_BETWEEN} and regexp_matches(event_type, '{_PATTERN}')""")
def comment_hits(spark, sf_dir):
    _, comments = thread_parts(spark, sf_dir)
    return volume.comment_hits(comments, KEYWORDS, *time_range(START, END))


@query("""select 'early' as policy, count(*) as n, min(ts) as first_ts, max(ts) as last_ts from events
  where ts between timestamp '2024-01-10 00:00:00' and timestamp '2024-01-20 23:59:59'
union all select 'late', count(*), min(ts), max(ts) from events
  where ts between timestamp '2024-01-10 23:59:59' and timestamp '2024-01-20 00:00:00'""")
def reversed_range(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    parts = [
        events.where(in_range("ts", *time_range("2024-01-20", "2024-01-10", swap))).agg(
            F.lit(swap).alias("policy"), F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        for swap in ("early", "late")
    ]
    return parts[0].unionByName(parts[1])


@query("""with hits as (
  select o_orderdate as ts from orders where regexp_matches(o_orderpriority, 'URGENT|HIGH')
  union all select l_shipdate from lineitem where regexp_matches(l_returnflag, 'R'))
select ts::date as date, count(*)::bigint as n from hits
where ts between timestamp '1996-01-01' and timestamp '1997-12-31 23:59:59' group by 1""")
def post_volume(spark, sf_dir):
    """Hits over orders as articles and their lines as comments, by date."""
    span = time_range("1996-01-01", "1997-12-31")
    posts = volume.article_hits(table(spark, sf_dir, "orders"), ["URGENT", "HIGH"], *span, text="o_orderpriority", time="o_orderdate")
    lines = volume.comment_hits(table(spark, sf_dir, "lineitem"), ["R"], *span, text="l_returnflag", time="l_shipdate")
    return posts.unionByName(lines).groupBy(F.to_date("publish_time").alias("date")).agg(F.sum("comment_count").alias("n"))
