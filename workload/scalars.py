"""Text, address and time expressions over whole tables."""

from pyspark.sql import functions as F

from hubbub.functions import text, times, urls
from hubbub.operators import audit
from hubbub.operators.joins import skewed_join
from hubbub.operators.ranking import cap_comments
from workload.base import query, table, texts

WALL = text.WS
_LINES = f"""list_filter(list_transform(string_split_regex(text, '{text.LINE_BREAK}'),
  lambda x: regexp_replace(x, '^{WALL}+|{WALL}+$', '', 'g')), lambda x: x <> '')"""
_LINE1 = "string_split(text, chr(10))[1]"


@query(rf"""with d as (select doc_id, text, {_LINES} as parts, string_split({_LINE1}, ' ') as words from documents)
select doc_id, len(parts)::bigint as line_sentences, left(text, 50) as preview, length(text)::bigint as n_chars,
  regexp_replace({_LINE1}, '[\\/:*?"<>|]', '_', 'g') as safe_title,
  case when len(words) > 5 then array_to_string(words[1:3], '、') || '...' else array_to_string(words, '、') end as label,
  len(words)::varchar || '. ' || words[1] || ' (' || length(text)::varchar || ')' as rank_label
from d where {_LINE1} <> ''""")
def text_scalars(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id")
    first = F.get(F.split("text", "\n"), F.lit(0))
    words = F.split(first, " ")
    return docs.where(first != "").select(
        "doc_id",
        F.size(text.sentences("text", by_line=True)).cast("bigint").alias("line_sentences"),
        text.preview("text", 50).alias("preview"),
        F.char_length("text").cast("bigint").alias("n_chars"),
        text.file_safe(first).alias("safe_title"),
        text.keyword_label(words).alias("label"),
        text.rank_label(F.size(words), F.get(words, F.lit(0)), F.char_length("text")).alias("rank_label"),
    )


@query(r"""select page_id, string_split(url, '?')[1] || case when string_split(url, '?')[1] like '%/' then '' else '/' end as canonical,
  replace(url, 'example.com', 'example.net') as rewritten,
  string_split(string_split(url, '/en/')[-1], '?')[1] as post_id,
  'https://base.example' || replace('./' || split_part(url, '/', 3), './', '/') as absolute,
  (1700000000 + page_id * 60)::bigint as epoch, try_cast(string_split(string_split(url, '/')[-1], '.')[2] as bigint) as own_epoch
from pages""")
def url_functions(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    named = F.concat(F.lit("https://f.example/b/M."), F.lit(1700000000) + F.col("page_id") * 60, F.lit(".A."), F.hex("page_id"), F.lit(".html"))
    relative = F.concat(F.lit("./"), F.split_part("url", F.lit("/"), F.lit(3)))
    return pages.select(
        "page_id", urls.canonical_url("url").alias("canonical"),
        urls.rewrite_host("url", "example.com", "example.net").alias("rewritten"),
        urls.post_id("url", "/en/").alias("post_id"),
        urls.absolute_url("https://base.example", relative).alias("absolute"),
        times.url_epoch(named).alias("epoch"), times.url_epoch("url").alias("own_epoch"),
    )


@query("""with e as (select event_id, date_trunc('second', ts) as s, event_type = 'error' as bad, event_type = 'view' as west from events)
select event_id, strftime(s + interval 8 hour, '%Y-%m-%d %H:%M:%S') as from_epoch,
  case when not bad then strftime(s + interval 8 hour, '%Y-%m-%d %H:%M:%S') end as from_iso,
  case when not bad then strftime(case when west then s + interval 11 hour + interval 30 minute else s + interval 2 hour + interval 30 minute end,
    '%Y-%m-%d %H:%M:%S') end as from_offset,
  case when not bad then strftime(s, '%Y-%m-%d %H:%M:%S') end as wall,
  year(s)::bigint as y, month(s)::bigint as m, day(s)::bigint as d, hour(s)::bigint as h from e""")
def time_conversions(spark, sf_dir):
    """Epoch, ISO and offset times; error events carry unreadable text, which must give NULL."""
    events = table(spark, sf_dir, "events")
    bad, wall = F.col("event_type") == "error", times.wall_text("ts")
    date, clock = F.left(wall, F.lit(10)), F.substring(wall, 12, 8)
    zone = F.when(F.col("event_type") == "view", "-03:30").otherwise("+05:30")
    broken = F.lit("13/45 late")
    epoch = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    return events.select(
        "event_id",
        times.wall_text(times.epoch_wall(epoch)).alias("from_epoch"),
        times.wall_text(times.iso_utc_wall(F.when(bad, broken).otherwise(F.concat(date, F.lit("T"), clock, F.lit(".250Z"))))).alias("from_iso"),
        times.wall_text(times.iso_offset_wall(F.when(bad, broken).otherwise(F.concat(date, F.lit("T"), clock, zone)))).alias("from_offset"),
        times.wall_text(times.parse_wall(F.when(bad, broken).otherwise(wall))).alias("wall"),
        F.year("ts").cast("bigint").alias("y"), F.month("ts").cast("bigint").alias("m"),
        F.dayofmonth("ts").cast("bigint").alias("d"), F.hour("ts").cast("bigint").alias("h"),
    )


def comment_lines(spark, sf_dir):
    """Lines as comments of orders with a year-less time: well formed, unpadded, with seconds (R,
    not readable) or on Feb 29 (line 7)."""
    lines = texts(spark, sf_dir, "lineitem", "l_orderkey").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("published"),
        (F.col("o_orderstatus") != "P").alias("has_header"))
    day, month = F.dayofmonth("l_shipdate"), F.month("l_shipdate")
    raw = (
        F.when(F.col("l_linenumber") == 7, "02/29 10:00")
        .when(F.col("l_returnflag") == "R", F.format_string("%02d/%02d 10:00:01", month, day))
        .when(F.col("l_returnflag") == "A", F.format_string("%d/%d 9:05", month, day))
        .otherwise(F.format_string("%02d/%02d 18:30", month, day))
    )
    return skewed_join(lines.withColumn("raw", raw), orders, "l_orderkey", how="inner")


SQL_LINES = """
lines as (
  select l_orderkey, l_linenumber, o_orderdate as published, o_orderstatus <> 'P' as has_header,
    case when l_linenumber = 7 then '02/29 10:00'
      when l_returnflag = 'R' then printf('%02d/%02d 10:00:01', month(l_shipdate), day(l_shipdate))
      when l_returnflag = 'A' then printf('%d/%d 9:05', month(l_shipdate), day(l_shipdate))
      else printf('%02d/%02d 18:30', month(l_shipdate), day(l_shipdate)) end as raw
  from lineitem join orders on l_orderkey = o_orderkey),
parts as (select *, regexp_extract(raw, '^([0-9]{1,2})/([0-9]{1,2}) ([0-9]{1,2}):([0-9]{1,2})$', ['mo', 'da', 'ho', 'mi']) as p from lines),
tried as (select *,
  try_cast(printf('%d-', year(published)) || lpad(p.mo, 2, '0') || '-' || lpad(p.da, 2, '0') || ' ' || lpad(p.ho, 2, '0') || ':' || lpad(p.mi, 2, '0') || ':00' as timestamp) as same_year,
  try_cast(printf('%d-', year(published) + 1) || lpad(p.mo, 2, '0') || '-' || lpad(p.da, 2, '0') || ' ' || lpad(p.ho, 2, '0') || ':' || lpad(p.mi, 2, '0') || ':00' as timestamp) as next_year
  from parts),
inferred as (select *, coalesce(case when same_year is null then null
    when month(same_year) < month(published) then next_year else same_year end, timestamp '1970-01-01') as by_month,
  case when same_year is null then null when has_header and published > same_year then next_year else same_year end as by_time
  from tried)
"""


@query(f"with {SQL_LINES} select l_orderkey, l_linenumber, raw, strftime(by_month, '%Y-%m-%d %H:%M:%S') as comment_date_format from inferred")
def comment_year_inferred(spark, sf_dir):
    time = times.comment_time("raw", "published")
    return comment_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "raw", times.wall_text(time).alias("comment_date_format"))


@query(f"with {SQL_LINES} select l_orderkey, l_linenumber, raw, strftime(by_time, '%Y-%m-%d %H:%M:%S') as comment_date_format from inferred")
def comment_year_full_policy(spark, sf_dir):
    time = times.comment_time("raw", "published", policy="full", has_header="has_header")
    return comment_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "raw", times.wall_text(time).alias("comment_date_format"))


@query(f"""with {SQL_LINES} select l_orderkey, count(*) as comments, count(*) filter (where year(by_month) = 1970) as invalid,
  max(year(by_month))::bigint as last_year, max(month(by_month))::bigint as last_month, max(day(by_month))::bigint as last_day
from inferred group by 1 having count(*) filter (where year(by_month) = 1970) > 0""")
def sentinel_audit(spark, sf_dir):
    timed = comment_lines(spark, sf_dir).withColumn("time", times.comment_time("raw", "published"))
    timed = timed.select("l_orderkey", times.wall_text("time").alias("text"), *times.date_parts("time", "comment"))
    found = timed.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("comments"), F.count_if(audit.is_sentinel("text")).alias("invalid"),
        *[F.max(f"comment_{part}").cast("bigint").alias(f"last_{part}") for part in ("year", "month", "day")])
    return found.where("invalid > 0")


_CAP_ORDER = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


@query(f"""with r as (select *, row_number() over (partition by l_orderkey order by {_CAP_ORDER}) as rn from lineitem)
select 'exact' as policy, l_orderkey, l_shipdate, l_linenumber, l_partkey from r where rn <= 3
union all select 'by page', l_orderkey, l_shipdate, l_linenumber, l_partkey from r where rn <= 4""")
def comment_cap(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    order = [F.col(c.strip()) for c in _CAP_ORDER.split(",")]
    columns = ["l_orderkey", "l_shipdate", "l_linenumber", "l_partkey"]
    exact = cap_comments(lines, "l_orderkey", order, 3).select(F.lit("exact").alias("policy"), *columns)
    paged = cap_comments(lines, "l_orderkey", order, 3, page=2).select(F.lit("by page").alias("policy"), *columns)
    return exact.unionByName(paged)
