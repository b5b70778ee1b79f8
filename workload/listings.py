"""Listing order, stops, caps, pinned posts and one row per key."""

from pyspark.sql import functions as F

from hubbub.functions.text import output_name
from hubbub.functions.urls import canonical_url
from hubbub.operators import audit, listing
from hubbub.operators.dedup import first_per_key, last_per_key
from hubbub.operators.ranking import number_rows
from hubbub.plans import listings
from workload.base import query, table, texts

YEAR, AS_OF, STOP_DATE, CAP = 2001, "2001-08-01 00:00:00", "2000-10-01 00:00:00", 500


def order_entries(spark, sf_dir):
    """Orders as board entries: one page per day, newest day first; cheap orders lost their link and
    the dearest ones are pinned."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("board"),
        F.date_diff(F.lit("2001-12-31").cast("date"), F.to_date("o_orderdate")).alias("page_seq"),
        F.col("o_orderkey").alias("pos"),
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("title"),
        F.when(price >= 50000, F.concat(F.lit("/o/"), F.col("o_orderkey"))).alias("url"),
        F.format_string("%2d/%02d", F.month("o_orderdate"), F.dayofmonth("o_orderdate")).alias("date"),
        (price > 450000).alias("pinned"),
    )


SQL_TASKS = f"""
entries as (select o_orderpriority as board, date_diff('day', o_orderdate, timestamp '2001-12-31')::bigint as page_seq, o_orderkey as pos,
    'order ' || o_orderkey as title, '/o/' || o_orderkey as url, o_totalprice > 450000 as pinned,
    lpad(month(o_orderdate)::varchar, 2, ' ') || '/' || lpad(day(o_orderdate)::varchar, 2, '0') as date,
    try_cast('{YEAR}-' || strftime(o_orderdate, '%m-%d') as timestamp) as parsed from orders where o_totalprice >= 50000),
placed as (select *, row_number() over (partition by board order by page_seq, pos desc) as rn from entries where not pinned),
dated as (select *, case when rn > 1 and parsed > timestamp '{AS_OF}' then parsed - interval 1 year else parsed end as d from placed),
running as (select *, sum(case when d < timestamp '{STOP_DATE}' then 1 else 0 end) over (partition by board order by page_seq, pos desc) as stopped from dated),
normal as (select board, title, url, date, pinned, page_seq, pos, d as parsed_date, row_number() over (partition by board order by page_seq, pos desc) - 1 as seq
  from running where stopped = 0 qualify seq < {CAP}),
first_page as (select board, min(page_seq) as page_seq from entries where pinned group by 1),
sizes as (select board, count(*) as size from normal group by 1),
tail as (select e.*, row_number() over (partition by e.board order by pos) - 1 as n from entries e join first_page f on e.board = f.board and e.page_seq = f.page_seq where pinned),
tasks as (select board, title, url, date, pinned, page_seq, seq from normal
  union all select t.board, title, url, date, pinned, page_seq, coalesce(size, 0) + n from tail t left join sizes using (board))
"""


@query(f"with {SQL_TASKS} select board, seq::bigint as seq, title, url, date, parsed_date from normal")
def post_date_window(spark, sf_dir):
    entries = order_entries(spark, sf_dir)
    dated = listing.date_entries(listing.valid_entries(entries), YEAR, AS_OF).where(~F.col("pinned"))
    kept = listing.capped(listing.until_stop_date(dated, STOP_DATE), CAP)
    return kept.select("board", "seq", "title", "url", "date", "parsed_date")


@query(f"with {SQL_TASKS} select board, seq::bigint as seq, title, url, date, pinned from tasks")
def pinned_appended(spark, sf_dir):
    tasks = listing.task_list(order_entries(spark, sf_dir), YEAR, AS_OF, STOP_DATE, CAP)
    return tasks.select("board", "seq", "title", "url", "date", "pinned")


@query(f"""with {SQL_TASKS} select board, count(*) filter (where not pinned) as normal_count, count(*) filter (where pinned) as pinned_count,
  arg_max(title, seq) filter (where not pinned) as last_title, arg_max(url, seq) filter (where not pinned) as last_url,
  max(page_seq) filter (where not pinned)::bigint as last_page from tasks group by 1""")
def listing_totals(spark, sf_dir):
    totals = audit.listing_totals(listing.task_list(order_entries(spark, sf_dir), YEAR, AS_OF, STOP_DATE, CAP))
    return totals.withColumn("last_page", F.col("last_page").cast("bigint"))


@query("select o_orderkey, row_number() over (order by o_orderdate desc, o_orderkey) as number from orders")
def numbered_posts(spark, sf_dir):
    """One running number over all posts, newest first."""
    posts = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return number_rows(posts, [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()]).select("o_orderkey", "number")


_NAME = r"""lang || '_' || regexp_replace(string_split(text, chr(10))[1], '[\\/:*?"<>|]', '_', 'g')"""


@query(f"select {_NAME} as output_name, max(doc_id) as doc_id, arg_max(source, doc_id) as source from documents group by 1")
def dedup_by_name(spark, sf_dir):
    """The last document wins among those that would be written under one name."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    named = docs.select("doc_id", "source", output_name("lang", F.get(F.split("text", "\n"), F.lit(0))).alias("output_name"))
    return last_per_key(named, ["output_name"], ["doc_id"])


@query("""with u as (select page_id, string_split(url, '?')[1] as base from pages),
c as (select page_id, base || case when base like '%/' then '' else '/' end as url from u)
select url, min(page_id) as page_id from c group by 1""")
def dedup_first_url(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", canonical_url("url").alias("url"))
    return first_per_key(pages, ["url"], ["page_id"])


@query("""with c as (select source, doc_id, string_split(text, chr(10))[1] as title from documents)
select title, arg_min(source, (source, doc_id)) as source, arg_min(doc_id, (source, doc_id)) as doc_id from c group by 1""")
def dedup_across_passes(spark, sf_dir):
    """Each source is one scroll pass; a title counts at its first place only."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    found = docs.select("source", "doc_id", F.get(F.split("text", "\n"), F.lit(0)).alias("title"))
    return listings.new_cards(found, ["source", "doc_id"])


_UNESCAPED = "replace({0}, '&amp;', '&')"


@query(f"""with l as (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) as href,
  unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) as title,
  unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)">', 1)))) as pos from pages),
t as (select page_id, pos, {_UNESCAPED.format('title')} as title, 'https://base.example' || {_UNESCAPED.format('href')} as link from l where title <> '')
select link, arg_min(title, (page_id, pos)) as title, min(page_id) as page_id from t group by 1""")
def html_link_list(spark, sf_dir):
    """Links of all pages, each address at its first place."""
    pages = texts(spark, sf_dir, "pages", "page_id").select("page_id", "html")
    links = first_per_key(listings.page_links(pages, "https://base.example"), ["link"], ["page_id", "pos"])
    return links.select("link", "title", "page_id")
