"""Forum pages: documents are wrapped in board markup and must come back from extraction."""

from pyspark.sql import functions as F

from hubbub.functions.times import epoch_wall
from hubbub.plans import forum
from workload.base import query, texts

BASE = "https://forum.example.net"
PER_PAGE = 20


def escape(c):
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def lines_of(c="text"):
    return F.split(c, "\n")


def _line(kind, name, value):
    return F.concat(
        F.lit(f'<div class="{kind}"><span class="article-meta-tag">{name}</span><span class="article-meta-value">'),
        escape(value), F.lit("</span></div>"))


def article_pages(spark, sf_dir):
    """One article page per document: line 1 is title and body, the other lines are pushes.

    German pages have no header lines, Spanish ones no author; French push times lack the clock.
    Lines that start with 'The' are incomplete pushes. src17 has a bad address, src18 no content
    container and src19 answers 404.
    """
    docs = texts(spark, sf_dir, "documents", "doc_id")
    epoch = F.lit(1704067200) + F.col("doc_id") * 3600
    published = epoch_wall(epoch)
    lang, source = F.col("lang"), F.col("source")
    address = F.when(source == "src17", F.concat(F.lit(f"{BASE}/bbs/x/D"), F.col("doc_id"))).otherwise(
        F.concat(F.lit(f"{BASE}/bbs/"), lang, F.lit("/M."), epoch, F.lit(".A."), F.hex("doc_id"), F.lit(".html")))
    first = F.get(lines_of(), F.lit(0))
    header = F.when(lang == "de", "").when(
        lang == "es", F.concat(_line("article-metaline-right", "看板", lang), _line("article-metaline", "標題", first))
    ).otherwise(F.concat(
        _line("article-metaline-right", "看板", lang), _line("article-metaline", "作者", source), _line("article-metaline", "標題", first)))

    def push(line, i):
        at = (published + F.make_dt_interval(F.lit(0), i + 1, F.lit(0), F.lit(0))).cast("string")
        day = F.replace(F.substring(at, 6, 5), F.lit("-"), F.lit("/"))
        clock = F.substring(at, 12, 5)
        stamp = F.when(lang == "fr", day).when(lang == "en", F.concat(F.lit("1.2.3.4 "), day, F.lit(" "), clock)).otherwise(
            F.concat(day, F.lit("  "), clock))
        time = F.when(line.startswith("The"), "").otherwise(
            F.concat(F.lit('<span class="push-ipdatetime"> '), stamp, F.lit("\n</span>")))
        return F.concat(
            F.lit('<div class="push"><span class="hl push-tag">推 </span><span class="f3 push-userid">'), source,
            F.lit('</span><span class="f3 push-content">: '), escape(line), F.lit("</span>"), time, F.lit("</div>\n"))

    count = F.size(lines_of())
    pushes = F.array_join(F.transform(F.slice(lines_of(), F.lit(2), count), push), "")
    html = F.concat(
        F.lit('<html><body><div id="topbar-container"><a class="board" href="/">看板'), lang, F.lit("</a></div>"),
        F.when(source == "src18", '<div id="other">').otherwise('<div id="main-content" class="bbs-screen">'),
        header, F.lit("\n"), escape(first), F.lit('\n<!-- note --><span class="f2">※ 發信站</span>'), pushes, F.lit("<div class=\"richcontent\">img</div></div></body>"))
    return docs.select("doc_id", address.alias("url"), F.when(source == "src19", 404).otherwise(200).alias("status_code"), html.alias("html"))


_SQL_DOCS = f"""
d as (select *, 1704067200 + doc_id * 3600 as epoch, string_split(text, chr(10)) as lines from documents),
a as (select *, case when source = 'src17' then '{BASE}/bbs/x/D' || doc_id else '{BASE}/bbs/' || lang || '/M.' || epoch || '.A.' || hex(doc_id) || '.html' end as article_url,
    make_timestamp(epoch * 1000000) + interval 8 hour as published,
    case when source = 'src17' then 'bad_url' when source = 'src19' then 'http_error' when source = 'src18' then 'no_container' else 'ok' end as status from d),
l as (select doc_id, article_url, lang, source, published, status, unnest(lines[2:]) as line, unnest(range(len(lines) - 1)) as i from a),
c as (select *, published + to_hours(i + 1) as at_time, row_number() over (partition by doc_id order by i) - 1 as comment_ix from l where not starts_with(line, 'The'))
"""


@query(f"""with {_SQL_DOCS} select article_url, status,
  case when lang = 'de' then '無標題' else trim(lines[1]) end as article_title, lang as article_category,
  case when lang = 'de' then '' when lang = 'es' then 'unknown' else source end as article_author,
  strftime(published, '%Y-%m-%d %H:%M:%S') as publish_time, trim(lines[1]) as content_raw,
  (select count(*) from c where c.doc_id = a.doc_id)::bigint as comment_count from a where status = 'ok'""")
def forum_articles(spark, sf_dir):
    good, _ = forum.good_and_bad(forum.parse_articles(article_pages(spark, sf_dir)))
    return good.select("article_url", "status", "article_title", "article_category", "article_author",
                       "publish_time", "content_raw", "comment_count")


@query(f"""with {_SQL_DOCS} select article_url, comment_ix::bigint as comment_ix, source as comment_author,
  case when lang = 'fr' then 'Unknown' else strftime(at_time, '%m/%d %H:%M') end as comment_raw_time,
  case when lang = 'fr' then '1970-01-01 00:00:00' else strftime(at_time, '%Y-%m-%d %H:%M:00') end as comment_date_format,
  '推' as comment_tag, trim(line) as comment_content from c where status = 'ok'""")
def forum_comments(spark, sf_dir):
    from hubbub.operators.units import explode_comments

    good, _ = forum.good_and_bad(forum.parse_articles(article_pages(spark, sf_dir)))
    rows = explode_comments(good)
    return rows.select("article_url", F.col("comment_ix").cast("bigint").alias("comment_ix"), "comment_author",
                       "comment_raw_time", "comment_date_format", "comment_tag", "comment_content")


@query(f"""with {_SQL_DOCS} select article_url, case when lang <> 'de' then lang end as board, case when lang in ('en', 'fr') then source end as author,
  case when lang <> 'de' then trim(lines[1]) end as title,
  trim(lines[1]) as content, coalesce((select string_agg(trim(line), '|' order by i) from c where c.doc_id = a.doc_id), '') as comments from a where status = 'ok'""")
def forum_legacy_articles(spark, sf_dir):
    good, _ = forum.good_and_bad(forum.parse_articles(article_pages(spark, sf_dir)))
    plain = forum.legacy_article(good)
    return plain.select("article_url", F.col("meta")["看板"].alias("board"), F.col("meta")["作者"].alias("author"),
                        F.col("meta")["標題"].alias("title"), "content",
                        F.array_join(F.transform("comment", lambda c: c["content"]), "|").alias("comments"))


@query(f"""with {_SQL_DOCS}, rows_ as (
  select article_url, case when status = 'ok' then null else status end as bad,
    status = 'ok' and lang in ('de', 'es') as no_meta,
    status = 'ok' and exists (select 1 from c where c.doc_id = a.doc_id and c.lang = 'fr') as bad_date from a)
select article_url, 'Error: ' || case when bad = 'http_error' then 'HTTP 404' else bad end as problem from rows_ where bad is not null
union all select article_url, 'Missing Meta' from rows_ where no_meta
union all select article_url, 'Invalid Date' from rows_ where bad_date""")
def forum_row_audit(spark, sf_dir):
    from hubbub.operators.audit import row_audit

    return row_audit(forum.parse_articles(article_pages(spark, sf_dir)))


@query(f"""with {_SQL_DOCS} select doc_id as seq, article_url, case when lang = 'es' then 'http_error' else status end as status from a""")
def task_results(spark, sf_dir):
    """Tasks joined to landed pages; Spanish pages never landed and give error rows."""
    pages = article_pages(spark, sf_dir)
    tasks = pages.select(F.col("doc_id").alias("seq"), "url")
    docs = texts(spark, sf_dir, "documents", "doc_id").where(F.col("lang") != "es").select("doc_id")
    landed = pages.join(docs, "doc_id", "left_semi").drop("doc_id")
    return forum.task_articles(tasks, landed).select("seq", "article_url", "status")


def index_pages(spark, sf_dir):
    """Board index pages of 20 documents each (a page never holds more): German ones are pinned below
    the separator, Spanish ones were deleted and have no link."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    page = F.floor(F.col("doc_id") / PER_PAGE)
    first = escape(F.get(lines_of(), F.lit(0)))
    link = F.when(F.col("lang") == "es", "(deleted)").otherwise(
        F.concat(F.lit('<a href="/bbs/x/'), F.col("doc_id"), F.lit('.html">'), first, F.lit("</a>")))
    date = F.format_string("%2d/%02d", F.pmod(F.col("n_chars"), F.lit(12)) + 1, F.pmod(F.col("n_chars"), F.lit(28)) + 1)
    entry = F.concat(F.lit('<div class="r-ent"><div class="title">'), link, F.lit('</div><div class="meta"><div class="date">'), date, F.lit("</div></div></div>"))
    rows = docs.select(page.alias("page_seq"), (F.col("lang") == "de").alias("pinned"), "doc_id", entry.alias("entry"))
    # At most PER_PAGE entries share a page number, because doc_id is unique.
    pages = rows.groupBy("page_seq").agg(F.array_sort(F.collect_list(F.struct("pinned", "doc_id", "entry"))).alias("e"))

    def html(pinned):
        return F.array_join(F.transform(F.filter("e", lambda x: x["pinned"] == pinned), lambda x: x["entry"]), "")

    separator = F.when(F.exists("e", lambda x: x["pinned"]), '<div class="r-list-sep"></div>').otherwise("")
    previous = F.when(F.col("page_seq") > 0, F.concat(F.lit('<a class="btn wide" href="/bbs/x/index'), F.col("page_seq") - 1, F.lit('.html">‹ 上頁</a>'))).otherwise(
        '<a class="btn wide disabled">‹ 上頁</a>')
    return pages.select(
        F.lit("x").alias("board"), "page_seq",
        F.concat(F.lit('<div class="btn-group btn-group-paging"><a class="btn wide" href="/bbs/x/index1.html">最舊</a>'), previous,
                 F.lit('</div><div class="r-list-container">'), html(False), separator, html(True), F.lit("</div>")).alias("html"))


@query(f"""with e as (select doc_id, doc_id // {PER_PAGE} as page_seq, lang, lang = 'de' as pinned, string_split(text, chr(10))[1] as title,
    lpad((n_chars % 12 + 1)::varchar, 2, ' ') || '/' || lpad((n_chars % 28 + 1)::varchar, 2, '0') as date from documents),
p as (select *, row_number() over (partition by page_seq order by pinned, doc_id) - 1 as pos from e)
select 'x' as board, page_seq, pos::bigint as pos, title, '{BASE}/bbs/x/' || doc_id || '.html' as url, date, pinned from p where lang <> 'es'""")
def forum_index(spark, sf_dir):
    from hubbub.operators.listing import valid_entries

    rows = valid_entries(forum.index_entries(index_pages(spark, sf_dir), BASE))
    return rows.select("board", "page_seq", F.col("pos").cast("bigint").alias("pos"), "title", "url", "date", "pinned")


@query(f"""select distinct 'x' as board, doc_id // {PER_PAGE} as page_seq,
  case when doc_id // {PER_PAGE} > 0 then '{BASE}/bbs/x/index' || (doc_id // {PER_PAGE} - 1) || '.html' end as prev_url from documents""")
def forum_previous_pages(spark, sf_dir):
    return forum.previous_pages(index_pages(spark, sf_dir), BASE)


@query(f"""select doc_id, case lang when 'en' then '{BASE}/p/' || doc_id when 'fr' then '{BASE}/bold/' || doc_id end as prev_url from documents""")
def forum_previous_anywhere(spark, sf_dir):
    """The older form: any link of the page that says so. French links wrap the text, German ones hold more than a text."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    link = lambda place, inside: F.concat(F.lit(f'<p><a href="/{place}/'), F.col("doc_id"), F.lit(f'">{inside}</a></p>'))
    chosen = F.when(F.col("lang") == "en", link("p", "‹ 上頁 x")).when(F.col("lang") == "fr", link("bold", "<b><i>上頁</i></b>")).when(F.col("lang") == "de", link("mixed", "<b>上頁</b> more")).otherwise("")
    html = F.concat(F.lit('<a href="/first">other</a>'), chosen, link("late", "none"))
    return forum.previous_pages(docs.select("doc_id", html.alias("html")), BASE, anywhere=True)
