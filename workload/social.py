"""Social pages, news pages and API payloads built from rows, and their way back."""

from pyspark.sql import functions as F

from hubbub.operators.units import explode_comments
from hubbub.plans import listings, social
from workload.base import query, table, texts
from workload.forum import escape, lines_of

NEWS = "https://news.example.org"


def _first():
    return F.get(lines_of(), F.lit(0))


def _meta(name, content):
    return F.concat(F.lit(f'<meta property="og:{name}" content="'), escape(content), F.lit('">'))


def _iso(seconds, tail):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    at = (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))).cast("string")
    return F.concat(F.left(at, F.lit(10)), F.lit("T"), F.substring(at, 12, 8), F.lit(tail))


def threads_pages(spark, sf_dir):
    """English and German pages carry JSON-LD behind an unreadable and a foreign block, the others
    Open Graph tags (Spanish ones none)."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    stats = F.array(*[
        F.struct(F.lit(f"https://schema.org/{kind}").alias("interactionType"), count.cast("bigint").alias("userInteractionCount"))
        for kind, count in (("LikeAction", F.lit(1)), ("CommentAction", F.col("doc_id")), ("LikeAction", F.col("n_chars")))
    ])
    person = F.struct(F.col("source").alias("name"))

    def ld(author):
        return F.to_json(F.struct(
            _first().alias("headline"), F.col("text").alias("articleBody"), _iso(F.col("doc_id") * 60, "+05:30").alias("datePublished"),
            author.alias("author"), stats.alias("interactionStatistic")))

    block = F.when(F.col("lang") == "en", ld(person)).otherwise(ld(F.array(person)))
    script = '<script type="application/ld+json">'
    with_ld = F.concat(F.lit(script + "{broken</script>" + script + '{"@type": "WebSite"}</script>' + script), block, F.lit("</script>"))
    with_og = F.concat(_meta("title", F.concat("source", F.lit(' on Threads: "..."'))), _meta("description", F.col("text")))
    head = F.when(F.col("lang").isin("en", "de"), with_ld).when(F.col("lang") == "fr", with_og).otherwise("")
    return docs.select("doc_id", F.concat(F.lit("https://www.threads.com/p/"), F.col("doc_id")).alias("url"),
                       F.concat(F.lit("<html><head>"), head, F.lit("</head><body></body></html>")).alias("html"))


_T = "strftime(timestamp '2024-01-01' + to_seconds(doc_id * 60) + interval 2 hour + interval 30 minute, '%Y-%m-%d %H:%M:%S')"


@query(f"""select 'https://www.threads.net/p/' || doc_id as article_url,
  case when lang in ('en', 'de') then string_split(text, chr(10))[1] when lang = 'fr' then 'Threads Post by ' || source else 'Threads Post by Unknown' end as article_title,
  case when lang in ('en', 'de', 'fr') then source else 'Unknown' end as article_author,
  case when lang in ('en', 'de') then {_T} end as publish_time,
  case when lang in ('en', 'de', 'fr') then text else '' end as content_raw,
  case when lang in ('en', 'de') then n_chars else 0 end as reaction_count,
  case when lang in ('en', 'de') then doc_id else 0 end as comment_count from documents""")
def threads_articles(spark, sf_dir):
    return social.threads_articles(threads_pages(spark, sf_dir)).select(
        "article_url", "article_title", "article_author", "publish_time", "content_raw", "reaction_count", "comment_count")


@query(f"""select 'https://www.threads.net/p/' || doc_id as article_url, case when lang = 'es' then 'Threads Post by Unknown' else 'T' || doc_id end as article_title,
  case when lang = 'es' then 'Unknown' else source end as article_author, case when lang = 'es' then '' else text end as content_raw,
  case when lang = 'es' then 0 else n_chars end as reaction_count from documents""")
def linked_data_shapes(spark, sf_dir):
    """The article is one of a list (English), part of a graph (German) or an object of its own (French)."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    stats = F.array(F.struct(F.lit("https://schema.org/LikeAction").alias("interactionType"), F.col("n_chars").alias("userInteractionCount")))
    person = F.struct(F.col("source").alias("name"))
    article = lambda author: F.to_json(F.struct(F.concat(F.lit("T"), "doc_id").alias("headline"), F.col("text").alias("articleBody"), author.alias("author"), stats.alias("interactionStatistic")))
    block = (
        F.when(F.col("lang") == "en", F.concat(F.lit('[{"@type": "WebSite"}, 7, '), article(F.array(person)), F.lit("]")))
        .when(F.col("lang") == "de", F.concat(F.lit('{"@context": "x", "@graph": [{"@type": "Person"}, '), article(person), F.lit("]}")))
        .when(F.col("lang") == "fr", article(person)).otherwise("[]"))
    script = '<script type="application/ld+json">'
    html = F.concat(F.lit("<html><head>" + script + "[broken</script>" + script), block, F.lit("</script></head></html>"))
    pages = docs.select("doc_id", F.concat(F.lit("https://www.threads.com/p/"), F.col("doc_id")).alias("url"), html.alias("html"))
    return social.threads_articles(pages).select("article_url", "article_title", "article_author", "content_raw", "reaction_count")


def instagram_pages(spark, sf_dir):
    """Spanish pages are login walls, German ones have a plain description."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    quoted = F.concat(F.lit("12 likes, 3 comments - "), "source", F.lit(' on May 1: "'), "text", F.lit('"'))
    description = F.when(F.col("lang") == "de", F.col("text")).otherwise(quoted)
    title = F.when(F.col("lang") == "es", "Login • Instagram").otherwise("Post")
    return docs.select(
        "doc_id", F.concat(F.lit("https://ig.example/p/"), F.col("doc_id"), F.lit("/?img_index=1")).alias("url"),
        F.concat(F.lit("<title>"), title, F.lit("</title>"), _meta("title", F.concat("source", F.lit(" on Instagram: x"))),
                 _meta("description", description)).alias("html"))


@query("""with d as (select *, case when lang = 'de' then text else '12 likes, 3 comments - ' || source || ' on May 1: "' || text || '"' end as t from documents),
q as (select *, instr(t, ': "') > 0 as quoted from d)
select 'https://ig.example/p/' || doc_id || '/' as article_url, case when quoted then source else 'Unknown' end as article_author,
  'IG Post by ' || case when quoted then source else 'Unknown' end as article_title,
  case when quoted then rtrim(substr(t, instr(t, ': "') + 3), '"') else t end as content_raw,
  case when lang = 'es' then 'login_wall' else 'ok' end as status from q""")
def instagram_articles(spark, sf_dir):
    return social.instagram_articles(instagram_pages(spark, sf_dir)).select(
        "article_url", "article_author", "article_title", "content_raw", "status")


def news_pages(spark, sf_dir):
    """Lines are paragraphs and also comments one hour apart; French pages have no heading."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    heading = F.when(F.col("lang") == "fr", "").otherwise(F.concat(F.lit("<h1>"), escape(_first()), F.lit("</h1>")))
    paragraphs = F.array_join(F.transform(lines_of(), lambda x: F.concat(F.lit("<p>"), escape(x), F.lit("</p>"))), "")
    messages = F.to_json(F.transform(lines_of(), lambda x, i: F.struct(
        F.col("source").alias("user"), x.alias("content"),
        (F.lit(1704067200) + F.col("doc_id") * 60 + i * 3600).cast("bigint").alias("time"), F.col("n_chars").alias("likes"))))
    html = F.concat(heading, F.lit('<time datetime="'), _iso(F.col("doc_id"), ".000Z"), F.lit('"></time><div class="caas-body">'), paragraphs, F.lit("</div>"))
    return docs.select("doc_id", F.concat(F.lit(f"{NEWS}/"), F.col("doc_id")).alias("url"), html.alias("html"), messages.alias("messages"))


@query(f"""select '{NEWS}/' || doc_id as article_url, case when lang = 'fr' then 'Unknown Title' else trim(string_split(text, chr(10))[1]) end as article_title,
  strftime(timestamp '2024-01-01 08:00:00' + to_seconds(doc_id), '%Y-%m-%d %H:%M:%S') as publish_time,
  array_to_string(list_transform(string_split(text, chr(10)), lambda x: trim(x)), chr(10)) as content_raw,
  len(string_split(text, chr(10)))::bigint as comment_count from documents""")
def news_articles(spark, sf_dir):
    return social.news_articles(news_pages(spark, sf_dir)).select(
        "article_url", "article_title", "publish_time", "content_raw", "comment_count")


@query(f"""with l as (select doc_id, source, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from documents)
select '{NEWS}/' || doc_id as article_url, i::bigint as comment_ix, source as comment_author, line as comment_content,
  strftime(timestamp '2024-01-01 08:00:00' + to_seconds(doc_id * 60 + i * 3600), '%Y-%m-%d %H:%M:%S') as comment_date_format from l""")
def news_comments(spark, sf_dir):
    rows = explode_comments(social.news_articles(news_pages(spark, sf_dir)))
    return rows.select("article_url", F.col("comment_ix").cast("bigint").alias("comment_ix"), "comment_author", "comment_content", "comment_date_format")


def payloads(spark, sf_dir):
    """API payloads: English posts hide the school, lines with a comma are hidden comments."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    school = F.when(F.col("lang") != "en", F.col("source"))
    post = F.to_json(F.struct(
        _first().alias("title"), F.when(F.col("lang") != "fr", F.col("lang")).alias("forumAlias"), school.alias("school"),
        _iso(F.col("doc_id"), ".000Z").alias("createdAt"), F.col("text").alias("content"),
        F.col("n_chars").alias("reactionCount"), F.size(lines_of()).alias("commentCount")))
    comments = F.to_json(F.transform(lines_of(), lambda x, i: F.struct(
        x.contains(",").alias("hidden"), F.when(F.col("lang") == "de", "yesterday").otherwise(_iso(F.col("doc_id") + i, ".000Z")).alias("createdAt"),
        school.alias("school"), x.alias("content"), (i + 1).alias("floor"))))
    return docs.select("doc_id", F.concat(F.lit("https://d.example/f/x/p/"), F.col("doc_id")).alias("url"), post.alias("post"), comments.alias("comments"))


@query("""select 'https://d.example/f/x/p/' || doc_id as article_url, string_split(text, chr(10))[1] as article_title,
  case when lang = 'fr' then 'Unknown' else lang end as article_category, case when lang = 'en' then '匿名' else source end as article_author,
  strftime(timestamp '2024-01-01 08:00:00' + to_seconds(doc_id), '%Y-%m-%d %H:%M:%S') as publish_time,
  n_chars as reaction_count, len(string_split(text, chr(10)))::bigint as comment_count, text as content_raw,
  len(list_filter(string_split(text, chr(10)), lambda x: not contains(x, ',')))::bigint as visible from documents""")
def payload_articles(spark, sf_dir):
    return social.payload_articles(payloads(spark, sf_dir)).select(
        "article_url", "article_title", "article_category", "article_author", "publish_time", "reaction_count",
        "comment_count", "content_raw", F.size("comments").cast("bigint").alias("visible"))


@query("""with l as (select doc_id, lang, source, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from documents)
select 'https://d.example/f/x/p/' || doc_id as article_url, 'B' || (i + 1) as comment_tag, line as comment_content,
  case when lang = 'en' then '匿名' else source end as comment_author,
  case when lang <> 'de' then strftime(timestamp '2024-01-01 08:00:00' + to_seconds(doc_id + i), '%Y-%m-%d %H:%M:%S') end as comment_date_format
from l where not contains(line, ',')""")
def payload_comments(spark, sf_dir):
    rows = explode_comments(social.payload_articles(payloads(spark, sf_dir)))
    return rows.select("article_url", "comment_tag", "comment_content", "comment_author", "comment_date_format")


@query("""with l as (select doc_id, lang, unnest(string_split(text, chr(10))) as title, unnest(range(len(string_split(text, chr(10))))) as pos from documents)
select doc_id as listing_id, pos::bigint as pos, doc_id * 1000 + pos as id, title, lang as forum from l""")
def payload_listing(spark, sf_dir):
    """Forum listings as JSON arrays, one per document with a post per line."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    listing = F.to_json(F.transform(lines_of(), lambda x, i: F.struct(
        (F.col("doc_id") * 1000 + i).alias("id"), x.alias("title"), F.col("lang").alias("forumAlias"))))
    posts = social.payload_listing(docs.select(F.col("doc_id").alias("listing_id"), listing.alias("listing")))
    return posts.select("listing_id", F.col("pos").cast("bigint").alias("pos"), "id", "title", F.col("forumAlias").alias("forum"))


@query("""select l_orderkey as post_id, 'B' || l_linenumber as comment_tag, 'part ' || l_partkey as comment_content,
  case when l_linestatus = 'O' then '匿名' else 'school' end as comment_author,
  strftime(l_shipdate + interval 8 hour, '%Y-%m-%d %H:%M:%S') as comment_date_format,
  'order ' || o_orderkey as article_title, o_orderpriority as article_category,
  strftime(o_orderdate + interval 8 hour, '%Y-%m-%d %H:%M:%S') as publish_time
from lineitem join orders on l_orderkey = o_orderkey where l_returnflag <> 'R'""")
def payload_join(spark, sf_dir):
    """Post payloads meet comment payloads by post id; returned lines are hidden comments."""
    def iso(c):
        return F.concat(F.left(F.col(c).cast("string"), F.lit(10)), F.lit("T00:00:00.000Z"))

    posts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post_id"), F.to_json(F.struct(
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("title"), F.col("o_orderpriority").alias("forumAlias"),
        iso("o_orderdate").alias("createdAt"))).alias("post"))
    comments = texts(spark, sf_dir, "lineitem", "l_orderkey").select(F.col("l_orderkey").alias("post_id"), F.to_json(F.struct(
        (F.col("l_returnflag") == "R").alias("hidden"), iso("l_shipdate").alias("createdAt"),
        F.when(F.col("l_linestatus") != "O", "school").alias("school"),
        F.concat(F.lit("part "), F.col("l_partkey")).alias("content"), F.col("l_linenumber").alias("floor"))).alias("comment"))
    return social.payload_comment_rows(posts, comments).select(
        "post_id", "comment_tag", "comment_content", "comment_author", "comment_date_format", "article_title", "article_category", "publish_time")


@query("""with k as (select event_id, event_type, (props::json->>'k')::bigint as k from events)
select event_id, k, 'none' as missing, case when event_type = 'error' then 0 else k + 2 end as likes,
  case when event_type in ('error', 'view') then 0 else k + 1 end as replies from k""")
def props_json(spark, sf_dir):
    """Nested fields with defaults, and the last count of each interaction kind."""
    events = table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "k bigint, other string"))
    k = F.col("p.k")

    def stat(kind, count):
        return F.struct(F.lit(kind).alias("interactionType"), count.alias("userInteractionCount"))

    stats = F.when(F.col("event_type") == "error", F.array().cast("array<struct<interactionType:string,userInteractionCount:bigint>>")).when(
        F.col("event_type") == "view", F.array(stat("LikeAction", k + 2))).otherwise(
        F.array(stat("LikeAction", k), stat("CommentAction", k + 1), stat("LikeAction", k + 2)))
    return events.select(
        "event_id", F.coalesce(k, F.lit(0)).alias("k"), F.coalesce("p.other", F.lit("none")).alias("missing"),
        social.interaction_count(stats, "LikeAction").alias("likes"),
        social.interaction_count(stats, "CommentAction", "LikeAction").alias("replies"))


def grouped_pages(spark, sf_dir, item):
    """Listing pages of 20 items each; doc_id is unique, so a page never holds more."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    rows = docs.select(F.floor(F.col("doc_id") / 20).alias("page_seq"), "doc_id", item.alias("item"))
    pages = rows.groupBy("page_seq").agg(F.array_sort(F.collect_list(F.struct("doc_id", "item"))).alias("i"))
    return pages.select("page_seq", F.array_join(F.transform("i", lambda x: x["item"]), "").alias("html"))


@query(f"""with d as (select doc_id, source, lang, trim(string_split(text, chr(10))[1]) as title from documents)
select title, case when lang = 'fr' then 'Unknown' else source end as source, '{NEWS}/articles/' || doc_id as url,
  case when lang = 'de' then 'Unknown' else strftime(timestamp '2024-01-01' + to_seconds(doc_id), '%Y-%m-%dT%H:%M:%SZ') end as publish_time
from d where title <> ''""")
def news_list(spark, sf_dir):
    """Each article is linked twice, first by a picture without text. French items name no source, German
    ones no time; items sit deeper than both searches may climb, so neighbours stay apart."""
    source = F.when(F.col("lang") == "fr", "").otherwise(F.concat(F.lit("<div>"), F.col("source"), F.lit("</div>")))
    time = F.when(F.col("lang") == "de", "").otherwise(F.concat(F.lit('<time datetime="'), _iso(F.col("doc_id"), "Z"), F.lit('"></time>')))
    href = F.concat(F.lit('<a href="./articles/'), F.col("doc_id"), F.lit('">'))
    item = F.concat(
        F.lit("<section><ul><li><p>"), F.lit("<b>"), href, F.lit('<img src="x"></a>'), href, escape(_first()), F.lit("</a>"), source, time, F.lit("</b></p></li></ul></section>"))
    found = listings.news_items(grouped_pages(spark, sf_dir, item), NEWS)
    return found.select("title", "source", "url", "publish_time")


@query("""with d as (select doc_id // 20 as page_seq, doc_id, source, n_chars, string_split(text, chr(10))[1] as title from documents),
r as (select *, row_number() over (partition by title order by doc_id) as rn from d)
select title, n_chars::varchar as reactions, source as comments, page_seq from r where rn = 1""")
def card_list(spark, sf_dir):
    """Cards of listing pages, each title at its first place."""
    item = F.concat(
        F.lit('<article class="card x"><a>'), escape(_first()), F.lit('</a><div class="r">'), F.col("n_chars"), F.lit('</div><div class="c">'),
        F.col("source"), F.lit("</div></article>"))
    found = listings.cards(grouped_pages(spark, sf_dir, item), "card x", "r", "c")
    return listings.new_cards(found, ["page_seq", "pos"]).select("title", "reactions", "comments", "page_seq")


@query(r"""select page_id, trim(regexp_replace(replace(replace(replace(replace(
    regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&quot;', '"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g')) as article_title, url as article_url,
  '' as content_raw, 'ok' as status from pages""")
def html_titles(spark, sf_dir):
    """Headings of the given pages; their text is not in a news body."""
    pages = texts(spark, sf_dir, "pages", "page_id").withColumn("messages", F.lit(None).cast("string"))
    return social.news_articles(pages).select("page_id", "article_title", "article_url", "content_raw", "status")


@query("""with p as (select *, case when page_id % 3 = 0 then 404 end as code from pages)
select page_id, source, case when code = 404 then 'http_error' when source = 'Instagram' and (contains(html, 'Login • Instagram') or contains(html, '登入 • Instagram'))
  then 'login_wall' else 'ok' end as status, code = 404 as refused from p, (select unnest(['Threads', 'Instagram', 'Yahoo']) as source)""")
def refused_pages(spark, sf_dir):
    """A third of the pages landed with status 404: no source makes an article of them."""
    pages = texts(spark, sf_dir, "pages", "page_id").withColumn("status_code", F.when(F.col("page_id") % 3 == 0, 404))
    news = pages.withColumn("messages", F.lit(None).cast("string"))
    found = [social.threads_articles(pages), social.instagram_articles(pages), social.news_articles(news)]
    rows = [f.select("page_id", F.col("article_source").alias("source"), "status", (F.col("status_code") == 404).alias("refused")) for f in found]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("""select event_id, k, strftime(ts + interval 8 hour - interval 1 hour * k, '%Y-%m-%d %H:%M:%S') as moved from (
  select event_id, ts, (event_id % 4)::int as k from events)""")
def iso_offsets(spark, sf_dir):
    """ISO times in UTC and with offsets in all their forms."""
    from hubbub.functions.times import iso_offset_wall, wall_text

    k = (F.col("event_id") % 4).cast("int")
    zone = F.when(k == 0, "Z").when(k == 1, "+01:00").when(k == 2, "+0200").otherwise("+03")
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), zone)
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), wall_text(iso_offset_wall(stamp)).alias("moved"))


@query("""select 'talk' as article_source, 'talk/' || conv_id as article_url, role as article_author, null::varchar as publish_time, length(text)::bigint as chars from conversations where turn = 0
union all select 'document', 'document/' || doc_id, null, null, length(text) from documents
union all select 'event', 'event/' || event_id, user_id::varchar, strftime(ts, '%Y-%m-%d %H:%M:%S'), length(event_type) from events""")
def conformed_sources(spark, sf_dir):
    from hubbub.functions.times import wall_text

    talks = table(spark, sf_dir, "conversations").where("turn = 0").select(
        F.lit("talk").alias("article_source"), F.concat(F.lit("talk/"), F.col("conv_id")).alias("article_url"),
        F.col("role").alias("article_author"), F.col("text").alias("content_raw"))
    docs = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("article_source"), F.concat(F.lit("document/"), F.col("doc_id")).alias("article_url"), F.col("text").alias("content_raw"))
    events = table(spark, sf_dir, "events").select(
        F.lit("event").alias("article_source"), F.concat(F.lit("event/"), F.col("event_id")).alias("article_url"),
        F.col("user_id").cast("string").alias("article_author"), wall_text("ts").alias("publish_time"), F.col("event_type").alias("content_raw"))
    return social.one_schema(talks, docs, events).select(
        "article_source", "article_url", "article_author", "publish_time", F.char_length("content_raw").cast("bigint").alias("chars"))
