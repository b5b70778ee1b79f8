import pytest
from pyspark.sql import functions as F

from hubbub.operators.audit import row_audit
from hubbub.plans import forum, listings, social
from hubbub.sources.html import extract_pages, parse_page
from hubbub.sources.readers import ARTICLE_FIELDS, read_article

URL = "https://f/bbs/Coffee/M.1766998030.A.8C2.html"


def meta(kind, tag, value):
    return f'<div class="{kind}"><span class="article-meta-tag">{tag}</span><span class="article-meta-value">{value}</span></div>'


def push(content=": hi", stamp="12/29 18:30", user="u", tag="推 "):
    spans = "".join(f'<span class="{c}">{v}</span>' for c, v in (
        ("f1 push-tag", tag), ("push-userid", user), ("push-content", content), ("push-ipdatetime", stamp)) if v is not None)
    return f'<div class="push">{spans}</div>'


def page(header="", body="", pushes="", board="看板Coffee"):
    return (f'<div id="topbar-container"><a class="board">{board}</a></div>'
            f'<div id="main-content" class="bbs">{header}{body}{pushes}</div>')


def parse(spark, *pages):
    rows = [p if len(p) == 3 else (*p, 200) for p in pages]
    return forum.parse_articles(spark.createDataFrame(rows, "url string, html string, status_code int"))


def test_article(spark):
    html = page(
        meta("article-metaline-right", "看板", "Coffee") + meta("article-metaline", "作者", " me (Me) ") + meta("article-metaline", "標題", "old") + meta("article-metaline", "標題", "T &amp; t"),
        "\n first <b> bold </b><!-- x -->\n second<script>no()</script>\n<span class='f2'>※ sent</span><div class='richcontent'><img></div>",
        push(":  a : b ", " 1.2.3.4 01/02 10:00\n") + push(stamp="12/29") + push(stamp=None) + push(":"))
    a = parse(spark, (URL, html)).first()
    assert (a.status, a.article_title, a.article_category, a.article_author) == ("ok", "T & t", "Coffee", "me (Me)")
    assert (a.publish_time, a.date_year, a.date_month, a.date_day) == ("2025-12-29 16:47:10", 2025, 12, 29)
    assert a.content_raw == "firstboldsecond"
    assert a.reaction_count == a.comment_count == 3
    assert [(c.comment_raw_time, c.comment_date_format, c.comment_content, c.comment_tag) for c in a.comments] == [
        ("01/02 10:00", "2026-01-02 10:00:00", "a : b", "推"), ("Unknown", "1970-01-01 00:00:00", "hi", "推"), ("12/29 18:30", "2025-12-29 18:30:00", "", "推")]
    assert a.header == {"看板": "Coffee", "作者": "me (Me)", "標題": "T & t"}


def test_defaults_and_outcomes(spark):
    rows = {r.article_url: r for r in parse(
        spark, (URL, page(body="x")), (URL + "?1", page(meta("article-metaline", "時間", "now"))), (URL + "?2", "<p>none", 200),
        (URL + "?3", page(), 404), ("https://f/about", page()), (URL + "?4", None, 0)).collect()}
    assert (rows[URL].article_title, rows[URL].article_author) == ("無標題", "")
    assert (rows[URL + "?1"].article_title, rows[URL + "?1"].article_author) == ("無標題", "unknown")
    assert [rows[u].status for u in (URL + "?2", URL + "?3", "https://f/about", URL + "?4")] == ["no_container", "http_error", "bad_url", "http_error"]
    assert rows[URL + "?3"].error == "HTTP 404"


def test_audit_rows(spark):
    parsed = parse(spark, (URL, page(body="x", pushes=push(stamp="1/1"))), (URL + "?2", "<p>none"))
    assert sorted(tuple(r) for r in row_audit(parsed).collect()) == [
        (URL, "Invalid Date"), (URL, "Missing Meta"), (URL + "?2", "Error: no_container")]


def test_dirty_pages_do_not_raise():
    root = parse_page("</div><p>a<b>c</p>d<br/>e<div class='x y'>f</x></div>&amp;&copy;<img src=1>")
    assert root.text() == "acdef&©"
    assert root.find("div", "y").text() == "f" and root.find("div", "x y") is not None and root.find("div", "y x") is None
    assert parse_page(None).text() == "" and parse_page("<a href>t</a>").find("a").get("href") == ""


def entry(title, href, date=" 1/02"):
    link = f'<a href="{href}">{title}</a>' if href else "(gone)"
    return f'<div class="r-ent"><div class="title">{link}</div><div class="date">{date}</div></div>'


def test_index(spark):
    paging = '<div class="btn-group btn-group-paging"><a href="/1">最舊</a>{}</div>'
    html = paging.format('<a href="/2">‹ 上頁</a>') + "<div>" + entry(" t1 ", "/a") + entry("", None) + entry("t2", "/b") + '<div class="r-list-sep"></div>' + entry("pin", "/p") + "</div>"
    plain = paging.format('<a>‹ 上頁</a>') + "<div><div>" + entry("x", "/x") + "</div></div>"
    pages = spark.createDataFrame([(0, html), (1, plain), (2, "")], "page_seq int, html string")
    rows = forum.index_entries(pages, "https://f").orderBy("page_seq", "pos").collect()
    assert [(r.page_seq, r.pos, r.title, r.url, r.pinned) for r in rows] == [
        (0, 0, " t1 ", "https://f/a", False), (0, 1, None, None, False), (0, 2, "t2", "https://f/b", False), (0, 3, "pin", "https://f/p", True),
        (1, 0, "x", "https://f/x", False)]
    previous = {r.page_seq: r.prev_url for r in forum.previous_pages(pages, "https://f").collect()}
    assert previous == {0: "https://f/2", 1: None, 2: None}


def test_tasks_without_page_give_error_rows(spark):
    tasks = spark.createDataFrame([(0, URL), (1, URL), (2, "https://f/M.5.A.html")], "seq int, url string")
    pages = spark.createDataFrame([(URL, page(body="x"), 200)], "url string, html string, status_code int")
    rows = forum.task_articles(tasks, pages).orderBy("seq").collect()
    assert [(r.seq, r.status, r.error) for r in rows] == [(0, "ok", None), (1, "ok", None), (2, "http_error", "no page")]
    assert [r.content_raw for r in rows] == ["x", "x", None]


LD = '<script type="application/ld+json">{}</script>'


@pytest.mark.parametrize("head, want", [
    (LD.format("{bad") + LD.format('{"@type": "x"}') + LD.format('{"headline": "h", "author": [{"name": "n"}], "datePublished": "2024-12-29T10:00:00Z"}'), ("h", "n", "", "2024-12-29 18:00:00")),
    (LD.format('{"articleBody": "b", "author": {"name": "n"}}') + LD.format('{"headline": "later"}'), ("無標題", "n", "b", None)),
    (LD.format('{"articleBody": null, "author": []}'), ("無標題", "Unknown", "", None)),
    ('<meta property="og:title" content="Ann on Threads: &quot;x&quot;"><meta property="og:description" content="d">', ("Threads Post by Ann", "Ann", "d", None)),
    ("", ("Threads Post by Unknown", "Unknown", "", None)),
])
def test_threads(spark, head, want):
    pages = spark.createDataFrame([("https://www.threads.com/x", head)], "url string, html string")
    a = social.threads_articles(pages).first()
    assert (a.article_title, a.article_author, a.content_raw, a.publish_time) == want
    assert a.article_url == "https://www.threads.net/x" and a.comments == []


def test_interaction_counts(one):
    def stats(*pairs):
        return F.array(*[F.struct(F.lit(k).alias("interactionType"), F.lit(n).alias("userInteractionCount")) for k, n in pairs])

    s = stats(("x/LikeAction", 1), ("CommentAction", 2), ("LikeAction", None), ("LikeAction", 7), ("LikeAction CommentAction", 9))
    assert list(one(social.interaction_count(s, "LikeAction"), social.interaction_count(s, "CommentAction", "LikeAction"))) == [9, 2]
    assert one(social.interaction_count(stats(("Other", 1)), "LikeAction"))[0] == 0


@pytest.mark.parametrize("title, text, want", [
    ("Ann on Instagram: x", '1 likes - ann: "say: "yes""', ("Ann", 'say: "yes')),
    ("Ann", 'ann: "t"', ("Unknown", "t")), ("Ann on Instagram", "plain", ("Unknown", "plain")),
])
def test_instagram(spark, title, text, want):
    html = f'<meta property="og:title" content="{title}"><meta property="og:description" content="{text.replace(chr(34), "&quot;")}">'
    pages = spark.createDataFrame([("https://i/p/1?img=1", html), ("https://i/p/2", html + "登入 • Instagram")], "url string, html string")
    ok, wall = social.instagram_articles(pages).orderBy("article_url").collect()
    assert (ok.article_author, ok.content_raw, ok.article_url, ok.status) == (*want, "https://i/p/1/", "ok") and wall.status == "login_wall"


def test_payload(spark):
    post = '{"title": "t", "createdAt": "2024-12-29T10:00:00.000Z", "reactionCount": 5}'
    comments = '[{"hidden": true, "content": "h"}, {"floor": 2, "content": "c", "createdAt": "bad"}, {"hidden": false}]'
    rows = spark.createDataFrame([("u", post, comments), ("v", "{", None)], "url string, post string, comments string")
    ok, bad = social.payload_articles(rows).orderBy("article_url").collect()
    assert (ok.article_title, ok.article_category, ok.article_author, ok.publish_time, ok.reaction_count, ok.comment_count) == (
        "t", "Unknown", "匿名", "2024-12-29 18:00:00", 5, 0)
    assert [(c.comment_tag, c.comment_content, c.comment_date_format) for c in ok.comments] == [("B2", "c", None), ("B0", "", None)]
    assert bad.status == "bad_payload" and bad.comments == []


def test_payload_listing(spark):
    listing = '[{"id": 7, "title": "a", "forumAlias": "f"}, {"id": 8, "commentCount": 2}]'
    rows = social.payload_listing(spark.createDataFrame([("l", listing), ("m", "x")], "url string, listing string")).collect()
    assert [(r.url, r.pos, r.id, r.title, r.commentCount) for r in rows] == [("l", 0, 7, "a", None), ("l", 1, 8, None, 2)]


def test_news_page(spark):
    html = '<h1> T </h1><time datetime="2024-01-01T00:00:00.000Z"></time><div class="caas-body x"><p>a</p><div><p> b <b>c</b></p></div></div>'
    rows = spark.createDataFrame([("u", html, '[{"user": "n", "content": "c", "time": 1704067200, "likes": 3}]'), ("v", "", None)], "url string, html string, messages string")
    ok, empty = social.news_articles(rows).orderBy("article_url").collect()
    assert (ok.article_title, ok.content_raw, ok.publish_time, ok.comment_count) == ("T", "a\nbc", "2024-01-01 08:00:00", 1)
    assert (ok.comments[0].comment_author, ok.comments[0].comment_date_format) == ("n", "2024-01-01 08:00:00")
    assert (empty.article_title, empty.content_raw, empty.comment_count) == ("Unknown Title", "", 0)
    messages = spark.createDataFrame([("n", "c", 1704067200, 3)], "user string, content string, time long, likes long")
    assert social.news_comments(messages).first().asDict() == {"user_name": "n", "content": "c", "time": "2024-01-01 08:00:00", "likes": 3, "reply_count": 0}


def test_news_list(spark):
    html = ('<main><div><article><a href="./articles/1"></a><div><h4><a href="./articles/1">Title one</a></h4></div><div>Paper</div><time datetime="T1"></time></article></div></main>'
            '<section><i><i><i><i><i><a href="./articles/2">Two</a></i></i></i></i></i></section><a href="/x">no</a>')
    pages = spark.createDataFrame([(0, html), (1, html)], "page_seq int, html string")
    rows = listings.news_items(pages, "https://n", "now").orderBy("url").collect()
    assert [(r.page_seq, r.title, r.source, r.url, r.publish_time, r.scraped_time) for r in rows] == [
        (0, "Title one", "Paper", "https://n/articles/1", "T1", "now"), (0, "Two", "Unknown", "https://n/articles/2", "Unknown", "now")]


def test_cards(spark):
    card = '<article class="c d"><a>{}</a><div class="e f">{}</div><div class="g h">{}</div></article>'
    pages = spark.createDataFrame([(0, card.format("t", 1, 2) + card.format("u", 3, 4)), (1, card.format("t", 5, 6))], "pass int, html string")
    found = listings.new_cards(listings.cards(pages, "c d", "e f", "g h"), ["pass", "pos"])
    assert sorted((r.title, r.reactions, r.comments) for r in found.collect()) == [("t", "1", "2"), ("u", "3", "4")]


def test_one_schema(spark):
    a = spark.createDataFrame([("A", "t")], "article_source string, article_title string")
    b = spark.createDataFrame([("B", 3)], "article_source string, reaction_count long")
    rows = sorted((r.article_source, r.article_title, r.reaction_count) for r in social.one_schema(a, b).collect())
    assert rows == [("A", "t", None), ("B", None, 3)]


def test_pages_are_dropped_before_they_are_parsed(spark, tmp_path):
    """One Python node, only the page text goes into it, and the choice of pages lies below."""
    html = "<div id='main-content'>text</div>"
    address = "https://forum.example/bbs/Board/M.17670000{:02d}.A.{:03d}.html".format
    spark.createDataFrame([(address(i, i), html, f"extra {i}", "unused") for i in range(20)], "url string, html string, note string, other string").write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    tasks = spark.createDataFrame([(k, address(k % 3, k % 3)) for k in range(50)] + [(50, "nowhere"), (51, None)], "seq long, url string")
    found = forum.task_articles(tasks, pages.where("note <> 'extra 1'")).select("seq", "article_url", "status", "note")
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    python = [k for k, line in enumerate(lines) if "EvalPython" in line]
    below = "\n".join(lines[python[0]:])
    assert len(python) == 1 and "LeftSemi" in below and "extra 1" in below
    assert "other:string" not in found._jdf.queryExecution().executedPlan().toString()  # in no scan's schema
    rows = {r["seq"]: (r["status"], r["note"]) for r in found.collect()}
    assert rows[0] == ("ok", "extra 0") and rows[1] == ("http_error", None) and rows[2] == ("ok", "extra 2")
    assert rows[50][0] == rows[51][0] == "http_error" and len(rows) == 52


def test_filters_on_other_columns_pass_the_reader(spark, tmp_path):
    spark.createDataFrame([(i, "<div id='main-content'>x</div>", "a") for i in range(5)], "id long, html string, kind string").write.parquet(str(tmp_path / "p"))
    found = extract_pages(spark.read.parquet(str(tmp_path / "p")), read_article, ARTICLE_FIELDS).where("id = 3").select("id", "body")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,3)" in plan and "kind" not in plan and [r["id"] for r in found.collect()] == [3]


def test_linked_objects(spark):
    blocks = ['[{"a": 1}, {"headline": "h"}]', '{"@graph": [{"headline": "g"}], "q": 2}', '{"headline": "p"}', " not json [", '[1, "x", null]', '{"@graph": 3}', '["a"', "[]"]
    rows = spark.createDataFrame([(blocks,), ([],), (None,)], "b array<string>").select(social.linked_objects(F.col("b")).alias("o")).collect()
    assert rows[0]["o"] == ['{"a":1}', '{"headline":"h"}', blocks[1], '{"headline":"g"}', blocks[2], blocks[3], "1", '"x"', "null", blocks[5], blocks[6]]
    assert rows[1]["o"] == [] and rows[2]["o"] is None


def test_previous_link_anywhere():
    from hubbub.sources.readers import read_previous

    def found(html, label="上頁"):
        return tuple(read_previous(parse_page(html), label).values())

    assert found('<a href="/a">x</a><a href="/b"><b>‹ 上頁</b></a><a href="/c">上頁</a>') == ("‹ 上頁", "/b")
    assert found('<a href="/c">上頁 <i>y</i></a>') == found("") == found('<a href="/d"></a>') == (None, None)
    assert found("<a>PREVious</a>", "prev") == ("PREVious", None)


def test_conditions_on_read_fields_do_not_read_pages_twice(spark):
    pages = spark.createDataFrame([(f"https://x/M.{i}.A.html", "<div id='main-content'>x</div>") for i in range(3)], "url string, html string").repartition(2)
    good, _ = forum.good_and_bad(forum.parse_articles(pages))
    counted = good.select("article_url", "content_raw", "comment_count")
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("EvalPython") == 1
    # The number of comments needs none of their times.
    assert "try_make_timestamp" not in plan and "make_timestamp_ntz" not in plan.replace("1970", "")
    assert sorted(r["comment_count"] for r in counted.collect()) == [0, 0, 0]


def test_usual_tags_are_read_as_the_library_reads_them():
    from html.parser import HTMLParser

    from hubbub.sources.html import _Builder

    class Library(_Builder):
        parse_starttag, parse_endtag, updatepos = HTMLParser.parse_starttag, HTMLParser.parse_endtag, HTMLParser.updatepos

    def page(builder, html):
        builder.feed(html)
        builder.close()
        builder.flush()
        return [(e.tag, e.attrs, [c if isinstance(c, str) else c.at for c in e.children]) for e in builder.page]

    for html in ('<div class="a b"  id="x"><p>1</p >2</DIV>', "<script>if (a <b) </p></script><title>a</b></title>t", '<a href="x&amp;y" b>&lt;</a><br/><a x="<b>">', '<p class="a', "<style><p></style><a x=\"1\" x=\"2\">", "<textarea><p></textarea></p>"):
        assert page(_Builder(), html) == page(Library(), html)
        own = _Builder()
        assert page(own, html[own.feed_plain(html):]) == page(Library(), html)
    assert _Builder().feed_plain('a &lt; <p class="x">b<!-- c --></p><B>') == 35
