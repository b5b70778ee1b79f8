"""What each kind of page holds. Every reader returns raw text; meaning is added in columns."""

INDEX_FIELDS = (
    "entries array<struct<pos:int,title:string,href:string,date:string,pinned:boolean>>, "
    "prev_text string, prev_href string"
)


def read_index(root):
    """Entries of a board index page, split at the separator, and its paging button."""
    separator = root.find("div", "r-list-sep")
    if separator is None:
        blocks = [(e, False) for e in root.find_all("div", "r-ent")]
    else:
        before, after = separator.siblings()
        blocks = [(e, e in after) for e in before + after if e.tag == "div" and e.has_class("r-ent")]
    entries = []
    for pos, (block, pinned) in enumerate(blocks):
        link, date = block.find("a"), block.find("div", "date")
        entries.append({
            "pos": pos,
            "title": link.text(strip=False) if link else None,
            "href": link.get("href") if link else None,
            "date": date.text(strip=False) if date else None,
            "pinned": pinned,
        })
    paging = root.find("div", "btn-group btn-group-paging")
    buttons = paging.find_all("a") if paging else []
    second = buttons[1] if len(buttons) > 1 else None
    return {
        "entries": entries,
        "prev_text": second.text(strip=False) if second else None,
        "prev_href": second.get("href") if second else None,
    }


PREVIOUS_FIELDS = "prev_text string, prev_href string"


def read_previous(root, label):
    """The first link on the page whose whole content is one text that holds ``label``, case ignored."""
    for link in root.find_all("a"):
        only = link
        while not isinstance(only, str) and len(only.children) == 1:
            only = only.children[0]
        if isinstance(only, str) and label.lower() in only.lower():
            return {"prev_text": only, "prev_href": link.get("href")}
    return {"prev_text": None, "prev_href": None}


ARTICLE_FIELDS = (
    "has_container boolean, board_text string, header map<string,string>, "
    "pushes array<struct<tag:string,author:string,content:string,stamp:string>>, body string"
)


def read_article(root):
    """Header lines, pushes and remaining body text of a forum article page."""
    main = root.find("div", id="main-content")
    if main is None:
        return {"has_container": False}
    bar = root.find("div", id="topbar-container")
    board = bar.find("a", "board") if bar else None
    right, normal = main.find_all("div", "article-metaline-right"), main.find_all("div", "article-metaline")
    normal = [e for e in normal if not any(e is r for r in right)]
    header = {}  # a later line of the same name wins
    for line in right + normal:
        tag, value = line.find("span", "article-meta-tag"), line.find("span", "article-meta-value")
        if tag is not None and value is not None:
            header[tag.text()] = value.text()
    pushes = main.find_all("div", "push")
    rows = []
    for push in pushes:
        parts = [push.find("span", c) for c in ("push-tag", "push-userid", "push-content", "push-ipdatetime")]
        tag, author, content, stamp = [p.text() if p else None for p in parts]
        rows.append({"tag": tag, "author": author, "content": content, "stamp": stamp})
    noise = main.find_all("span", "f2") + main.find_all("div", "richcontent")
    skip = {id(e) for e in right + normal + pushes + noise}
    return {
        "has_container": True,
        "board_text": board.text() if board else None,
        "header": header,
        "pushes": rows,
        "body": main.text(skip=skip),
    }


HEAD_FIELDS = (
    "h1 string, paragraphs array<string>, time_attr string, og_title string, og_description string, "
    "ld_blocks array<string>"
)


def read_head(root, body_class="caas-body"):
    """Heading, body paragraphs, time, Open Graph tags and JSON-LD blocks of a post page."""
    h1, body, time = root.find("h1"), root.find("div", body_class), root.find("time")
    title, description = root.find("meta", property="og:title"), root.find("meta", property="og:description")
    return {
        "h1": h1.text() if h1 else None,
        "paragraphs": [p.text() for p in body.find_all("p")] if body else None,
        "time_attr": time.get("datetime") if time else None,
        "og_title": title.get("content") if title else None,
        "og_description": description.get("content") if description else None,
        "ld_blocks": [s.text(strip=False) for s in root.find_all("script", type="application/ld+json")],
    }


NEWS_FIELDS = (
    "links array<struct<pos:int,title:string,href:string,"
    "near:array<struct<level:int,tag:string,text:string,href:string,time_attr:string>>>>"
)
# Longer texts around a link are whole passages; no label is read from them.
_LABEL_ROOM = 200


def read_news(root, prefix="./articles/", levels=5):
    """Article links with what stands around them: the links, boxes and times of the enclosing areas, innermost
    area first, each element once. Which of them is the label or the time is decided on the rows."""
    links = [e for e in root.find_all("a") if e.get("href", "").startswith(prefix)]
    return {"links": [
        {"pos": pos, "title": link.text(), "href": link.get("href"), "near": list(_surroundings(link, levels))}
        for pos, link in enumerate(links)
    ]}


def _surroundings(link, levels):
    # Elements below an area are one stretch of the page's list; the inner area's stretch was told before.
    inner_from, inner_to, area = link.at, link.at, link.parent
    for level in range(1, levels + 1):
        if area is None:
            return
        for at in (*range(area.at + 1, inner_from), *range(inner_to, area.end)):
            element = area.page[at]
            if element.tag in ("a", "div", "time"):
                text = element.text()
                yield {
                    "level": level, "tag": element.tag, "text": text if len(text) <= _LABEL_ROOM else None,
                    "href": element.get("href"), "time_attr": element.get("datetime"),
                }
        inner_from, inner_to, area = area.at + 1, area.end, area.parent


LINK_FIELDS = "links array<struct<pos:int,title:string,href:string>>"


def read_links(root):
    """Every anchor of a page."""
    return {
        "links": [
            {"pos": pos, "title": a.text(strip=False), "href": a.get("href")}
            for pos, a in enumerate(root.find_all("a"))
        ]
    }


CARD_FIELDS = "cards array<struct<pos:int,title:string,reactions:string,comments:string>>"


def read_cards(root, card_class, reaction_class, comment_class):
    """Title, reaction text and comment text of each card in a listing."""
    cards = []
    for pos, card in enumerate(root.find_all("article", card_class)):
        parts = (card.find("a"), card.find("div", reaction_class), card.find("div", comment_class))
        title, reactions, comments = [p.text(strip=False) if p else None for p in parts]
        cards.append({"pos": pos, "title": title, "reactions": reactions, "comments": comments})
    return {"cards": cards}
