"""Pages to typed rows: one Arrow-batched pass over each page.

The page helper only walks tags and returns raw text; defaults, time repair, numbering and
routing are column expressions on the rows it yields.
"""

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hubbub.session import in_slices

# Elements without content, and elements whose content is not page text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SILENT = {"script", "style", "template"}
# The usual form of a tag, which one match reads whole; HTMLParser takes several for it. All others, and elements whose
# content is no markup, are left to HTMLParser.
PLAIN_START = re.compile(r'<([a-z][a-z0-9]*)((?: +[a-z][a-z0-9:-]*="[^"&]*")*) *>')
PLAIN_ATTRIBUTE = re.compile(r' +([a-z][a-z0-9:-]*)="([^"&]*)"')
# A text and the usual tag or comment that ends it.
PLAIN_PIECE = re.compile(r'([^<]*)<(?:([a-z][a-z0-9]*)((?: +[a-z][a-z0-9:-]*="[^"&]*")*) *>|/([a-z][a-z0-9]*)>|!--[^->]*-->)')
PLAIN_END = re.compile(r"</([a-z][a-z0-9]*)>")
NO_MARKUP = {"script", "style", "textarea", "title", "plaintext", "xmp", "iframe", "noembed", "noframes", "noscript"}


class Element:
    """A node of the page: children are elements or strings, in page order.

    ``page`` lists all elements in page order; those below this one are ``page[at + 1:end]``.
    """

    __slots__ = ("tag", "parent", "children", "attrs", "names", "page", "at", "end")

    def __init__(self, tag, attrs, parent, page):
        self.tag, self.parent, self.children = tag, parent, []
        self.attrs = {k: v or "" for k, v in attrs}
        self.names = self.attrs.get("class", "").split()
        self.page, self.at, self.end = page, len(page), None
        page.append(self)

    def get(self, name, default=None):
        return self.attrs.get(name, default)

    def has_class(self, wanted):
        return wanted in self.names or wanted == self.attrs.get("class")

    def _matches(self, tag, cls, attrs):
        tags = (tag,) if isinstance(tag, str) else tag
        for e in self.page[self.at + 1:self.end]:
            if e.tag in tags and (cls is None or e.has_class(cls)) and all(e.attrs.get(k) == v for k, v in attrs.items()):
                yield e

    def find_all(self, tag, cls=None, **attrs):
        return list(self._matches(tag, cls, attrs))

    def find(self, tag, cls=None, **attrs):
        return next(self._matches(tag, cls, attrs), None)

    def strings(self, skip=frozenset()):
        """Text nodes below this one, leaving out elements in ``skip`` and silent elements."""
        stack = [iter(self.children)]
        while stack:
            child = next(stack[-1], None)
            if child is None:
                stack.pop()
            elif isinstance(child, str):
                yield child
            elif child.tag not in SILENT and id(child) not in skip:
                stack.append(iter(child.children))

    def text(self, strip=True, skip=frozenset()):
        parts = self.strings(skip)
        return "".join(p.strip() for p in parts) if strip else "".join(parts)

    def siblings(self):
        """Element siblings before and after this one, in page order."""
        all_ = [c for c in self.parent.children if isinstance(c, Element)]
        at = next(i for i, e in enumerate(all_) if e is self)
        return all_[:at], all_[at + 1:]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = []
        self.root = Element("[page]", (), None, self.page)
        self.open = [self.root]
        self.pending = []

    def flush(self):
        if self.pending:
            self.open[-1].children.append("".join(self.pending))
            self.pending = []

    def shut(self, depth):
        """Close all open elements from ``depth`` on."""
        for element in self.open[depth:]:
            element.end = len(self.page)
        del self.open[depth:]

    def feed_plain(self, html):
        """Read as far as all tags are usual ones and give the place where that ends."""
        piece, at = PLAIN_PIECE.scanner(html).match, 0
        while (found := piece()) is not None:
            text, start, attrs, end = found.groups()
            if start in NO_MARKUP:
                break
            at = found.end()
            if text:
                self.pending.append(unescape(text) if "&" in text else text)
            if start:
                self.handle_starttag(start, PLAIN_ATTRIBUTE.findall(attrs) if attrs else ())
            elif end:
                self.handle_endtag(end)
            else:
                self.flush()
        return at

    def parse_starttag(self, i):
        plain = PLAIN_START.match(self.rawdata, i)
        if plain is None or plain[1] in NO_MARKUP:
            return super().parse_starttag(i)
        self.lasttag = plain[1]
        self.handle_starttag(plain[1], PLAIN_ATTRIBUTE.findall(plain[2]) if plain[2] else ())
        return plain.end()

    def parse_endtag(self, i):
        plain = PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if plain is None:
            return super().parse_endtag(i)
        self.handle_endtag(plain[1])
        return plain.end()

    def updatepos(self, i, j):
        """Lines are not counted: nobody asks for a place."""
        return j

    def handle_starttag(self, tag, attrs):
        self.flush()
        element = Element(tag, attrs, self.open[-1], self.page)
        self.open[-1].children.append(element)
        self.open.append(element)
        if tag in VOID:
            self.shut(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.shut(i)
                return

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self.flush()

    handle_decl = unknown_decl = handle_pi = handle_comment


def parse_page(html):
    """Build the element tree of one page; unclosed or stray tags never raise."""
    builder, html = _Builder(), html or ""
    builder.feed(html[builder.feed_plain(html):])
    builder.close()
    builder.flush()
    builder.shut(0)
    return builder.root


def landed(pages, also=None, html="html"):
    """Pages with ``_refused``: the status code, where there is one, is not 200. Their html is NULL from here on, and that
    of rows for which ``also`` is false, so that no page is parsed whose outcome is already decided."""
    code = F.col("status_code") if "status_code" in pages.columns else F.lit(200)
    refused = F.coalesce(code != 200, F.lit(False))
    kept = ~refused if also is None else ~refused & also
    return pages.withColumn("_refused", refused).withColumn(html, F.when(kept, F.col(html)))


def extract_pages(pages, reader, schema, html="html"):
    """Run ``reader(root) -> dict`` on every page and append its fields as columns.

    Only the page text goes to Python; all other columns stay where they are, so filters and column choices
    pass below. ``schema`` is the DDL of the added fields. A page its reader cannot handle gives NULL fields and the
    reason in ``page_error``. The outer explode of one element keeps conditions on the fields above it; below, they would
    parse every page a second time.
    """
    fields = T.StructType.fromDDL(f"{schema}, page_error string")
    empty, kind = dict.fromkeys(fields.names), to_arrow_type(fields)
    maps = [f.name for f in fields if isinstance(f.dataType, T.MapType)]

    def read(texts):
        rows = []
        for text in texts:
            try:
                found = reader(parse_page(text.as_py()))
                rows.append({**empty, **found, **{m: list(found[m].items()) for m in maps if found.get(m) is not None}})
            except Exception as problem:  # a bad page must not end the run
                rows.append({**empty, "page_error": f"{type(problem).__name__}: {problem}"})
        return pa.array(rows, kind)

    @F.arrow_udf(fields)
    def run(texts: pa.Array) -> pa.Array:
        return in_slices(texts, read)

    kept = [F.col(f"`{c}`") for c in pages.columns if c != html]
    return pages.select(*kept, F.explode_outer(F.array(run(html))).alias("_page")).select(*kept, "_page.*")
