"""Text expressions. All of them stay in the JVM."""

from pyspark.sql import functions as F

# The members of Python's whitespace (as a regex class and as characters), the
# sentence marks, and the characters for which str.isdigit() is true. The classes are spelled
# out because \s and \d are ASCII-only here.
WS_SET = r"\t\n\x0B\f\r\x1C-\x1F\x20\x{85}\p{Z}"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SENTENCE_MARKS = ",，。;；!！?？"
DIGIT_SET = (
    r"\p{Nd}\x{B2}-\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}"
    r"\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)

WS = f"[{WS_SET}]"
SENTENCE_BREAK = f"[{SENTENCE_MARKS}{WS_SET}]"
LINE_BREAK = rf"[{SENTENCE_MARKS}\n]"
ALL_DIGITS = f"^[{DIGIT_SET}]+$"
FILE_UNSAFE = r'[\\/:*?"<>|]'


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c):
    """Trim Unicode whitespace at both ends."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def ws_tokens(c):
    """Split on whitespace runs, without empty parts."""
    return F.filter(F.split(_col(c), f"{WS}+"), lambda x: x != "")


def sentences(c, by_line=False):
    """Split text into non-empty sentences.

    ``by_line`` keeps blanks inside a sentence and breaks at newlines only.
    """
    if by_line:
        parts = F.transform(F.split(_col(c), LINE_BREAK), strip_ws)
    else:
        parts = F.split(_col(c), SENTENCE_BREAK)
    return F.filter(parts, lambda x: x != "")


def is_digits(c):
    return _col(c).rlike(ALL_DIGITS)


def is_term(c):
    """A word worth counting: longer than one character, not blank, not a number."""
    c = _col(c)
    return (F.char_length(c) > 1) & ~c.rlike(f"^({WS}*|[{DIGIT_SET}]+)$")


def file_safe(c):
    """Replace characters that file names cannot hold."""
    return F.regexp_replace(_col(c), FILE_UNSAFE, "_")


def output_name(category, title, fallback_title=None, prefix=None):
    """Name of a written article: [prefix_]category_title."""
    title = _col(title) if fallback_title is None else F.coalesce(_col(title), _col(fallback_title))
    parts = [file_safe(title)]
    if category is not None:
        parts.insert(0, F.coalesce(_col(category), F.lit("Unknown")))
    if prefix is not None:
        parts.insert(0, F.lit(prefix))
    return F.concat_ws("_", *parts)


def preview(c, n):
    return F.left(_col(c), F.lit(n))


def keyword_label(c, sep="、", most=5, shown=3):
    """Join keywords for a caption; beyond ``most`` show the first ``shown`` and dots."""
    c = _col(c)
    return F.when(F.size(c) > most, F.concat(F.array_join(F.slice(c, 1, shown), sep), F.lit("..."))).otherwise(
        F.array_join(c, sep)
    )


def rank_label(rank, word, count):
    return F.format_string("%d. %s (%d)", _col(rank), _col(word), _col(count))


def joined_text(words):
    """Words of one row as blank-separated text."""
    return F.array_join(_col(words), " ")
