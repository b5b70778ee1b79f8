import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hubbub.functions import text, urls

def test_whitespace_class_is_pythons(spark):
    rows = [(i,) for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    points = spark.createDataFrame([(i, chr(i)) for (i,) in rows], "i int, c string")
    found = {r.i for r in points.where(F.col("c").rlike(f"^{text.WS}$")).collect()}
    assert found == {i for (i,) in rows if chr(i).isspace()}


def test_trim_characters_are_pythons(one):
    assert all(c.isspace() for c in text.WS_CHARS) and len(set(text.WS_CHARS)) == 29
    assert one(text.strip_ws(F.lit(text.WS_CHARS + "a b" + text.WS_CHARS)))[0] == "a b"


def test_digit_class_covers_isdigit(spark):
    points = [(i, chr(i)) for i in range(0x20000) if not 0xD800 <= i < 0xE000 and chr(i).isdigit()]
    df = spark.createDataFrame(points, "i int, c string")
    missed = {r.i for r in df.where(~text.is_digits("c")).collect()}
    # Java's tables hold fewer decimal digits than newer Unicode versions; nothing else may be missed.
    assert all(chr(i).isdecimal() for i in missed) and len(missed) < 60


def is_blank(c):
    """White space by Unicode category, and the control characters that count as such."""
    return unicodedata.category(c) in ("Zs", "Zl", "Zp") or ord(c) in (*range(9, 14), *range(28, 32), 0x85)


def pieces_by_character(line, ends_at_blank):
    """Sentences by walking over the characters, trimming blanks as they come."""
    pieces, piece, waiting = [], "", ""
    for c in line + "\n":
        if c in ",;!?" or unicodedata.name(c, "").startswith("FULLWIDTH ") or c in "。\n" or ends_at_blank and is_blank(c):
            if piece:
                pieces.append(piece)
            piece = waiting = ""
        elif is_blank(c):
            waiting += c if piece else ""
        else:
            piece, waiting = piece + waiting + c, ""
    return pieces


def counts_as_term(word):
    """At least two characters, of which one is neither blank nor a digit, unless blanks and digits mix."""
    kinds = {"blank" if is_blank(c) else "digit" if unicodedata.digit(c, None) is not None else "other" for c in word}
    return len(word) > 1 and kinds not in ({"blank"}, {"digit"})


ALPHABET = st.sampled_from(list("ab字，。;；!！?？,.　 \u0085\x1c\n\t 1²") + [" "])


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=30), min_size=400, max_size=400))
def test_sentences_match_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: (r.s, r.l) for r in df.select("i", text.sentences("t").alias("s"), text.sentences("t", True).alias("l")).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == pieces_by_character(t, ends_at_blank=True)
        assert got[i][1] == pieces_by_character(t, ends_at_blank=False)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=4), min_size=400, max_size=400))
def test_terms_match_python(spark, words):
    df = spark.createDataFrame(list(enumerate(words)), "i int, w string")
    got = {r.i for r in df.where(text.is_term("w")).collect()}
    assert got == {i for i, w in enumerate(words) if counts_as_term(w)}


def test_full_width_space_splits(one):
    assert one(text.sentences(F.lit("a　b c,d")))[0] == ["a", "b", "c", "d"]


def test_names_and_labels(one):
    row = one(
        text.file_safe(F.lit('a\\b/c:d*e?f"g<h>i|j')), text.output_name(F.lit(None).cast("string"), F.lit("a/b")),
        text.output_name(F.lit("C"), F.lit("t"), prefix="Dcard"), text.output_name(F.lit("C"), F.lit(None).cast("string"), F.lit("task")),
        text.keyword_label(F.array(*[F.lit(c) for c in "abcde"])), text.keyword_label(F.array(*[F.lit(c) for c in "abcdef"])),
        text.rank_label(F.lit(1), F.lit("w"), F.lit(3)), text.preview(F.lit("字字字"), 2), F.char_length(F.lit("😀字")),
    )
    assert list(row) == ["a_b_c_d_e_f_g_h_i_j", "Unknown_a_b", "Dcard_C_t", "C_task", "a、b、c、d、e", "a、b、c...", "1. w (3)", "字字", 2]


def test_addresses(one):
    row = one(
        urls.canonical_url(F.lit("https://i/p/1/?x=2?y")), urls.canonical_url(F.lit("https://i/p/1")),
        urls.rewrite_host(F.lit("https://www.threads.com/a"), "threads.com", "threads.net"),
        urls.absolute_url("https://n", F.lit("./articles/x")), urls.absolute_url("https://n", F.lit("/bbs/y")),
        urls.post_id(F.lit("https://d/f/p/p/12?c=/p/")), urls.post_id(F.lit("https://d/f/a/p/12?c=1")),
    )
    url = "https://d/f/p/p/12?c=/p/"
    assert list(row) == [
        "https://i/p/1/", "https://i/p/1/", "https://www.threads.net/a", "https://n/articles/x", "https://n/bbs/y",
        url.split("/p/")[-1].split("?")[0], "12",
    ]
