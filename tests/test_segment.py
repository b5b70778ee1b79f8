import random
from itertools import combinations
from math import log

import pytest
from pyspark.sql import functions as F

from hubbub.operators import segment, units
from hubbub.sources.lexicon import weighted_dictionary

HAN = "台北市政府加密貨幣"


def brute_force(text, weights):
    """Best score over all ways to cut a text into dictionary words and single characters."""
    log_total = log(sum(weights.values()))
    best = None
    for k in range(len(text)):
        for cuts in combinations(range(1, len(text)), k):
            ends = (*cuts, len(text))
            words = [text[a:b] for a, b in zip((0, *cuts), ends)]
            if all(len(w) == 1 or w in weights for w in words):
                score = sum(log(weights.get(w, 1.0)) - log_total for w in words)
                best = score if best is None else max(best, score)
    return best


def test_path_is_the_most_probable_one():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice(HAN[:4]) for _ in range(rng.randrange(1, 9)))
        weights = {"".join(rng.choice(HAN[:4]) for _ in range(rng.randrange(1, 4))): float(rng.randrange(1, 50)) for _ in range(6)}
        known = segment.Dictionary([(w, v, None) for w, v in weights.items()])
        words = known.cut(text)
        assert "".join(words) == text
        assert all(len(w) == 1 or w in weights for w in words)
        score = sum(log(weights.get(w, 1.0)) - log(sum(weights.values())) for w in words)
        assert score == pytest.approx(brute_force(text, weights))


def test_runs_and_loose_characters():
    known = segment.Dictionary([("台北", 1, "Nc"), ("柯P", 1, "Nb"), ("台北市政府", 1, "Nc")])
    assert known.cut("台北市政府說3.5%的iPhone15...柯P") == ["台北市政府", "說", "3.5%", "的", "iPhone15", "...", "柯P"]
    assert known.cut("é（x）") == ["é", "（", "x", "）"]
    assert segment.Dictionary([]).cut("abc 中文") == ["abc", " ", "中", "文"]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(
        [("a", 0, "台北市政府，加密貨幣 XD"), ("a", 1, ""), ("b", 0, "貨幣加密！不知道不知道")], "article_url string, unit_ix int, text string")


def test_dictionary_join_gives_the_same_words(spark, texts):
    lexicon = weighted_dictionary(
        spark, {"台北市政府": 1, "台北": 3, "加密貨幣": 1, "不知道": 2, "": 1, "來亂的": "啦", "貨幣": True},
        {"台北市政府": "Nc", "不知道": "VK"})
    assert lexicon.count() == 4
    small = segment.segment(texts, lexicon, small=True).select("article_url", "unit_ix", "tagged")
    large = segment.segment(texts, lexicon, small=False).select("article_url", "unit_ix", "tagged")
    got = {(r.article_url, r.unit_ix): [(t.word, t.pos) for t in r.tagged] for r in small.collect()}
    assert got == {(r.article_url, r.unit_ix): [(t.word, t.pos) for t in r.tagged] for r in large.collect()}
    assert got["a", 0] == [("台北市政府", "Nc"), ("加密貨幣", "x"), ("XD", "x")]
    assert got["a", 1] == []
    assert got["b", 0] == [("貨", "x"), ("幣", "x"), ("加", "x"), ("密", "x"), ("！", "x")][:4] + [("不知道", "VK"), ("不知道", "VK")]


def test_registered_segmentation_against_plain_python(spark, tmp_path):
    """The registered dictionary query over a small table, word by word in plain Python."""
    import re
    from collections import Counter

    from workload import QUERIES

    docs = [(0, "abab cdab, xyzxyz"), (1, "cdcd ab!abcd"), (2, "")]
    bench = [(0, "ab ab cd xyzxyz abcdxyz")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {(r.doc_id, r.word): r.n for r in QUERIES["segmented_terms_lexicon"](spark, str(tmp_path)).collect()}
    counts = Counter(bench[0][1].split())
    known = segment.Dictionary([(w, float(n), "P" if len(w) < 4 else "VA" if len(w) < 7 else "Na") for w, n in counts.items()])
    want = Counter()
    for doc, text in docs:
        for part in re.split(r"[,!\s]", text):
            want.update((doc, w) for w in known.cut(part) if len(w) > 1 and known.tag(w, "x")[0] in "NV")
    assert got == dict(want) and got == {(0, "xyzxyz"): 1}


def test_registered_enrichment_against_plain_python(spark, tmp_path):
    import re
    from collections import Counter

    from workload import QUERIES

    text = "abab xyzxyz\nlonglong xyzxyz abab\nlonglong! zz"
    bench = "abab abab xyzxyz longlong"
    spark.createDataFrame([(0, text, "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, bench)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    row = QUERIES["enriched_articles_tagged"](spark, str(tmp_path)).first()
    known = segment.Dictionary([(w, float(n), "VA" if len(w) < 7 else "Na") for w, n in Counter(bench.split()).items()])
    units_ = [[w for part in re.split(r"[!\s]", line) for w in known.cut(part) if known.tag(w, "x") != "x"] for line in text.split("\n")]
    assert row.keywords == " ".join(units_[0]) == "abab xyzxyz"
    want = Counter(w for unit in units_[1:] for w in unit).most_common()
    assert row.comments_top == " ".join(f"{w}:{n}" for w, n in want) == "longlong:2 xyzxyz:1 abab:1"
    assert row.content_top == "abab:1 xyzxyz:1"


def test_token_rows_keep_order(spark, texts):
    cut = segment.segment(texts, None)
    rows = units.token_rows(cut, segment.words()).where("article_url = 'a'").orderBy("pos").collect()
    assert [r.word for r in rows] == list("台北市政府加密貨幣") + ["XD"]
    assert cut.select(F.size("tagged")).where("article_url = 'a' and unit_ix = 1").first()[0] == 0


def test_more_blocks_than_are_remembered(monkeypatch):
    """Texts of one batch with more different blocks than the table holds keep their own words."""
    rows, texts = [("ab", 9.0, "N"), ("cd", 9.0, "V")], [f"abcd w{i} ab, {i}cd" for i in range(60)] + ["", None, "abcd w1"]
    want = segment.Dictionary(rows).tagged(texts, "x").to_pylist()
    for remembered in (0, 1, 7, 50):
        monkeypatch.setattr(segment, "_REMEMBERED", remembered)
        known = segment.Dictionary(rows)
        assert known.tagged(texts, "x").to_pylist() == want
        assert len(known.cuts) + len(known.words) <= remembered + 10
        assert [known.cut(t) for t in texts if t] == [segment.Dictionary(rows).cut(t) for t in texts if t]


def test_blocks_of_many_texts_are_cut_together(monkeypatch):
    """New blocks of all texts of a slice go through one search, and those met before through none."""
    asked, search = [], segment.Dictionary.best_ends
    monkeypatch.setattr(segment.Dictionary, "best_ends", lambda self, *blocks: asked.append(1) or search(self, *blocks))
    known = segment.Dictionary([("ab", 9.0, "N"), ("台北", 2.0, "V")])
    texts = [f"abc w{i % 7}, 3.{i % 5}% 台北市é" for i in range(300)]
    rows = known.tagged(texts, "x").to_pylist()
    assert len(asked) == 1
    assert [(t["word"], t["pos"]) for t in rows[6]] == [("ab", "N"), ("c", "x"), ("w6", "x"), ("3.1%", "x"), ("台北", "V"), ("市", "x"), ("é", "x")]
    assert known.tagged(texts, "x").to_pylist() == rows and len(asked) == 1


def test_texts_longer_than_a_window(monkeypatch):
    rows, texts = [("ab", 9.0, "N"), ("台北", 2.0, "V")], ["abcab 台北é " * 30, "", "abab" * 40, None, "a,b" * 50]
    want = segment.Dictionary(rows).tagged(texts, "x").to_pylist()
    for window in (1, 10, 100):
        monkeypatch.setattr(segment, "_WINDOW", window)
        assert segment.Dictionary(rows).tagged(texts, "x").to_pylist() == want


def test_words_of_neighbours_travel_once(spark):
    """A word that stands in every one of many neighbouring texts is looked up once for all of them."""
    texts = spark.range(0, 1000, 1, 1).select((F.col("id") / 500).cast("bigint").alias("_near"), F.lit("abc abcd,ab").alias("text"))
    words = spark.createDataFrame([("ab",), ("abcd",), ("zz",)], "word string")
    assert sorted(map(tuple, segment.parts_near(texts, words).collect())) == [(0, "ab"), (0, "abcd"), (1, "ab"), (1, "abcd")]


def test_join_over_many_neighbourhoods(spark, monkeypatch):
    monkeypatch.setattr(segment, "_NEAR_BITS", 2)
    rng = random.Random(8)
    make = lambda a, b: "".join(rng.choice("ab台北, ") for _ in range(rng.randrange(a, b)))
    lexicon = spark.createDataFrame([(w, float(rng.randrange(1, 9)), rng.choice(["N", None])) for w in {make(1, 5) for _ in range(80)}], "word string, weight double, tag string")
    texts = spark.createDataFrame([(rng.choice(["u", None]), i % 3, rng.choice([None, "", make(0, 60)])) for i in range(100)], "article_url string, unit_ix int, text string").repartition(3)
    texts = texts.withColumns({"weight": F.lit("a unit's own"), "tag": F.lit(1)})
    near, far = (sorted(map(str, segment.segment(texts, lexicon, small=s).collect())) for s in (True, False))
    assert near == far and len(near) == 100


def test_words_of_earlier_neighbours_may_go(monkeypatch):
    monkeypatch.setattr(segment, "_LISTED", 2)
    nearby = segment.Nearby(5.0)
    cuts = []
    for place, words in enumerate((["ab", "cd", "ef"], ["cd"], ["gh"], [])):
        nearby.learn(place, words, [2.0] * len(words), ["N"] * len(words))
        assert len(nearby.rows) <= 3
        cuts.append([[(t["word"], t["pos"]) for t in own] for own in nearby.dictionary().tagged([w * 2 for w in words], "x").to_pylist()])
    assert cuts == [[[(w, "N")] * 2 for w in own] for own in (["ab", "cd", "ef"], ["cd"], ["gh"], [])]
