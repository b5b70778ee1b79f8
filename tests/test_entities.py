import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hubbub.operators import entities, trie

WORDS = "art par party new york city 台北 台北市 市政府 a b ab 1 12".split()


def letter(c):
    return c.isascii() and c.isalnum()


def plain(text, names):
    """Leftmost, then longest, trying every name at every place."""
    out, at = [], 0
    while at < len(text):
        fitting = [
            n for n in names if text.startswith(n, at) and not (at and letter(text[at - 1]) and letter(n[0]))
            and not (at + len(n) < len(text) and letter(n[-1]) and letter(text[at + len(n)]))
        ]
        if fitting:
            best = max(fitting, key=len)
            out.append((at, at + len(best), names[best], best))
            at += len(best)
        else:
            at += 1
    return out


def cases(seed, n=40):
    pick = random.Random(seed)
    join = lambda k: "".join(pick.choice(WORDS) + pick.choice(["", " ", " ", ", "]) for _ in range(k))
    names = {join(pick.randrange(1, 4)).strip() or "art": pick.choice("PQ") for _ in range(25)}
    return names, [join(pick.randrange(0, 30)) for _ in range(n)] + ["", next(iter(names)), "é" + next(iter(names)) + "😀"]


@pytest.mark.parametrize("seed", range(30))
def test_spans_in_plain_python(seed):
    names, texts = cases(seed)
    got = entities.Names(list(names.items())).spans(texts).to_pylist()
    assert [list(zip(g["start"], g["end"], g["section"], g["name"])) for g in got] == [plain(t, names) for t in texts]


@pytest.mark.parametrize("small", [True, False])
def test_both_ways(spark, small):
    names, texts = cases(77)
    names |= {"x" * 70 + " y": "LONG", "x" * 70 + " yz": "LONG", "z": "ONE"}
    texts += ["so " + "x" * 70 + " yz and z", "x" * 70 + " yw z"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x"), (None, None, None)]
    units = spark.createDataFrame(rows, "doc_id long, text string, word string")
    lexicon = [(n, s) for n, s in names.items()] + [(n, "Z") for n in names] + [(None, "P"), ("", "P"), ("art", None)]
    lexicon = spark.createDataFrame(lexicon, "word string, section string")
    got = sorted(tuple(r) for r in entities.entity_spans(units, lexicon, ["doc_id"], small=small).collect())
    assert got == sorted((i, *s) for i, t, _ in rows if t for s in plain(t, names))


def test_sections_and_empty_lists(spark):
    units = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    lexicon = spark.createDataFrame([("a", "P"), ("b", "Q")], "word string, section string")
    for small in (True, False):
        assert [r["name"] for r in entities.entity_spans(units, lexicon, ["doc_id"], sections=["Q"], small=small).collect()] == ["b"]
        assert entities.entity_spans(units, lexicon.where(F.lit(False)), ["doc_id"], small=small).collect() == []
        assert entities.entity_spans(units.where(F.lit(False)), lexicon, ["doc_id"], small=small).collect() == []


def test_a_hundred_thousand_names_in_one_pass():
    pick = random.Random(1)
    names = list({f"{pick.randrange(10**7)} {pick.choice(WORDS)}" for _ in range(100_000)})
    known = entities.Names([(n, "P") for n in names])
    assert len(known.trie) == len(names) and known.trie.nbytes < 100 * len(names)
    texts = [f"-- {n} --" for n in names[:2000]]
    assert [g["name"] for g in known.spans(texts).to_pylist()] == [[n] for n in names[:2000]]


def test_trie_matches_are_all_matches():
    pick = random.Random(2)
    words = list({"".join(pick.choice("ab台") for _ in range(pick.randrange(1, 6))) for _ in range(40)})
    text = "".join(pick.choice("ab台c") for _ in range(300))
    stop = np.full(len(text), len(text))
    stop[:100] = 100
    got = list(zip(*(c.tolist() for c in trie.Trie(words).matches(trie.code_points(text), stop))))
    want = [(a, a + len(w), i) for i, w in enumerate(words) for a in range(len(text)) if text.startswith(w, a) and a + len(w) <= stop[a]]
    assert got == sorted(want)
    assert [len(c) for c in trie.Trie([]).matches(trie.code_points(text), stop)] == [0, 0, 0]
