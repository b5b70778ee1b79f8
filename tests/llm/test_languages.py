import collections
import math
import unicodedata
import zlib

import pytest

from hubbub.llm import languages

WORDS = {
    "aa": "the and of water house green tree running through winter".split(),
    "bb": "der und das wasser haus grün baum läuft durch winter".split(),
    "cc": "вода дом зеленый дерево бежит через зима и на".split(),
}


def story(lang, n, seed):
    import random

    pick = random.Random(f"{lang}{seed}")
    return " ".join(pick.choice(WORDS[lang]) for _ in range(n))


def plain_words(text):
    """Runs of letters and marks with a letter, in pieces."""
    words, run = [], ""
    for c in (text or "").lower() + "\0":
        if unicodedata.category(c)[0] in "LM":
            run += c
            continue
        if any(unicodedata.category(x)[0] == "L" for x in run):
            words += [run[a:a + languages.LONGEST] for a in range(0, len(run), languages.LONGEST)]
        run = ""
    return words


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def plain(rows, entries=languages.ENTRIES):
    """The method word by word, over (id, text, lang)."""
    counts = collections.defaultdict(collections.Counter)
    for i, text, lang in rows:
        if i is not None and not out(i) and lang is not None and text is not None:
            for w in plain_words(text):
                counts[lang, 0][w] += 1
                for size in range(1, languages.ORDERS + 1):
                    for a in range(len(w) + 3 - size):
                        counts[lang, size][f" {w} "[a:a + size]] += 1
    names = sorted({lang for lang, _ in counts})
    keep = max(1, entries // ((languages.ORDERS + 1) * max(1, len(names))))
    model = collections.defaultdict(dict)
    for (lang, size), own in counts.items():
        for unit, n in sorted(own.items(), key=lambda u: (-u[1], u[0].encode()))[:keep]:
            model[size, unit][lang] = -math.log10(n / own.total())
    value = lambda size, unit: [model[size, unit].get(lang, languages.PENALTY) for lang in names]
    result = []
    for i, text, _ in rows:
        scores = []
        for w in plain_words(text):
            if (0, w) in model:
                scores.append(value(0, w))
                continue
            for size in range(languages.ORDERS, 0, -1):
                found = [value(size, g) for g in (f" {w} "[a:a + size] for a in range(len(w) + 3 - size)) if (size, g) in model]
                if found:
                    scores.append([sum(c) / len(found) for c in zip(*found)])
                    break
            else:
                scores.append([languages.PENALTY] * len(names))
        if not scores or not names:
            result.append((i, out(i), "und", 0.0))
            continue
        mean = [sum(c) / len(scores) for c in zip(*scores)]
        best = min(range(len(names)), key=lambda k: (round(mean[k], 9), names[k]))
        result.append((i, out(i), names[best], 1 / sum(10 ** (mean[best] - m) for m in mean)))
    return result


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, lang, "x", "x", "x") for i, t, lang in rows], "doc_id long, text string, lang string, word string, unit string, size string")
    model = languages.fit(frame, **options)
    return [tuple(r) for r in languages.predict(frame, model).collect()]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[3], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


CORPUS = [(i, story(lang, 20 + i % 9, i), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 30)]
ODD = [
    None, "", " \n\t12 34 ²½", "the", "winter", "Wassr huase", "дома лесу", "日本語のテキスト", "x" * 5000 + " the", "é" * 100, "́́ áb", "\0the\0und", "Straße ẞ İ",
    "a" * 39 + " " + "b" * 40 + " " + "c" * 41 + " " + "ü" * 41, "zz qq", "naïve über wasser 😀 water", "don't the",
]
DIRTY = CORPUS + [(1000 + k, t, ["aa", None, "", "zz"][k % 4]) for k, t in enumerate(ODD)] + [(3, CORPUS[3][1], "aa"), (None, "the house", "nobody"), (None, None, None)]


def test_same_as_the_plain_method(spark):
    same(found(spark, DIRTY), plain(DIRTY))


@pytest.mark.parametrize("entries", [1, 60, 400])
def test_a_smaller_model(spark, entries):
    same(found(spark, DIRTY, entries=entries), plain(DIRTY, entries))


def test_small_tables(spark, monkeypatch):
    """Tables and counters that overflow all the time change nothing."""
    want = found(spark, DIRTY)
    for name, value in (("TABLE_WORDS", 8), ("HELD", 10), ("SCORES", 1), ("PARTS", 3)):
        monkeypatch.setattr(languages, name, value)
    same(found(spark, DIRTY), want)


def test_held_out_rows_teach_nothing(spark):
    """Held-out rows and rows without id carry wrong languages here."""
    rows = [(i, t, "wrong" if out(i) else lang) for i, t, lang in CORPUS] + [(None, "the and", "wrong")]
    assert {r[2] for r in found(spark, rows)} == {"aa", "bb", "cc"}


def test_held_out_accuracy(spark):
    from hubbub.llm.shared import table

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    true = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in languages.identify(docs).collect() if r["held_out"]]
    assert len(held) > 100 and sum(r["lang_pred"] == true[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_nothing_to_learn_from(spark):
    assert found(spark, []) == []
    assert {r[1:] for r in found(spark, [(1, "the", None), (3, None, "aa"), (4, "12", "aa")])} <= {(False, "und", 0.0), (True, "und", 0.0)}
