import random
from difflib import SequenceMatcher

from hubbub.llm import licenses
from llm_texts import story


def common(a, b):
    """Length of a longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_increasing_is_longest():
    pick = random.Random(1)
    for _ in range(200):
        values = pick.sample(range(50), pick.randint(0, 12))
        got = [values[i] for i in licenses.increasing(values)]
        assert got == sorted(got) and len(got) == common(values, sorted(values))


def test_alignment_is_a_common_subsequence():
    pick = random.Random(2)
    for _ in range(200):
        a, b = ([pick.choice("abcdefgh") for _ in range(pick.randint(0, 15))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) <= common(a, b)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))


def test_changed_notices_reach_the_full_coverage():
    words, _ = licenses.words_of(licenses.TEMPLATES["MIT notice"])
    pick = random.Random(3)
    for k in range(12):
        own = list(words)
        for _ in range(k):
            own[pick.randrange(len(own))] = f"other{pick.randrange(99)}"
        best = common(words, own)
        pairs = licenses.align(words, own)
        assert best - len(pairs) <= 2 and SequenceMatcher(None, words, own, autojunk=False).ratio() <= 1


def test_every_template_is_found_where_it_stands():
    own = licenses.prepared(licenses.TEMPLATES, licenses.COVERAGE)
    for name, text in licenses.TEMPLATES.items():
        body = story(300, 4) + "\n" + text + "\n" + story(200, 5) + " " + text.upper().replace(" ", "\n")
        got = [(n, c, body[s:e]) for n, c, s, e in licenses.find(body, own) if n == name]
        assert [c for _, c, _ in got] == [1.0, 1.0] and got[0][2].strip(".") == text.strip(".")
    assert licenses.find(story(2000, 6) + " the license of a version under public terms", own) == []


def test_stray_key_words_near_the_start_hide_no_notice():
    own = {t.name: t for t in licenses.prepared(licenses.TEMPLATES, licenses.COVERAGE)}
    notice = licenses.TEMPLATES["MIT notice"]
    for stray in ("Documentation", "Merge", "Persons"):
        for k in range(own["MIT notice"].slack):
            body = f"{stray} {'foo ' * k}{notice}"
            got = [(c, body[s:e]) for n, c, s, e in licenses.find(body, own.values()) if n == "MIT notice"]
            assert len(got) == 1 and got[0][0] == 1.0 and got[0][1].endswith(notice[11:])
    for lead in ("Documentation of foo. Copyright 2020 Jane Doe. ", "See http://www.apache.org for details. "):
        for name in ("MIT notice", "Apache-2.0 notice"):
            assert [c for n, c, *_ in licenses.find(lead + licenses.TEMPLATES[name], own.values()) if n == name] == [1.0]


def test_the_name_and_version_must_match():
    own = licenses.prepared(licenses.TEMPLATES, licenses.COVERAGE)
    names = lambda text: sorted(n for n, *_ in licenses.find(text, own))
    for kind in ("BY", "BY-SA", "BY-NC"):
        assert names(f"Licensed under CC {kind} 4.0.") == [f"CC-{kind}-4.0 reference"]
    assert names("Released under the BSD License.") == [] and names("Licensed under CC BY 3.0.") == []
    assert names("This work is licensed under the GNU General Public License, version 2.") == []
    assert names("This work is licensed under the GNU Lesser General Public License, version 3.") == []
    for name, text in licenses.TEMPLATES.items():
        if "GPL" in name or name in ("ISC notice", "Unlicense"):
            assert names(text) == [name]


def test_dirty_rows_and_repeats(frame, dirty):
    line = "Released under the MIT License."
    rows = [*dirty, (70, (line + " ") * 3), (71, "released under mit license"), (72, "released the license"), (73, line), (73, line)]
    got = licenses.scan(frame(rows)).collect()
    assert sorted((r["doc_id"], r["license"], r["coverage"], r["start"]) for r in got) == [
        (70, "MIT reference", 1.0, 0), (70, "MIT reference", 1.0, 32), (70, "MIT reference", 1.0, 64), (71, "MIT reference", 0.8, 0), (73, "MIT reference", 1.0, 0), (73, "MIT reference", 1.0, 0)]


def test_empty_table(frame):
    assert licenses.scan(frame([])).collect() == []
