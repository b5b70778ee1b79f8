import random
import re

import numpy as np
import pytest

from hubbub.llm import ngram_join
from hubbub.llm.wordtable import Powers
from llm_texts import story


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_join(rows):
    """(doc_id, n_shingles, component_id) of every row, by comparing all pairs."""
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 80 * (len(sets[i]) + len(sets[j]) - inter):
                label[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        ids = least.setdefault(top(i), [])
        ids += [d] if d is not None else []
    return sorted(str((d, len(s), min(least[top(i)], default=None) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def joined(frame, rows):
    return sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in ngram_join.join(frame(rows)).collect())


def changed(text, k, seed):
    pick, words = random.Random(seed), text.split()
    for _ in range(k):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10_000)}"
    return " ".join(words)


def crowd(seed=0):
    """Copies, near copies of growing distance around one text, and texts that share one passage."""
    base, passage = story(120, 900 + seed), story(55, 901 + seed)
    near = [changed(base, k % 5, k) for k in range(60)]
    mixed = [passage + " " + story(8 + k % 30, 2000 + k) for k in range(40)]
    twice = [changed(near[3], 2, 77), changed(near[3], 2, 78), base, base, base.upper()]
    return [(i + 500, t) for i, t in enumerate([*near, *mixed, *twice, *[story(30, 3000 + k) for k in range(30)]])]


def test_dirty_rows(frame, dirty):
    assert joined(frame, dirty) == plain_join(dirty)


@pytest.mark.parametrize("small, block, task_rows", [(16, 1024, 600_000), (2, 1024, 5), (2, 7, 600_000)])
def test_large_meetings_lose_no_link(frame, monkeypatch, small, block, task_rows):
    monkeypatch.setattr(ngram_join, "TASK_ROWS", task_rows)
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = crowd()
    assert joined(frame, rows) == plain_join(rows)


def test_threshold_is_exact(frame):
    # 5 of 6 words differ at the end only: 80 shared of 100 shingles links, 79 of 100 does not.
    head = [f"h{i}" for i in range(84)]
    rows = []
    for at, shared in ((0, 80), (10, 79)):
        own = head[:shared + 4] if shared == 80 else [w + "x" for w in head[:shared + 4]]
        left, right = (100 - shared) // 2, 100 - shared - (100 - shared) // 2
        rows += [(at, " ".join(own + [f"l{at}{i}" for i in range(left)])), (at + 1, " ".join(own + [f"r{at}{i}" for i in range(right)]))]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(frame(rows)).collect()}
    assert got == {0: 0, 1: 0, 10: 10, 11: 11}


def test_parities_bound_the_difference():
    pick = np.random.default_rng(1)
    for _ in range(200):
        pool = np.unique(pick.integers(0, 1 << 63, 800).astype(np.uint64))
        x, y = (np.sort(pick.choice(pool, pick.integers(1, 700), replace=False)) for _ in range(2))
        differ = ngram_join.differing(ngram_join.parities(x), ngram_join.parities(y))
        assert differ <= len(np.setxor1d(x, y)) and (differ > 0) == (len(np.setxor1d(x, y)) > 0)


def test_similar_sets_share_leading_tokens_in_every_order():
    pick, classes = np.random.default_rng(2), np.random.default_rng(3).integers(0, 4, ngram_join.COUNTERS).astype(np.uint8)
    for _ in range(200):
        n = int(pick.integers(1, 200))
        x = np.unique(pick.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[pick.random(len(x)) > 0.12], pick.integers(0, 1 << 63, max(0, n // 15)).astype(np.uint64)]))
        if ngram_join.similar(len(np.intersect1d(x, y)), len(x), len(y), 80):
            assert all(len(np.intersect1d(ngram_join.prefix(x, k, classes), ngram_join.prefix(y, k, classes))) for k in range(ngram_join.ORDERS))


def test_sets_do_not_depend_on_neighbours(dirty):
    texts = [t or "" for _, t in dirty]
    for t, s in zip(texts, ngram_join.shingle_sets(texts, Powers())):
        assert (ngram_join.shingle_sets([t], Powers())[0] == s).all() and len(s) == len(plain_set(t))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (-5, 101)], "a long, b long")
    got = {r["id"]: r["label"] for r in ngram_join.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: -5, 101: -5, -5: -5}


def test_keep_one(frame):
    rows = crowd()
    docs = frame(rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = {eval(r)[2] for r in plain_join(rows)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_keep_one_decides_by_row(frame):
    a, b, c = story(60, 41), story(60, 42), story(60, 43)
    rows = [
        (1, a), (1, a), (1, a), (2, a + " more"),  # repeated rows of the kept document
        (3, b), (1, b + " more"), (1, b + " more"),  # another text under an id that stays elsewhere, of a group that 1 leads
        (None, ""), (None, None), (None, a), (None, a + " x"),  # no id: a wordless row brings no copy of a kept document back
        (None, c), (None, c), (4, c + " y"), (5, c + " y"),
        (6, ""), (6, ""),
    ]
    got = sorted(((r["doc_id"], r["text"]) for r in ngram_join.keep_one(frame(rows)).collect()), key=str)
    assert got == sorted([(1, a), (1, b + " more"), (4, c + " y"), (6, ""), (None, ""), (None, None)], key=str)


def test_keep_one_of_rows_without_ids(frame):
    a = story(60, 44)
    got = [r["text"] for r in ngram_join.keep_one(frame([(None, a), (None, a), (None, a + " more"), (7, ""), (7, story(40, 45))])).collect()]
    assert len(got) == 3 and sum(t.startswith(a) for t in got) == 1


def test_empty_table(frame):
    assert joined(frame, []) == [] and ngram_join.keep_one(frame([])).collect() == []


def test_orders_are_intersected_before_sets_travel(spark):
    """Pairs without a shared leading token under some order are dropped from slim rows; similar pairs never are."""
    base = [story(200, k).split() for k in range(4)]
    texts = [" ".join(w) for w in base] + [" ".join(w[:-3]) for w in base] + [" ".join(w[:100]) for w in base]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    powers, classes = Powers(), np.zeros(ngram_join.COUNTERS, np.uint8)
    sets = ngram_join.shingle_sets(texts, powers)
    ids = [ngram_join.digest(s) for s in sets]
    pairs = spark.createDataFrame([(ids[i], ids[j]) for i in range(12) for j in range(12) if i < j], "a long, b long")
    kept = {(r["a"], r["b"]) for r in ngram_join.sharing_leads(rows, pairs, classes, 5, 80).collect()}
    for i in range(12):
        for j in range(i + 1, 12):
            x, y = sets[i], sets[j]
            if ngram_join.similar(len(np.intersect1d(x, y)), len(x), len(y), 80):
                assert (ids[i], ids[j]) in kept
    assert 4 <= len(kept) < 40
    links = {(r["a"], r["b"]) for r in ngram_join.verified(rows, ngram_join.durable(pairs), classes, 5, 80).collect()}
    assert links == {(ids[k], ids[k + 4]) for k in range(4)}


def test_counters_beyond_a_byte(spark):
    """A shingle in more than 255 sets of one task is counted on."""
    rows = spark.createDataFrame([(k, f"one two three four five {k}") for k in range(700)], "doc_id long, text string").coalesce(1)
    profiled = ngram_join.durable(ngram_join.profile(rows, 5))
    classes = ngram_join.token_classes(profiled, 1400)
    # Twice the mean load is 2; 700 = 2 x 350 lies in the ninth class.
    assert classes.max() == 8
