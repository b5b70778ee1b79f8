import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from hubbub.llm import fingerprints
from llm_texts import story


def plain_print(text):
    """The 128 bits by counting votes one by one."""
    words = [w for w in re.split("[ \t\n\x0b\f\r]+", text) if w]
    votes = [0] * 128
    for i in range(len(words)):
        seed = 42
        for w in words[i:i + 3]:
            seed = xxhash.xxh64_intdigest(w.encode(), seed=seed)
        other = xxhash.xxh64_intdigest(seed.to_bytes(8, "little"), seed=42)
        for k in range(64):
            votes[k] += 1 if seed >> k & 1 else -1
            votes[64 + k] += 1 if other >> k & 1 else -1
    half = lambda v: sum(1 << k for k in range(64) if v[k] > 0)
    return f"{half(votes[:64]):016x}{half(votes[64:]):016x}"


def plain(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 3
        edited = t[:len(t) - cut] + follow[:cut] if cut else t
        own, then, after = plain_print(t), plain_print(edited), plain_print(follow)
        like = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
        out.append(str((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, then, like(own, then), like(own, after))))
    return sorted(out)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("block, steps", [(256, 256), (2, 3)])
def test_dirty_rows(frame, dirty, monkeypatch, block, steps):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", block)
    monkeypatch.setattr(fingerprints, "STEPS", steps)
    got = fingerprints.fingerprint_edited(frame(dirty)).select(*COLUMNS).collect()
    assert sorted(str(tuple(r)) for r in got) == plain(dirty)


def test_uneven_ids(frame, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 4)
    rows = [(i, story(20, i)) for i in [*range(40), 10**6, 10**6 + 1, 5 * 10**15, -7]]
    got = fingerprints.fingerprint_edited(frame(rows)).select(*COLUMNS).collect()
    assert sorted(str(tuple(r)) for r in got) == plain(rows)


def test_blocks_of_dense_runs(spark, monkeypatch):
    """More dense runs of ids than steps: no block is much larger than meant."""
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 50)
    monkeypatch.setattr(fingerprints, "STEPS", 8)
    ids = spark.range(40 * 60).select((F.expr("id div 60") * 10**9 + F.col("id") % 60).alias("doc_id"), F.lit("").alias("text"))
    got = {r["block"]: (r["count"], r["low"], r["high"]) for r in fingerprints.blocked(ids).groupBy("block").agg(F.count("*").alias("count"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).collect()}
    assert max(c for c, _, _ in got.values()) <= 100 and len(got) >= 40
    ends = [got[b][1:] for b in sorted(got)]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def plain_classes(names, radius):
    """The smallest fingerprint that each linked one reaches, by comparing all pairs."""
    names = sorted(set(names))
    numbers, label = [int(n, 16) for n in names], list(range(len(names)))
    near = [[j for j, w in enumerate(numbers) if j != i and (v ^ w).bit_count() <= radius] for i, v in enumerate(numbers)]
    changed = True
    while changed:
        changed = False
        for i, own in enumerate(near):
            least = min([label[i], *(label[j] for j in own)])
            changed |= least < label[i]
            label[i] = least
    return {names[i]: names[label[i]] for i in range(len(names)) if near[i]}


def found_classes(spark, names, radius):
    frame = spark.createDataFrame([(n,) for n in [*names, *names, None]], "fingerprint string")
    got = fingerprints.classes(frame, radius).collect()
    assert len(got) == len({r["fingerprint"] for r in got})
    # Classes are named by the smallest of signed halves: compare the partitions.
    groups = {}
    for r in got:
        groups.setdefault(r["class"], set()).add(r["fingerprint"])
    assert all(c in own for c, own in groups.items())
    return sorted(map(sorted, groups.values()))


def want_classes(names, radius):
    groups = {}
    for n, c in plain_classes(names, radius).items():
        groups.setdefault(c, []).append(n)
    return sorted(map(sorted, groups.values()))


def chains(seed, starts, copies, flips):
    """Fingerprints in chains: each differs a little from the one before."""
    import random

    pick = random.Random(seed)
    values = []
    for _ in range(starts):
        v = pick.getrandbits(128)
        values.append(v)
        for _ in range(copies):
            for k in pick.sample(range(128), pick.randint(1, flips)):
                v ^= 1 << k
            values.append(v)
    return sorted({f"{v:032x}" for v in values})


@pytest.mark.parametrize("radius, small", [(0, 16), (3, 2), (10, 3)])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, radius, small):
    monkeypatch.setattr(fingerprints, "SMALL", small)
    names = chains(radius, 10, 6, 13) + chains(radius + 1, 1, 12, 3)
    assert found_classes(spark, names, radius) == want_classes(names, radius)


def test_large_meetings_lose_no_link(spark, monkeypatch):
    """Two groups that share a front, joined by one link between members that are no leaders."""
    monkeypatch.setattr(fingerprints, "SMALL", 4)
    import random

    pick = random.Random(4)
    base = pick.getrandbits(128)
    flip = lambda v, bits: v ^ sum(1 << b for b in bits)
    one = [flip(base, pick.sample(range(0, 20), 2)) for _ in range(30)]
    other = [flip(flip(base, range(20, 34)), pick.sample(range(0, 20), 2)) for _ in range(30)]
    bridge = [flip(base, range(20, 27))]
    for extra in ([], bridge):
        names = sorted({f"{v:032x}" for v in one + other + extra})
        assert found_classes(spark, names, 9) == want_classes(names, 9)
    assert len(want_classes(names, 9)) == 1


def test_rows_in_proportion_to_the_group(spark):
    """400 near copies: no join puts out pairs of them."""
    import random

    pick = random.Random(9)
    base = pick.getrandbits(128)
    frames = {}
    for n in (400,):
        names = sorted({f"{base ^ sum(1 << b for b in pick.sample(range(128), 3)):032x}" for _ in range(n)})
        frames[n] = spark.createDataFrame([(x,) for x in names], "fingerprint string")
        assert len({r["class"] for r in fingerprints.classes(frames[n]).collect()}) == 1
    written = []
    real = fingerprints.durable
    fingerprints.durable = lambda df: written.append(real(df)) or written[-1]
    try:
        fingerprints.classes(frames[400]).collect()
    finally:
        fingerprints.durable = real
    assert max(w.count() for w in written) <= 66 * 400


def test_small_meetings_give_a_link_for_each_member(spark, monkeypatch):
    """Groups of 16 near copies: no checkpoint holds all their pairs, and their places are shuffled once."""
    import random

    pick = random.Random(5)
    names = sorted({f"{base ^ sum(1 << b for b in pick.sample(range(128), 3)):032x}" for base in [pick.getrandbits(128) for _ in range(5)] for _ in range(16)})
    frame = spark.createDataFrame([(x,) for x in names], "fingerprint string")
    written, real = [], fingerprints.durable
    monkeypatch.setattr(fingerprints, "durable", lambda df: written.append(real(df)) or written[-1])
    got = fingerprints.classes(frame).collect()
    assert len(got) == len(names) and len({r["class"] for r in got}) == 5
    pairs = [w.count() for w in written if w.columns == ["a", "b"]]
    assert pairs and max(pairs) <= len(names)
    plan = fingerprints.meetings(written[0], 10)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Generate") == 1 and "Join" not in plan


def test_one_changed_word_is_near(frame):
    words = story(300, 3).split()
    texts = [" ".join(words)] + [" ".join([*words[:k], "changed", *words[k + 1:]]) for k in range(5, len(words), 12)]
    got = fingerprints.fingerprint_edited(frame(list(enumerate(texts)))).collect()
    assert sum(r["class_id"] == 0 for r in got) >= 0.9 * len(got)


def test_class_ids(frame):
    text = story(400, 8)
    rows = [(7, text), (2, text), (3, text + " more"), (4, story(300, 9)), (None, story(300, 9)), (None, None), (9, ""), (8, " ")]
    got = fingerprints.fingerprint_edited(frame(rows), radius=16).collect()
    assert sorted(((r["doc_id"] or 0, r["class_id"]) for r in got)) == [(0, 4), (0, 8), (2, 2), (3, 2), (4, 4), (7, 2), (8, 8), (9, 8)]


def test_empty_table(frame):
    assert fingerprints.fingerprint_edited(frame([])).collect() == []


def test_no_python(frame, dirty):
    plan = fingerprints.fingerprint_edited(frame(dirty))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None
