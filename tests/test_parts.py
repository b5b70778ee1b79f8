import random
import re

import pytest

from hubbub.operators import parts


def inside(text, words):
    return {w for w in words if w in text}


@pytest.mark.parametrize("blocks", [None, re.compile("[a-z台北]+")])
def test_no_part_is_missing_and_few_others_travel(spark, monkeypatch, blocks):
    """Texts whose places all begin like some word: only what has a word's hash leaves the tasks."""
    monkeypatch.setattr(parts, "_SLICE", 100)
    pick = random.Random(5)
    make = lambda k: "".join(pick.choice("ab台北") for _ in range(k))
    words = list({make(pick.randrange(1, 30)) for _ in range(300)} | {"a" * 70, "a" * 70 + "b", "台" * 65})
    texts = [" ".join(make(pick.randrange(0, 40)) for _ in range(pick.randrange(0, 30))) for _ in range(50)] + ["x " + "a" * 70 + "ba", "台" * 70, "a" * 69, "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(2)
    got = parts.parts_like(rows, spark.createDataFrame([(w,) for w in words], "word string"), ["id"], blocks=blocks).collect()
    assert len(got) == len(set(got))
    found = {(r.id, r.word) for r in got}
    want = {(i, w) for i, t in enumerate(texts) if t for w in inside(t, words)}
    assert want <= found and len(found) < 1.5 * len(want)


def test_places_are_those_of_the_bitmap(spark):
    words = ["a", "ab", "台北", "x" * 100]
    for bits in (15, 17):
        bits_set = parts.bitmap(spark.createDataFrame([(w,) for w in words], "word string"), bits)
        at = parts.places([*words, "x" * 64], bits)
        assert (bits_set[at >> 3] >> (at & 7) & 1 == 1).all()
        assert sum(int(b).bit_count() for b in bits_set) == len(set(at.tolist()))
