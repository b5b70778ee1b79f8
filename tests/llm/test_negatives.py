import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from hubbub.llm import negatives

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    *[T.StructField(c, T.StringType()) for c in ("id", "block", "vec", "score", "asked")],
])


def plain(rows, every=50, positives=5, negatives_=3, low=50, high=95):
    """All scores of every anchor, sorted."""
    rows = [(i, l, [math.floor(256 * float(np.float32(x))) for x in v]) for i, l, v in rows if None not in (i, l, v) and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, label, v in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, l) for i, l, w in rows if i != a)
        for s, p in [(-s, i) for s, i, l in scored if l == label][:positives]:
            inside = [(-n, i) for n, i, l in scored if l != label and low * s <= -100 * n <= high * s]
            out += [(a, p, k, i, s, n) for k, (n, i) in enumerate(inside[:negatives_], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in negatives.mine(frame, lambda i: i % 50 == 0, **options).collect())


def vectors(n, seed, size=8, step=64, labels=4):
    """Coarse components, so that many scores are equal."""
    pick = random.Random(seed)
    return [(i, pick.randrange(labels), [round(pick.gauss(0.1, 0.3) * step) / step for _ in range(size)]) for i in range(n)]


@pytest.mark.parametrize("block", [1 << 19, 200, 40])
def test_same_as_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK_VALUES", block)
    monkeypatch.setattr(negatives, "FIRST_ROWS", 2)
    for rows in (vectors(300, block), vectors(260, block + 1, step=2), vectors(220, block + 2, size=3, step=4, labels=2)):
        assert mined(spark, rows) == plain(rows)


def test_dirty_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_VALUES", 160)
    rows = vectors(200, 3)
    same = [(1000 + k, k % 3, rows[50][2]) for k in range(120)]  # one vector very often, anchors among them
    odd = [
        (400, None, rows[0][2]), (450, 1, None), (None, 1, rows[0][2]), (500, 1, [None] + rows[0][2][1:]), (550, 1, [math.nan] + rows[0][2][1:]),
        (600, 1, [math.inf] + rows[0][2][1:]), (650, 1, [0.0] * 8), (651, 2, [0.0] * 8), (-50, 1, [-x for x in rows[0][2]]), (-51, 2, rows[0][2]), (700, 77, rows[0][2]),
    ]
    want = plain(rows + same + odd)
    assert mined(spark, rows + same + odd) == want and len(want) > 100
    # Empty vectors, others of another length, components beyond the bound; repeated rows.
    more = [(750, 1, []), (800, 1, [1.0]), (850, 1, [1e30] * 8)]
    assert mined(spark, (rows + same + odd) * 2 + more) == want


def test_few_partners(spark):
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 0.5]), (50, 3, [1.0, 1.0])]
    assert mined(spark, rows) == plain(rows) == [(0, 1, 1, 2, 98304, 49152)]
    assert mined(spark, rows[:1]) == [] and mined(spark, []) == []


def test_other_limits(spark):
    rows = vectors(150, 9)
    assert mined(spark, rows, positives=2, negatives=7, low=10, high=120) == plain(rows, positives=2, negatives_=7, low=10, high=120)


def test_threshold_stops_early():
    """Lists with one row far ahead are left after the first rounds, and what was not seen lies below the threshold."""
    random_ = np.random.default_rng(1)
    block = random_.integers(-20, 20, (5000, 4))
    block[77] = [900, 900, 900, 900]
    lists, anchor = negatives.Lists(np.arange(5000), np.ones(5000, int), block), np.array([3, 2, 0, 5])
    found, scores = lists.positives(-1, 1, anchor, 1)
    assert found.tolist() == [77] and scores.tolist() == [9000]
    seen, rounds = np.zeros(5000, bool), 0
    for new, got, threshold in lists.rounds(anchor):
        assert not seen[new].any() and (got == block[new] @ anchor).all()
        seen[new] = True
        rounds += 1
        assert threshold is None or (block[~seen] @ anchor <= threshold).all()
        if threshold is not None and threshold < 9000:
            break
    assert rounds == 1 and seen.sum() < 500


def test_large_integers_stay_exact():
    block = np.array([[(1 << 24) - 1] * 40, [(1 << 24) - 2] * 40])
    lists = negatives.Lists(np.arange(2), np.ones(2, int), block)
    assert lists.scores(np.arange(2), block[0]).tolist() == [40 * ((1 << 24) - 1) ** 2, 40 * ((1 << 24) - 1) * ((1 << 24) - 2)]


def test_sql_agrees(spark):
    from pyspark.sql import functions as F

    rows = vectors(200, 5) + [(350, 1, None), (357, None, [0.5] * 8), (400, 2, [0.0] * 8)]
    db = duckdb.connect()
    db.execute("create table embeddings (vec_id bigint, label integer, embedding float[])")
    db.executemany("insert into embeddings values (?, ?, ?)", [list(r) for r in rows])
    names = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    want = sorted(db.execute(f"select {names} from ({negatives.SQL})").fetchall())
    changed = [(i, (l + 1) % 10 if i % 7 == 0 and l is not None else l, v) for i, l, v in rows]
    assert mined(spark, changed) == want and F is not None
