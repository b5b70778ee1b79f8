import numpy as np
import pytest

from hubbub.llm import ann

SCHEMA = "vec_id long, embedding array<float>, vec string, place int, leaf int"


@pytest.fixture(scope="module")
def cloud():
    random = np.random.default_rng(6)
    centres = random.normal(size=(12, 16))
    return (centres[random.integers(0, 12, 3000)] + 0.5 * random.normal(size=(3000, 16))).astype(np.float32) * random.uniform(0.5, 2, (3000, 1)).astype(np.float32)


def plain(rows, k):
    rows = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            near = sorted((-float((x * y).sum()), i) for i, y in rows if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def found(spark, rows, **options):
    data = [(i, v, "x", 1, 2) for i, v in rows]
    got = ann.search(spark.createDataFrame(data, SCHEMA), lambda i: i % 20 == 0, **options).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_order_and_scores(spark, cloud):
    rows = [(i, v.tolist()) for i, v in enumerate(cloud)]
    got, want = found(spark, rows), plain(rows, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)
    for q, near in got.items():
        assert near == sorted(near, key=lambda n: (-n[1], n[0]))
        assert all(abs(s - float((cloud[q].astype(float) * cloud[i]).sum())) < 1e-9 for i, s in near)


def test_small_shards_find_the_same(spark, cloud, monkeypatch):
    rows = [(i, v.tolist()) for i, v in enumerate(cloud[:900])]
    first = found(spark, rows)
    monkeypatch.setattr(ann, "SHARD_ROWS", 10)
    assert found(spark, rows) == first


def test_common_vector_and_ties(spark, cloud):
    same = cloud[0].tolist()
    rows = [(i, same if i % 3 else cloud[i].tolist()) for i in range(600)]
    got, want = found(spark, rows), plain(rows, 20)
    hits = [[i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want]
    assert got.keys() == want.keys() and sum(hits) >= 0.9 * len(hits)


def test_rows_that_take_no_part(spark):
    good = [(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, -0.5]), (3, [-1.0, 0.0])]
    bad = [(40, None), (60, [0.0, 0.0]), (80, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 1.0]), (6, []), (7, [1.0]), (None, [1.0, 1.0])]
    assert found(spark, good + bad) == {20: [(1, 0.5), (2, 0.5), (3, -1.0)]}
    # A repeated row of the query is the query's own.
    assert found(spark, [*good, good[0]]) == {20: [(1, 0.5), (2, 0.5), (3, -1.0)]}


def test_repeated_rows_take_no_places(spark, cloud):
    rows = [(i, v.tolist()) for i, v in enumerate(cloud[:60] / np.linalg.norm(cloud[:60], axis=1, keepdims=True))]
    want = plain(rows, 20)
    # Repeats of a query, of another row, and of a row with the same vector as a third one.
    twins = [*rows, (61, rows[7][1])]
    want_twins = plain(twins, 20)
    ids = lambda got: {q: [i for i, _ in near] for q, near in got.items()}
    assert ids(found(spark, rows + [rows[20]] * 15 + [rows[7]] * 30)) == ids(want)
    assert ids(found(spark, twins + [rows[7]] * 30)) == ids(want_twins)
    # Other vectors of the query's id are no candidates either, and leave room for 20.
    more = [(40, (np.array(rows[40][1]) * (1 + k / 100)).tolist()) for k in range(1, 6)]
    assert len({i for i, _ in found(spark, rows + more)[40]} - {40}) == 20


def test_empty_single_and_no_queries(spark):
    assert found(spark, []) == {} and found(spark, [(20, [1.0, 2.0])]) == {} and found(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == {}


def test_walk_visits_every_leaf_nearest_bin_first(cloud):
    tree = ann.Tree(cloud.astype(float), len(cloud), float(np.linalg.norm(cloud, axis=1).max()))
    order = list(tree.walk(cloud[5].astype(float)))
    assert sorted(order) == list(range(tree.leaves)) and tree.leaves > 20
    assert set(tree.assign(cloud.astype(float)).tolist()) <= set(order)
