import zlib

import numpy as np
import pytest

from llm_texts import story
from hubbub.llm import quality
from hubbub.llm.wordtable import Powers


@pytest.fixture(scope="module")
def corpus():
    good = [story(80 + k % 50, k) for k in range(300)]
    bad = [" | ".join(f"w{j}" for j in range(40 + k)) for k in range(60)] + [("ha " * 15 + "of " * 12) * 4 for k in range(60)]
    return [(i, t, 1 if i < 300 else 0) for i, t in enumerate([*good, *bad])]


def test_statistics_are_finite_and_per_text(dirty):
    texts = [t or "" for _, t in dirty]
    together = quality.statistics(texts, Powers())
    assert together.shape == (len(texts), quality.STATISTICS) and np.isfinite(together).all()
    for t, row in zip(texts, together):
        assert np.allclose(quality.statistics([t], Powers())[0], row)
    assert (together[1] == 0).all()


def test_held_out_rows_are_told_apart(spark, frame, corpus, dirty):
    rows = [(i, t) for i, t, _ in corpus] + [(i + 1000 if i is not None else None, t) for i, t in dirty]
    # Labels of held-out rows are turned round: they must not be learned.
    labels = [(i, int(q if zlib.crc32(str(i).encode()) % 5 else 1 - q), "x") for i, _, q in corpus] + [(None, 1, "x"), (1, None, "x"), (2, 7, "x"), (3, 1, "x")]
    got = quality.classify(frame(rows), spark.createDataFrame(labels, "doc_id long, quality int, text string")).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    held = [(score[i], q) for i, _, q in corpus if zlib.crc32(str(i).encode()) % 5 == 0]
    assert min(s for s, q in held if q) > max(s for s, q in held if not q)


def test_keep_good_keeps_columns_and_decides_alike(spark, frame, corpus):
    docs = frame([(i, t) for i, t, _ in corpus])
    labels = spark.createDataFrame([(i, q) for i, _, q in corpus], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    want = {r["doc_id"] for r in quality.classify(docs, labels).collect() if r["predicted"]}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_no_labels_and_no_documents(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.classify(frame([(1, "a b")]), none).collect()] == [0.5]
    assert quality.classify(frame([]), none).collect() == []


def test_pooling_rises():
    raw, share = quality.pooled([0, 1, 2, 3, 4], [0.2, 0.1, 0.5, 0.4, 0.9], [1, 3, 2, 2, 1])
    assert np.allclose(share, [0.125, 0.45, 0.9]) and (np.diff(raw) > 0).all()


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    held = got.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held) > 30


def test_keep_good_of_dirty_rows(spark, frame, corpus, dirty):
    """Every row is decided by its text alone: repeated rows, null texts and rows without id are kept or dropped alike."""
    rows = [(i, t) for i, t, _ in corpus] + [(i + 1000 if i is not None else None, t) for i, t in [*dirty, *dirty]]
    labels = spark.createDataFrame([(i, q, "x") for i, _, q in corpus], "doc_id long, quality int, text string")
    docs = frame(rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    score = {}
    for r in quality.classify(docs, labels).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        score[r["text"]] = r["predicted"]
    none = [t for _, t in dirty if t not in score]  # only rows without id have these
    want = sorted(str((i, t)) for i, t in rows if t not in none and score[t])
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect() if r["text"] not in none) == want
    assert quality.keep_good(frame([]), labels).collect() == [] and len(want) > 200


def test_features_approach_the_kernel(spark):
    """Ridge regression on the features scores as kernel ridge regression with the Gaussian kernel itself does."""
    random_ = np.random.default_rng(4)
    stats = random_.normal(size=(160, quality.STATISTICS))
    label = (np.sin(stats[:, 0]) + stats[:, 1] > 0).astype(float)
    model = quality.Model(mean=np.zeros(quality.STATISTICS), scale=np.ones(quality.STATISTICS), features=8192)
    scale = model.width / np.sqrt(quality.STATISTICS) * 2  # of the frequencies
    far = ((stats[:, None] - stats[None]) ** 2).sum(axis=2)
    kernel = np.exp(-far * scale * scale / 2)
    waves = model.expand(stats)[:, 1:]
    assert np.abs(waves @ waves.T - kernel).max() < 0.08
    ridge, train, test = 0.1, slice(0, 120), slice(120, 160)
    plain = kernel[test, train] @ np.linalg.solve(kernel[train, train] + ridge * np.eye(120), label[train])
    weights = np.linalg.solve(waves[train].T @ waves[train] + ridge * np.eye(8192), waves[train].T @ label[train])
    assert np.abs(waves[test] @ weights - plain).max() < 0.1
