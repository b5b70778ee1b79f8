import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from hubbub.llm import packing, pii, quality
from test_ngram_join import plain_join
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, tmp_path):
    docs = source = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == source.columns and [f.dataType for f in out.schema] == [f.dataType for f in source.schema]
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs.collect())
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in quality.classify(source, labels).collect() if r["predicted"]}
    assert {r["doc_id"] for r in seen[0]} == good and len(good) < source.count()
    want = {eval(r)[2] for r in plain_join([(r["doc_id"], r["text"]) for r in seen[0]])}
    assert sorted(r["doc_id"] for r in seen[1]) == sorted(want) and len(want) < len(good)
    kept = {r["doc_id"]: r["text"] for r in seen[1]}
    spans = {r["doc_id"]: r["spans"] for r in pii.find(spark.read.parquet(f"{tmp_path}/1")).collect()}
    for r in seen[2]:
        text = kept[r["doc_id"]]
        for s in sorted(spans[r["doc_id"]], key=lambda s: -s["start"]):
            text = text[:s["start"]] + f"[{s['kind'].upper()}]" + text[s["end"]:]
        assert r["text"] == text and r["n_chars"] == len(text)
    assert any(spans.values()) and len(seen[2]) == len(seen[1])
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    pieces = []
    for r in seen[2]:
        ids = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0], "<u4")
        pieces += [(r["doc_id"], s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for s in range(0, len(ids), 2048)]
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in seen[3]) == sorted(pieces)
    assert len({r["sequence_id"] for r in seen[3]}) == len(packing.best_fit_decreasing([p[2] for p in pieces], 2048))
    final = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"]) for r in final) == sorted((r["doc_id"], r["piece"], r["length"]) for r in seen[3])


def test_dirty_rows(spark, frame, dirty, tmp_path):
    """Nulls, empty and very long texts, repeated rows, rows without id and clashing column names go through every stage."""
    frame([*dirty, *dirty]).write.parquet(f"{tmp_path}/documents.parquet")
    # All texts count as good, so that the later stages see them; labels hold nulls and repeats.
    labels = [(i, 1, 0) for i, _ in dirty if i is not None] * 2 + [(None, 1, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    worded = {" ".join((t or "").lower().split()) for _, t in dirty} - {""}
    kept = {(r["doc_id"], r["start"]) for r in final}
    assert len(kept) >= len({i for i, t in dirty if i is not None and (t or "").split()}) - 3 and len(worded) > 5
    # Of the rows with one id and text only one was packed.
    named = [(r["doc_id"], r["start"]) for r in final if r["doc_id"] is not None]
    assert len(named) == len(set(named))
    place = {}
    for r in final:
        place.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in place.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(n for _, n in own) <= 2048


def test_empty_tables(spark, frame, tmp_path):
    frame([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
