import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from hubbub.llm import pieces
from llm_texts import story


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(public_tokenizers.path(pieces.VOCABULARY))


@pytest.fixture(scope="module")
def twin():
    """The library's unigram search over the same pieces: the file's model type changed."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path(pieces.VOCABULARY), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_words_score_as_the_library_does(vocabulary, twin):
    words = {w for k in range(40) for w in story(200, k).split()} | {"don't", "naïve", "größer", "a", "x" * 30, "straße.", "42nd"}
    pick = random.Random(2)
    words |= {"".join(pick.choice("etaoinshr") for _ in range(pick.randint(1, 14))) for _ in range(2000)}
    for w in words:
        # The library's list of best paths; its quick search skips some. Paths of equal score may differ.
        own, best = vocabulary.encode([w])[0].tolist(), twin.nbest_encode_as_ids(w, 2)[0]
        assert abs(score(vocabulary, own) - score(vocabulary, best)) < 1e-3 and vocabulary.decode(own) == w


def score(vocabulary, ids):
    return sum(vocabulary.scores[i] for i in ids)


def test_no_path_of_the_library_scores_better(vocabulary, twin, dirty):
    # Over long texts the library adds in single precision, so its path may fall short of the best.
    for _, t in dirty:
        t = (t or "")[:3000]
        own = vocabulary.encode([t])[0].tolist()
        assert score(vocabulary, own) >= score(vocabulary, twin.encode(t)) - 1e-6 * abs(score(vocabulary, own))


def test_brute_force_over_all_cuts(vocabulary):
    known = {p: (i, s) for i, (p, s) in enumerate(zip(vocabulary.pieces, vocabulary.scores)) if not p.startswith("<0x")}

    def best(text):
        options = [0.0] if not text else [known[text[:k]][1] + best(text[k:]) for k in range(1, len(text) + 1) if text[:k] in known]
        return max(options)

    for word in ("hello", "there", "ringing", "nation"):
        ids = vocabulary.encode([word])[0].tolist()
        assert sum(vocabulary.scores[i] for i in ids) == best("▁" + word)


def test_cutting_at_markers_changes_nothing(vocabulary, dirty):
    texts = [(t or "")[:2000] for _, t in dirty]
    cut = [i.tolist() for i in vocabulary.encode(texts)]
    vocabulary.splits = False
    try:
        assert [i.tolist() for i in vocabulary.encode(texts)] == cut
    finally:
        vocabulary.splits = True


def test_round_trip_of_dirty_rows(frame, dirty):
    got = pieces.encode(frame(dirty))
    rows = got.collect()
    assert len(rows) == len(dirty)
    texts = {i: t for i, t in dirty if i is not None}
    assert all(r["round_trip"] == ("▁" not in (texts[r["doc_id"]] or "")) for r in rows if r["doc_id"] is not None)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(got).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in texts.items())


def test_double_array_finds_all_prefixes():
    pick = random.Random(5)
    keys = list({bytes(pick.choice(b"ab\x00\xffxyz") for _ in range(pick.randint(1, 6))) for _ in range(400)})
    trie = pieces.DoubleArray(keys)
    for _ in range(500):
        data = bytes(pick.choice(b"ab\x00\xffxyzq") for _ in range(8))
        assert {(e, keys[v]) for e, v in trie.prefixes(data, 1)} == {(1 + len(k), k) for k in keys if data[1:].startswith(k)}


def test_empty_table(frame):
    assert pieces.encode(frame([])).collect() == []


def test_cuts_side_by_side_are_solved_as_one_by_one():
    own = pieces.vocabulary(public_tokenizers.path(pieces.VOCABULARY))
    r = random.Random(5)
    cuts = ["".join(r.choice(["a", "b", "é", "日", "😀", pieces.MARKER, "\0", "tion", " the"]) for _ in range(r.randint(0, 20))).encode() for _ in range(3000)]
    cuts += [c[:r.randint(0, len(c))] for c in cuts[:500]]  # also such that end within a character
    assert sum(len(c) <= pieces.LONG for c in cuts) > 1000 > sum(len(c) > pieces.LONG for c in cuts) > 0
    assert own.best_of(cuts) == [own.best(c) for c in cuts]
    assert own.best_of(cuts[:5]) == own.best_of(cuts)[:5] and own.best_of([]) == []
