import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hubbub.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def test_ids_equal_the_tokenizers(dirty, tokenizer):
    odd = ["İstanbul ſ ŉ ×÷ é½²", "Kelvin K Å ẞ ŸÿĀ", "á é", "''s 's's", "l'été 'tis 12'3", "_ab_c #'s ' s", "’s", "x\x00y", "İ'll 'LL"]
    pick = random.Random(4)
    odd += ["".join(pick.choice("ab'stlrevdm 1é\n.#İΣς") for _ in range(pick.randrange(40))) for _ in range(500)]
    texts = [t or "" for _, t in dirty] + odd
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [i.tolist() for i in packing.Encoder(public_tokenizers.path(packing.VOCABULARY)).encode(texts)] == want


def test_full_word_table_starts_anew(dirty, tokenizer):
    encoder = packing.Encoder(public_tokenizers.path(packing.VOCABULARY))
    encoder.words = packing.WordTable(encoder.words.encode, words=64)
    for _, t in dirty:
        assert encoder.encode([t or ""])[0].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_fit_decreasing(seed):
    pick = random.Random(seed)
    capacity = pick.choice([7, 10, 16, 33, 64])
    lengths = [pick.randint(1, capacity) for _ in range(pick.choice([0, 1, 5, 50, 400, 2000]))]
    rows, made = packing.plan(dict(Counter(lengths)), capacity)
    bins, counts = defaultdict(int), Counter()
    for length, first, per, begin, offset in sorted(rows, key=lambda r: (-r[0], r[1])):
        assert counts[length] == first
        many = next((r[1] for r in sorted(rows) if r[0] == length and r[1] > first), Counter(lengths)[length]) - first
        counts[length] += many
        for k in range(many):
            assert bins[begin + k // per] == offset + k % per * length
            bins[begin + k // per] += length
    assert counts == Counter(lengths) and len(bins) == made
    assert sorted(capacity - used for used in bins.values()) == sorted(packing.best_fit_decreasing(lengths, capacity))


@pytest.mark.parametrize("group_rows", [500, 2])
def test_packed_documents(frame, dirty, tokenizer, monkeypatch, group_rows):
    monkeypatch.setattr(packing, "GROUP_ROWS", group_rows)
    got = packing.pack_documents(frame(dirty)).collect()
    want = []
    for i, t in dirty:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, p, s, len(ids[s:s + 2048]), zlib.crc32(np.array(ids[s:s + 2048], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), 2048))]
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in got)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) == len(packing.best_fit_decreasing([w[3] for w in want], 2048))


def test_empty_table(frame):
    assert packing.pack_documents(frame([])).collect() == []
