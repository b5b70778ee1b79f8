import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from hubbub.llm import token_counts


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(public_tokenizers.path(token_counts.VOCABULARY))


def replaced(text, start, end, new):
    start = min(max(start, 0), len(text))
    return text[:start] + new + text[min(max(end, start), len(text)):]


@pytest.mark.parametrize("seed", range(20))
def test_edits_count_as_whole_texts_do(counter, seed):
    pick = random.Random(seed)
    some = lambda sizes: "".join(pick.choice(" \n\t'aebrs1.tlév😀") for _ in range(pick.choice(sizes)))
    for _ in range(40):
        text = some([0, 1, 5, 40, 300, 3000])
        tree = token_counts.PretokenTree(text, counter)
        for _ in range(6):
            start = pick.randint(-2, len(text) + 2)
            end, new = start + pick.choice([-1, 0, 0, 1, 3, 20, len(text)]), some([0, 1, 2, 10, 60])
            text = replaced(text, start, end, new)
            tree.edit(start, end, new)
            assert tree.text() == text and tree.total == len(counter.encoding.encode_ordinary(text))


def test_an_edit_encodes_few_pretokens(counter):
    tree = token_counts.PretokenTree("the cat sat on a mat. " * 5000, counter)
    tree.edit(60_000, 60_003, "dog")
    assert tree.encoded < 20


def test_dirty_rows(frame, dirty, counter):
    docs = frame(dirty).withColumn("changes", F.from_json(F.lit('[{"start": 3, "end": 5, "new": "new"}, null, {}, {"start": 0, "end": 0, "new": "  "}]'), "array<struct<start:int,end:int,new:string>>"))
    got = token_counts.count(docs, "changes").collect()
    size = lambda t: len(counter.encoding.encode_ordinary(t))
    want = sorted(str((i, size(t or ""), size(replaced(replaced(t or "", 3, 5, "new"), 0, 0, "  ")))) for i, t in dirty)
    assert sorted(str((r["doc_id"], r["n_tokens"], r["n_edited"])) for r in got) == want
    assert all(r["n_tokens"] == r["n_edited"] for r in token_counts.count(frame(dirty)).collect())


def test_empty_table(frame):
    assert token_counts.count(frame([])).collect() == []
