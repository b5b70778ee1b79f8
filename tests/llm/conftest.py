import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_texts import story  # noqa: E402

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use inside.
    *[T.StructField(c, T.StringType()) for c in ("block", "at", "id", "n", "spans", "__row", "__id", "length", "score", "part", "edits_", "label")],
])

@pytest.fixture(scope="session")
def dirty():
    """(doc_id, text) with nulls, empty, blank, short, very long and odd texts, copies and repeated rows."""
    long = story(20_000, 1)
    texts = [
        None, "", "   \n\t ", "a", "one two three four", "ONE two THREE four five", "x" * 50_000, long, long, story(60, 2), story(60, 2),
        story(60, 3), story(60, 3) + " end", "it's we'll don't 's ''s", "é ñ ß ÀÉ 日本語 😀 \x1f ▁ a", "<|endoftext|> <|im_end|> [EMAIL]",
        "mail a.b@mail1.example.com or 4111 1111 1111 1111 now, call +1 (555) 010-9999, host 10.0.0.255 and 1.2.3.999",
    ]
    rows = list(enumerate(texts))
    return [*rows, rows[9], (None, "no id"), (None, None)]


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None, *["x"] * 12) for i, t in rows], SCHEMA)

    return make
