"""Names in text: where each one stands, also across words.

All names of a dictionary are looked for in one pass over a text, with a trie walked from all places at once. Of names that
overlap, the one that begins first is kept, and of those the longest; the search goes on behind it. A name that begins or ends
with an ASCII letter or digit only stands where no other such character touches it, so "art" is not found in "party"; in
scripts that do not separate words names are found anywhere.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hubbub.operators.joins import fits_broadcast
from hubbub.operators.parts import parts_like
from hubbub.operators.trie import Trie, code_points
from hubbub.session import durable, in_slices, kept_in_worker

_SPANS = "struct<start:array<int>,end:array<int>,section:array<string>,name:array<string>>"


class Names:
    """Distinct names with their sections."""

    def __init__(self, rows):
        self.names, self.sections = [r[0] for r in rows], [r[1] for r in rows]
        self.trie = Trie(self.names)

    def spans(self, texts):
        """The names in each text, as Arrow lists; places count characters from 0, ends are exclusive."""
        codes = code_points("".join(texts))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        stops, begins = np.cumsum(sizes), np.cumsum(sizes) - sizes
        letter = np.zeros(len(codes) + 1, bool)
        letter[:-1] = (codes < 128) & ((codes - 48 < 10) & (codes >= 48) | ((codes | 32) - 97 < 26) & ((codes | 32) >= 97))
        after = np.concatenate([[False], letter[:-1]])
        after[begins[sizes > 0]] = False
        stop = np.repeat(stops, sizes)
        start, end, name = self.trie.matches(codes, stop, np.flatnonzero(~(letter & after)[:-1]))
        touched = letter[end - 1] & letter[np.minimum(end, len(codes))] & (end < stop[start])
        start, end, name = start[~touched], end[~touched], name[~touched]
        longest = np.append(start[1:] != start[:-1], True)[:len(start)]
        start, end, name = start[longest], end[longest], name[longest]
        kept, free = [], 0
        for k, (a, b) in enumerate(zip(start.tolist(), end.tolist())):
            if a >= free:
                kept.append(k)
                free = b
        start, end, name = start[kept], end[kept], name[kept]
        text = np.searchsorted(stops, start, side="right")
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))]), pa.int32())
        used, place = np.unique(name, return_inverse=True)
        columns = [pa.array(start - begins[text], pa.int32()), pa.array(end - begins[text], pa.int32())]
        columns += [pa.array([own[k] for k in used.tolist()], pa.string()).take(pa.array(place)) for own in (self.sections, self.names)]
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, c) for c in columns], ["start", "end", "section", "name"])


def one_per_name(lexicon, sections=None):
    """One row for each name with a section: the smallest of its sections."""
    rows = lexicon.where((F.col("word") != "") & F.col("section").isNotNull())
    if sections is not None:
        rows = rows.where(F.col("section").isin(*sections))
    return rows.groupBy("word").agg(F.min("section").alias("section"))


def entity_spans(units, lexicon, keys=("article_url",), text="text", sections=None, small=None):
    """(keys, start, end, section, name) of every name in every text unit.

    Names measured as small are sent to the workers as rows and become a trie once in each. A larger list never leaves the
    executors: parts of the texts that may be names by length and hash are joined to it, and what is found in a
    batch of texts is the list for that batch."""
    names = one_per_name(lexicon, sections)
    if small is None:
        small = fits_broadcast(names)
    if small:
        shared = units.sparkSession.sparkContext.broadcast([tuple(r) for r in names.collect()])  # measured before

        @F.arrow_udf(_SPANS)
        def found_in(texts: pa.Array) -> pa.Array:
            known = kept_in_worker(("names", id(shared.value)), lambda: (shared.value, Names(shared.value)))[1]
            return in_slices(texts, lambda part: known.spans([t or "" for t in part.to_pylist()]))

        found = units.withColumn("_found", found_in(text))
    else:
        numbered = durable(units.withColumn("_row", F.monotonically_increasing_id()))
        parts = parts_like(numbered, names, ["_row"], text, alone=True)
        hits = parts.join(names, "word").groupBy("_row").agg(F.collect_list(F.struct("word", "section")).alias("_hits"))

        @F.arrow_udf(_SPANS)
        def found_among(texts: pa.Array, hits: pa.Array) -> pa.Array:
            rows = hits.flatten()
            known = Names(list(dict.fromkeys(zip(rows.field(0).to_pylist(), rows.field(1).to_pylist()))))
            return in_slices(texts, lambda part: known.spans([t or "" for t in part.to_pylist()]))

        found = numbered.join(hits, "_row", "left").withColumn("_found", found_among(text, "_hits"))
    spans = F.arrays_zip(*[F.col(f"_found.{c}").alias(c) for c in ("start", "end", "section", "name")])
    return found.select(*keys, F.inline(spans))
