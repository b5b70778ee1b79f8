"""Token counts that follow edits: each document keeps a segment tree over its pre-tokens.

A pre-token is encoded on its own, so a document's count is the sum over them. A leaf holds a few neighbouring pre-tokens
with their characters and tokens; inner nodes hold sums, so the leaf at a position is found from the root down. An edit
re-encodes from the last pre-token that cannot see it until the new cuts meet old ones again, and only the leaves it
touches and their parents change.

Defined results: null text counts as empty, with 0 tokens; edits are applied in their order, positions clipped to the
text; null positions count as 0 and null replacements as empty; edits of unknown documents are ignored. Repeated
documents each take the edits of their id. Only the named columns are read, so others cannot clash.
"""

import base64

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import functions as F

from hubbub.llm.shared import column, kept_in_worker, slices

VOCABULARY = "byte_bpe_50k.tiktoken"
# Pre-tokens of a leaf; characters past its end that a pre-token's cut may depend on; words remembered.
LEAF, CONTEXT, REMEMBERED = 32, 3, 1 << 19


class Counter:
    """Tokens of pre-tokens, each different one encoded once while remembered."""

    def __init__(self, path):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cuts, self.known = regex.compile(public_tokenizers.PATTERN), {}

    def counts(self, parts):
        new = set(parts).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, set(parts)
        for p in new:
            self.known[p] = len(self.encoding._core_bpe.encode_single_piece(p.encode("utf-8", "replace")))
        return list(map(self.known.__getitem__, parts))


class PretokenTree:
    """A text as leaves of pre-tokens under sums of characters and tokens."""

    def __init__(self, text, counter):
        self.counter, self.encoded = counter, 0
        parts = counter.cuts.findall(text)
        self.size = 1 << max(0, (max(1, -(-len(parts) // LEAF)) - 1).bit_length())
        self.leaves = [[] for _ in range(self.size)]
        self.counts = [[] for _ in range(self.size)]
        counts = counter.counts(parts)
        lengths = list(map(len, parts))
        chars, tokens = np.zeros(2 * self.size, np.int64), np.zeros(2 * self.size, np.int64)
        for i in range(0, len(parts), LEAF):
            k = i // LEAF
            self.leaves[k], self.counts[k] = parts[i:i + LEAF], counts[i:i + LEAF]
            chars[self.size + k], tokens[self.size + k] = sum(lengths[i:i + LEAF]), sum(self.counts[k])
        level = self.size
        while level > 1:
            for sums in (chars, tokens):
                sums[level // 2:level] = sums[level:2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2
        self.chars, self.tokens = chars.tolist(), tokens.tolist()

    @property
    def total(self):
        return self.tokens[1]

    def find(self, position):
        """(leaf, its first character) of the leaf that holds this position; the last used place at the end."""
        node, start = 1, 0
        while node < self.size:
            left = self.chars[2 * node]
            if position < start + left or self.chars[2 * node + 1] == 0:
                node = 2 * node
            else:
                node, start = 2 * node + 1, start + left
        return node - self.size, start

    def put(self, leaf, parts, counts):
        self.leaves[leaf], self.counts[leaf] = parts, counts
        node = self.size + leaf
        self.chars[node], self.tokens[node] = sum(map(len, parts)), sum(counts)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start, end, new):
        """Replace characters start to end."""
        length = self.chars[1]
        start = min(max(start, 0), length)
        end = min(max(end, start), length)
        # The last pre-token whose cut cannot depend on what changes.
        leaf, at = self.find(max(0, start - CONTEXT))
        first, keep = leaf, []
        keep_counts = []
        for part, count in zip(self.leaves[leaf], self.counts[leaf]):
            if at + len(part) > start - CONTEXT:
                break
            keep.append(part), keep_counts.append(count)
            at += len(part)
        begin, skip = at, len(keep)
        # Old text from there on, leaf by leaf, until new cuts meet old ones behind the edit.
        old, sources, position = "", [], begin
        cuts, leaf_ = set(), leaf
        shift = len(new) - (end - start)
        while True:
            parts = self.leaves[leaf_][skip:] if leaf_ == first else self.leaves[leaf_]
            sources.append(leaf_)
            for p in parts:
                cuts.add(position)
                position += len(p)
                old += p
            if leaf_ + 1 < self.size and position < end + CONTEXT:
                leaf_ += 1
                continue
            text = old[:start - begin] + new + old[end - begin:]
            fresh, at, met = [], begin, None
            last = leaf_ + 1 >= self.size or position >= length
            for m in self.counter.cuts.finditer(text):
                where = begin + m.start() - shift
                if where >= end and begin + m.start() >= start + len(new) and where in cuts:
                    met = where
                    break
                if not last and begin + m.end() - shift > position - CONTEXT:
                    break
                fresh.append(m[0])
            else:
                if last:
                    met = position
            if met is not None:
                break
            leaf_ += 1
        tail, tail_counts, at = [], [], begin
        for k in sources:
            for p, c in list(zip(self.leaves[k], self.counts[k]))[skip if k == first else 0:]:
                if at >= met:
                    tail.append(p), tail_counts.append(c)
                at += len(p)
        self.encoded += len(fresh)
        parts, counts = keep + fresh + tail, keep_counts + self.counter.counts(fresh) + tail_counts
        share = -(-len(parts) // len(sources)) if parts else 0
        for i, k in enumerate(sources):
            self.put(k, parts[i * share:(i + 1) * share], counts[i * share:(i + 1) * share])

    def text(self):
        return "".join(p for leaf in self.leaves for p in leaf)


def count(docs, edits=None, path=None, id_col="doc_id", text_col="text"):
    """doc_id, n_tokens, n_edited (tokens after the edits), n_encoded (pre-tokens encoded for them).

    ``edits`` is the name of a column of ``docs``: an array of (start, end, new), applied in order; None means none."""
    path = path or public_tokenizers.path(VOCABULARY)
    changes = F.lit(None).cast("array<struct<start:int,end:int,new:string>>") if edits is None else column(docs, edits).cast("array<struct<start:int,end:int,new:string>>")
    rows = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"), changes.alias("edits"))

    def run(batches):
        counter = kept_in_worker(f"counter {path}", lambda: Counter(path))
        for part, texts in slices(batches):
            out = []
            for text, own in zip(texts, part.column(2).to_pylist()):
                tree = PretokenTree(text, counter)
                before = tree.total
                for e in own or []:
                    if e is not None:
                        tree.edit(e["start"] or 0, e["end"] or 0, e["new"] or "")
                out.append((before, tree.total, tree.encoded))
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([o[k] for o in out], pa.int64()) for k in range(3)]], ["doc_id", "n_tokens", "n_edited", "n_encoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, n_edited long, n_encoded long")

