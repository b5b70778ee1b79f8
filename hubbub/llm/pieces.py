"""Encoding to and decoding from subword pieces: unigram Viterbi over a double-array trie, with byte fallback.

White space follows the marker convention: a marker is put in front and every space becomes one. No piece of a usual vocabulary
goes on past a marker, so a text is cut before each run of markers and each different cut is solved once per worker;
a vocabulary with such pieces is solved over whole texts. Characters no piece covers become their bytes' pieces.
Among equally good paths the one whose last piece starts first wins.

Defined results: null text counts as empty and gives no ids; repeated rows are encoded each; null ids are kept. A
marker character inside a text cannot be told from a space and decodes to one. Only the id and text columns are read,
so others cannot clash.
"""

import re

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from hubbub.llm.shared import kept_in_worker, slices, with_nulls_as_text
from hubbub.llm.wordtable import WordTable

VOCABULARY = "piece_bpe_32k.model"
MARKER = "▁"
# What an uncovered character costs below the least likely piece.
PENALTY = 10.0
# Cuts of at most LONG bytes are solved side by side as arrays, between FEW and MANY of about the same length at once.
LONG, FEW, MANY = 64, 64, 4096


class DoubleArray:
    """Trie over byte strings in two arrays: a node's child by byte c is at base[node] + c + 1, if check there says so."""

    def __init__(self, keys):
        size = 1 << 16
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        self.check[0] = 0
        keys = sorted((k, v) for v, k in enumerate(keys) if k)
        todo, start, hint = [(0, 0, len(keys), 0)], 258, 258  # any byte's place has a base below it
        while todo:
            node, lo, hi, depth = todo.pop()
            if lo < hi and len(keys[lo][0]) == depth:
                self.value[node] = keys[lo][1]
                lo += 1
            groups, at = [], lo
            while at < hi:
                byte, begin = keys[at][0][depth], at
                while at < hi and keys[at][0][depth] == byte:
                    at += 1
                groups.append((byte, begin, at))
            if not groups:
                continue
            # A single child takes the first free place; several look on from where the last several fitted.
            while self.check[start] >= 0:
                start += 1
            base = (start if len(groups) == 1 else max(start, hint)) - groups[0][0] - 1
            while True:
                self.reserve(base + 258)
                if all(self.check[base + b + 1] < 0 for b, _, _ in groups):
                    break
                base += 1
            if len(groups) > 1:
                hint = base + groups[0][0] + 1
            self.base[node] = base
            for byte, begin, end in groups:
                self.check[base + byte + 1] = node
                todo.append((base + byte + 1, begin, end, depth + 1))
        end = max(i for i, c in enumerate(self.check) if c >= 0) + 258
        self.reserve(end)
        self.base, self.check, self.value = self.base[:end], self.check[:end], self.value[:end]

    def reserve(self, size):
        while len(self.check) < size:
            n = len(self.check)
            self.base += [0] * n
            self.check += [-1] * n
            self.value += [-1] * n

    def prefixes(self, data, at):
        """(end, value) of every key that data has at this place."""
        node, base, check, value = 0, self.base, self.check, self.value
        for end in range(at, len(data)):
            child = base[node] + data[end] + 1
            if child >= len(check) or check[child] != node or child == 0:
                return
            node = child
            if value[node] >= 0:
                yield end + 1, value[node]


class Vocabulary:
    def __init__(self, path):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes = [0] * 256
        usual = []
        for i, p in enumerate(self.pieces):
            if model.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
            usual.append(not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)))
        self.scores = [model.get_score(i) for i in range(n)]
        self.least = min(s for s, u in zip(self.scores, usual) if u) - PENALTY
        self.trie = DoubleArray([p.encode() if u else b"" for p, u in zip(self.pieces, usual)])
        self.splits = not any(re.search(f"[^{MARKER}]{MARKER}", p) for p, u in zip(self.pieces, usual) if u)
        # What each id stands for: bytes for byte pieces, nothing for control pieces.
        self.plain = [bytes([self.bytes.index(i)]) if i in set(self.bytes) else p.replace(MARKER, " ").encode() if u else b"" for i, (p, u) in enumerate(zip(self.pieces, usual))]
        self.arrays = [np.array(a, np.int32) for a in (self.trie.base, self.trie.check, self.trie.value)]
        self.words = WordTable(lambda words: self.best_of([w.replace(b" ", MARKER.encode()) for w in words]), words=1 << 19)

    def best(self, data):
        """Ids of the most probable path over one cut."""
        n, trie, scores = len(data), self.trie, self.scores
        total, back = [None] * (n + 1), [None] * (n + 1)
        total[0] = 0.0
        at = 0
        while at < n:
            step = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
            here, covered = total[at], False
            for end, piece in trie.prefixes(data, at):
                score = here + scores[piece]
                if total[end] is None or score > total[end]:
                    total[end], back[end] = score, (at, piece)
                covered = covered or end == at + step
            if not covered:
                end = min(n, at + step)
                score = here + self.least
                if total[end] is None or score > total[end]:
                    total[end], back[end] = score, (at, -1)
            at += step
        ids, at = [], n
        while at > 0:
            start, piece = back[at]
            ids += [piece] if piece >= 0 else [self.bytes[b] for b in reversed(data[start:at])]
            at = start
        return ids[::-1]

    def best_of(self, cuts):
        """``best`` of each of many cuts."""
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        order, found = np.argsort(sizes, kind="stable"), [None] * len(cuts)
        short = int(np.searchsorted(sizes[order], LONG, side="right"))
        for begin in range(0, short, MANY):
            chosen = order[begin:min(begin + MANY, short)].tolist()
            part = [cuts[k] for k in chosen]
            for k, ids in zip(chosen, self.side_by_side(part) if len(part) >= FEW else map(self.best, part)):
                found[k] = ids
        for k in order[short:].tolist():
            found[k] = self.best(cuts[k])
        return found

    def side_by_side(self, cuts):
        """``best`` of short cuts: the same steps in the same order, each taken for all cuts at once."""
        (base, check, value), scores = self.arrays, np.array(self.scores)
        m, width = len(cuts), max(map(len, cuts))
        size = np.fromiter(map(len, cuts), np.int64, m)
        data = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in cuts), np.uint8).reshape(m, width).T.astype(np.int32)
        total = np.full((width + 1, m), -np.inf)
        since, chosen = np.zeros((width + 1, m), np.int32), np.full((width + 1, m), -1, np.int32)
        total[0] = 0.0
        after = np.zeros(m, np.int64)  # where the character that is read ends

        def reach(end, of, score, at, piece):
            better = score > total[end, of]
            end, of = end[better] if isinstance(end, np.ndarray) else end, of[better]
            total[end, of], since[end, of], chosen[end, of] = score[better], at, piece[better]

        for at in range(width):
            reading = np.flatnonzero((after == at) & (size > at))
            first = data[at, reading]
            after[reading] = at + 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0) + ((first >= 0x80) & (first < 0xC0))
            covered, live, node, end = np.zeros(m, bool), reading, np.zeros(len(reading), np.int32), at
            while len(live) and end < width:
                child = base[node] + data[end, live] + 1
                on = (check[child] == node) & (size[live] > end)
                live, node, end = live[on], child[on], end + 1
                piece = value[node]
                hit = piece >= 0
                of, piece = live[hit], piece[hit]
                covered[of[after[of] == end]] = True
                reach(end, of, total[at, of] + scores[piece], at, piece)
            bare = reading[~covered[reading]]
            reach(np.minimum(after[bare], size[bare]), bare, total[at, bare] + self.least, at, np.full(len(bare), -1))
        for cut, starts, pieces in zip(cuts, since.T.tolist(), chosen.T.tolist()):
            ids, at = [], len(cut)
            while at > 0:
                start, piece = starts[at], pieces[at]
                ids += [piece] if piece >= 0 else [self.bytes[b] for b in reversed(cut[start:at])]
                at = start
            yield ids[::-1]

    def encode(self, texts):
        """One array of ids per text."""
        if not self.splits:
            return [np.array(self.best((MARKER + t.replace(" ", MARKER)).encode("utf-8", "replace")) if t else [], np.uint32) for t in texts]
        raw = [(" " + t.replace(MARKER, " ")).encode("utf-8", "replace") if t else b"" for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        data = np.frombuffer(b"".join(raw), np.uint8)
        if not len(data):
            return [np.zeros(0, np.uint32) for _ in texts]
        blank = data == 32
        begins = blank & ~np.concatenate([[False], blank[:-1]])
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(begins)
        ids, lengths = self.words.joined(self.words.lookup(data, starts, np.append(starts[1:], len(data))))
        until = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, bounds)]
        return [ids[a:b] for a, b in zip(until[:-1].tolist(), until[1:].tolist())]

    def decode(self, ids):
        """The text of a sequence of ids; bytes that are no text become replacement characters."""
        text = b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def vocabulary(path):
    return kept_in_worker(f"pieces {path}", lambda: Vocabulary(path))


def encode(docs, path=None, id_col="doc_id", text_col="text"):
    """doc_id, ids, round_trip: whether decoding gives the text back."""
    path = path or public_tokenizers.path(VOCABULARY)
    rows = with_nulls_as_text(docs, id_col, text_col)

    def run(batches):
        own = vocabulary(path)
        for part, texts in slices(batches):
            ids = own.encode(texts)
            same = [own.decode(i.tolist()) == t for i, t in zip(ids, texts)]
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
            flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat), pa.array(same)], ["doc_id", "ids", "round_trip"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, round_trip boolean")


def decode(rows, path=None, ids_col="ids"):
    """``rows`` with ``text``, the text of their ids; null ids give null."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        own = vocabulary(path)
        return ids.map(lambda i: None if i is None else own.decode(i.tolist()))

    return rows.withColumn("text", text(F.col(ids_col)))
