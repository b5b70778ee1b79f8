"""Blocks of texts as arrays: where they stand, and numbers of those met before.

A block is a longest run of characters that can form words; every other character stands alone. A text's blocks are found from a
table of characters, hashed from running sums, and looked up together, so that only new ones need any work of their own.
"""

import numpy as np

from hubbub.functions.text import SENTENCE_MARKS, WS_CHARS

# Characters that can form one word, as a class of a pattern and as ranges: Han characters, Latin letters and digits, marks inside of words.
BLOCK_SET = r"一-鿕a-zA-Z0-9+#&\._%\-"
_RANGES = ("一鿕", "az", "AZ", "09", "++", "##", "&&", "..", "__", "%%", "--")
BREAK, BLOCK, ALONE = 0, 1, 2
# All characters beyond are of one kind.
_LAST = 1 << 16


def kinds_of_characters(breaks=SENTENCE_MARKS + WS_CHARS):
    """The kind of each character: ``breaks`` are in no token."""
    kinds = np.full(_LAST + 1, ALONE, np.uint8)
    for first, last in _RANGES:
        kinds[ord(first):ord(last) + 1] = BLOCK
    kinds[[ord(c) for c in breaks]] = BREAK
    return kinds


def tokens(codes, begins, kinds):
    """(starts, ends, kept): where the blocks and the characters that stand alone lie, in order, and which characters are in one.

    ``begins`` are the places where a text begins; no block reaches over one."""
    kind = kinds[np.minimum(codes, _LAST)]
    block, alone = kind == BLOCK, kind == ALONE
    joined = np.append(block[1:] & block[:-1], False) if len(codes) else np.zeros(0, bool)  # to the next character
    begins = begins[(begins > 0) & (begins <= len(codes))]
    joined[begins - 1] = False
    starts = block | alone
    starts[1:] &= ~joined[:-1]
    return np.flatnonzero(starts), np.flatnonzero((block | alone) & ~joined) + 1, kind != BREAK


def stretches(starts, sizes):
    """The places start, start + 1, ... of every stretch, one stretch after another."""
    stops = np.cumsum(sizes)
    return np.repeat(starts - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0)


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.own, self.size = np.zeros(1 << 10, kind), 0

    def __len__(self):
        return self.size

    def put(self, values, keep=None):
        """Write values behind the end, of which ``keep`` (all) are there to stay and the others till the next ones come."""
        end = self.size + len(values)
        if end > len(self.own):
            self.own = np.concatenate([self.own[:self.size], np.zeros(2 * end - self.size, self.own.dtype)])
        self.own[self.size:end] = values
        self.size = end if keep is None else self.size + keep


class Numbers:
    """Numbers from 0 for 64-bit hashes, in the order they come, by open addressing."""

    def __init__(self):
        self.hashes, self.slots, self.shift = Grown(np.uint64), np.full(1 << 12, -1, np.int32), np.uint64(64 - 12)

    def __len__(self):
        return len(self.hashes)

    def find(self, hashes):
        """The number of each hash, -1 where it is new."""
        at, mask, own = (hashes >> self.shift).astype(np.int64), len(self.slots) - 1, self.hashes.own
        number = self.slots[at]
        wrong = np.flatnonzero((number >= 0) & (own[number] != hashes))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & mask
            number[wrong] = self.slots[at[wrong]]
            wrong = wrong[(number[wrong] >= 0) & (own[number[wrong]] != hashes[wrong])]
        return number

    def put(self, hashes):
        """Number new hashes, all different."""
        first = len(self.hashes)
        self.hashes.put(hashes)
        if 2 * len(self) > len(self.slots):
            bits, first = (4 * len(self)).bit_length(), 0
            self.slots, self.shift = np.full(1 << bits, -1, np.int32), np.uint64(64 - bits)
        numbers, mask = np.arange(first, len(self), dtype=np.int32), len(self.slots) - 1
        at = (self.hashes.own[first:len(self)] >> self.shift).astype(np.int64)
        while len(numbers):
            free = self.slots[at] < 0
            self.slots[at[free]] = numbers[free]
            left = self.slots[at] != numbers  # of those that meet in one place the last gets it
            numbers, at = numbers[left], (at[left] + 1) & mask
