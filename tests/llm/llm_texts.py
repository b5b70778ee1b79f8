"""Invented texts for the tests."""

import random

WORDS = "the of and river stone ring green table seven moon paper cloud winter bread glass north".split()


def story(n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(50)) for _ in range(n))
