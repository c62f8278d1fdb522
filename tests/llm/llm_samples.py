"""Made-up texts."""

import random


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(1 + rng.randrange(vocabulary) % 9)) for _ in range(words))
