"""Made-up prose for the corpus tests."""

import random

WORDS = ("the of and to in is a that it was for on with he be by at thing other water under house paper "
         "green stone light river cloud table voice night morning garden letter window").split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (r.choice("abcdefgh") if r.random() < 0.4 else "") for _ in range(n))


def edited(text: str, seed: int, n: int) -> str:
    r = random.Random(seed)
    words = text.split(" ")
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)
