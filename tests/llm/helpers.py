"""Texts for the tests of this folder."""

import random

from rows import normal

WORDS = "the of and river stone green walk light over under mill tower quiet seven paper north garden wind along copper".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS) + rng.choice(["", "s", "ed", str(rng.randrange(40))]))
        if rng.random() < 0.12:
            out[-1] += ".\n" if rng.random() < 0.5 else ","
    return " ".join(out).replace("\n ", "\n")


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join("changed" + str(rng.randrange(999)) if rng.random() < share else w for w in text.split(" "))


__all__ = ["SCHEMA", "edited", "normal", "prose"]
