from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

WORDS = [a + b for a in ("ba", "de", "ki", "lo", "mu", "na", "po", "ri", "sa", "tu") for b in ("n", "r", "s", "lt", "rk", "m")]


@pytest.fixture(scope="session")
def prose():
    """Random sentences: ``prose(seed, words)``."""

    def write(seed: int, words: int) -> str:
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) for _ in range(words))

    return write


@pytest.fixture(scope="session")
def corpus(prose):
    """Documents with copies, near copies, a shared passage, and odd rows."""
    rng = random.Random(7)
    passage = prose(1, 60)
    found: list[tuple[int, str | None]] = []
    for k in range(30):
        found.append((len(found), prose(100 + k, rng.randint(30, 120))))
    for k in range(12):
        found.append((len(found), found[k][1]))
    for k in range(12):
        words = found[k][1].split()
        words[rng.randrange(len(words))] = "changed"
        found.append((len(found), " ".join(words).upper() if k % 2 else " ".join(words)))
    for k in range(40):
        found.append((len(found), prose(300 + k, 10) + " " + passage + " " + prose(400 + k, 12)))
    found += [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "one"), (905, "four words are here"), (906, "é ü 中文 ß")]
    found += [(907, "x" * 400), (908, "x" * 300), (909, "ab " * 1500), (910, prose(5, 8_000))]
    return found
