"""Texts made by rule; apart from conftest so that test modules can import them by name."""

import random

WORDS = [a + b for a in ("ba", "ko", "mi", "tu", "re", "sha", "lo", "pe") for b in ("n", "st", "rim", "dal", "vo", "x", "", "que")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else f"z{rng.randrange(10**6)}" for w in text.split(" "))


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)
