"""Brute-force helpers of the tests in this folder."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def prose(rng, n, vocabulary=400):
    """``n`` words in sentences and lines."""
    out = []
    for _ in range(n):
        w = f"w{rng.randrange(vocabulary)}"
        w += rng.choice([""] * 14 + ["."])
        out.append(w + ("\n" if rng.random() < 0.05 else " "))
    return "".join(out).strip()
