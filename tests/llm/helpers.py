import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))


def docs_of(spark, rows):
    """rows: (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


def words_of(text):
    return WORD.findall(text or "")


def sentence(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


def rng():
    return np.random.default_rng(7)


class Union:
    """Smallest member of each connected group."""

    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, a):
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
