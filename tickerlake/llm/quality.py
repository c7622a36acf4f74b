"""Operator 7: quality by a generalised additive model with pair interactions.

Each text becomes a few numbers (lengths, character classes, repetition). The
model is a sum of lookup tables: one per feature over quantile bins, learned
by boosting shallow trees feature by feature in turn, then some for pairs of
features, chosen by how much residual gain a coarse two-way grid shows.
Scoring is an addition of table entries for whole batches at once.

Fitting uses a bounded sample (``labelled.SAMPLE_ROWS`` labelled rows outside
the held-out fold); scoring covers every row in place, without a shuffle.
Labels, lang, source and doc_id never reach a score.

Defined cases: a null text is empty, and an empty text's features are all 0;
repeated rows are scored alike; with no labels every score is 0.5; no rows
give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm import labelled
from tickerlake.llm.common import extended

BINS = 32                 # per feature
PAIR_BINS = 8             # per side of a pair's table
PAIRS = 8                 # interactions, at most
ROUNDS, PAIR_ROUNDS = 120, 60
RATE, L2 = 0.15, 1.0

FEATURES = ("words", "word_length", "upper", "punctuation", "symbols", "digits", "exclaims", "distinct",
            "top_word", "repeats", "distinct_lines", "line_words", "ended", "non_ascii", "short", "pipes", "links")

_UPPER = bytes(range(65, 91))
_LETTER = bytes([*range(65, 91), *range(97, 123)])
_PUNCT = b"!\"'(),-.:;?"
_SYMBOL = b"#$%&*+/<=>@[\\]^_`{|}~"
_DIGIT = b"0123456789"
_HIGH = bytes(range(128, 256))
_LINK = re.compile(rb"https?://|www\.")


def features_of(text: str) -> list[float]:
    raw = text.encode()
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    count = lambda kind: size - len(raw.translate(None, kind))
    letters = count(_LETTER)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ended = raw.count(b". ") + raw.count(b".\n") + raw.count(b", ") + raw.endswith(b".")
    return [float(np.log1p(n)), (size - n) / n, count(_UPPER) / max(letters, 1), count(_PUNCT) / size,
            count(_SYMBOL) / size, count(_DIGIT) / size, raw.count(b"!") / n, len(seen) / n,
            max(seen.values()) / n, sum(map(eq, words, words[1:])) / n, len(set(lines)) / len(lines),
            n / len(lines), ended / n, count(_HIGH) / size, sum(1 for w in words if len(w) <= 3) / n,
            raw.count(b"|") / n, len(_LINK.findall(raw)) / n]


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Values of a small tree over the bins of one feature: greedy splits."""
    n = len(grad)
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + L2)
    cuts = [0, n]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                mid = np.arange(a + 1, b)
                value = gain(a, mid) + gain(mid, b) - gain(a, b)
                k = int(value.argmax())
                if value[k] > best[0]:
                    best = (float(value[k]), int(mid[k]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(n)
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + L2)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """One split of each axis: four quadrants with their values."""
    def quadrants(x):
        c = np.zeros((x.shape[0] + 1, x.shape[1] + 1))
        c[1:, 1:] = x.cumsum(0).cumsum(1)
        a = c[1:-1, 1:-1]
        right, low = c[1:-1, -1:], c[-1:, 1:-1]
        return [a, right - a, low - a, c[-1, -1] - right - low + a]

    g, h = quadrants(grad), quadrants(hess)
    value = sum(x * x / (y + L2) for x, y in zip(g, h))
    i, j = np.unravel_index(int(value.argmax()), value.shape)
    out = np.empty_like(grad)
    for k, (rows, cols) in enumerate((a, b) for a in (slice(0, i + 1), slice(i + 1, None)) for b in (slice(0, j + 1), slice(j + 1, None))):
        out[rows, cols] = g[k][i, j] / (h[k][i, j] + L2)
    return out


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]


def boost(x: np.ndarray, y: np.ndarray) -> dict:
    """Tables of the additive model for features ``x`` and labels ``y``."""
    k = x.shape[1]
    edges, coarse = _edges(x, BINS), _edges(x, PAIR_BINS)
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    model = {"base": float(np.log(rate / (1 - rate))), "edges": edges, "coarse": coarse,
             "tables": [np.zeros(len(e) + 1) for e in edges], "pairs": []}
    if len(y) < 10 or y.min() == y.max():
        return model
    b, c = _bins(x, edges), _bins(x, coarse)
    z = np.full(len(y), model["base"])

    def residual():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(k):
            g, h = residual()
            size = len(edges[j]) + 1
            step = RATE * _tree(np.bincount(b[:, j], g, size), np.bincount(b[:, j], h, size))
            model["tables"][j] += step
            z += step[b[:, j]]
    g, h = residual()
    gains = []
    for i in range(k):
        for j in range(i + 1, k):
            rows, cols = len(coarse[i]) + 1, len(coarse[j]) + 1
            if rows > 1 and cols > 1:
                cell = c[:, i] * cols + c[:, j]
                gg, hh = (np.bincount(cell, v, rows * cols) for v in (g, h))
                gains.append((float((gg * gg / (hh + L2)).sum()), i, j))
    chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in chosen]
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in zip(chosen, tables):
            g, h = residual()
            cell = c[:, i] * t.shape[1] + c[:, j]
            step = RATE * _pair_tree(*(np.bincount(cell, v, t.size).reshape(t.shape) for v in (g, h)))
            t += step
            z += step[c[:, i], c[:, j]]
    model["pairs"] = [(i, j, t) for (i, j), t in zip(chosen, tables)]
    return model


def apply_tables(model: dict, x: np.ndarray) -> np.ndarray:
    b, c = _bins(x, model["edges"]), _bins(x, model["coarse"])
    z = np.full(len(x), model["base"])
    for j, t in enumerate(model["tables"]):
        z += t[b[:, j]]
    for i, j, t in model["pairs"]:
        z += t[c[:, i], c[:, j]]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Tables learned from the bounded labelled sample, some tens of kB."""
    sample = labelled.labelled_sample(docs, labels, "quality")

    def extract(batches):
        for batch in batches:
            x = [features_of(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"y": batch.column("y").cast(pa.int32()), "x": pa.array(x, pa.list_(pa.float64()))})

    got = sample.select((F.col("y") > 0).cast("int").alias("y"), "text").mapInArrow(extract, "y int, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(got.num_rows, len(FEATURES))
    y = got.column("y").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))          # in one order whatever the tasks: the same sums, so the same tables
    x, y = x[order], y[order]
    if not len(y):
        x, y = np.zeros((1, len(FEATURES))), np.array([0.5])
    return boost(x, y)


def score(docs: DataFrame, model: dict, name: str = "_score") -> DataFrame:
    """``docs`` with a column ``name``: 0 to 1, in place, no shuffle."""
    names, schema = docs.columns, extended(docs.schema, **{name: "double"})

    def run(batches):
        for batch in batches:
            x = np.array([features_of(t.as_py() or "") for t in batch.column(names.index("text"))], float)
            out = apply_tables(model, x.reshape(batch.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*names, name])

    return docs.mapInArrow(run, schema)
