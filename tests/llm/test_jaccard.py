import numpy as np
import pytest

from tickerlake.llm import jaccard_join
from tickerlake.llm.queries import op10_ngram_jaccard
from tests.conftest import SF_SMALL
from tests.llm.helpers import LOWER, LONG, Union, docs_of, rng, sentence, words_of


def grams(text, words):
    w = words_of((text or "").translate(LOWER))
    if len(w) < words:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1))


def brute(rows, words, percent):
    """(size, component) per id, all pairs of different sets compared."""
    sets = {i: grams(t, words) for i, t in rows}
    first = {}
    want = Union(sets)
    for i in sorted(sets):
        if sets[i]:
            want.join(i, first.setdefault(sets[i], i))
    items = sorted(first.items(), key=lambda x: len(x[0]))
    for k, (x, i) in enumerate(items):
        for y, j in items[k + 1:]:
            if len(x) * 100 < percent * len(y):
                break
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                want.join(i, j)
    return {i: (len(s), want.find(i)) for i, s in sets.items()}


def got(spark, rows, **kw):
    out = jaccard_join.similar_documents(docs_of(spark, [(i, t, "s") for i, t in rows]), **kw).collect()
    assert len(out) == len(rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in out}


def corpus():
    r = rng()
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n * 7 % 1009, text))
        n += 1

    def edited(text, edits):
        w = text.split()
        for _ in range(edits):
            w[int(r.integers(0, len(w)))] = sentence(r, 1)
        return " ".join(w)

    passage = sentence(r, 50)
    for size in (12, 30, 60, 150, 400):
        for _ in range(6):
            base = sentence(r, size)
            add(base)
            add(base.upper() + " ")
            for edits in (1, 1, 2, 3, 5, 8):
                add(edited(base, edits))
    hot = sentence(r, 120)
    for _ in range(120):                        # a large group of near copies
        add(edited(hot, int(r.integers(1, 4))))
    for _ in range(80):                         # a passage that many texts share
        add(sentence(r, int(r.integers(3, 40))) + " " + passage)
    for _ in range(40):
        add(passage + " " + sentence(r, int(r.integers(1, 4))))
    for t in ("", " \t", None, "a", "A", "a b", "B a", "a  b", "a b c", "A\nB\x0bC", "a b c d", LONG, LONG + " tail", "é È É", "é è é"):
        add(t)
    return rows


@pytest.mark.parametrize("words,percent,most", [(3, 90, 200_000), (5, 80, 20)])
def test_equals_brute_force(spark, words, percent, most, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT", most)
    monkeypatch.setattr(jaccard_join, "BLOCK", 512 if words == 3 else 16)
    monkeypatch.setattr(jaccard_join, "SMALL", 512 if words == 3 else 20)
    rows = corpus()
    assert got(spark, rows, words=words, percent=percent) == brute(rows, words, percent)


@pytest.mark.parametrize("boundary", [0, 10_000])
def test_light_and_heavy_alone_are_exact(spark, boundary, monkeypatch):
    monkeypatch.setattr(jaccard_join, "choose_boundary", lambda *_: boundary)
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    rows = [r for r in corpus() if r[1] is None or len(r[1]) < 1200][::2]
    assert got(spark, rows, words=3, percent=90) == brute(rows, 3, 90)


def test_repeats_nulls_and_empty(spark):
    docs = docs_of(spark, [(5, "one two three four", "s"), (5, "one two three four", "s"), (None, "One two three four", "s"), (None, "alone here", "s"), (7, None, None), (7, None, None)])
    out = sorted(jaccard_join.similar_documents(docs.withColumnRenamed("lang", "node"), words=3, percent=90).collect(), key=str)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == sorted(
        [(5, 2, 5), (5, 2, 5), (None, 2, 5), (None, 1, None), (7, 0, 7), (7, 0, 7)], key=str)
    assert jaccard_join.similar_documents(docs.limit(0)).collect() == []


def test_prefixes_share_what_they_must():
    r = np.random.default_rng(3)
    none = np.zeros(0, np.uint64)
    for _ in range(300):
        n = int(r.integers(2, 120))
        x = np.unique(r.integers(0, 1 << 60, n).astype(np.uint64))
        drop, more = r.integers(0, n // 6 + 1, 2)
        y = np.unique(np.concatenate([r.permutation(x)[int(drop):], r.integers(0, 1 << 60, int(more)).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 90 * (len(x) + len(y) - both) and both and not np.array_equal(x, y):
            for boundary in (0, 30, 1000):
                a, b = (jaccard_join.signatures(v, none, none, 90, boundary) for v in (x, y))
                assert len(np.intersect1d(a, b))
            bits = np.array(jaccard_join.parity(x)) ^ np.array(jaccard_join.parity(y))
            assert sum(int(v).bit_count() if v >= 0 else (int(v) + (1 << 64)).bit_count() for v in bits) <= len(x) + len(y) - 2 * both


def test_spanning_connects_what_all_pairs_would():
    r = np.random.default_rng(1)
    for _ in range(50):
        n = int(r.integers(2, 40))
        label = r.integers(0, n, n)
        linked = r.random((n, n)) < 0.1
        linked = (linked | linked.T) & (label[:, None] != label[None, :])
        want, got = Union(label.tolist()), Union(label.tolist())
        for i, j in zip(*np.nonzero(linked)):
            want.join(int(label[i]), int(label[j]))
        pairs = jaccard_join.spanning(linked, label)
        assert all(linked[i, j] for i, j in pairs) and len(pairs) < len(set(label.tolist()))
        for i, j in pairs:
            got.join(int(label[i]), int(label[j]))
        assert [got.find(int(x)) for x in label] == [want.find(int(x)) for x in label]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op10_ngram_jaccard(spark, SF_SMALL).collect()} == brute(rows, 3, 90)
