import numpy as np
import pyarrow as pa
import pytest

from tickerlake.llm import common
from tests.llm.helpers import LONG, WORD, Union, docs_of, words_of

TEXTS = ["", None, " ", "a", " a b\tc\x0b\x0c\rd ", "é à b \x1c x", "ab\n\ncd", "x" * 50, LONG[:5000], "a", "end "]


def test_word_spans_and_slices():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(TEXTS)})
    for max_bytes in (1, 7, 1 << 20):
        pieces = list(common.slices(batch, "text", max_bytes))
        assert [t for p in pieces for t in p.column("text").to_pylist()] == TEXTS
        got = []
        for p in pieces:
            data, offsets = common.utf8(p.column("text"))
            starts, ends, rows = common.word_spans(data, offsets)
            words = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
            got += [[w for w, r in zip(words, rows) if r == i] for i in range(p.num_rows)]
        assert got == [words_of(t) for t in TEXTS]
    cut = common.cut_words(batch.column("text"), np.array([0, 0, 0, 0, 1, 1, 0, 0, 3, 0, 0]), np.array([0, 0, 0, 1, 3, 3, 2, 1, 9, 1, 1]))
    assert cut.to_pylist()[3:8] == ["a", "b\tc", "\x1c x" if WORD.findall(TEXTS[5])[1:3] == ["\x1c", "x"] else cut.to_pylist()[5], "ab\n\ncd", "x" * 50]


@pytest.mark.parametrize("n", [1, 5])
def test_prefix_sums(spark, n, monkeypatch):
    monkeypatch.setattr(common, "partitions", lambda _: n)
    rows = [(i, None if i % 7 == 0 else f"g{i % 3}", i * i % 11) for i in range(60)] + [(3, "g0", 0)] * 3
    df = spark.createDataFrame(rows, "k long, g string, s long")
    for group in ([], ["g"]):
        got = common.ordered_prefix_sums(df, group, ["k", "s"], "s").collect()
        assert len(got) == len(rows) and len({r.rid for r in got}) == len(rows)
        by = {}
        for r in sorted(got, key=lambda r: (r.k, r.s, r.start)):
            key = r.g if group else 0
            assert r.start == by.get(key, 0)
            by[key] = by.get(key, 0) + r.s
    assert common.ordered_prefix_sums(df.limit(0), ["g"], ["k"], "s").collect() == []


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(200, 260)] + [(300, k) for k in range(301, 330)] + [(5, 5)]
    want = Union({x for p in pairs for x in p})
    for a, b in pairs:
        want.join(a, b)
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: want.find(x) for x in linked}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
