import numpy as np
import pytest

from tickerlake.llm import mixing
from tickerlake.llm.queries import op2_source_mix
from tests.conftest import SF_SMALL
from tests.llm.helpers import LONG, docs_of, words_of


def test_targets():
    assert mixing.targets([100, 100], [1, 1]) == [100, 100]
    assert mixing.targets([10, 190], [5, 1]) == [30, 170]
    assert mixing.targets([0, 10], [5, 2]) == [0, 10]
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [5, 2]) == [0, 0]
    got = mixing.targets([10, 20, 1000, 3], [5, 2, 1, 5])
    assert got[0] == 30 and got[1] == 60 and got[3] == 9 and abs(sum(got) - 1033) < 1e-9


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 100, 1025])
def test_permutation(n):
    got = mixing.permuted(np.arange(n), n, 99)
    assert sorted(got) == list(range(n))
    plan = mixing.Plan([n * 4 - 1], [0], 4, 1)
    for turn in range(3):
        order = mixing.permuted(np.arange(n), n, plan.key(0, turn))
        assert plan.inverse_of_last(0, turn) == int(np.flatnonzero(order == n - 1)[0])


@pytest.mark.parametrize("shards", [1, 2, 7, 64])
def test_shards_add_up(shards):
    quotas = np.array([shards * 5, shards * 3 + 1, 0, 2])
    each = [mixing.shard_counts(s, quotas, 8, 5) for s in range(-(-int(quotas.sum()) // 8))]
    before = np.zeros(4, int)
    for at, here in each:
        assert (at == before).all()
        before = before + here
    assert (before == quotas).all()
    assert all(here.sum() == 8 for _, here in each[:-1])


def test_large_totals_follow_the_same_law():
    left, take = np.array([2_000_000_000, 1_500_000_000, 3, 500_000_000]), 2_500_000_000
    got = np.array([mixing._draw(mixing._rng(i), left, take) for i in range(1500)])
    assert (got.sum(1) == take).all() and (got >= 0).all() and (got <= left).all()
    n = left.sum()
    for own, mean, var in zip(left, got.mean(0), got.var(0)):
        want = take * (own / n) * (1 - own / n) * ((n - take) / (n - 1))
        assert abs(mean - take * (own / n)) < 5 * (want / 1500) ** 0.5 and 0.8 < var / want < 1.25
    # Against numpy's draws, where it has any.
    rng = mixing._rng(1)
    for good, bad, many in ((30, 50, 25), (50, 30, 70), (3, 900, 400), (700, 900, 1000)):
        own = np.array([mixing._hypergeometric(rng, good, bad, many) for _ in range(20_000)])
        ref = rng.hypergeometric(good, bad, many, 20_000)
        assert abs(own.mean() - ref.mean()) < 0.05 * ref.std() and 0.93 < own.var() / ref.var() < 1.07
        steps = np.arange(ref.min(), ref.max() + 1)
        assert np.abs((own[:, None] <= steps).mean(0) - (ref[:, None] <= steps).mean(0)).max() < 0.025


def mixed(spark, docs, **kw):
    rows, spans = mixing.mix(docs, **kw)
    return mixing.taken_per_row(rows, spans).collect(), spans.collect(), rows.collect()


def test_mix_keeps_to_targets(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join("w" * int(rng.integers(1, 4)) for _ in range(int(rng.integers(0, 90)))), f"s{i % 5}") for i in range(120)]
    rows += [(200, LONG[:30_000], "s0"), (201, None, "s1"), (202, "  ", None), (203, "one two three", None), (204, "x", "empty"), (None, "n n", "s1")]
    rows += [(300, "again and again", "s2")] * 3 + [(400, "", "nothing")]
    docs = docs_of(spark, rows)
    taken, spans, listed = mixed(spark, docs, block_words=16, shard_blocks=4)
    assert len(taken) == len(rows)
    assert sorted(r["size"] for r in taken) == sorted(len(words_of(t)) for _, t, _ in rows)
    by = {}
    for r in taken:
        assert r.taken <= 3 * r["size"]
        got = by.setdefault(r.source, [0, r.target, 0, r.source_size])
        got[0] += r.taken
        got[2] += r["size"]
    for got, target, size, said in by.values():
        assert abs(got - target) <= 1 and size == said
    names = sorted(by, key=lambda s: (s is None, s))
    assert [by[s][1] for s in names] == pytest.approx(mixing.targets([by[s][2] for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))]))
    # Spans lie inside their documents; a pass takes no word twice.
    size = {r.rid: r["size"] for r in listed}
    seen = set()
    for s in spans:
        assert 0 <= s.first < s.last <= size[s.rid]
        for w in range(s.first, s.last):
            assert (s.rid, s.turn, w) not in seen
            seen.add((s.rid, s.turn, w))
    shards = {}
    for s in spans:
        shards.setdefault(s.shard, set()).add((s.source_no, s.slot))
    assert max(len(v) for v in shards.values()) <= 4
    again, _, _ = mixed(spark, docs.repartition(7), block_words=16, shard_blocks=4)
    key = lambda rs: sorted((str(r.doc_id), str(r.source), r.taken) for r in rs)
    assert key(again) == key(taken)


def test_empty(spark):
    for rows in ([], [(1, None, "a"), (2, " ", None)]):
        taken, spans, _ = mixed(spark, docs_of(spark, rows))
        assert len(taken) == len(rows) and spans == [] and all(r.taken == 0 for r in taken)


def test_query(spark):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op2_source_mix(spark, SF_SMALL).collect()
    assert {r.doc_id: r["size"] for r in got} == {k: len(words_of(r.text)) for k, r in rows.items()}
    sums = {}
    for r in got:
        s = sums.setdefault(rows[r.doc_id].source, [0, r.target])
        s[0] += r.taken
    assert all(abs(a - b) <= 1 for a, b in sums.values())


def test_shared_draws_equal_each_shards_own():
    quotas = np.array([1000, 37, 0, 501, 4])
    for first, last in ((0, 193), (5, 6), (17, 90), (192, 400)):
        got = list(mixing.counts_between(first, last, quotas, 8, 5))
        assert [s for s, _, _ in got] == list(range(first, min(last, 193)))
        for s, before, here in got:
            want = mixing.shard_counts(s, quotas, 8, 5)
            assert (before == want[0]).all() and (here == want[1]).all()


def test_slots_and_documents_meet_without_a_broadcast(spark):
    _, spans = mixing.mix(docs_of(spark, [(i, "some words of a text " * 50, f"s{i % 2}") for i in range(40)]))
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    slots = plan[plan.index("SortMergeJoin"):]
    assert "BroadcastHashJoin" not in slots[:slots.index("MapInArrow")]


def test_counting_words_takes_little_memory_beside_the_texts():
    """An Arrow batch of 8 MB is counted in slices of 1 MB (it took 4 MB at once, and many times that for the places of words)."""
    import tracemalloc

    import pyarrow as pa

    texts = ["ab " * 4_000] * 650 + [None, "", " x\t"]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
    tracemalloc.start()
    sizes = [n for out in mixing.counted([batch], ["doc_id"], "text", "size") for n in out.column("size").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == [4_000] * 650 + [0, 0, 1]
    assert peak < 30e6
