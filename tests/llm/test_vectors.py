import math

import numpy as np
import pytest

from tickerlake.llm import ann, vector_dedup
from tickerlake.llm.queries import op3_learned_partitions, op4_vector_dedup
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import Union

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [(9000, None, 1), (9020, [0.0] * 8, 1), (9040, [1.0] * 7 + [None], 1), (9060, [1.0] * 7 + [math.nan], 1), (9080, [1.0] * 7 + [math.inf], 1),
       (9100, [1.0] * 3, 1), (9120, [], 1)]


def near(seed=0, n=300, d=8):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d))
    x[100:160] = x[0] + 0.05 * r.normal(size=(60, d))          # a group of near copies
    x[160:170] = x[1]                                          # equal ones
    x[170] = x[1] * 2
    return x.astype(np.float32)


def rows_of(x, labels):
    return [(i, [float(v) for v in row], labels[i]) for i, row in enumerate(x)]


def brute_links(rows, threshold):
    d = 8
    ok = [r for r in rows if r[1] is not None and r[2] is not None and len(r[1]) == d and all(v is not None and math.isfinite(v) for v in r[1]) and any(r[1])]
    x = np.array([r[1] for r in ok], float)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    same = np.array([r[2] for r in ok])
    linked = (u @ u.T >= threshold) & (same[:, None] == same[None, :])
    np.fill_diagonal(linked, False)
    want = Union([r[0] for r in rows])
    for a, b in zip(*np.nonzero(linked)):
        want.join(ok[a][0], ok[b][0])
    links = {r[0]: 0 for r in rows} | {r[0]: int(n) for r, n in zip(ok, linked.sum(1))}
    return {k: (links[k], want.find(k)) for k in links}


@pytest.mark.parametrize("leaf,block", [(16, 8), (64, 1000), (1000, 16)])
def test_dedup_equals_brute_force(spark, leaf, block):
    x = near()
    rows = rows_of(x, [None if i % 29 == 0 else (0 if i < 160 else i % 3) for i in range(len(x))]) + ODD
    df = spark.createDataFrame(rows, SCHEMA)
    got = vector_dedup.near_duplicates(df, 0.98, trees=8, leaf=leaf, block=block).collect()
    assert len(got) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute_links(rows, 0.98)


def test_dedup_repeats_and_empty(spark):
    v = [1.0, 2.0]
    df = spark.createDataFrame([(5, v, 1), (5, v, 1), (7, v, 1), (3, v, 2), (None, v, 1), (None, [3.0, 1.0], 1), (8, [-0.0, 1.0], 4), (9, [0.0, 1.0], 4)], SCHEMA)
    got = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in vector_dedup.near_duplicates(df.withColumnRenamed("label", "label")).collect())
    assert got == [(False, 3, 0, 3, True), (False, 5, 3, 5, True), (False, 5, 3, 5, True), (False, 7, 3, 5, False), (False, 8, 1, 8, True),
                   (False, 9, 1, 8, False), (True, 0, 0, 0, True), (True, 0, 3, 5, False)]
    assert vector_dedup.near_duplicates(df.limit(0)).collect() == []


def test_dedup_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    got = op4_vector_dedup(spark, SF_MID).collect()
    assert len(got) == len(rows)
    x = np.array([r[1] for r in rows], float)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    same = np.array([r[2] for r in rows])
    links = ((u @ u.T >= 0.98) & (same[:, None] == same[None, :])).sum(1) - 1
    assert {r.vec_id: r.n_links for r in got} == {r[0]: int(n) for r, n in zip(rows, links)}


def brute_nearest(ids, x, k):
    x = x.astype(float)
    out = {}
    for i, own in enumerate(ids):
        if own is not None and own % 20 == 0:
            s = (x * x[i]).sum(1)
            order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-s[j], ids[j] is None, ids[j] or 0))[:k]
            out[own] = [(ids[j], s[j]) for j in order]
    return out


def found(df, **kw):
    out = {}
    for r in sorted(ann.nearest(df, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        own = out.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r.rank == len(own)
    return out


def test_small_search_is_exact(spark):
    x = near()
    ids = [*range(len(x) - 1), None]
    df = spark.createDataFrame([(i, [float(v) for v in row], 0) for i, row in zip(ids, x)] + ODD, SCHEMA)
    got, want = found(df, k=20), brute_nearest(ids, x, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(a[1] == pytest.approx(b[1], abs=1e-12) for q in got for a, b in zip(got[q], want[q]))


def test_fewer_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.5, 0.0], 0)], SCHEMA)
    assert found(df, k=20) == {0: [(1, 1.0), (2, 0.5)]}
    assert found(df.where("vec_id = 0"), k=20) == {}
    assert found(df.limit(0), k=20) == {}
    assert found(df.where("vec_id > 0"), k=20) == {}


def test_learned_partitions_recall(spark):
    """Many parts: rows in clusters, several probes, recall against brute force."""
    r = np.random.default_rng(2)
    centres = r.normal(size=(40, 16)) * 2
    x = (centres[r.integers(0, 40, 4000)] + r.normal(size=(4000, 16))).astype(np.float32)
    x[:600] = x[0] + 0.01 * r.normal(size=(600, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in row], 0) for i, row in enumerate(x)], SCHEMA)
    model = ann.learn(x.astype(float), 16, 20)
    assert model["w2"].shape[1] == 16 and model["coverage"] < 1
    got, want = found(df, k=20, part_rows=250), brute_nearest(list(range(len(x))), x, 20)
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9


@pytest.mark.parametrize("sample", [250, 5000])
def test_copies_do_not_crowd_the_index_sample(spark, monkeypatch, sample):
    r = np.random.default_rng(4)
    x = np.concatenate([np.repeat(r.normal(size=(40, 4)), 50, axis=0), r.normal(size=(500, 4))]).astype(np.float32)
    seen, learn = [], ann.learn
    monkeypatch.setattr(ann, "learn", lambda x, *a: (seen.append(x), learn(x, *a))[1])
    found(spark.createDataFrame([(i, [float(v) for v in row], 0) for i, row in enumerate(x)], SCHEMA), k=5, sample=sample)
    drawn, = seen
    assert len(np.unique(drawn, axis=0)) == len(drawn)
    assert len(drawn) == 540 if sample > 540 else 0.7 * sample < len(drawn) < 1.3 * sample


def test_nearly_empty_parts_lead_on(spark, monkeypatch):
    """Parts 0 and 1 hold 3 rows each and part 2 the rest: every query still gets k rows."""
    x = np.random.default_rng(6).normal(size=(100, 3)).astype(np.float32) * 0.01
    x[np.arange(100), [0] * 3 + [1] * 3 + [2] * 94] += 1
    model = {"w1": np.eye(3), "b1": np.zeros(3), "w2": 9 * np.eye(3), "b2": np.zeros(3), "scale": 1.0, "coverage": 0.3}
    monkeypatch.setattr(ann, "learn", lambda *a: model)
    df = spark.createDataFrame([(20 * i, [float(v) for v in row], 0) for i, row in enumerate(x)], SCHEMA)
    got = found(df, k=20)
    assert len(got) == 100 and {len(v) for v in got.values()} == {20}
    assert {len(v) for v in found(df, k=200).values()} == {99}


def two_lengths():
    short = near(3, 200, 5)[60:]
    return rows_of(near(), [i % 2 for i in range(300)]) + [(1000 + i, [float(v) for v in row], 0) for i, row in enumerate(short)]


def test_dedup_of_two_lengths(spark):
    rows = two_lengths()
    got = vector_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), 0.98, trees=8, leaf=16, block=8).collect()
    short = [(i, [*v, 0.0, 0.0, 0.0], label) for i, v, label in rows[300:]]
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute_links(rows[:300], 0.98) | brute_links(short, 0.98)
    assert sum(r.n_links for r in got if r.vec_id >= 1000)


def test_search_of_two_lengths(spark):
    rows = two_lengths()
    got = found(spark.createDataFrame(rows, SCHEMA), k=20)
    for own in (rows[:300], rows[300:]):
        ids = [r[0] for r in own]
        for q, best in brute_nearest(ids, np.array([r[1] for r in own], np.float32), 20).items():
            assert [i for i, _ in got[q]] == [i for i, _ in best]


def test_search_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows])
    want = brute_nearest(ids, x, 20)
    got = {}
    for r in op3_learned_partitions(spark, SF_SMALL).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
