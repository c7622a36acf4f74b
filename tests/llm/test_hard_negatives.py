import numpy as np
import pytest

from tickerlake.llm import hard_negatives as N

ROWS = "vec_id long, embedding array<float>, label int"


def plain(rows, every=100):
    """Brute force over all pairs, in exact integers."""
    fine = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        fine.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = set()
    for i, a, label in fine:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), j, m) for j, b, m in fine)
        for p, j, _ in [s for s in scored if s[2] == label and s[1] != i][:5]:
            fits = [(s, n) for s, n, m in scored if m != label and 80 * -p <= 100 * -s <= 100 * -p][:5]
            out |= {(i, j, r, n, -p, -s) for r, (s, n) in enumerate(fits, 1)}
    return out


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' as node", "0 as block", "1 as norm")
    got = [tuple(r) for r in N.mine(N.relabelled(df), **kw).collect()]
    assert len(got) == len(set(got))
    return set(got)


def clustered(seed, n, d, labels, step):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d))
    return [(int(i * step), (centres[i % labels] + rng.normal(size=d) * 0.4).astype(np.float32).tolist(), int(i % labels)) for i in range(n)]


@pytest.mark.parametrize("leaf_rows", [16, 4096])
def test_equals_brute_force(spark, leaf_rows):
    rows = clustered(4, 420, 6, 3, 10)
    assert mined(spark, rows, leaf_rows=leaf_rows) == plain(rows)


def test_ties_copies_nulls_zeros_and_odd_values(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), rng.integers(-2, 3, 3).astype(float).tolist(), int(rng.integers(0, 3))) for i in range(0, 3000, 10)]
    rows += [(100_000 + i, [1.0, 0.5, 0.25], i % 4) for i in range(0, 400)]                  # a large group of copies
    rows += [(200_000, None, 1), (200_100, [1.0, None, 2.0], 1), (200_200, [float("nan"), 1.0, 0.0], 1), (200_300, [1.0, 2.0, 3.0], None),
             (200_400, [0.0, 0.0, 0.0], 2), (200_500, [float("inf"), 0.0, 1.0], 0), (200_600, [-1e-3, 1e-3, 0.999], 1),
             (-700, [1.0, 1.0, -1.0], 0), (None, [1.0, 1.0, 1.0], 0)]
    assert mined(spark, rows, leaf_rows=32) == plain(rows)


def test_large_components_short_vectors_and_few_rows(spark):
    rows = [(100 * i, [1e5 * (i + 1), -3e5 * i, 7.0][: 3 if i % 2 else 2], i % 2) for i in range(12)]
    assert mined(spark, rows, leaf_rows=4) == plain(rows)
    assert mined(spark, [(100, [1.0, 2.0], 1), (200, [1e30, 1.0], 1)]) == set()
    assert mined(spark, rows[:0]) == set()


def test_search_skips_subtrees_and_loses_nothing(spark):
    """On separated clusters the ranges rule leaves out, and what is left holds every row of the annulus."""
    rows = clustered(6, 900, 3, 9, 10)
    space_rows = N.integer_rows(spark.createDataFrame(rows, ROWS))
    size = space_rows.selectExpr("max(norm) m").first()["m"]
    space = N.Space(3, size)
    tree = N.Tree(space_rows.selectExpr("*", "true as candidate"), space, 20)
    assert len(tree.levels) >= 2
    probes = space_rows.where("vec_id % 500 = 0").selectExpr("vec_id as anchor", "vec", "norm")
    far = float(np.sqrt(size) * 0.3)
    met = {(r["anchor"], r["node"]) for r in tree.search(probes.selectExpr("*", "0D as near", f"{far}D as far")).collect()}
    leaves = tree.leaves.collect()
    nodes = {r["node"] for r in leaves}
    anchors = probes.collect()
    assert len(met) < 0.7 * len(nodes) * len(anchors)
    for a in anchors:
        for r in leaves:
            s = space.scores(space.matrix([a["vec"]]), space.matrix([r["vec"]]))[0, 0]
            if space.of_scores(a["norm"], s) <= far:
                assert (a["anchor"], r["node"]) in met
