"""Operator 4: near-duplicate vectors by a random-projection tree forest.

Equal vectors of a label first become one class. Vectors of another length
count as another label. Each tree splits space by
random projections, one direction a level, at the medians of a bounded
sample; a vector within the spill width of a cut goes to both sides. Vectors
of one label in one leaf are compared, verified in double precision and united.

A pair is counted where it meets first (the smallest leaf that both are in,
over all trees), which each side can tell from the leaves it carries. So no
pair is written: a cell of a leaf passes on a count per vector and a link to
the smallest vector it reaches there. Leaves are dealt to cells of pairs of
blocks of ``BLOCK`` vectors by a hash: a leaf of any size, as a large group of
near copies makes, is compared whole in many tasks of bounded size.

Why nothing is lost: near-duplicates are at most ``sqrt(2 - 2 * threshold)``
apart, so their projections differ by a ``1 / sqrt(dimension)``-th of that
(standard deviation); a spill of one such deviation to either side leaves
about 0.2 % a level, and ``TREES`` independent trees the power of the rest.

Defined cases: vectors that are null, zero or hold a null or non-finite
component, or with a null label, link with nothing and are their own component;
vectors of different lengths never link, and each length has a forest of its own; repeated rows are linked vectors; no rows give no
rows. A null vec_id never names a component unless it is all there is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm import vectors
from tickerlake.llm.common import connected_components, written

TREES = 6
LEAF = 512                # vectors of a label in a leaf, about
BLOCK = 1_024             # vectors compared at once, per side
SAMPLE = 16_384           # vectors the cuts are taken from, at most
LEAST_SAMPLE = 32         # sample vectors for a cut of its own; below, the parent's middle


class Forest:
    """Cuts of all trees to some depth. ``cuts[t][level]`` holds a threshold
    per node; a child has node ``2 * parent + side``."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int, spill: float, seed: int = 4):
        self.depth, self.spill = depth, spill
        rng = np.random.default_rng(seed)
        d = sample.shape[1]
        self.axes = rng.normal(size=(trees, max(depth, 1), d))
        self.axes /= np.linalg.norm(self.axes, axis=2, keepdims=True)
        self.cuts, self.middle = [], []
        for t in range(trees):
            node, cuts, middle = np.zeros(len(sample), np.int64), [], []
            for level in range(depth):
                p = sample @ self.axes[t, level]
                middle.append(float(np.median(p)) if len(p) else 0.0)
                if level > 20 or len(sample) < LEAST_SAMPLE << level:
                    cuts.append(None)            # too few to tell: every node cuts at the middle of all
                    continue
                own = np.full(1 << level, middle[-1])
                order = np.argsort(node, kind="stable")
                edges = np.searchsorted(node[order], np.arange((1 << level) + 1))
                for k in range(1 << level):
                    rows = order[edges[k]:edges[k + 1]]
                    if len(rows) >= LEAST_SAMPLE:
                        own[k] = np.median(p[rows])
                cuts.append(own)
                node = 2 * node + (p > own[node])
            self.cuts.append(cuts)
            self.middle.append(middle)

    def leaves(self, x: np.ndarray, depths: np.ndarray) -> list[np.ndarray]:
        """The leaf keys of each unit vector, ascending; ``depths``: how deep
        its label's trees go."""
        rows, keys = [], []
        for t in range(len(self.axes)):
            r, node, level_of = np.arange(len(x)), np.zeros(len(x), np.int64), depths
            for level in range(int(depths.max()) if len(depths) else 0):
                ends = level_of <= level
                rows.append(r[ends])
                keys.append(self._key(t, level, node[ends]))
                r, node, level_of = r[~ends], node[~ends], level_of[~ends]
                p = x[r] @ self.axes[t, level]
                cut = self.cuts[t][level]
                away = p - (cut[node] if cut is not None else self.middle[t][level])
                left, right = away <= self.spill, away > -self.spill
                r, level_of = np.concatenate([r[left], r[right]]), np.concatenate([level_of[left], level_of[right]])
                node = np.concatenate([2 * node[left], 2 * node[right] + 1])
            rows.append(r)
            keys.append(self._key(t, int(depths.max()) if len(depths) else 0, node))
        rows, keys = np.concatenate(rows), np.concatenate(keys)
        order = np.lexsort((keys, rows))
        return np.split(keys[order], np.searchsorted(rows[order], np.arange(1, len(x))))

    @staticmethod
    def _key(tree: int, depth: int, node: np.ndarray) -> np.ndarray:
        return (np.int64(tree) << np.int64(54)) + (np.int64(depth) << np.int64(48)) + node


def _first_common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    out = np.empty(len(a), np.int64)
    for i, (x, y) in enumerate(zip(a, b)):
        both = np.intersect1d(x, y, assume_unique=True)
        out[i] = both[0] if len(both) else -1
    return out


def _components(linked: np.ndarray) -> np.ndarray:
    """The smallest index that each row reaches over ``linked`` (symmetric)."""
    lab = np.arange(len(linked))
    while True:
        reach = np.where(linked, lab[None, :], len(lab)).min(axis=1, initial=len(lab))
        nxt = np.minimum(lab, reach)
        nxt = nxt[nxt]
        if (nxt == lab).all():
            return lab
        lab = nxt


def compare_cell(leaf: int, x: np.ndarray, rid: np.ndarray, mult: np.ndarray, side: np.ndarray, same_block: bool,
                 leaves: list[np.ndarray], threshold: float):
    """(rid, links, root) of the vectors of a cell that link in it. ``side``: 0
    or 1, the block of each; pairs of a block are compared if ``same_block``."""
    order = np.argsort(rid, kind="stable")
    x, rid, mult, side = x[order], rid[order], mult[order], side[order]
    leaves = [leaves[i] for i in order]
    i, j = np.nonzero(np.triu(x @ x.T >= threshold, 1))
    if not same_block:
        cross = side[i] != side[j]
        i, j = i[cross], j[cross]
    if not len(i):
        return rid[:0], mult[:0], rid[:0]
    # Vectors of the same leaves answer alike; look once per pair of such kinds.
    kinds, kind = {}, np.empty(len(rid), np.int64)
    for n, own in enumerate(leaves):
        kind[n] = kinds.setdefault(own.tobytes(), len(kinds))
    example = [None] * len(kinds)
    for n, k in enumerate(kind):
        example[k] = leaves[n]
    codes, back = np.unique(kind[i] * len(kinds) + kind[j], return_inverse=True)
    first = _first_common([example[c // len(kinds)] for c in codes], [example[c % len(kinds)] for c in codes])
    here = (first == leaf)[back]
    i, j = i[here], j[here]
    links = np.bincount(i, mult[j], len(rid)) + np.bincount(j, mult[i], len(rid))
    linked = np.zeros((len(rid), len(rid)), bool)
    linked[i, j] = linked[j, i] = True
    root = rid[_components(linked)]
    hit = links > 0
    return rid[hit], links[hit].astype(np.int64), root[hit]


def near_duplicates(rows: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector: str = "embedding",
                    label: str = "label", trees: int = TREES, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    v, group = F.col(f"`{vector}`"), F.col(f"`{label}`")
    given = rows.select(F.col(f"`{id_col}`").alias("id"), group.cast("string").alias("label"), v.alias("v"))
    kind = vectors.kind_of(given, "v")
    fine = vectors.usable(F.col("v")) & F.col("label").isNotNull()
    keys = [F.when(fine, F.xxhash64("label", "v", F.lit(s))).alias(f"h{s}") for s in (1, 2)]
    # Zeroes of either sign are one value, as in grouping by the vector itself.
    plus = given.withColumn("v", F.transform("v", lambda z: F.when(z == 0, F.lit(0).cast("float" if kind == "<f4" else "double")).otherwise(z)))
    hashed = plus.select("id", "label", "v", *keys)
    classes = (hashed.where("h1 is not null").groupBy("h1", "h2")
               .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("mult"), F.concat_ws(":", F.size(F.first("v")), F.first("label")).alias("label"), F.first("v").alias("v")).withColumn("d", F.size("v")))

    def pack(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("h1", "h2", "id", "mult", "label", "d", "rid")), vectors.packed(b.column("v"), kind)],
                names=["h1", "h2", "id", "mult", "label", "d", "rid", "v"])

    classes = written(classes.withColumn("rid", F.monotonically_increasing_id())
                      .select("h1", "h2", "id", "mult", "label", "d", "rid", "v")
                      .mapInArrow(pack, "h1 long, h2 long, id long, mult long, label string, d int, rid long, v binary"), "dedup-classes")
    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.first("d").alias("d"))
    share = F.pmod(F.xxhash64("v", F.lit("forest")), F.lit(1 << 20))
    unit = lambda m: m / np.sqrt((m * m).sum(axis=1, keepdims=True))
    forests = {}
    for length, most, total in sizes.groupBy("d").agg(F.max("n"), F.sum("n")).orderBy("d").collect():     # a row per length
        depth = max(0, int(np.ceil(np.log2(most / leaf))))
        some = classes.where(F.col("d") == length)
        some = some if total <= SAMPLE else some.where(share < (1 << 20) * SAMPLE // total)
        drawn = some.orderBy("v").select("v").limit(2 * SAMPLE).toArrow().column("v").to_pylist() if depth else []
        sample = unit(vectors.unpacked(drawn, kind, length).astype(np.float64)) if drawn else np.zeros((0, length))
        spill = float(np.sqrt(max(0.0, 2 - 2 * threshold)) / np.sqrt(length))
        forests[length] = Forest(sample, depth, trees, spill)

    def leaves(batches):
        for b in batches:
            own = np.maximum(0, np.ceil(np.log2(b.column("n").to_numpy() / leaf))).astype(np.int64)
            found = [None] * b.num_rows
            for length, at, x in vectors.by_length(b.column("v").to_pylist(), kind):
                for i, keys in zip(at, forests[length].leaves(unit(x.astype(np.float64)), own[at])):
                    found[i] = keys.tolist()
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("rid", "label", "mult", "v")), pa.array(found, pa.list_(pa.int64()))],
                names=["rid", "label", "mult", "v", "leaves"])

    placed = written(classes.join(sizes.drop("d"), "label").select("rid", "label", "mult", "v", "n").mapInArrow(
        leaves, "rid long, label string, mult long, v binary, leaves array<long>"), "dedup-leaves")
    members = placed.withColumn("leaf", F.explode("leaves"))
    held = members.groupBy("label", "leaf").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    held = written(held, "dedup-cells")
    # Leaves of one block need no dealing; of the others there are at most
    # (leaf memberships / block), and AQE measures them before it broadcasts.
    dealt = (members.join(held, ["label", "leaf"])
             .withColumn("mine", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("label", "leaf", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"),
                     (F.col("mine") > F.col("other")).cast("int").alias("side"), "rid", "mult", "v", "leaves"))

    def cell(keys, t):
        (_, _, x), = vectors.by_length(t.column("v").to_pylist(), kind)      # a label's vectors are of one length
        x = unit(x.astype(np.float64))
        got = compare_cell(keys[1].as_py(), x, t.column("rid").to_numpy(), t.column("mult").to_numpy().astype(np.float64),
                           t.column("side").to_numpy(), keys[2].as_py() == keys[3].as_py(),
                           [np.array(k, np.int64) for k in t.column("leaves").to_pylist()], threshold)
        return pa.table([pa.array(c, pa.int64()) for c in got], names=["rid", "links", "root"])

    links = written(dealt.groupBy("label", "leaf", "a", "b").applyInArrow(cell, "rid long, links long, root long"), "dedup-links")
    parts = connected_components(links.where("rid <> root"), "rid", "root", "dedup")
    counted = links.groupBy("rid").agg(F.sum("links").alias("links"))
    joined = (classes.join(counted, "rid", "left").join(parts, F.col("rid") == F.col("node"), "left")
              .select("h1", "h2", "id", "mult", F.coalesce("links", F.lit(0).cast("long")).alias("links"), F.coalesce("component", "rid").alias("part")))
    joined = written(joined, "dedup-parts")
    names = joined.groupBy("part").agg(F.min("id").alias("component_id"))
    result = joined.join(names, "part").select("h1", "h2", (F.col("links") + F.col("mult") - 1).alias("n_links"), "component_id")
    out = hashed.select("id", "h1", "h2").join(result, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
