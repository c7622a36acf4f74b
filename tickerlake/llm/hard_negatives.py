"""Operator 13: hard negatives by a multiway hyperplane tree with range tables
(GNAT-style).

Scores are integer inner products of vectors whose components became
floor(256 * x). One more coordinate, sqrt(M - |x|^2) with M the largest squared
length, lifts the rows onto a sphere; an anchor's lift is 0. Then

    distance(anchor, row)^2 = |anchor|^2 + M - 2 * score,

so a window of scores is exactly an annulus of distances around the anchor.

The tree grows level by level, each level a pass over the rows of the nodes that hold
more than ``LEAF_ROWS``: a node gets up to ``FANOUT`` split points, chosen far from
each other among ``CANDIDATES`` of its rows, and its rows go to the nearest one. Each split
point stores the least and greatest distance to the rows of every sibling subtree, as sums
over all rows (no sample). A search goes down level by level with all its
anchors: a child is passed over if, for some split point, its range does
not meet what the annulus allows by the triangle inequality. In the leaves that are
left every row is compared, so results are exact.

1. An anchor's rows of its own leaf give a bound for its positives: the score
   of the fifth best there. 2. Positives: a search from that bound up, then the
best five. 3. Negatives: a search in the annulus from 80 % of the least to the
greatest positive score, then the best five inside each positive's own window.

Leaves meet anchors in cells of at most some ``LEAF_ROWS`` rows by as many anchors:
a leaf that can't be split (equal vectors) is cut by a hash, as are many anchors. Of rows equal in
vector and label only the six smallest ids can be among the first five
others of anything, so only those are candidates; each copy may be an anchor.

Defined cases: rows with a null id, label or vector, or with a null or
non-finite component take no part, nor do rows whose squared integer length is
2^62 or more (their scores fit no 64-bit integer); a shorter vector counts as if
followed by zeros; a zero vector is a vector; a negative positive score has
an empty window; repeated rows of one id are rows of their own, and
no row is its own positive; other columns do not matter; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerlake.llm.common import partitions, written

FANOUT = 8
CANDIDATES = 64           # rows of a node among which its split points are chosen
LEAF_ROWS = 4_096
MOST_LEVELS = 20          # node numbers take three bits a level
BROADCAST_BYTES = 32 << 20    # tree levels up to this size are broadcast, larger ones are joined by a shuffle
POSITIVES = NEGATIVES = 5
LARGEST = float(1 << 62)


# --- vectors --------------------------------------------------------------------

def integer_rows(rows: DataFrame, vector: str = "embedding", label: str = "label", id_col: str = "vec_id") -> DataFrame:
    """(vec_id, label, vec, norm): usable rows, their integer vectors packed as
    32-bit integers, and the squared length."""
    told = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"),
                       F.transform(f"`{vector}`", lambda c: c.cast("double")).alias("x"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    told = told.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.coalesce(fine, F.lit(False)))

    def run(batches):
        for batch in batches:
            column = batch.column("x")
            sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            values = np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            ends = np.cumsum(sizes)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            norm = np.bincount(owner, values * values, minlength=len(sizes)).astype(np.float64)
            bounded = np.clip(values, -(1 << 31), (1 << 31) - 1).astype("<i4")
            offsets = np.concatenate([[0], ends * 4]).astype("<i4")
            vec = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(bounded.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), vec, pa.array(norm)],
                                             names=["vec_id", "label", "vec", "norm"])

    return told.mapInArrow(run, "vec_id long, label long, vec binary, norm double").where(F.col("norm") < LARGEST)


class Space:
    """Length of the vectors, and M, the largest squared length."""

    def __init__(self, length: int, most: float):
        self.length, self.most = length, most
        self.exact = most < float(1 << 53)       # then products in doubles are exact
        self.slack = 1e-6 * (most ** 0.5 + 1)

    def matrix(self, packed: list[bytes]) -> np.ndarray:
        out = np.zeros((len(packed), self.length), np.float64 if self.exact else np.int64)
        if packed and all(len(v) == 4 * self.length for v in packed):
            out[:] = np.frombuffer(b"".join(packed), "<i4").reshape(len(packed), self.length)
        else:
            for i, v in enumerate(packed):
                out[i, :len(v) // 4] = np.frombuffer(v, "<i4")
        return out

    def lift(self, norms: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.most - norms, 0))

    def between(self, a, a_norms, b, b_norms) -> np.ndarray:
        """Distances of lifted rows."""
        dots = (a @ b.T).astype(np.float64) + np.outer(self.lift(a_norms), self.lift(b_norms))
        return np.sqrt(np.maximum(2 * self.most - 2 * dots, 0))

    def of_scores(self, norms, scores) -> np.ndarray:
        """Distances of rows with these scores from anchors of these norms."""
        return np.sqrt(np.maximum(norms + self.most - 2 * scores, 0))

    def scores(self, a, b) -> np.ndarray:
        return (a @ b.T).astype(np.int64)


def _by_node(batch: pa.RecordBatch):
    """(node, rows) of a batch."""
    nodes = batch.column("node").to_numpy(zero_copy_only=False)
    order = np.argsort(nodes, kind="stable")
    cuts = np.flatnonzero(np.diff(nodes[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(nodes[rows[0]]), rows


# --- the tree -------------------------------------------------------------------

def _sized(small: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``small`` as a broadcast side if its size allows."""
    return F.broadcast(small) if rows * row_bytes <= BROADCAST_BYTES else small


class Tree:
    """``leaves``: the rows with their leaf (node) and cell (block);
    ``levels``: of each level (node, points, norms, ranges) of its inner nodes
    and their number; ``wide``: leaves cut into more than one block."""

    def __init__(self, rows: DataFrame, space: Space, leaf_rows: int = LEAF_ROWS):
        self.space, self.leaf_rows = space, leaf_rows
        self.levels: list[tuple[DataFrame, int]] = []
        going, done, counts = rows.withColumn("node", F.lit(1).cast("long")), None, None
        for level in range(MOST_LEVELS):
            sizes = written(going.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "gnat-sizes")
            large = sizes.where(F.col("n") > leaf_rows)
            points = written(self._split_points(going, large.select("node")), "gnat-points")
            nodes = points.count()
            if not nodes:
                break
            row_bytes = FANOUT * (space.length * 4 + 8)
            own = _sized(points, nodes, row_bytes)
            if level:
                own_ids = _sized(points.select(F.col("node").alias("_node")), nodes, 8)
                settled = going.join(own_ids, F.col("node") == F.col("_node"), "left_anti")
                done = settled if done is None else done.unionByName(settled)
                counts = (sizes.join(own_ids, F.col("node") == F.col("_node"), "left_anti") if counts is None
                          else counts.unionByName(sizes.join(own_ids, F.col("node") == F.col("_node"), "left_anti")))
            placed = written(self._placed(going.join(own, "node")), "gnat-level")
            ranges = placed.groupBy("parent", "node").agg(
                *[F.array(*[f(F.col("away")[i]) for i in range(FANOUT)]).alias(name) for name, f in (("low", F.min), ("high", F.max))])
            inside = (ranges.groupBy("parent").agg(F.collect_list(F.struct(F.col("node").alias("child"), "low", "high")).alias("ranges"))
                      .withColumnRenamed("parent", "node"))          # FANOUT at most
            self.levels.append((written(points.join(inside, "node"), "gnat-nodes"), nodes))
            going = placed.drop("parent", "away")
        else:
            sizes = written(going.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "gnat-sizes")
        done = going if done is None else done.unionByName(going)
        counts = sizes if counts is None else counts.unionByName(sizes)
        self.wide = written(counts.where(F.col("n") > leaf_rows).select(
            F.col("node").alias("_node"), F.ceil(F.col("n") / leaf_rows).cast("int").alias("blocks")), "gnat-wide")
        cut = done.join(self.wide, F.col("node") == F.col("_node"), "left").drop("_node")
        block = F.pmod(F.xxhash64("vec_id", "label"), F.coalesce("blocks", F.lit(1))).cast("int")
        self.leaves = written(cut.withColumn("block", block).drop("blocks"), "gnat-leaves")

    def _split_points(self, rows: DataFrame, large: DataFrame) -> DataFrame:
        """(node, points, norms) of the nodes with two different rows or more
        among their candidates; split points are packed one after the other."""
        space = self.space
        w = W.partitionBy("node").orderBy(F.xxhash64("vec", "vec_id"), "vec_id", "label")
        few = (rows.join(large, "node").select("node", "vec", "norm", "vec_id", "label")
               .withColumn("k", F.row_number().over(w)).where(F.col("k") <= CANDIDATES))

        def choose(key, table):
            table = table.sort_by("k")
            x, norms = space.matrix(table.column("vec").to_pylist()), table.column("norm").to_numpy()
            away, chosen = np.full(len(norms), np.inf), [0]
            while len(chosen) < min(FANOUT, len(norms)):
                away = np.minimum(away, space.between(x, norms, x[chosen[-1:]], norms[chosen[-1:]])[:, 0])
                far = int(np.argmax(away))
                if away[far] <= space.slack:
                    break
                chosen.append(far)
            if len(chosen) < 2:
                chosen = []
            return pa.table({"node": pa.array([key[0].as_py()] if chosen else [], pa.int64()),
                             "points": pa.array([x[chosen].astype("<i4").tobytes()] if chosen else [], pa.binary()),
                             "norms": pa.array([norms[chosen].tolist()] if chosen else [], pa.list_(pa.float64()))})

        return few.groupBy("node").applyInArrow(choose, "node long, points binary, norms array<double>")

    def _placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the child they go to, and their distances from the
        split points of its parent."""
        space = self.space
        names = ["vec_id", "label", "vec", "norm", "candidate"]

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                child, away = np.empty(batch.num_rows, np.int64), np.full((batch.num_rows, FANOUT), np.nan)
                vecs, norms = batch.column("vec"), batch.column("norm").to_numpy(zero_copy_only=False)
                for node, own in _by_node(batch):
                    x = space.matrix(vecs.take(pa.array(own)).to_pylist())
                    at = int(own[0])
                    p, p_norms = _points(space, batch.column("points")[at].as_py(), batch.column("norms")[at].as_py())
                    d = space.between(x, norms[own], p, p_norms)
                    child[own] = node * FANOUT + np.argmin(d, axis=1)
                    away[own[:, None], np.arange(d.shape[1])] = d
                flat = pa.array(away.ravel(), from_pandas=True)      # no such split point: null
                offsets = pa.array(np.arange(0, batch.num_rows * FANOUT + 1, FANOUT, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), batch.column("node"), pa.array(child),
                                                  pa.ListArray.from_arrays(offsets, flat)], names=[*names, "parent", "node", "away"])

        return rows.mapInArrow(run, "vec_id long, label long, vec binary, norm double, candidate boolean, parent long, node long, away array<double>")

    def search(self, probes: DataFrame) -> DataFrame:
        """``probes`` (anchor, vec, norm, near, far and others: the annulus of
        distances) with each leaf that their annulus may meet."""
        space, kinds = self.space, probes.withColumn("node", F.lit(1).cast("long")).schema
        names = [f.name for f in kinds.fields]

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                rows, nodes = [], []
                vecs, norms = batch.column("vec"), batch.column("norm").to_numpy(zero_copy_only=False)
                near, far = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("near", "far"))
                for _, own in _by_node(batch):
                    at = int(own[0])
                    p, _ = _points(space, batch.column("points")[at].as_py(), batch.column("norms")[at].as_py())
                    away = space.of_scores(norms[own][:, None], (space.matrix(vecs.take(pa.array(own)).to_pylist()) @ p.T).astype(np.float64))
                    least = np.maximum(away - far[own][:, None], near[own][:, None] - away) - space.slack
                    most = away + far[own][:, None] + space.slack
                    for child in batch.column("ranges")[at].as_py():
                        low, high = (np.array(child[c][:len(p)], np.float64) for c in ("low", "high"))
                        meets = own[((high >= least) & (low <= most)).all(axis=1)]
                        rows.append(meets)
                        nodes.append(np.full(len(meets), child["child"], np.int64))
                at = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in names[:-1]),
                                                  pa.array(np.concatenate(nodes) if nodes else np.zeros(0, np.int64))], names=names)

        going, found = probes.withColumn("node", F.lit(1).cast("long")), None
        for info, nodes in self.levels:
            info = _sized(info.withColumnRenamed("node", "_node"), nodes, FANOUT * (self.space.length * 4 + 8 + 16 * FANOUT + 8))
            met = going.join(info, F.col("node") == F.col("_node"), "left")
            ended = met.where("_node is null").select(*names)
            found = ended if found is None else found.unionByName(ended)
            going = written(met.where("_node is not null").drop("_node").mapInArrow(run, kinds), "gnat-front")
        return going if found is None else found.unionByName(going)

    def compared(self, met: DataFrame, compare, schema: str) -> DataFrame:
        """``compare(anchors, rows)`` (Arrow tables) over the cells of leaves
        and the anchors that ``met`` sends there."""
        wide = met.join(self.wide, F.col("node") == F.col("_node"), "left").drop("_node")
        wide = written(wide.withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).drop("blocks"), "gnat-met")
        many = (wide.groupBy(F.col("node").alias("_node"), F.col("block").alias("_block")).agg(F.count(F.lit(1)).alias("n"))
                .select("_node", "_block", F.ceil(F.col("n") / self.leaf_rows).cast("int").alias("parts")))
        many = written(many, "gnat-parts")      # cells that some anchor comes to: the rows of others don't travel
        here = (F.col("node") == F.col("_node")) & (F.col("block") == F.col("_block"))
        anchors = wide.join(many, here).withColumn("part", F.pmod(F.xxhash64("anchor"), F.col("parts")).cast("int")).drop("_node", "_block", "parts")
        rows = (self.leaves.where("candidate").join(many, here)
                .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("_node", "_block", "parts"))
        cell = ["node", "block", "part"]
        return anchors.groupBy(*cell).cogroup(rows.groupBy(*cell)).applyInArrow(compare, schema)


def _points(space: Space, points: bytes, norms: list[float]):
    size = space.length * 4
    return space.matrix([points[i:i + size] for i in range(0, len(points), size)] if size else [b""] * len(norms)), np.array(norms, np.float64)


# --- mining -----------------------------------------------------------------------

def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by score, ties by smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        few = np.flatnonzero(scores >= cut)
    else:
        few = np.arange(len(scores))
    return few[np.lexsort((ids[few], -scores[few]))[:k]]


def _columns(table: pa.Table, *names):
    return [table.column(n).to_numpy() for n in names]


def _home_bounds(tree: Tree, every: int, k: int) -> DataFrame:
    """(anchor, label, vec, norm, bound): anchors and the k-th best score of their label in
    their own cell; null where it has fewer."""
    space = tree.space

    def best(key, table):
        ids, labels, norms, candidate = _columns(table, "vec_id", "label", "norm", "candidate")
        mine = np.flatnonzero(ids % every == 0)
        x = space.matrix(table.column("vec").to_pylist())
        bound: list = []
        for at in range(0, len(mine), 512):
            part = mine[at:at + 512]
            scores = space.scores(x[part], x)
            for i, s in zip(part, scores):
                own = s[(labels == labels[i]) & (ids != ids[i]) & candidate]
                bound.append(int(np.partition(own, len(own) - k)[len(own) - k]) if len(own) >= k else None)
        few = table.take(pa.array(mine))
        return pa.table({"anchor": few.column("vec_id"), "label": few.column("label"), "vec": few.column("vec"), "norm": few.column("norm"),
                         "bound": pa.array(bound, pa.int64())})

    return tree.leaves.groupBy("node", "block").applyInArrow(best, "anchor long, label long, vec binary, norm double, bound long")


def _annulus(probes: DataFrame, space: Space, low, high) -> DataFrame:
    """``probes`` with near and far, the distances of scores high and low (null: no bound)."""
    def away(score):
        return F.when(score.isNotNull(), F.sqrt(F.greatest(F.col("norm") + F.lit(space.most) - 2 * score, F.lit(0.0))))

    return probes.withColumns({"near": F.coalesce(away(high), F.lit(0.0)) if high is not None else F.lit(0.0),
                               "far": F.coalesce(away(low), F.lit(float("inf")))})


def positives_of(tree: Tree, anchors: DataFrame, k: int = POSITIVES) -> DataFrame:
    """(anchor, label, vec, norm, positive_id, positive_score): the first ``k`` other
    rows of the anchor's label."""
    space = tree.space
    schema = "anchor long, label long, vec binary, norm double, positive_id long, positive_score long"

    def compare(key, a, b):
        ids, labels = _columns(b, "vec_id", "label")
        own, own_labels = _columns(a, "anchor", "label")
        bounds = a.column("bound").to_pylist()
        x, q = space.matrix(b.column("vec").to_pylist()), space.matrix(a.column("vec").to_pylist())
        rows, at, scores = [], [], []
        for start in range(0, len(own), 512):
            for i, s in enumerate(space.scores(q[start:start + 512], x), start):
                fits = (labels == own_labels[i]) & (ids != own[i])
                if bounds[i] is not None:
                    fits &= s >= bounds[i]
                fits = np.flatnonzero(fits)
                best = fits[_first(s[fits], ids[fits], k)]
                rows += [i] * len(best)
                at += best.tolist()
                scores += s[best].tolist()
        few = a.take(pa.array(rows, pa.int64()))
        return pa.table({"anchor": few.column("anchor"), "label": few.column("label"), "vec": few.column("vec"), "norm": few.column("norm"),
                         "positive_id": pa.array(ids[np.array(at, np.int64)], pa.int64()), "positive_score": pa.array(scores, pa.int64())})

    met = tree.search(_annulus(anchors, space, F.col("bound"), None))
    found = tree.compared(met.select("anchor", "label", "vec", "bound", "norm", "node"), compare, schema)
    w = W.partitionBy("anchor", "label", "vec").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("k", F.row_number().over(w)).where(F.col("k") <= k).drop("k")


def negatives_of(tree: Tree, positives: DataFrame, k: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): the first ``k`` rows of other labels in each positive's window."""
    space = tree.space
    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"

    def compare(key, a, b):
        ids, labels = _columns(b, "vec_id", "label")
        own, own_labels = _columns(a, "anchor", "label")
        pairs = a.column("pairs").to_pylist()
        x, q = space.matrix(b.column("vec").to_pylist()), space.matrix(a.column("vec").to_pylist())
        out = []
        for start in range(0, len(own), 512):
            for i, s in enumerate(space.scores(q[start:start + 512], x), start):
                other = labels != own_labels[i]
                for pair in pairs[i]:
                    p = pair["positive_score"]
                    fits = np.flatnonzero(other & (s <= p) & (s >= p - p // 5))       # 80 * p <= 100 * s, exactly
                    best = fits[_first(s[fits], ids[fits], k)]
                    out += [(int(own[i]), pair["positive_id"], n, p, v) for n, v in zip(ids[best].tolist(), s[best].tolist())]
        columns = list(zip(*out)) or [()] * 5
        return pa.table({n.split()[0]: pa.array(c, pa.int64()) for n, c in zip(schema.split(", "), columns)})

    told = (positives.where("positive_score >= 0").groupBy("anchor", "label", "vec", "norm")
            .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("pairs"),       # POSITIVES at most
                 F.min(F.expr("positive_score - positive_score div 5")).alias("low"), F.max("positive_score").alias("high")))
    met = tree.search(_annulus(told, space, F.col("low"), F.col("high")))
    found = tree.compared(met.select("anchor", "label", "vec", "pairs", "node"), compare, schema)
    w = W.partitionBy("anchor_id", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, vector: str = "embedding", label: str = "label", id_col: str = "vec_id", anchors_every: int = 100,
         leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Hard negatives of the rows whose id ``anchors_every`` divides."""
    spark = rows.sparkSession
    usable = written(integer_rows(rows, vector, label, id_col), "gnat-rows")
    size = usable.agg(F.max("norm").alias("most"), F.max(F.length("vec")).alias("bytes")).first()
    if size["most"] is None:
        return spark.createDataFrame([], RESULT)
    space = Space(size["bytes"] // 4, size["most"])
    # Of equal vectors of a label the first others of anything are among the smallest ids.
    w = W.partitionBy("vec", "label").orderBy("vec_id")
    most = max(POSITIVES, NEGATIVES) + 1
    first = usable.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).drop("k").withColumn("candidate", F.lit(True))
    is_anchor = F.col("vec_id") % anchors_every == 0
    again = usable.where(is_anchor).withColumn("candidate", F.lit(False))
    tree = Tree(written(first.unionByName(again).repartition(partitions(spark)), "gnat-all"), space, leaf_rows)
    anchors = written(_home_bounds(tree, anchors_every, POSITIVES).where("anchor is not null"), "gnat-anchors")
    # An anchor stands in the tree twice where it is a candidate too.
    anchors = anchors.groupBy("anchor", "label", "vec", "norm").agg(F.max("bound").alias("bound"))
    positives = written(positives_of(tree, anchors), "gnat-positives")
    return negatives_of(tree, positives)


def relabelled(embeddings: DataFrame) -> DataFrame:
    """The rows of the query: where 7 divides vec_id the label becomes
    (label + 1) % 10."""
    wrong = F.col("vec_id") % 7 == 0
    return embeddings.select("vec_id", F.when(wrong, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")
