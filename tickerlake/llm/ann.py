"""Operator 3: nearest neighbours by learned partitions.

A neighbour graph over a bounded sample of the distinct vectors is cut into parts of equal size with
few edges between them; a small classifier (one hidden layer) learns, from
each sample vector, the parts in which its neighbours lie. Every row is
indexed under its most probable part. A query is sent to its most probable
parts until their probabilities add up to a coverage, which is calibrated on
sample queries that were kept from the classifier, for ``TARGET_RECALL``, and
on to further parts until those visited hold ``k`` other rows. In the parts,
all rows are compared with the query in double precision.

Parts are dealt to cells of about ``CELL_ROWS`` rows and ``CELL_QUERIES``
queries by a hash, however large a part or how many copies it holds; a task
compares a cell's rows with a cell's queries as matrices and passes on each
query's best ``k``. No partner or candidate of a searched part is left out.

Defined cases: vectors that are null, zero, hold a null or non-finite
component take no part; vectors of each length are searched among themselves,
with parts of their own; with fewer candidates than ``k`` all are returned; equal scores come by the smaller id,
null ids last; repeated rows are candidates of their own; a query is a row, so
repeated query ids give their results repeatedly; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerlake.llm import vectors
from tickerlake.llm.common import written

SAMPLE = 8_192             # vectors the partition and the classifier are learned from, at most
PART_ROWS = 4_096          # rows of a part, about, as far as the sample can tell parts apart
LEAST_PER_PART = 64        # sample vectors a part needs
NEIGHBOURS = 20
TARGET_RECALL = 0.97
CELL_ROWS, CELL_QUERIES = 2_048, 512
RUN = 16                   # cells of rows that a cell of queries meets in one task
HIDDEN = 128


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row by inner product."""
    n, k = len(x), min(k, len(x) - 1)
    out = np.empty((n, k), np.int64)
    for at in range(0, n, 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng, sweeps: int = 12) -> np.ndarray:
    """Parts of nearly equal size with few graph edges between them: halves
    along the main direction of each half, then moves to the part with the
    most neighbours wherever there is room."""
    n = len(x)
    part = np.zeros(n, np.int64)
    stack, done = [(np.arange(n), parts)], 0
    while stack:
        rows, m = stack.pop()
        if m == 1 or len(rows) < 2:
            part[rows], done = done, done + 1
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        axis = rng.normal(size=x.shape[1])
        for _ in range(8):
            axis = centred.T @ (centred @ axis)
            axis /= np.linalg.norm(axis) + 1e-30
        order = rows[np.argsort(centred @ axis, kind="stable")]
        cut = len(order) * (m // 2) // m
        stack += [(order[:cut], m // 2), (order[cut:], m - m // 2)]
    room = np.full(parts, int(np.ceil(1.05 * n / parts)))
    sizes = np.bincount(part, minlength=parts)
    pairs = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()], 1),
                            np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])], 1)])
    order = np.argsort(pairs[:, 0], kind="stable")
    near, starts = pairs[order, 1], np.searchsorted(pairs[order, 0], np.arange(n + 1))
    for _ in range(sweeps):
        moved = 0
        for i in rng.permutation(n):
            votes = np.bincount(part[near[starts[i]:starts[i + 1]]], minlength=parts)
            votes_here = votes[part[i]]
            votes[sizes >= room] = -1
            to = int(votes.argmax())
            if votes[to] > votes_here:
                sizes[part[i]] -= 1
                sizes[to] += 1
                part[i], moved = to, moved + 1
        if moved < n // 200:
            break
    return part


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def route(model: dict, x: np.ndarray) -> np.ndarray:
    """The probability of each part for each row."""
    hidden = np.maximum((x * model["scale"]) @ model["w1"] + model["b1"], 0)
    return _softmax(hidden @ model["w2"] + model["b2"])


def train_router(x: np.ndarray, wanted: np.ndarray, rng, epochs: int = 40, rate: float = 3e-3) -> dict:
    """A classifier with one hidden layer for soft targets; Adam."""
    d, m = x.shape[1], wanted.shape[1]
    scale = 1 / (np.sqrt((x * x).sum(axis=1).mean() / d) + 1e-30)
    p = [rng.normal(size=(d, HIDDEN)) / np.sqrt(d), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, m)) / np.sqrt(HIDDEN), np.zeros(m)]
    mom, var, step = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at:at + 256]
            xb = x[rows] * scale
            h = np.maximum(xb @ p[0] + p[1], 0)
            err = (_softmax(h @ p[2] + p[3]) - wanted[rows]) / len(rows)
            back = (err @ p[2].T) * (h > 0)
            grads = [xb.T @ back + 1e-4 * p[0], back.sum(0), h.T @ err + 1e-4 * p[2], err.sum(0)]
            step += 1
            for i, g in enumerate(grads):
                mom[i] = 0.9 * mom[i] + 0.1 * g
                var[i] = 0.999 * var[i] + 0.001 * g * g
                p[i] -= rate * (1 - epoch / epochs) * mom[i] / (1 - 0.9 ** step) / (np.sqrt(var[i] / (1 - 0.999 ** step)) + 1e-8)
    return {"w1": p[0], "b1": p[1], "w2": p[2], "b2": p[3], "scale": scale}


def probed(prob: np.ndarray, coverage: float, rows: np.ndarray | None = None, least: int = 0) -> np.ndarray:
    """Which parts each query visits: the most probable ones until their sum
    reaches ``coverage`` (1 or more: all), and, given the ``rows`` of each
    part, until they hold at least ``least`` rows."""
    order = np.argsort(-prob, axis=1, kind="stable")
    sums = np.cumsum(np.take_along_axis(prob, order, 1), axis=1)
    wanted = np.concatenate([np.ones((len(prob), 1), bool), sums[:, :-1] < coverage], axis=1) if coverage < 1 else np.ones_like(prob, bool)
    if rows is not None:
        held = np.cumsum(rows[order], axis=1)
        wanted[:, 1:] |= held[:, :-1] < least
    out = np.zeros_like(wanted)
    np.put_along_axis(out, order, wanted, 1)
    return out


def learn(x: np.ndarray, parts: int, k: int, seed: int = 3) -> dict:
    """Partition, classifier and coverage from sample vectors ``x``."""
    rng = np.random.default_rng(seed)
    if parts < 2 or len(x) < 4 * LEAST_PER_PART:
        d = x.shape[1]
        return {"w1": np.zeros((d, 1)), "b1": np.zeros(1), "w2": np.zeros((1, 1)), "b2": np.zeros(1), "scale": 1.0, "coverage": 1.0}
    asked = np.zeros(len(x), bool)
    asked[rng.permutation(len(x))[:min(512, len(x) // 5)]] = True
    base = x[~asked]
    graph = neighbour_graph(base, NEIGHBOURS)
    part = balanced_parts(base, graph, parts, rng)
    wanted = np.zeros((len(base), parts))
    for j in range(graph.shape[1]):
        wanted[np.arange(len(base)), part[graph[:, j]]] += 1 / graph.shape[1]
    wanted = 0.7 * wanted + 0.3 * np.eye(parts)[part]
    model = train_router(base, wanted, rng)
    at = route(model, base).argmax(axis=1)
    scores = x[asked] @ base.T
    k = min(k, len(base))
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    prob = route(model, x[asked])
    model["coverage"] = 1.0
    for coverage in (0.3, 0.4, 0.5, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995, 0.999):
        seen = np.take_along_axis(probed(prob, coverage), at[best], 1)
        if seen.mean() >= TARGET_RECALL:
            model["coverage"] = coverage
            break
    return model


def _best(queries: np.ndarray, rows: np.ndarray, own: np.ndarray, rids: np.ndarray, ids: np.ndarray, k: int):
    """(query, row, score) of each query's best k rows, the query's own row
    excepted. Matrix products choose; scores are summed pair by pair, so they
    do not depend on where a row stands."""
    q, x = queries.astype(np.float64), rows.astype(np.float64)
    s = q @ x.T
    s[own[:, None] == rids[None, :]] = -np.inf
    n = min(k, s.shape[1])
    bound = -np.partition(-s, n - 1, axis=1)[:, n - 1]
    slack = 1e-12 * np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1).max())
    i, j = np.nonzero((s >= (bound - slack)[:, None]) & np.isfinite(s))
    exact = np.empty(len(i))
    for at in range(0, len(i), 65_536):
        exact[at:at + 65_536] = (q[i[at:at + 65_536]] * x[j[at:at + 65_536]]).sum(axis=1)
    keep = _leading(i, ids[j], exact, k)
    return i[keep], j[keep], exact[keep]


def _leading(i: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Where each query's first k stand: by score, ties by the smaller id."""
    order = np.lexsort((np.where(ids == vectors.NULL_ID, np.iinfo(np.int64).max, ids), -score, i))
    sorted_i = i[order]
    return order[np.arange(len(i)) - np.searchsorted(sorted_i, sorted_i) < k]


def _first_k(i: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    keep = _leading(i, ids, score, k)
    return i[keep], ids[keep], score[keep]


def index_sample(table: DataFrame, sample: int) -> list[bytes]:
    """About ``sample`` of the distinct vectors ``v``, by their hashes: copies
    count once, so that no group of copies crowds out the others."""
    share = F.pmod(F.xxhash64("v", F.lit("ann")), F.lit(1 << 20))
    different = table.select(F.xxhash64("v", F.lit("ann"))).distinct().count()
    some = table if different <= sample else table.where(share < (1 << 20) * sample // different)
    return (some.select("v").distinct().orderBy(F.xxhash64("v", F.lit("thin")), "v").limit(2 * sample)
            .toArrow().column("v").to_pylist())


def nearest(rows: DataFrame, k: int = 20, id_col: str = "vec_id", vector: str = "embedding", query=None,
            sample: int = SAMPLE, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row
    for which the condition ``query`` holds."""
    spark = rows.sparkSession
    v = F.col(f"`{vector}`")
    query = F.coalesce(F.col(f"`{id_col}`") % 20 == 0 if query is None else query, F.lit(False))
    given = rows.where(vectors.usable(v)).select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(vectors.NULL_ID)).alias("id"), query.alias("asks"), v.alias("v"))
    kind = vectors.kind_of(given, "v")
    given = given.withColumn("rid", F.monotonically_increasing_id()).withColumn("d", F.size("v"))
    result = "query_id long, rank int, vec_id long, score double"

    def pack(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("rid", "id", "asks", "d")), vectors.packed(b.column("v"), kind)], names=["rid", "id", "asks", "d", "v"])

    table = written(given.select("rid", "id", "asks", "d", "v").mapInArrow(pack, "rid long, id long, asks boolean, d int, v binary"), "ann-rows")
    totals = {r["d"]: r["count"] for r in table.groupBy("d").count().orderBy("d").collect()}     # a row per length
    if not totals:
        return spark.createDataFrame([], result)
    models, n_parts = {}, 0
    for length, total in totals.items():
        x = vectors.unpacked(index_sample(table.where(F.col("d") == length), sample), kind, length).astype(np.float64)
        parts = int(min(max(1, -(-total // part_rows)), max(1, len(x) // LEAST_PER_PART)))
        model = learn(x, parts, k)
        models[length] = (model, n_parts, n_parts + model["w2"].shape[1])
        n_parts = models[length][2]

    def routed(batch):
        """For each length of a batch: its rows, model, first and last part, and the probabilities of its parts."""
        for length, rows, x in vectors.by_length(batch.column("v").to_pylist(), kind):
            model, first, last = models[length]
            yield rows, model, first, last, route(model, x.astype(np.float64))

    def place(batches):
        for b in batches:
            part = np.empty(b.num_rows, np.int32)
            for rows, _, first, _, prob in routed(b):
                part[rows] = first + prob.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("rid", "id", "asks", "v")), pa.array(part)],
                                             names=["rid", "id", "asks", "v", "part"])

    placed = written(table.mapInArrow(place, "rid long, id long, asks boolean, v binary, part int"), "ann-placed")
    held = np.zeros(n_parts, np.int64)
    for r in placed.groupBy("part").count().collect():      # a row per part
        held[r["part"]] = r["count"]

    def visit(batches):
        for b in batches:
            visits = [None] * b.num_rows
            for rows, model, first, last, prob in routed(b):
                for i, own in zip(rows, probed(prob, model["coverage"], held[first:last], k + 1)):      # the query's own row is one of them
                    visits[i] = (first + np.flatnonzero(own)).tolist()
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("rid", "id", "v")), pa.array(visits, pa.list_(pa.int32()))],
                                             names=["rid", "id", "v", "visits"])

    asked = written(placed.where("asks").select("rid", "id", "v").mapInArrow(visit, "rid long, id long, v binary, visits array<int>"), "ann-asked")
    placed, asked = placed.select("rid", "id", "v", "part"), asked.select("rid", "id", "v", F.explode("visits").alias("part"))
    # Cells per part: a table of as many rows as parts.
    n_rows = placed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("row_cells"))
    n_asked = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).alias("query_cells"))
    cells = F.broadcast(n_rows.join(n_asked, "part"))
    salt = lambda n, word: F.pmod(F.xxhash64("rid", F.lit(word)), F.col(n)).cast("int")

    def bundled(df, word):
        """One row per cell: the bytes of its ids and vectors."""
        def run(keys, t):
            return pa.Table.from_pydict({
                "part": [keys[0].as_py()], "cell": [keys[1].as_py()], f"{word}_rids": [t.column("rid").to_numpy().astype("<i8").tobytes()],
                f"{word}_ids": [t.column("id").to_numpy().astype("<i8").tobytes()], f"{word}_v": [b"".join(t.column("v").to_pylist())]},
                schema=pa.schema([("part", pa.int32()), ("cell", pa.int32()), (f"{word}_rids", pa.binary()), (f"{word}_ids", pa.binary()), (f"{word}_v", pa.binary())]))

        return df.groupBy("part", "cell").applyInArrow(
            run, f"part int, cell int, {word}_rids binary, {word}_ids binary, {word}_v binary")

    row_cells = bundled(placed.join(cells, "part").select("rid", "id", "v", "part", salt("row_cells", "r").alias("cell")), "r")
    query_cells = bundled(asked.join(cells, "part").select("rid", "id", "v", "part", salt("query_cells", "q").alias("cell")), "q")
    # A task sees one cell of queries and up to RUN cells of rows, one by one.
    row_cells = (row_cells.join(cells, "part").withColumn("run", F.floor(F.col("cell") / RUN).cast("int"))
                 .withColumn("asked", F.explode(F.sequence(F.lit(0), F.col("query_cells").cast("int") - 1)))
                 .select("part", "asked", "run", "r_rids", "r_ids", "r_v"))
    query_cells = (query_cells.withColumnRenamed("cell", "asked").join(cells, "part")
                   .withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("row_cells") - 1) / RUN).cast("int"))))
                   .select("part", "asked", "run", "q_rids", "q_ids", "q_v"))

    def compare(left, right):
        ids = lambda x: np.frombuffer(x, "<i8")
        out = {"q": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows:
            (q_rids, q_ids, q_v), = (tuple(r[n] for n in ("q_rids", "q_ids", "q_v")) for r in left.to_pylist())
            q = np.frombuffer(q_v, kind).reshape(len(ids(q_rids)), -1)
            best = None
            for n in range(right.num_rows):
                r_rids, r_ids, r_v = (right.column(c)[n].as_py() for c in ("r_rids", "r_ids", "r_v"))
                i, j, score = _best(q, np.frombuffer(r_v, kind).reshape(-1, q.shape[1]), ids(q_rids), ids(r_rids), ids(r_ids), k)
                new = (i, ids(r_ids)[j], score)
                best = new if best is None else _first_k(*(np.concatenate(x) for x in zip(best, new)), k)
            if best is not None:
                i, near, score = best
                out = {"q": ids(q_rids)[i], "query_id": ids(q_ids)[i], "vec_id": near, "score": score}
        return pa.table({"q": pa.array(out["q"], pa.int64()), "query_id": pa.array(out["query_id"], pa.int64()),
                         "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    found = (query_cells.groupBy("part", "asked", "run").cogroup(row_cells.groupBy("part", "asked", "run"))
             .applyInArrow(compare, "q long, query_id long, vec_id long, score double")
             .withColumn("vec_id", F.when(F.col("vec_id") != vectors.NULL_ID, F.col("vec_id"))))
    order = W.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
