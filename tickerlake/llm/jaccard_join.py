"""Operator 10: exact n-gram Jaccard join, light and heavy sets apart.

A document is the set of its distinct word n-grams, each a 64-bit number.
Equal sets become one node first. Two sets of a Jaccard similarity of at least
``percent`` share all but a tenth (or so) of either, hence, in any common
order of n-grams, the first ``k`` that they share lie among the first
``n - ceil(percent * n / 100) + k`` of both. So

* light sets (up to ``boundary`` n-grams) enumerate all subsets of ``SUBSET``
  n-grams of that prefix and meet in any common subset;
* heavy sets enter the inverted lists of the prefix for ``k = 1`` and meet in
  any common list. Sets near the boundary do both.

The boundary minimises the rows written for subsets against the rows of lists
plus what scanning them adds, from the histogram of set sizes and the measured
sharing of n-grams. Frequent n-grams (the ``HOT`` most shared ones) come last
in the order, so lists of common passages stay out of most prefixes; any order
gives the same links.

A subset or list with several sets is a bucket; buckets with the same sets are
one. A large bucket is dealt to cells of pairs of blocks of ``BLOCK`` sets. A
cell compares its sets as matrices by an exact bound on the symmetric
difference (parities of 512 hashed bits), and what it passes on is verified
on whole sets. It does not pass on all pairs: first, within blocks, as many as
would connect what all its pairs would; then, over all cells, as many as would
connect the components found so far; last, every pair left that the bound
allows between different components. So every linked pair is either verified or
already connected through verified ones, and a large group of near copies costs
about one pair for each.

Sets and n-grams are told apart by 64-bit hashes: among N different sets some
two agree by chance with a probability of N * N / 2**65.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; with
fewer words than ``words`` the whole sequence is one n-gram; null, empty or
blank texts have no set, link with nothing and are their own component; ties
and repeated rows are one node; a null doc_id never names a component unless
it is all there is; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import connected_components, give_back, lower_ascii, mix64, process_cache, slices, small_batches, utf8, word_spans, written

WORDS = 5
PERCENT = 80
SUBSET = 2                # n-grams of an enumerated subset
HOT = 200_000             # most shared n-grams that come last in the order
HOT_SETS = 16             # sets an n-gram is shared by, at least, to be one of them
BLOCK = 512               # sets of a bucket compared at once, per side
WIDE, SMALL = 1 << 14, 512  # bits of a wide parity; sets up to this size have none
BROADCAST_IDS = 1_000_000  # ids broadcast at most; beyond, a shuffle join
SLICE = 1 << 19           # bytes of text made into n-grams at once
SEEN = 100_000            # sets that a task remembers; then it starts anew, and some come twice
_BASE = np.uint64(0x9E3779B97F4A7C55)


def _inverse(base: int) -> int:
    x = base
    for _ in range(6):
        x = x * (2 - base * x) % (1 << 64)
    return x


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, kept by the worker process."""
    cache = process_cache("powers")
    if len(cache.get("up", ())) < size:
        size = max(size, 2 * SLICE)
        for name, factor in (("up", _BASE), ("down", np.uint64(_inverse(int(_BASE))))):
            p = np.full(size, factor, np.uint64)
            p[0] = 1
            cache[name] = np.multiply.accumulate(p)
    return cache["up"], cache["down"]


def shingle_rows(column: pa.Array, words: int = WORDS):
    """The sorted distinct n-grams of each text, as 64-bit numbers."""
    data, offsets = utf8(column)
    data = lower_ascii(data)
    starts, ends, rows = word_spans(data, offsets)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    word = mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    edges = np.searchsorted(rows, np.arange(len(column) + 1))
    step = np.uint64(0xD1342543DE82EF95)
    gram = word.copy()
    for k in range(1, words):
        gram = mix64(gram * step)
        gram[:len(gram) - k or None] += word[k:] if k < len(word) else np.uint64(0)
    gram = mix64(gram)
    for i in range(len(column)):
        a, b = edges[i], edges[i + 1]
        if b - a >= words:
            yield np.unique(gram[a:b - words + 1])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                whole = mix64(whole * step + word[k:k + 1])
            yield whole
        else:
            yield word[:0]


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def prefix_length(n: int, percent: int, k: int) -> int:
    return min(n, n - -(-percent * n // 100) + k)


def fingerprint(grams: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = mix64(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(grams))
        return int(_signed(mix64(np.array([total], np.uint64)))[0])


def parity(grams: np.ndarray) -> list[int]:
    """512 bits; a set and another differ in at most as many bits as n-grams."""
    odd = np.bincount((grams >> np.uint64(7)).astype(np.int64) & 511, minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def wide_parity(grams: np.ndarray) -> bytes | None:
    """As ``parity``, in WIDE bits, for sets that 512 bits hardly tell apart."""
    if len(grams) <= SMALL:
        return None
    odd = np.bincount((grams >> np.uint64(20)).astype(np.int64) & (WIDE - 1), minlength=WIDE) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def signatures(grams: np.ndarray, hot: np.ndarray, rank: np.ndarray, percent: int, boundary: int) -> np.ndarray:
    """What a set meets others by. ``hot`` (sorted) and ``rank``: the frequent
    n-grams and their places at the end of the order."""
    n = len(grams)
    if -(-percent * n // 100) == n and -(-percent * (n + 1) // 100) == n + 1:
        return grams[:0]                   # similar to nothing but an equal set
    if len(hot):
        at = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
        last = np.where(hot[at] == grams, rank[at], 0)
        if last.any():
            grams = grams[np.argsort(last, kind="stable")]
    out = []
    if n * percent <= boundary * 100:
        first = grams[:prefix_length(n, percent, SUBSET)]
        i, j = np.triu_indices(len(first), 1)
        out.append(mix64(first[i] * np.uint64(0xD1342543DE82EF95) + mix64(first[j])))
    if n > boundary:
        out.append(mix64(grams[:prefix_length(n, percent, 1)] ^ np.uint64(0xA0761D6478BD642F)))
    return np.concatenate(out) if out else grams[:0]


def shared_grams(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(gram, sets): n-grams at the start of sets in hash order, those that
    several sets of a task share, with the number of sets."""
    def run(batches):
        give_back()
        seen, held, size = set(), [], 0

        def counted():
            grams, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n > 1
            return pa.RecordBatch.from_pydict({"gram": pa.array(_signed(grams[keep])), "sets": pa.array(n[keep].astype(np.int64))})

        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                for grams in shingle_rows(piece.column("text"), words):
                    if len(grams):
                        own = fingerprint(grams)
                        if own not in seen:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(own)
                            held.append(grams[:2 * prefix_length(len(grams), percent, SUBSET)])
                            size += len(held[-1])
                if size > 2_000_000:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return docs.select("text").mapInArrow(run, "gram long, sets long").groupBy("gram").agg(F.sum("sets").alias("sets"))


def choose_boundary(histogram: list[tuple[int, int]], sharing: float, percent: int) -> int:
    """The size up to which subsets cost less. ``histogram``: (size, sets);
    ``sharing``: the part of entries of inverted lists that others share; each
    of those meets a pivot, so it costs once more."""
    best, at = None, 0
    for bound in sorted({0, *range(8, 200, 4), *(int(200 * 1.3 ** k) for k in range(12))}):
        cost = 0.0
        for n, sets in histogram:
            p = prefix_length(n, percent, SUBSET)
            if n * percent <= bound * 100:
                cost += sets * p * (p - 1) / 2
            if n > bound:
                cost += sets * prefix_length(n, percent, 1) * (1 + sharing)
        if best is None or cost < best:
            best, at = cost, bound
    return at


def profile(docs: DataFrame, hot: np.ndarray, rank: np.ndarray, percent: int, words: int, boundary: int) -> DataFrame:
    """(doc_id, n, node, parity, sigs) of each document. ``sigs`` of a set
    that the task has met before are left out: equal sets share them."""
    def run(batches):
        give_back()
        seen = set()
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                n, node, bits, sigs = [], [], [], []
                for grams in shingle_rows(piece.column("text"), words):
                    n.append(len(grams))
                    node.append(fingerprint(grams) if len(grams) else None)
                    fresh = len(grams) > 0 and node[-1] not in seen
                    bits.append(parity(grams) if len(grams) else None)
                    if fresh:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(node[-1])
                    sigs.append(_signed(signatures(grams, hot, rank, percent, boundary)) if fresh else None)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column("doc_id"), "n": pa.array(n, pa.int64()), "node": pa.array(node, pa.int64()),
                    "parity": pa.array(bits, pa.list_(pa.int64())), "sigs": pa.array(sigs, pa.list_(pa.int64()))})

    return docs.mapInArrow(run, "doc_id long, n long, node long, parity array<long>, sigs array<long>")


def _verified(docs: DataFrame, pairs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link, from whole sets."""
    wanted = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
                     .join(reps.select("node", "doc_id"), "node"), "jaccard-wanted")
    few = wanted.count() <= BROADCAST_IDS
    ids = wanted.withColumnRenamed("node", "wanted")
    side = F.broadcast(ids) if few else ids
    texts = docs.join(side, docs["doc_id"].eqNullSafe(ids["doc_id"])).select("wanted", "text")

    def sets(batches):
        give_back()
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                grams = list(shingle_rows(piece.column("text"), words))
                right = [w == fingerprint(g) for w, g in zip(piece.column("wanted").to_pylist(), grams)]
                yield pa.RecordBatch.from_pydict({
                    "node": piece.column("wanted").filter(pa.array(right, pa.bool_())),
                    "wide": pa.array([wide_parity(g) for g, r in zip(grams, right) if r], pa.binary()),
                    "grams": pa.array([g.tobytes() for g, r in zip(grams, right) if r], pa.binary())})

    held = written(texts.mapInArrow(sets, "node long, wide binary, grams binary").groupBy("node").agg(
        F.first("wide").alias("wide"), F.first("grams").alias("grams")), "jaccard-sets")
    # Whole sets travel only for pairs that their wide parities leave open.
    slim = held.select("node", "wide", (F.length("grams") / 8).cast("long").alias("n"))
    rough = (pairs.select("a", "b").join(slim.toDF("a", "x", "n"), "a").join(slim.toDF("b", "y", "m"), "b")
             .select("a", "b", "n", "m", "x", "y"))

    def bound(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            most = n + m - 2 * -(-(n + m) * percent // (100 + percent))
            may = pa.array([x is None or y is None or int(np.bitwise_count(np.frombuffer(x, np.uint64) ^ np.frombuffer(y, np.uint64)).sum()) <= k
                            for x, y, k in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), most.tolist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(may), batch.column("b").filter(may)], names=["a", "b"])

    pairs = written(rough.mapInArrow(bound, "a long, b long"), "jaccard-open")
    both = (pairs.select("a", "b").join(held.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
            .join(held.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b"))

    def compare(batches):
        give_back()
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return both.mapInArrow(compare, "a long, b long")


def probable_links(size: np.ndarray, bits: np.ndarray, label: np.ndarray, percent: int) -> np.ndarray:
    """Pairs (a matrix) that may link: of different labels, and not ruled out
    by their sizes or by the bits in which their parities differ."""
    n, m = size[:, None], size[None, :]
    need = -(-(n + m) * percent // (100 + percent))
    fits = (label[:, None] != label[None, :]) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent)
    for at in range(0, len(size), 128):
        apart = np.bitwise_count(bits[at:at + 128, None, :] ^ bits[None, :, :]).sum(axis=2, dtype=np.int64)
        fits[at:at + 128] &= apart <= (n[at:at + 128] + m - 2 * need[at:at + 128])
    return fits


def spanning(linked: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of ``linked`` that connect its labels as all of its pairs do."""
    _, kind = np.unique(label, return_inverse=True)
    members = np.argsort(kind, kind="stable")
    starts = np.searchsorted(kind[members], np.arange(kind.max() + 2))
    own = [members[starts[k]:starts[k + 1]].tolist() for k in range(kind.max() + 1)]
    left, out = np.ones(len(label), bool), []
    for k in range(len(own)):
        if not left[own[k][0]]:
            continue
        left[own[k]] = False
        frontier = list(own[k])
        while frontier:
            u = frontier.pop()
            for v in np.flatnonzero(linked[u] & left).tolist():
                if left[v]:
                    out.append((u, v))
                    left[own[kind[v]]] = False
                    frontier += own[kind[v]]
    return out


def _meetings(cells: DataFrame, percent: int, every: bool) -> DataFrame:
    """(a, b): pairs to verify of each cell (sig, x, y) of ``cells``: all that
    may link, or as many as connect the cell's labels as all would."""
    def pairs_of(t):
        node, side = t.column("node").to_numpy(), t.column("side").to_numpy()
        bits = t.column("parity").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), 8)
        linked = probable_links(t.column("n").to_numpy(), bits, t.column("label").to_numpy(), percent)
        if side.any():
            linked &= side[:, None] != side[None, :]
        if not linked.any():
            return []
        found = zip(*np.nonzero(np.triu(linked))) if every else spanning(linked, t.column("label").to_numpy())
        return [(min(node[i], node[j]), max(node[i], node[j])) for i, j in found]

    def run(batches):
        """Rows come sorted by cell; a cell is at most two blocks."""
        give_back()
        held = None
        for batch in _then_none(batches):
            t = held if batch is None else pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if t is None or not t.num_rows:
                continue
            key = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("sig", "x", "y")], 1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            edges = [0, *cuts.tolist(), t.num_rows]
            if batch is not None:                # the last cell may go on
                held, edges = t.slice(edges[-2]), edges[:-1]
            t = t.combine_chunks()
            out = [p for i, j in zip(edges, edges[1:]) if j - i > 1 for p in pairs_of(t.slice(i, j - i))]
            yield pa.RecordBatch.from_pydict({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return (cells.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y")
            .mapInArrow(run, "a long, b long").distinct())


def _then_none(batches):
    yield from batches
    yield None


def links_between(docs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame | None:
    """(node, component) of all nodes that link with another; ``rows`` as
    ``profile`` gives them."""
    # A node's row: its first document id, size and parity bits.
    reps = written(rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("parity").alias("parity")), "jaccard-nodes")
    entries = rows.where("sigs is not null").select(F.explode("sigs").alias("sig"), "node")
    # A count for each key is all that is shuffled at first; copies that
    # several tasks have met are told apart from other sets below.
    several = entries.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sig")
    buckets = written(entries.join(several, "sig").distinct(), "jaccard-buckets")
    # Of buckets with the same sets, one will do.
    per = buckets.groupBy("sig").agg(F.count(F.lit(1)).alias("sets"), *[
        F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(38,0)")).alias(f"h{k}") for k in (1, 2)])
    kept = per.where("sets > 1").groupBy("sets", "h1", "h2").agg(F.min("sig").alias("sig")).select("sig", F.ceil(F.col("sets") / BLOCK).cast("int").alias("blocks"))
    members = written(buckets.join(kept, "sig").join(reps.select("node", "n", "parity"), "node"), "jaccard-members")
    links, labels = None, None
    for inside, every in ((True, False), (False, False), (False, True)):
        state = members.withColumn("label", F.col("node")) if labels is None else (
            members.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component"))
        if inside:
            cells = state.withColumns({"x": F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), "side": F.lit(0)}).withColumn("y", F.col("x"))
        else:
            state = written(state, "jaccard-state")
            open_ = state.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("sig")
            cells = (state.join(open_, "sig").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                     .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                     .withColumns({"x": F.least("mine", "other"), "y": F.greatest("mine", "other"), "side": (F.col("mine") > F.col("other")).cast("int")}))
        near = _meetings(cells.select("sig", "x", "y", "side", "node", "n", "parity", "label"), percent, every)
        if not every:                            # at first, one pair for each set; the last turn leaves none out
            near = near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        near = written(near, "jaccard-pairs")
        if near.isEmpty():
            if inside:
                continue
            break
        new = _verified(docs, near, reps, words, percent)
        links = written(new if links is None else links.union(new), "jaccard-links")
        labels = connected_components(links, "a", "b", "jaccard")
    return labels


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                      percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    with small_batches(docs.sparkSession, "4m"):
        return _similar_documents(docs, id_col, text_col, words, percent)


def _similar_documents(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    shared = written(shared_grams(docs, words, percent), "jaccard-shared")
    listed = shared.where(F.col("sets") >= HOT_SETS).orderBy(F.desc("sets"), "gram").limit(HOT).toArrow()
    hot = listed.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hot)
    hot, rank = hot[order], (len(hot) - order).astype(np.int64)      # the most shared come last of all
    size = F.length(F.coalesce("text", F.lit("")))
    # Sizes by thirds of octaves from the lengths of texts, some 6 characters a word.
    histogram = [(int(2 ** (r["k"] / 3)), r["n"]) for r in docs.select(F.floor(3 * F.log2(size / 6 + 1)).alias("k"))
                 .groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect() if r["k"]]
    entries = sum(sets * prefix_length(n, percent, 1) for n, sets in histogram) or 1
    met = shared.where(F.col("sets") < HOT_SETS).agg(F.sum("sets")).first()[0] or 0
    boundary = choose_boundary(histogram, min(1.0, met / entries), percent)
    rows = written(profile(docs, hot, rank, percent, words, boundary), "jaccard-rows")
    labels = links_between(docs, rows, words, percent)
    slim = rows.select("doc_id", F.col("n").alias("n_shingles"), "node")
    if labels is None:
        joined = slim.withColumn("label", F.col("node"))
    else:
        joined = slim.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    joined = written(joined, "jaccard-labels")
    names = joined.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("first"))
    return joined.join(names, "label", "left").select(
        F.col("doc_id").alias(id_col), "n_shingles",
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("component_id"))
