"""Operator 2: mixing sources to target weights.

The words of each source are packed into blocks of a fixed number of words,
documents in a pseudorandom order. Targets follow the weights, but stop at a
multiple of the source's size; what is cut off goes to the others by weight.
The output is a number of shards of equal size. Each shard draws how many of
its slots go to each source: multinomial counts, drawn so that a source's
counts add up to its target over all shards (halving the shards again and
again, every half draws its share of the rest, which is the multinomial law
given the totals). A shard needs only the seeds on its way down, so shards
draw in parallel, and the counts of the halves passed by are the prefix sums
that number a source's slots. Slot ``j`` of a source takes block
``permutation(j mod blocks)`` of pass ``j div blocks``, so a block is taken at
most once a pass; slots and blocks meet in a join on (source, block).

No text moves here: a taken span names the row and its words. All draws hang
on ``seed`` and the rows alone, so reruns agree.

Defined cases: a null or blank text has no words, and nothing of it is
taken; a null source is a source, ordered last; repeated rows are documents of
their own; no words at all give no spans.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import extended, give_back, ordered_prefix_sums, partitions, slices, small_batches, utf8, word_spans, written

BLOCK_WORDS = 256
SHARD_BLOCKS = 64
COUNT_BYTES = 1 << 20      # text counted at once inside a task: its words' places take many times as much
MOST = 3                   # passes over a source, at most
WEIGHTS = (5, 2, 1)        # of the sources in order, repeating


def with_word_count(docs: DataFrame, text: str = "text", name: str = "size") -> DataFrame:
    """The columns of ``docs`` but the text, and the number of words
    ``[^\\x20\\x09-\\x0D]+`` of each whole text; no text comes back from the workers."""
    names = [c for c in docs.columns if c != text]
    schema = extended(docs.drop(text).schema, **{name: "long"})

    def run(batches):
        yield from counted(batches, names, text, name)
        give_back()

    return docs.select(*names, text).mapInArrow(run, schema)


def counted(batches, names: list[str], text: str, name: str):
    """The columns ``names`` of Arrow batches, and the number of words of each text."""
    for batch in batches:
        for piece in slices(batch, text, COUNT_BYTES):
            data, offsets = utf8(piece.column(text))
            _, _, rows = word_spans(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in names), pa.array(np.bincount(rows, minlength=piece.num_rows).astype(np.int64))],
                names=[*names, name])


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Shares of ``sum(sizes)`` by weight, none above ``most`` times its size;
    the excess is shared again by weight among the rest."""
    total, free, out = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    left = total
    while free:
        w = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w > most * sizes[i]] if w > 0 else list(free)
        if not over:
            for i in free:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = float(most * sizes[i]) if w > 0 else 0.0
            free.discard(i)
        left = total - sum(out[i] for i in range(len(sizes)) if i not in free)
    return out


def _rng(*seed: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(np.random.SeedSequence([s & 0xFFFFFFFFFFFFFFFF for s in seed])))


def _log_factorials(a: int, b: int) -> float:
    """log(a! / b!), without the cancellation of large terms."""
    if min(a, b) < 1_000:
        return math.lgamma(a + 1) - math.lgamma(b + 1)
    return (a + 0.5) * math.log1p((a - b) / b) + (a - b) * (math.log(b) - 1) + (1 / a - 1 / b) / 12


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, take: int) -> int:
    """How many of ``take`` slots out of ``good + bad`` are good, for totals of
    any size: Stadlober's ratio of uniforms, some two tries a draw."""
    total = good + bad
    if not good or not take:
        return 0
    if not bad or take == total:
        return min(good, take)
    few, many, m = min(good, bad), max(good, bad), min(take, total - take)
    share = few / total
    centre = m * share + 0.5
    width = math.sqrt(m * share * (1 - share) * (total - m) / (total - 1) + 0.5)
    spread = 1.7155277699214135 * width + 0.8989161620588988
    mode = (m + 1) * (few + 1) // (total + 2)
    end = min(min(m, few) + 1, math.floor(centre + 16 * width))
    while True:
        x, y = 1 - rng.random(), rng.random()
        w = centre + spread * (y - 0.5) / x
        if not 0 <= w < end:
            continue
        z = int(w)
        if z < m - many:
            continue
        t = -(_log_factorials(z, mode) + _log_factorials(few - z, few - mode) + _log_factorials(m - z, m - mode)
              + _log_factorials(many - m + z, many - m + mode))
        if 2 * math.log(x) <= t:
            break
    z = m - z if good > bad else z
    return good - z if m < take else z


def _draw(rng: np.random.Generator, left: np.ndarray, take: int) -> np.ndarray:
    """How ``take`` slots fall on sources with ``left`` slots to come."""
    total = int(left.sum())
    if total < 1_000_000_000:
        return rng.multivariate_hypergeometric(left, take)
    got = np.zeros_like(left)          # numpy ends there; the same law source by source
    for i, own in enumerate(left.tolist()):
        total -= own
        got[i] = _hypergeometric(rng, own, total, take)
        take -= int(got[i])
    return got


def shard_counts(shard: int, quotas: np.ndarray, shard_blocks: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots of each source before this shard, slots in it)."""
    left, before = quotas.copy(), np.zeros_like(quotas)
    lo, hi = 0, -(-int(quotas.sum()) // shard_blocks)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        first = _draw(_rng(seed, lo, hi), left, (mid - lo) * shard_blocks)
        if shard < mid:
            left, hi = first, mid
        else:
            left, before, lo = left - first, before + first, mid
    return before, left


def counts_between(first: int, last: int, quotas: np.ndarray, shard_blocks: int, seed: int):
    """``shard_counts`` of the shards first <= shard < last, in order; the
    draws that they have in common are made once."""
    todo = [(0, -(-int(quotas.sum()) // shard_blocks), quotas.copy(), np.zeros_like(quotas))]
    while todo:
        lo, hi, left, before = todo.pop()
        if hi <= first or lo >= last:
            continue
        if hi - lo == 1:
            yield lo, before, left
            continue
        mid = (lo + hi) // 2
        half = _draw(_rng(seed, lo, hi), left, (mid - lo) * shard_blocks)
        todo += [(mid, hi, left - half, before + half), (lo, mid, half, before)]


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 at ``index``: four Feistel
    rounds over the next even power of two, walked until inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = _rng(key).integers(0, 1 << 63, 4, dtype=np.uint64)

    def step(x):
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out = step(index.astype(np.uint64))
    while (outside := out >= size).any():
        out[outside] = step(out[outside])
    return out.astype(np.int64)


class Plan:
    """Sizes, targets and slots per source; a row per source."""

    def __init__(self, sizes: list[int], wanted: list[float], block: int, seed: int):
        self.sizes, self.wanted, self.block, self.seed = sizes, wanted, block, seed
        self.blocks = [-(-s // block) for s in sizes]
        self.quota, self.rest = [], []
        for s, (size, want, n) in enumerate(zip(sizes, wanted, self.blocks)):
            want = int(round(want))
            full, rest = divmod(want, size) if size else (0, 0)
            slots = full * n
            if rest:   # blocks of the last pass until the words suffice; the short last block may be among them
                tail, short = size - (n - 1) * block, self._place_of_last(s, full)
                m = -(-rest // block)
                if short < m and (m - 1) * block + tail < rest:
                    m += 1
                slots += m
            self.quota.append(slots)
            self.rest.append(rest)

    def key(self, source: int, turn: int) -> int:
        return (self.seed * 1_000_003 + source) * 1_000_003 + turn

    def _place_of_last(self, s: int, turn: int) -> int:
        """Where the short last block comes in a pass: by the inverse walk, in
        pieces, so memory stays small for any number of blocks."""
        n = self.blocks[s]
        if self.sizes[s] % self.block == 0:
            return n                       # no short block
        return self.inverse_of_last(s, turn)

    def inverse_of_last(self, s: int, turn: int) -> int:
        n, key = self.blocks[s], self.key(s, turn)
        half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        mask, keys = (1 << half) - 1, [int(k) for k in _rng(key).integers(0, 1 << 63, 4, dtype=np.uint64)]
        x = n - 1
        while True:
            left, right = x >> half, x & mask
            for k in reversed(keys):
                f = ((left + k) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
                f ^= f >> 29
                f = (f * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
                left, right = right ^ ((f >> 32) & mask), left
            x = (left << half) | right
            if x < n:
                return x

    def slots_of(self, before: np.ndarray, here: np.ndarray):
        """(source, slot, pass, block, words) of a shard's slots: ``here`` of each
        source, after the ``before`` of earlier shards."""
        for s in np.flatnonzero(here):
            j = np.arange(before[s], before[s] + here[s])
            n, block, size = self.blocks[s], self.block, self.sizes[s]
            turn, place = j // n, j % n
            taken = np.empty(len(j), np.int64)
            for t in np.unique(turn):
                own = turn == t
                taken[own] = permuted(place[own], n, self.key(int(s), int(t)))
            words = np.where(taken == n - 1, size - (n - 1) * block, block)
            last = turn == int(round(self.wanted[s])) // size
            if last.any():                 # the last pass ends with the target
                short = self._place_of_last(int(s), int(turn[last][0]))
                tail = size - (n - 1) * block
                done = place * block - np.where(place > short, block - tail, 0)
                words = np.where(last, np.clip(self.rest[s] - done, 0, words), words)
            yield np.full(len(j), s), j, turn, taken, words


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, most: float = MOST,
        block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = 20) -> tuple[DataFrame, DataFrame]:
    """(rows, spans). rows: rid, id_col, source, size, source_size and
    target of each document. spans: (shard, source_no, slot, turn, rid, first, last): the words
    first <= i < last of row rid that a slot takes."""
    spark = docs.sparkSession
    keep = [id_col, source]
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)],
                        F.col(f"`{source}`").alias("_source"), F.col(f"`{text}`").alias("_text"))
    told = inner.withColumn("_order", F.xxhash64("_text", F.lit(seed), *[F.col(f"c{i}") for i in range(len(keep))]))
    with small_batches(spark):                 # texts are read once; sizes and keys are what is dealt by ranges
        sized = written(with_word_count(told, "_text", "_size"), "mix-sizes")
    others = [f"c{i}" for i in range(len(keep))]
    rows = ordered_prefix_sums(sized, ["_source"], ["_order", *others], "_size", "mix-rows")
    # One row per source: the table that a mix is stated in.
    per = rows.groupBy("_source").agg(F.sum("_size").alias("n")).orderBy(F.asc_nulls_last("_source")).collect()
    sizes = [r["n"] for r in per]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(per))], most)
    plan = Plan(sizes, wanted, block_words, seed)
    listed = spark.createDataFrame([(i, r["_source"], r["n"], wanted[i]) for i, r in enumerate(per)],
                                   "source_no long, _name string, source_size long, target double")
    known = rows.join(F.broadcast(listed), F.col("_source").eqNullSafe(F.col("_name")), "left")
    out = known.select("rid", *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("_size").alias("size"),
                       "source_size", "target")
    total = sum(plan.quota)
    shards = -(-total // shard_blocks)

    def run(batches):
        for batch in batches:
            ids = batch.column("id").to_pylist()          # a run of shards
            for shard, before, here in counts_between(ids[0], ids[-1] + 1, np.array(plan.quota, np.int64), shard_blocks, seed) if ids else ():
                for s, j, turn, block, words in plan.slots_of(before, here):
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (
                        np.full(len(j), shard), s, j, turn, block, words)],
                        names=["shard", "source_no", "slot", "turn", "block", "words"])

    # A few thousand slots a task: the planned table is small beside the text.
    tasks = min(max(1, shards), max(partitions(spark), shards // 64))
    slots = spark.range(0, shards, 1, tasks).mapInArrow(
        run, "shard long, source_no long, slot long, turn long, block long, words long").where("words > 0")
    first = F.col("start")
    spread = known.where("_size > 0").select(
        "rid", "source_no", "start", "_size",
        F.explode(F.sequence(F.floor(first / block_words), F.floor((first + F.col("_size") - 1) / block_words))).alias("block"))
    at = F.col("block") * block_words
    # Both sides grow with the corpus: never a broadcast, whatever Spark makes of the range's size.
    met = slots.hint("merge").join(spread, ["source_no", "block"])
    begin, end = F.greatest(at, first), F.least(at + F.col("words"), first + F.col("_size"))
    spans = met.where(begin < end).select("shard", "source_no", "slot", "turn", "rid",
                                          (begin - first).alias("first"), (end - first).alias("last"))
    return out, spans


def taken_per_row(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """rows with ``taken``: the words that the mix takes, repeats counted."""
    sums = spans.groupBy("rid").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    return rows.join(sums, "rid", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
