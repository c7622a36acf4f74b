"""Operator 6: best-fit packing under conflicts.

Documents are cut at multiples of the bin's capacity; the pieces are dealt by
a hash to groups of about ``GROUP_PIECES`` pieces, so a hot source or a large
group of copies spreads over all groups, and each group is packed by a task of
its own. Longest pieces first, each goes to the bin with the least room that
still holds it (bins are kept by the room they have left, and the search goes
to the next larger room until a bin is compatible). A bin carries bitmaps of
the sources and duplicate clusters in it: no two pieces of one cluster, nor
two of one source where ``one_per_source``, share a bin.

Only sizes travel, no texts. Groups and their order hang on the rows alone, so
reruns agree.

Defined cases: a document without words has no piece; null sources are one
source; a null cluster conflicts with none; repeated rows are documents of
their own (and share their cluster); no rows give no bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import small_batches, written
from tickerlake.llm.mixing import with_word_count

CAPACITY = 2048           # words of a bin
GROUP_PIECES = 4096


class Bins:
    """Open bins of one group, by room left. Bins with the same room and the
    same sources stand together, so a source conflict is met once for all of
    them; only cluster conflicts are looked at bin by bin."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []                              # rooms some bin has, ascending
        self.at: dict[int, dict[int, list[int]]] = {}           # room -> source bitmap -> bins
        self.clusters: list[int] = []                           # bitmap of each bin

    def _put(self, room: int, sources: int, bin_no: int) -> None:
        if room == 0:
            return
        if room not in self.at:
            insort(self.rooms, room)
            self.at[room] = {}
        self.at[room].setdefault(sources, []).append(bin_no)

    def _take(self, room: int, sources: int, k: int) -> int:
        bins = self.at[room][sources]
        bin_no = bins.pop(k)
        if not bins:
            del self.at[room][sources]
            if not self.at[room]:
                del self.at[room]
                self.rooms.pop(bisect_left(self.rooms, room))
        return bin_no

    def place(self, size: int, source_bit: int, cluster_bit: int) -> int:
        """The bin for a piece; ``source_bit`` and ``cluster_bit`` are bitmaps
        of what must not be in it already (0: no conflict)."""
        for r in range(bisect_left(self.rooms, size), len(self.rooms)):
            room = self.rooms[r]
            best = None
            for sources, bins in self.at[room].items():
                if sources & source_bit:
                    continue
                for k, bin_no in enumerate(bins):
                    if not self.clusters[bin_no] & cluster_bit:
                        if best is None or bin_no < best[2]:
                            best = (sources, k, bin_no)
                        break
            if best:
                sources, k, bin_no = best
                self._take(room, sources, k)
                self.clusters[bin_no] |= cluster_bit
                self._put(room - size, sources | source_bit, bin_no)
                return bin_no
        bin_no = len(self.clusters)
        self.clusters.append(cluster_bit)
        self._put(self.capacity - size, source_bit, bin_no)
        return bin_no


def pack_group(sizes: list[int], sources: list, clusters: list, capacity: int, one_per_source: bool) -> list[int]:
    """The bin of each piece; pieces come longest first."""
    bins = Bins(capacity)
    source_bits: dict = {}
    cluster_bits: dict = {}
    repeated: dict = {}
    for c in clusters:
        repeated[c] = repeated.get(c, 0) + 1
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s = source_bits.setdefault(source, 1 << len(source_bits)) if one_per_source else 0
        c = 0
        if cluster is not None and repeated[cluster] > 1:        # a single piece conflicts with none
            c = cluster_bits.setdefault(cluster, 1 << len(cluster_bits))
        out.append(bins.place(size, s, c))
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
         one_per_source: bool = True) -> DataFrame:
    """``pieces``: rid (unique), size, source, cluster and other columns.
    Returns one row per piece of at most ``capacity``: all columns but size,
    with first, words (its span in the document), group_no and bin_no."""
    names = [c for c in pieces.columns if c != "size"]
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(capacity).cast("long")))
    cut = (pieces.where("size > 0").withColumn("first", start)
           .withColumn("words", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("first"))).drop("size"))
    total = cut.agg(F.count(F.lit(1))).first()[0]
    groups = max(1, -(-total // group_pieces))
    keyed = (cut.withColumn("group_no", F.pmod(F.xxhash64("rid", "first"), F.lit(groups)))
             .repartition(groups, "group_no").sortWithinPartitions("group_no", F.desc("words"), "rid", "first"))
    schema = keyed.select(*names, "first", "words", "group_no", F.lit(0).alias("bin_no").cast("long")).schema

    def run(batches):
        """Rows come sorted by group and hold sizes only: a group is some
        thousand short rows."""
        held: list[pa.RecordBatch] = []

        def packed():
            t = pa.Table.from_batches(held)
            bins = pack_group(*(t.column(c).to_pylist() for c in ("words", "source", "cluster")), capacity, one_per_source)
            t = t.select([*names, "first", "words", "group_no"]).append_column("bin_no", pa.array(bins, pa.int64()))
            return t.to_batches()

        for batch in batches:
            groups_here = batch.column("group_no").to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                end = at + int((groups_here[at:] == groups_here[at]).argmin()) if groups_here[-1] != groups_here[at] else batch.num_rows
                piece = batch.slice(at, end - at)
                if held and held[0].column("group_no")[0].as_py() != groups_here[at]:
                    yield from packed()
                    held.clear()
                held.append(piece)
                at = end
        if held:
            yield from packed()

    return keyed.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, source: str = "source", cluster=None, capacity: int = CAPACITY,
                   group_pieces: int = GROUP_PIECES, one_per_source: bool = True) -> DataFrame:
    """Pieces of ``docs`` (rid, doc_id, text, ...) in bins; rid is unique.
    ``cluster``: a column of duplicate clusters; by default equal texts."""
    same = F.when(F.length("text") > 0, F.xxhash64("text")) if cluster is None else cluster
    told = docs.select("rid", "doc_id", F.col(f"`{source}`").cast("string").alias("source"), same.alias("cluster"), "text")
    with small_batches(docs.sparkSession):
        sizes = written(with_word_count(told), "pack-sizes")
    return pack(sizes, capacity, group_pieces, one_per_source)
