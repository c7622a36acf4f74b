"""Operator 11: cheapest repair of a conversation's structure, by Four-Russians
block tables.

The rows of a conversation, ordered by turn, are read as symbols: the role's
initial (s, u, a, or another), whether the text is truncated, or that the row
must go (blank, or a duplicate of an earlier row). A repair makes the role
initials fit ``(s?(ua)+)?``:

    K  keep a row           0
    R  make its role user or assistant  2
    D  delete it            3
    I  insert an empty user or assistant row  2

and a truncated row that is not deleted costs 1 more. The cost from a place on
is a vector over four states (nothing yet, after s, after u, after a). Its
entries differ by a few units at most, so there are only some dozen vectors
once their least entry is taken off; the transition of every vector over every
block of ``BLOCK`` symbols is computed once, and a conversation is processed
from its end by one lookup a block. The edits are then read from the front:
each block is expanded backward into the vectors between its symbols, and at
each step the ASCII-least edit that keeps the cost least is taken, so of all cheapest
repairs the one with the least string of initials comes out.

No conversation has to fit a task. Rows get their places by range partitions
and prefix sums; symbols are gathered in chunks of ``CHUNK`` rows; chunks of a longer
conversation are summed up by the transition of each vector over the whole
chunk, joined from the right (the vector at each chunk's end) and then from
the left (the state at each chunk's start), which streams one short row a
chunk. Texts move only to be put in order and to be joined with their edit.

Defined cases: a null role or text is one space; rows come by turn (nulls
first), then role, then the text's SHA-256; a null conv_id is a conversation
like any other; repeated rows are rows, the later ones duplicates; an empty
role or one of another initial is neither s, u nor a; no rows give no rows;
other columns do not matter.
"""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import extended, ordered_prefix_sums, written

BLOCK = 4                 # symbols looked up at once
CHUNK = 4_096             # rows of a conversation handled together

# Symbols: must go; s, u, a, other; the same, truncated.
SYMBOLS = "-suaxSUAX"
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)          # where a user or assistant row leads from each state
ROLE = {USER: "user", ASSISTANT: "assistant"}
END = (0, 4, 2, 0)                             # cost of finishing from each state
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
SPACE = "\\x20\\x09-\\x0D"


def _kept(symbol: str, state: int) -> int | None:
    """The state after keeping ``symbol``, None if it can't be kept."""
    initial = symbol.lower()
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    if initial in "ua" and ROLE[AFTER[state]][0] == initial:
        return AFTER[state]
    return None


def _choices(symbol: str, state: int):
    """(edit, cost, next state) of a row, apart from insertions before it."""
    yield "D", DELETE, state
    if symbol != "-":
        more = TRUNCATED if symbol.isupper() else 0
        to = _kept(symbol, state)
        if to is not None:
            yield "K", more, to
        yield "R", REROLE + more, AFTER[state]


def _before(symbol: str, after: tuple) -> tuple:
    """Costs from each state before ``symbol``, given those after it."""
    row = [min(cost + after[to] for _, cost, to in _choices(symbol, q)) for q in range(4)]
    pair = [min(row[q], INSERT + row[AFTER[q]]) for q in range(4)]          # one insertion
    return tuple(min(pair[q], INSERT + pair[AFTER[q]]) for q in range(4))   # or two


def _normal(costs: tuple) -> tuple[tuple, int]:
    least = min(costs)
    return tuple(c - least for c in costs), least


class Tables:
    """Normalised cost vectors, their transitions over a symbol and over every
    block of ``BLOCK`` symbols, and the edit to take at each place."""

    def __init__(self):
        self.vectors, numbers, todo = [END], {END: 0}, [END]
        step = {}
        while todo:
            v = todo.pop()
            for c in SYMBOLS:
                w, least = _normal(_before(c, v))
                if w not in numbers:
                    numbers[w] = len(self.vectors)
                    self.vectors.append(w)
                    todo.append(w)
                step[numbers[v], c] = numbers[w], least
        n, k = len(self.vectors), len(SYMBOLS)
        self.to = np.array([[step[v, c][0] for c in SYMBOLS] for v in range(n)], np.int32)
        self.cost = np.array([[step[v, c][1] for c in SYMBOLS] for v in range(n)], np.int32)
        blocks = np.array(list(product(range(k), repeat=BLOCK)), np.int32)      # block number = its digits
        to, cost = np.tile(np.arange(n, dtype=np.int32)[:, None], len(blocks)), np.zeros((n, len(blocks)), np.int32)
        for place in reversed(range(BLOCK)):
            cost += self.cost[to, blocks[:, place]]
            to = self.to[to, blocks[:, place]]
        self.block_to, self.block_cost = to, cost
        self.to_list, self.block_list = self.to.tolist(), to.tolist()
        self.edit = {(v, c, q): self._edit(v, SYMBOLS[c], q) for v in range(n) for c in range(k) for q in range(4)}

    def _edit(self, v: int, symbol: str, q: int) -> tuple[str, int, bool]:
        """(edit, next state, row consumed): the ASCII-least edit in state q before
        ``symbol`` on a cheapest way, with costs ``vectors[v]`` after it."""
        after = self.vectors[v]
        before = _before(symbol, after)
        ways = [(e, to, True) for e, cost, to in _choices(symbol, q) if cost + after[to] == before[q]]
        if INSERT + before[AFTER[q]] == before[q]:
            ways.append(("I", AFTER[q], False))
        return min(ways)


@cache
def tables() -> Tables:
    return Tables()


def digits(codes: str) -> np.ndarray:
    place = np.zeros(128, np.int32)
    place[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
    return place[np.frombuffer(codes.encode("ascii"), np.uint8)]


def boundaries(symbols: np.ndarray, end: int) -> list[int]:
    """Vectors at the block boundaries, from the last (``end``) to the first;
    blocks are counted from the end, what is left over goes symbol by symbol."""
    t, n = tables(), len(symbols)
    odd = n % BLOCK
    weights = len(SYMBOLS) ** np.arange(BLOCK - 1, -1, -1)
    numbers = (symbols[odd:].reshape(-1, BLOCK) @ weights).tolist()
    out, v = [end], end
    for b in reversed(numbers):
        v = t.block_list[v][b]
        out.append(v)
    for c in reversed(symbols[:odd].tolist()):
        v = t.to_list[v][c]
    if odd:
        out.append(v)
    return out


def over_chunk(codes: str) -> tuple[list[int], list[int]]:
    """(vector before, cost added) for each vector after the chunk."""
    t, symbols = tables(), digits(codes)
    odd = len(symbols) % BLOCK
    to, cost = np.arange(len(t.vectors)), np.zeros(len(t.vectors), np.int64)
    for b in reversed((symbols[odd:].reshape(-1, BLOCK) @ len(SYMBOLS) ** np.arange(BLOCK - 1, -1, -1)).tolist()):
        cost += t.block_cost[to, b]
        to = t.block_to[to, b]
    for c in reversed(symbols[:odd].tolist()):
        cost += t.cost[to, c]
        to = t.to[to, c]
    return to.tolist(), cost.tolist()


def trace(codes: str, end: int, start: int, last: bool) -> tuple[str, int]:
    """(edits, state after them): the ASCII-least cheapest edits of a chunk
    entered in state ``start`` with vector ``end`` behind it; ``last``: nothing
    comes after it, and the conversation is finished."""
    t, symbols = tables(), digits(codes)
    bounds = boundaries(symbols, end)[::-1]
    odd, q, edits = len(symbols) % BLOCK, start, []
    starts = ([0] if odd else []) + list(range(odd, len(symbols), BLOCK))
    for k, at in enumerate(starts):
        block = symbols[at:(odd if odd and at == 0 else at + BLOCK)].tolist()
        inner = [bounds[k + 1]]                 # backward through the block
        for c in reversed(block[1:]):
            inner.append(t.to_list[inner[-1]][c])
        for c, v in zip(block, reversed(inner)):
            consumed = False
            while not consumed:
                e, q, consumed = t.edit[v, c, q]
                edits.append(e)
    while last and q in (SYSTEM, USER):
        edits.append("I")
        q = AFTER[q]
    return "".join(edits), q


def cost_of(codes: str, edits: str) -> int:
    total, rows = 0, iter(codes)
    for e in edits:
        if e == "I":
            total += INSERT
        else:
            c = next(rows)
            total += {"D": DELETE, "K": 0, "R": REROLE}[e] + (TRUNCATED if e != "D" and c.isupper() else 0)
    return total


# --- rows, faults and symbols in Spark ----------------------------------------

def faulty_rows(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turn, role, text, place, rid, fault, symbol, initial): rows with
    their place in the conversation, first fault and symbol."""
    told = rows.select(F.col(f"`{conv}`").alias("conv"), F.col("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))
    told = told.withColumns({"late": F.col("turn").isNotNull(), "digest": F.sha2("text", 256), "one": F.lit(1).cast("long"),
                             "tie": F.monotonically_increasing_id()})       # equal rows may lie in several tasks
    placed = written(ordered_prefix_sums(told, ["conv"], ["late", "turn", "role", "digest", "tie"], "one", "repair-order")
                     .withColumnRenamed("start", "place").drop("late", "one", "tie"), "repair-rows")
    first = (placed.groupBy("conv", "role", "digest").agg(F.min_by("rid", "place").alias("rid")).select("rid")
             .withColumn("is_first", F.lit(True)))
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    duplicate = F.col("is_first").isNull()
    truncated = ~F.col("text").rlike(f"[.!?][{SPACE}]*\\z")
    fault = F.when(blank, "blank").when(duplicate, "duplicate").when(truncated, "truncated")
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(known))
              .otherwise(known))
    return (placed.join(first, "rid", "left").withColumn("fault", fault)
            .withColumns({"symbol": symbol, "initial": known}).drop("is_first", "digest"))


def chunks_of(faulty: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv, chunk, codes, initials, rids): each chunk's rows in order.
    ``initials`` has the row before the chunk in front, where there is one."""
    own = F.floor(F.col("place") / chunk)
    goes = F.when((F.col("place") + 1) % chunk == 0, F.array(own, own + 1)).otherwise(F.array(own))
    rows = faulty.select("conv", "place", "symbol", "initial", "rid", own.alias("own"), F.explode(goes).alias("chunk"))
    item = F.struct("place", (F.col("own") == F.col("chunk")).alias("here"), "symbol", "initial", "rid")
    told = rows.groupBy("conv", "chunk").agg(F.sort_array(F.collect_list(item)).alias("rows"))     # chunk + 1 at most
    here = F.filter("rows", lambda r: r.here)
    return told.select("conv", "chunk", F.array_join(F.transform(here, lambda r: r.symbol), "").alias("codes"),
                       F.array_join(F.transform("rows", lambda r: r.initial), "").alias("initials"),
                       F.transform(here, lambda r: r.rid).alias("rids")).where("codes <> ''")


def _streamed(df: DataFrame, descending: bool, schema, step):
    """``step(row, state)`` -> (out row, state) over the chunks of each
    conversation in order, one short row at a time."""
    order = F.desc("chunk") if descending else F.asc("chunk")

    def run(batches):
        now, state, seen = None, None, False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not seen or row["conv"] != now:
                    now, state, seen = row["conv"], None, True
                made, state = step(row, state)
                out.append(made)
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    return df.repartition("conv").sortWithinPartitions("conv", order).mapInArrow(run, schema)


def entries(chunks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``chunks`` with end (the vector behind the chunk), start (the state
    before it) and last. A conversation of one chunk needs no exchange."""
    from pyspark.sql import types as T

    whole = (F.col("chunk") == 0) & (F.length("codes") < chunk)
    short = chunks.where(whole).withColumns({"end": F.lit(0), "start": F.lit(EMPTY), "last": F.lit(True)})
    long = chunks.where(~whole)
    key = [f for f in chunks.schema.fields if f.name in ("conv", "chunk")]

    def schema(**more):
        return T.StructType([*key, *[T.StructField(n, k) for n, k in more.items()]])

    numbers = T.ArrayType(T.IntegerType())
    table = schema(to=numbers)

    def summed(batches):
        for batch in batches:
            to = [over_chunk(c)[0] for c in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("chunk"), pa.array(to, pa.list_(pa.int32()))],
                                             names=["conv", "chunk", "to"])

    def from_right(row, v):
        last = v is None
        v = 0 if last else v
        return {"conv": row["conv"], "chunk": row["chunk"], "end": v, "last": last}, row["to"][v]

    ends = written(_streamed(long.mapInArrow(summed, table), True, schema(end=T.IntegerType(), last=T.BooleanType()), from_right),
                   "repair-ends").withColumnsRenamed({"conv": "_conv", "chunk": "_chunk"})
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))
    ended = long.join(ends, same).drop("_conv", "_chunk")

    def walked(batches):
        for batch in batches:
            to = [[trace(c, v, q, last)[1] for q in range(4)] for c, v, last in
                  zip(*(batch.column(n).to_pylist() for n in ("codes", "end", "last")))]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("chunk"), pa.array(to, pa.list_(pa.int32()))],
                                             names=["conv", "chunk", "to"])

    def from_left(row, q):
        q = EMPTY if q is None else q
        return {"conv": row["conv"], "chunk": row["chunk"], "start": q}, row["to"][q]

    starts = written(_streamed(ended.mapInArrow(walked, table), False, schema(start=T.IntegerType()), from_left),
                     "repair-starts").withColumnsRenamed({"conv": "_conv", "chunk": "_chunk"})
    return short.unionByName(ended.join(starts, same).drop("_conv", "_chunk"))


def edited(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, codes, rids, start, edits, cost, illegal) of each chunk."""
    names = ["conv", "chunk", "codes", "rids", "start"]
    rows = chunks.select(*names, "initials", "end", "last")
    legal = {"su", "ua", "au"}

    def run(batches):
        for batch in batches:
            codes, *ways = (batch.column(c).to_pylist() for c in ("codes", "end", "start", "last"))
            edits = [trace(*r)[0] for r in zip(codes, *ways)]
            costs = [cost_of(c, e) for c, e in zip(codes, edits)]
            illegal = [sum(x + y not in legal for x, y in zip(r, r[1:])) for r in batch.column("initials").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(edits, pa.string()), pa.array(costs, pa.int64()),
                                              pa.array(illegal, pa.int64())], names=[*names, "edits", "cost", "illegal"])

    return rows.mapInArrow(run, extended(rows.select(*names).schema, edits="string", cost="long", illegal="long"))


def placed_edits(chunks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv, place, step, edit, new_role, rid): every row that stays or is put
    in; rows put in before a place have the lower steps."""
    names = ["conv", "place", "step", "edit", "new_role", "rid"]
    schema = extended(chunks.select("conv").schema, place="long", step="int", edit="string", new_role="string", rid="long")

    def run(batches):
        for batch in batches:
            out = []
            columns = (batch.column(n).to_pylist() for n in ("chunk", "codes", "rids", "start", "edits"))
            for k, (number, codes, rids, q, edits) in enumerate(zip(*columns)):
                at = step = 0
                for e in edits:
                    if e == "K":
                        q = _kept(codes[at], q)
                    elif e in "RI":
                        q = AFTER[q]
                    if e != "D":
                        out.append((k, number * chunk + at, step, e, ROLE[q] if e in "RI" else None, None if e == "I" else rids[at]))
                    step += 1
                    if e != "I":
                        at, step = at + 1, 0
            k, *rest = zip(*out) if out else [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("conv").take(pa.array(k, pa.int64())),
                                              *(pa.array(c, t) for c, t in zip(rest, kinds))], names=names)

    return chunks.select("conv", "chunk", "codes", "rids", "start", "edits").mapInArrow(run, schema)


def repair(rows: DataFrame, conv: str = "conv_id", chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(report, repaired). report: a row per conversation that has rows: conv,
    gaps, blank, duplicate, truncated, illegal, cost, audit. repaired: the rows
    of the repaired conversations, conv, place, step, edit, role, text; their
    order is (place, step)."""
    faulty = written(faulty_rows(rows, conv), "repair-faults")
    chunks = written(edited(entries(written(chunks_of(faulty, chunk), "repair-chunks"), chunk)), "repair-edits")
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = faulty.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
                                        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    strings = chunks.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "edits"))), lambda c: c.edits), "").alias("audit"))
    both = counts.unionByName(strings, allowMissingColumns=True)
    report = both.groupBy("conv").agg(*[F.max(c).alias(c) for c in both.columns if c != "conv"])
    edits = placed_edits(chunks, chunk)
    new = edits.where("rid is null").select("conv", "place", "step", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    kept = (edits.where("rid is not null").join(faulty.select("rid", "role", "text"), "rid")
            .select("conv", "place", "step", "edit", F.coalesce("new_role", "role").alias("role"), "text"))
    return report, kept.unionByName(new)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of the lines ``role:text``, joined by line feeds.
    A digest is sequential by nature, so a conversation streams through one
    task, in order; memory holds a batch."""
    schema = extended(repaired.select("conv").schema, repaired_sha256="string")

    def run(batches):
        now, state, held = None, None, None
        for batch in batches:
            out, keys = [], batch.column("conv")
            for i, (conv, role, text) in enumerate(zip(keys.to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist())):
                if state is None or conv != now:
                    if state is not None:
                        out.append((held, state.hexdigest()))
                    now, state, held = conv, hashlib.sha256(), keys.slice(i, 1)
                    state.update(f"{role}:{text}".encode())
                else:
                    state.update(f"\n{role}:{text}".encode())
            if out:
                yield _table(out)
        if state is not None:
            yield _table([(held, state.hexdigest())])

    def _table(out):
        return pa.RecordBatch.from_arrays([pa.concat_arrays([k for k, _ in out]), pa.array([d for _, d in out], pa.string())],
                                          names=["conv", "repaired_sha256"])

    return (repaired.select("conv", "place", "step", "role", "text").repartition("conv").sortWithinPartitions("conv", "place", "step")
            .mapInArrow(run, schema))


# --- the damaged conversations of the query -----------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20 (nulls: one space): 0 drops
    a row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets its
    role to user."""
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    h = F.crc32(F.concat_ws(":", *known)) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), h.alias("h")).where("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("h") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The damaged conversations repaired: a row for every conv_id of
    ``conversations``; one without rows left has zeros, an empty audit and
    the digest of an empty text."""
    report, repaired = repair(damaged(conversations))
    ids = conversations.select(F.col("conv_id").alias("conv")).distinct()
    parts = report.unionByName(digests(repaired), allowMissingColumns=True).unionByName(ids, allowMissingColumns=True)
    numbers = [F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return parts.groupBy(F.col("conv").alias("conv_id")).agg(
        *numbers, F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
