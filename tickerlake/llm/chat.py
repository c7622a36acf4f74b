"""Operator 8: conversations as budgeted, turn-aligned training windows.

Turns are marked ``[INST] user [/INST] assistant </s>`` with the system turn
as ``<<SYS>> system <</SYS>>``; any other role is a tag of its own. A control
string inside a text is escaped: every backslash is doubled and a backslash
is put before each ``[``, ``<`` that would open one, so texts come back exactly.

Every turn gets the prefix sum of its conversation's tokens by a range-partitioned
pass, so no task needs a whole conversation. A conversation is divided by these
sums into blocks of some ``BLOCK`` budgets, and each block is cut into windows
by looking its spans up in the sums: a window is a span of whole turns whose tokens fit
the budget, repeats the leading system turn and up to ``history_tokens`` of
whole turns before the span; repeated turns carry no loss. New assistant turns
carry loss, so every target counts once over all windows. A turn longer than
the budget gets a window of its own, whole. A block begins with a window of its own.

Blocks are dealt by (conversation, block), with the few turns before them that
may be history and a copy of the system turn: a conversation that holds most of all turns
spreads over many tasks, and memory holds one block. Only the digests of
``read_back`` are sequential, as a hash is; they stream.

Defined cases: null text or role is empty; rows of a conversation come by
(turn, role, text), nulls first; a null conv_id is a conversation like any
other; repeated rows are repeated turns; no rows give no windows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import ordered_prefix_sums

BUDGET = 512              # tokens (blank-separated words) of a window
HISTORY = 128             # of which repeated history may take so many
BLOCK = 64                # budgets of a block
WINDOW = ("conv_id long, block long, window int, first_token long, new_turns int, repeated_turns int, tokens long, "
          "over_budget boolean, text string, loss array<struct<start:long,end:long>>")

OPEN = {"system": "<<SYS>>", "user": "[INST]", "assistant": "[ANS]"}
CLOSE = {"system": "<</SYS>>", "user": "[/INST]", "assistant": "</s>"}
WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(WORD)
_ESCAPED = re.compile(r"\\(.)", re.S)
_SPECIAL = re.compile(r"[\\\[<]")
_TURN = re.compile(r"(<<SYS>>|\[INST\]|\[ANS\]|\[ROLE (?P<role>(?:[^\\\]\[<]|\\.)*)\])(?P<text>[^\\\[<]*(?:\\.[^\\\[<]*)*)"
                   r"(?:<</SYS>>|\[/INST\]|</s>|\[/ROLE\])", re.S)
_ROLE = {v: k for k, v in OPEN.items()}


def escape(text: str) -> str:
    """No ``[`` or ``<`` of a text stands unescaped, so none opens a mark."""
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The marked turn, and where its escaped text starts and ends."""
    opening = OPEN.get(role) or "[ROLE " + escape(role).replace("]", "\\]") + "]"
    body = escape(text)
    closing = CLOSE.get(role, "[/ROLE]")
    return opening + body + closing, len(opening), len(opening) + len(body)


def parse_window(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn of a formatted window."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"not a formatted window at {at}")
        role = _ROLE.get(m[1])
        if role is None:
            role = unescape(m["role"])
        out.append((role, unescape(m["text"]), m.start("text"), m.end("text")))
        at = m.end()
    return out


def turn_tokens(role: str, text: str) -> int:
    return len(_WORD.findall(text)) + 2          # two marks


def spans_of(sums: np.ndarray, past: int, leads: bool, system: int, budget: int, history: int) -> list[tuple[int, int, int]]:
    """The windows of a block as (first repeated turn, first new turn, end).

    ``sums``: the prefix sum before each turn and the one after the last; the
    first ``past`` turns are history only. ``leads``: turn 0 is the system
    turn itself; else ``system`` tokens of it go before every window."""
    out, i, last = [], past, len(sums) - 1
    while i < last:
        lead = int(sums[1] - sums[0]) if leads and i else system
        room = budget - lead
        oldest = max(sums[i] - history, sums[i + 1] - room)       # the history and turn i both fit
        h = max(min(int(np.searchsorted(sums, oldest)), i), 1 if leads and i else 0)
        end = max(i + 1, int(np.searchsorted(sums, sums[h] + room, side="right")) - 1)
        out.append((h, i, end))
        i = end
    return out


def format_window(lead: list, repeated: list, new: list) -> tuple[str, list[dict]]:
    """The text of a window and its loss spans: the assistant texts in ``new``."""
    text, loss, at = [], [], 0
    fresh = len(lead) + len(repeated)
    for k, (role, body) in enumerate(lead + repeated + new):
        s, a, b = format_turn(role, body)
        if k >= fresh and role == "assistant":
            loss.append({"start": at + a, "end": at + b})
        text.append(s)
        at += len(s)
    return "".join(text), loss


def blocks_of(conversations: DataFrame, budget: int, history: int) -> DataFrame:
    """(conv_id, block, kind, start, tokens, role, text): the turns of each
    block (kind 2), the turns before it that its history may take (kind 1), and the
    conversation's system turn (kind 0), which block 0 has among its own."""
    size = BLOCK * max(budget, history, 1)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("_t"), "turn",
        F.col("role").isNotNull().alias("_r"), "role", F.col("text").isNotNull().alias("_x"), "text",
        (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) + 2).cast("long").alias("tokens"))
    # The range is cut by the first characters of a text only: whole ones would be sampled to the driver.
    rows = rows.withColumn("_begin", F.substring("text", 1, 64))
    order = ["_t", "turn", "_r", "role", "_x", "_begin", "text"]
    turns = ordered_prefix_sums(rows, ["conv_id"], order, "tokens", "chat-turns", spread_by=order[:-1])
    turns = turns.select("conv_id", F.floor(F.col("start") / F.lit(size)).cast("long").alias("block"), F.lit(2).alias("kind"),
                         "start", "tokens", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    after = turns.where(F.col("start") >= (F.col("block") + 1) * size - history)
    after = after.withColumn("block", F.col("block") + 1).withColumn("kind", F.lit(1))
    ends = turns.groupBy(F.col("conv_id").alias("_conv")).agg(F.max("block").alias("_last")).where("_last > 0")
    leads = turns.where((F.col("start") == 0) & (F.col("role") == "system"))
    leads = (leads.join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")))
             .withColumn("block", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_last")))).withColumn("kind", F.lit(0)).drop("_conv", "_last"))
    return turns.union(after.select(*turns.columns)).union(leads.select(*turns.columns))


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY) -> DataFrame:
    """One row per window: (conv_id, first_token) orders and names them."""
    names = [x.split()[0] for x in WINDOW.split(", ")]
    kinds = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("window", pa.int32()), ("first_token", pa.int64()),
                       ("new_turns", pa.int32()), ("repeated_turns", pa.int32()), ("tokens", pa.int64()), ("over_budget", pa.bool_()),
                       ("text", pa.string()),
                       ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def windows(key, lead, turns, past):
        """Turns are (start, tokens, role, text); ``lead``: the system turn, if it is not among them."""
        sums = np.array([t[0] for t in turns] + [turns[-1][0] + turns[-1][1]], np.int64)
        leads = turns[0][0] == 0 and turns[0][2] == "system"
        for n, (h, i, end) in enumerate(spans_of(sums, past, leads, lead[1] if lead else 0, budget, history_tokens)):
            first = [lead] if lead else [turns[0]] if leads and i else []
            text, loss = format_window(*([t[2:] for t in part] for part in (first, turns[h:i], turns[i:end])))
            tokens = int(sums[end] - sums[h]) + sum(t[1] for t in first)
            yield (*key, n, int(sums[i]), end - i, len(first) + i - h, tokens, tokens > budget, text, loss)

    def run(batches):
        key, lead, turns, past = None, None, [], 0
        out, size = [], 0

        def table():
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=kinds)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "block", "kind", "start", "tokens", "role", "text"))
            for conv, block, kind, *turn in zip(*columns):
                if key != (conv, block):
                    if len(turns) > past:
                        out += windows(key, lead, turns, past)
                    key, lead, turns, past = (conv, block), None, [], 0
                if kind == 0:
                    lead = tuple(turn)
                else:
                    turns.append(tuple(turn))
                    past += kind == 1
                size += len(turn[-1])
                if size > 4 << 20 and out:
                    yield table()
                    out, size = [], 0
        if len(turns) > past:
            out += windows(key, lead, turns, past)
        if out:
            yield table()

    rows = blocks_of(conversations, budget, history_tokens)
    return (rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "kind", "start")
            .mapInArrow(run, WINDOW))


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the formatted windows alone: the turns and the
    text under the loss mask, as digests. A digest is sequential: a
    conversation's windows stream through one task, in order."""
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, n_windows long")

    def run(batches):
        conv, state, rows = None, None, []

        def done():
            rows.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]))

        for batch in batches:
            for w in batch.to_pylist():
                if state is None or w["conv_id"] != conv:
                    if state is not None:
                        done()
                    conv, state = w["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                masked = {(x["start"], x["end"]) for x in w["loss"]}
                for i, (role, text, start, end) in enumerate(parse_window(w["text"])):
                    if i >= w["repeated_turns"]:
                        state[0] += 1
                        state[1].update(f"{role}\n{text}\n".encode())
                    if (start, end) in masked:
                        under = unescape(w["text"][start:end])
                        state[2] += len(under)
                        state[3].update(under.encode())
                state[4] += len(w["text"])
                state[5] += 1
            if len(rows) > 5_000:
                yield pa.RecordBatch.from_pylist([dict(zip(cols, r)) for r in rows], schema=kinds)
                rows.clear()
        if state is not None:
            done()
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(cols, r)) for r in rows], schema=kinds)

    cols = [x.split()[0] for x in schema.split(", ")]
    kinds = pa.schema([(c, pa.string() if "sha" in c else pa.int64()) for c in cols])
    return windows.repartition("conv_id").sortWithinPartitions("conv_id", "first_token").mapInArrow(run, schema)
