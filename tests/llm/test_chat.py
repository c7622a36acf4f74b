import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerlake.llm import chat
from tickerlake.llm.queries import op8_chat_format
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<<SYS>>\\", "\\", "[ROLE x]", "a\\[b", "", "]", "[/ROLE]", "é\u2028🙂\x00", "[ANS]"]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "to]ol", "\\", "[x"]),
                          st.text(alphabet="\\[]<>/sINST ab\n\u00e9") | st.sampled_from(NASTY)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_template_round_trip(turns):
    text = "".join(chat.format_turn(r, t)[0] for r, t in turns)
    assert [(r, t) for r, t, _, _ in chat.parse_window(text)] == turns


def digest(turns):
    """(n, turns hash, loss chars, loss hash) of (role, text) turns."""
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest())


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    windows = chat.chat_windows(df, **kw)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(windows).collect()}
    least = lambda x: (x is not None, x or 0 if not isinstance(x, str) else x)
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (least(r[1]), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or "")))
        want[conv] = digest([(r[2] or "", r[3] or "") for r in own])
    assert got == want
    return windows.collect()


def test_windows_hold_everything_once(spark):
    rows = [(1, 0, "system", "be kind " * 5)]
    rows += [(1, i, ("user", "assistant")[i % 2 == 0], f"w{i} " * (7 * i % 40)) for i in range(1, 60)]
    rows += [(2, i, "assistant", NASTY[i]) for i in range(len(NASTY))]
    rows += [(None, 0, None, None), (None, None, "user", "x"), (3, 0, "user", "a"), (3, 0, "user", "a"), (4, 1, "assistant", "long " * 5000)]
    windows = check(spark, rows, budget=100, history_tokens=30)
    one = [w for w in windows if w.conv_id == 1]
    assert len(one) > 5
    for w in one:
        turns = chat.parse_window(w.text)
        assert w.over_budget == (w.tokens > 100)
        assert len(turns) == w.repeated_turns + w.new_turns
        if w.window:
            assert turns[0][0] == "system"
        assert sum(chat.turn_tokens(r, t) for r, t, _, _ in turns) == w.tokens
        masked = {(x.start, x.end) for x in w.loss}
        for i, (role, _, a, b) in enumerate(turns):
            assert ((a, b) in masked) == (i >= w.repeated_turns and role == "assistant") or a == b
    assert any(w.repeated_turns > 1 for w in one) and not any(w.over_budget for w in one)
    assert [w.over_budget for w in windows if w.conv_id == 4] == [True]


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", 5, "z")], SCHEMA + ", window int, loss string")
    assert chat.read_back(chat.chat_windows(df)).count() == 1
    assert chat.read_back(chat.chat_windows(df.limit(0))).collect() == []


def test_query(spark):
    got = {r.conv_id: r for r in op8_chat_format(spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect()
    turns = {-7: [("user", NASTY[0]), ("assistant", NASTY[0])]}
    for r in rows:
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == {k: digest(v) for k, v in turns.items()}

# --- against a plain window cutter ---

def plain_windows(turns, budget, history, size):
    """(new turns, repeated turns) of one conversation by a walk over its (role, text) turns."""
    tokens = [chat.turn_tokens(r, t) for r, t in turns]
    starts = [sum(tokens[:i]) for i in range(len(turns))]
    lead = [0] if turns[0][0] == "system" else []
    out, i = [], 0
    while i < len(turns):
        first = lead if i else []
        room = budget - sum(tokens[k] for k in first)
        repeated = []
        for k in range(i - 1, -1 + len(first), -1):
            if sum(tokens[j] for j in repeated) + tokens[k] > history or sum(tokens[j] for j in repeated) + tokens[k] + tokens[i] > room:
                break
            repeated.insert(0, k)
        new = [i]
        while new[-1] + 1 < len(turns):
            k = new[-1] + 1
            if starts[k] // size != starts[i] // size or sum(tokens[j] for j in repeated + new) + tokens[k] > room:
                break
            new.append(k)
        out.append(([turns[k] for k in first + repeated], [turns[k] for k in new]))
        i = new[-1] + 1
    return out


def windows_of(rows):
    out = []
    for w in sorted(rows, key=lambda w: w.first_token):
        told = [(r, t) for r, t, _, _ in chat.parse_window(w.text)]
        out.append((told[:w.repeated_turns], told[w.repeated_turns:]))
    return out


def test_windows_equal_a_plain_cutter(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 2)                 # many blocks, also between short turns
    rng, rows, want = random.Random(5), [], {}
    for conv in range(30):
        turns = [(rng.choice(["user", "assistant", "system"]), "w " * rng.choice([0, 1, 3, 8, 20, 60, 400])) for _ in range(rng.randint(1, 60))]
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(turns)]
        want[conv] = plain_windows(turns, 50, 25, 100)
    windows = check(spark, rows, budget=50, history_tokens=25)
    assert {c: windows_of([w for w in windows if w.conv_id == c]) for c in want} == want
    assert max(w.block for w in windows) > 20


def test_a_hot_conversation_spreads_over_tasks(spark):
    rows = spark.range(40_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                      F.when(F.col("id") == 0, "system").when(F.col("id") % 2 == 1, "user").otherwise("assistant").alias("role"),
                                      F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"))
    parts = chat.blocks_of(rows, chat.BUDGET, chat.HISTORY).repartition(8, "conv_id", "block").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 3 and max(r["count"] for r in parts) < 30_000
    windows = chat.chat_windows(rows)
    assert windows.where("over_budget or not startswith(text, '<<SYS>>')").count() == 0
    [got] = chat.read_back(windows).collect()
    assert (got.n_turns, got.loss_chars) == (40_000, rows.where("role = 'assistant'").agg(F.sum(F.length("text"))).first()[0])
