import hashlib
import itertools
import re
import zlib

import numpy as np
from tests.llm.helpers import LONG

from tickerlake.llm import conversation_repair as R

ROWS = "conv_id long, turn long, role string, text string"


def cheapest(codes):
    """Least (cost, edits) by the plain recurrence over whole strings."""
    best = {R.EMPTY: (0, "")}

    def closed(best):
        for _ in range(2):
            for q, (c, e) in list(best.items()):
                to = R.AFTER[q]
                best[to] = min(best.get(to, (9e9, "")), (c + 2, e + "I"))
        return best

    # Costs first from the end, then the least string forward by trying all edits.
    n = len(codes)
    go = [[0.0] * 4 for _ in range(n + 1)]
    go[n] = [0, 4, 2, 0]
    for i in range(n - 1, -1, -1):
        row = [min(c + go[i + 1][to] for _, c, to in R._choices(codes[i], q)) for q in range(4)]
        for _ in range(3):
            row = [min(row[q], 2 + row[R.AFTER[q]]) for q in range(4)]
        go[i] = row
    out, i, q = "", 0, 0
    while i < n or q in (1, 2):
        ways = [("I", 2, R.AFTER[q], i)]
        if i < n:
            ways += [(e, c, to, i + 1) for e, c, to in R._choices(codes[i], q)]
        e, _, q2, i2 = min(w for w in ways if w[1] + go[w[3]][w[2]] == go[i][q])
        out, q, i = out + e, q2, i2
    return int(go[0][0]), out


def enumerated(codes, limit):
    """All repairs of cost up to ``limit``, found by trying every edit."""
    found, todo = [], [(0, 0, 0, "", "")]
    while todo:
        i, q, cost, edits, roles = todo.pop()
        if cost > limit:
            continue
        if i == len(codes) and q in (0, 3):
            assert re.fullmatch("(s?(ua)+)?", roles)
            found.append((cost, edits))
        todo.append((i, R.AFTER[q], cost + 2, edits + "I", roles + R.ROLE[R.AFTER[q]][0]))
        if i < len(codes):
            for e, c, to in R._choices(codes[i], q):
                todo.append((i + 1, to, cost + c, edits + e, roles + ("" if e == "D" else codes[i].lower() if e == "K" else R.ROLE[to][0])))
    return min(found)


def test_tables_are_small_and_finite():
    t = R.tables()
    assert len(t.vectors) < 100
    assert t.block_to.shape == (len(t.vectors), len(R.SYMBOLS) ** R.BLOCK)
    assert all(min(v) == 0 for v in t.vectors)


def test_cheapest_edits_against_all_edit_scripts():
    for n in range(4):
        for codes in itertools.product(R.SYMBOLS, repeat=n):
            codes = "".join(codes)
            edits, q = R.trace(codes, 0, R.EMPTY, True)
            assert q in (0, 3)
            assert (R.cost_of(codes, edits), edits) == cheapest(codes)
    rng = np.random.default_rng(3)
    for _ in range(60):
        codes = "".join(rng.choice(list(R.SYMBOLS), 5))
        edits, _ = R.trace(codes, 0, R.EMPTY, True)
        cost = R.cost_of(codes, edits)
        assert (cost, edits) == enumerated(codes, cost)


def test_long_strings_and_chunks_equal_the_plain_recurrence():
    rng = np.random.default_rng(5)
    for n in (7, 64, 301, 1000):
        codes = "".join(rng.choice(list(R.SYMBOLS), n, p=[.1, .1, .25, .25, .05, .05, .1, .05, .05]))
        cost, want = cheapest(codes)
        edits, _ = R.trace(codes, 0, R.EMPTY, True)
        assert (R.cost_of(codes, edits), edits) == (cost, want)
        cut = [codes[i:i + 50] for i in range(0, n, 50)]
        end, ends = 0, []
        for c in reversed(cut):
            ends.append(end)
            end = R.over_chunk(c)[0][end]
        q, out = R.EMPTY, ""
        for i, (c, v) in enumerate(zip(cut, reversed(ends))):
            e, q = R.trace(c, v, q, i == len(cut) - 1)
            out += e
        assert out == want


def plain_report(rows):
    """The contract's columns of one conversation's rows after damage, in order."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults, codes = set(), [], ""
    for _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        c = role[:1] if role[:1] and role[:1] in "sua" else "x"
        codes += "-" if fault in ("blank", "duplicate") else c.upper() if fault else c
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest(codes)
    lines, i, q = [], 0, 0
    for e in audit:
        if e in "RI":
            q = R.AFTER[q]
            lines.append(f"{R.ROLE[q]}:{rows[i][2] if e == 'R' else ''}")
        elif e == "K":
            q = R._kept(codes[i], q)
            lines.append(f"{rows[i][1]}:{rows[i][2]}")
        i += e != "I"
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(key.encode()) % 20
        out.setdefault(conv, [])
        if h == 1:
            text = ""
        elif h == 2:
            text = re.sub("[.!?]", "", text)
        elif h == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    for rows in out.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    return out


def reported(df):
    return {r[0]: tuple(r[1:]) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                                   "repaired_sha256").collect()}


def random_rows(seed, convs, turns):
    rng = np.random.default_rng(seed)
    texts = ["Hi.", "Hi", "What? ", " ", "", "So \t\n", "a.b", "x!", None, "ünï.", " ", "Hi. "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u"]
    return [(c if c else None, None if rng.random() < .1 else int(rng.integers(-2, turns)), roles[rng.integers(len(roles))],
             texts[rng.integers(len(texts))] if rng.random() < .4 else f"text {rng.integers(99)}.")
            for c in range(convs) for _ in range(int(rng.integers(0, turns)))]


def test_query_equals_plain_code_on_edge_rows(spark):
    rows = random_rows(1, 60, 14) + [(900, 0, "user", LONG), (900, 1, "assistant", LONG + "."), (901, None, "user", "a."), (901, None, "user", "a.")]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 as place", "'x' as conv", "2 as rid", "'y' as chunk")
    got = reported(R.repair_report(df))
    want = {c: plain_report(r) for c, r in plain_damage(rows).items()}
    assert got == want


def test_small_chunks_join_into_the_same_repair(spark):
    rows = random_rows(2, 3, 90) + [(7, i, "user" if i % 3 else "assistant", f"t{i % 40}.") for i in range(64)]
    df = spark.createDataFrame(rows, ROWS)
    damaged = R.damaged(df)
    report, repaired = R.repair(damaged, chunk=16)
    want = {c: plain_report(r) for c, r in plain_damage(rows).items() if r}
    got = {r["conv"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")) for r in report.collect()}
    assert got == {c: w[:-1] for c, w in want.items()}
    sha = {r["conv"]: r["repaired_sha256"] for r in R.digests(repaired).collect()}
    assert all(sha.get(c, hashlib.sha256(b"").hexdigest()) == w[-1] for c, w in want.items())


def test_conversation_without_rows_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], ROWS)
    assert reported(R.repair_report(df)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert R.repair_report(df.limit(0)).count() == 0


def test_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert reported(R.repair_report(df)) == {c: plain_report(r) for c, r in plain_damage(rows).items()}
