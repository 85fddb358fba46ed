"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

from kinbridge.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = (2, 2, 3, 2)


def cheapest(rows, faults):
    """The cheapest and then ASCII-least edits, by a search ordered by cost and letters."""
    waiting, done = [(0, "", 0, 0)], set()
    while waiting:
        cost, audit, i, s = heapq.heappop(waiting)
        if i == len(rows) and s in (0, 3):
            return cost, audit
        if (i, s) in done:
            continue
        done.add((i, s))
        heapq.heappush(waiting, (cost + 2, audit + "I", i, NEXT[s]))
        if i == len(rows):
            continue
        heapq.heappush(waiting, (cost + 3, audit + "D", i + 1, s))
        if faults[i] in "bd":
            continue
        stays, initial = cost + (faults[i] == "t"), rows[i][1][:1]
        for fits, after in (
            (initial == "s" and s == 0, 1),
            (initial == "u" and s != 2, 2),
            (initial == "a" and s == 2, 3),
        ):
            if fits:
                heapq.heappush(waiting, (stays, audit + "K", i + 1, after))
        heapq.heappush(waiting, (stays + 2, audit + "R", i + 1, NEXT[s]))


def plain(table):
    def given(x):
        return " " if x is None else str(x)

    found = []
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            kind = zlib.crc32(f"{given(conv)}:{given(turn)}".encode()) % 20
            role, text = given(role), given(text)
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        rows.sort(
            key=lambda r: (
                r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()
            )
        )
        seen, faults = set(), ""
        for _, role, text in rows:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            again, cut = (role, text) in seen, visible and visible[-1] not in ".!?"
            faults += "b" if not visible else "d" if again else "t" if cut else "-"
            seen.add((role, text))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = cheapest(rows, faults)
        left, s, lines = iter(rows), 0, []
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[1:]
            if edit == "D":
                continue
            s = 1 if edit == "K" and role[:1] == "s" else NEXT[s]
            name = role if edit == "K" else "user" if s == 2 else "assistant"
            lines.append(f"{name}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(x) for x in "bdt"]
        found.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return set(found)


def damaged_table():
    rng = random.Random(2)
    texts = ["Hi.", "Yes!", "no", "", "  ", "ok? \t", "...", "é", "a\x1c", None, "long " * 4000 + "."]
    roles = ["user", "assistant", "system", "tool", "user", "assistant", None, "", "Ute"]
    table = []
    for conv in [*range(150), None]:
        for t in range(rng.choice([0, 1, 2, 3, 8, 30])):
            turn = rng.choice([t, t, t, t * 2, None])
            table.append((conv, turn, rng.choice(roles), rng.choice([*texts, f"Row {t}.", f"Row {t}"])))
    return table + table[:20]  # repeated rows


def test_repair_equals_search(spark):
    table = damaged_table()
    rows = spark.createDataFrame(table, SCHEMA).repartition(5)
    got = [tuple(r) for r in conversations.repaired(spark, rows).collect()]
    assert len(got) == len({r[0] for r in table})
    assert set(got) == plain(table)


def test_conversation_with_a_third_of_all_rows(spark):
    # Many rows of few symbols: long runs, one conversation over many batches.
    big = [(1, t, "user" if t % 700 < 650 else "assistant", f"Row {t}.") for t in range(6000)]
    table = big + [(2 + t // 6, t % 6, ("user", "assistant")[t % 2], f"Row {t}.") for t in range(12000)]
    rows = spark.createDataFrame(table, SCHEMA)
    got = {tuple(r) for r in conversations.repaired(spark, rows).collect()}
    assert got == plain(table)


def test_runs_of_any_length_and_their_powers():
    rng = random.Random(3)
    for _ in range(300):
        runs = []
        for _ in range(rng.randint(0, 6)):
            symbol = rng.choice(["s-", "u-", "a-", "x-", "st", "ut", "at", "xt", "xb"])
            if not runs or runs[-1][0] != symbol:
                runs.append((symbol, rng.randint(1, 9)))
        rows = [(0, s[0], "") for s, n in runs for _ in range(n)]
        faults = "".join(s[1] * n for s, n in runs)
        assert conversations.cheapest_edits(runs) == cheapest(rows, faults)


def test_a_run_costs_few_steps(monkeypatch):
    cost, audit = conversations.cheapest_edits([("u-", 1 << 17), ("xb", 5)])
    assert (cost, audit.count("D")) == (1 << 17 | 15, 5)
    steps = 0
    applied = conversations._applied

    def counted(matrix, after):
        nonlocal steps
        steps += 1
        return applied(matrix, after)

    monkeypatch.setattr(conversations, "_applied", counted)
    conversations.before_run("u-", 1 << 40, conversations.AT_END)
    assert steps == 1


def test_empty_table_dropped_conversations_and_clashing_columns(spark):
    assert conversations.repaired(spark, spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    kept = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 > 4)
    rows = [(gone, 0, "user", "Hi.", "x", 5), (kept, 0, "user", "Hi.", "y", 6)]
    frame = spark.createDataFrame(rows, f"{SCHEMA}, audit string, copy int")
    got = {r.conv_id: r for r in conversations.repaired(spark, frame).collect()}
    assert tuple(got[gone])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert (got[kept].cost, got[kept].audit) == (2, "KI")
    digest = hashlib.sha256(b"user:Hi.\nassistant:").hexdigest()
    assert got[kept].repaired_sha256 == digest
