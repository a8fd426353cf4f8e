"""Conversation repair against a plain search over whole strings of edits."""

import hashlib
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from valuekit.llm import queries
from valuekit.llm.conversations import Editor, plan_repair, repaired_digests, repaired_rows
from valuekit.llm.turn_blocks import Tables

FOLDER = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def damaged(rows):
    """(conv_id, turn, role, text) after the planted faults."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of rows (turn, role, text) in order."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, flaws = set(), []
    for _, role, text in rows:
        bare = SPACE.sub("", text)
        flaws.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    def follow(before, name):
        """Repaired roles so far as a state, or None where ``name`` can't stand."""
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[before]
        return name[:1] if name[:1] and name[:1] in allowed else None

    @lru_cache(None)
    def best(at, before, inserted=0):
        ways = []
        if at == len(rows) and before in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 2:
            for name in ("user", "assistant"):
                if (to := follow(before, name)) is not None:
                    cost, audit, lines = best(at, to, inserted + 1)
                    ways.append((cost + 3, "I" + audit, (f"{name}:", *lines)))
        if at < len(rows):
            _, role, text = rows[at]
            cost, audit, lines = best(at + 1, before)
            ways.append((cost + 4, "D" + audit, lines))
            if flaws[at] not in ("blank", "duplicate"):
                extra = 3 * (flaws[at] == "truncated")
                for letter, price, name in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                    if (to := follow(before, name)) is not None:
                        cost, audit, lines = best(at + 1, to)
                        ways.append((cost + price + extra, letter + audit, (f"{name}:{text}", *lines)))
        return min(ways) if ways else (10**9, "", ())

    cost, audit, lines = best(0, "")
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, flaws.count("blank"), flaws.count("duplicate"), flaws.count("truncated"), illegal, cost, audit, digest, lines


def expected(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role, text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    return {conv: repair(sorted(group, key=order)) for conv, group in groups.items()}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_query_matches_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected(damaged(rows))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op13_conversation_repair"](spark, FOLDER).collect()}
    assert got == {conv: want[conv][:8] if conv in want else NOTHING for conv, *_ in rows}


TEXTS = ["Yes.", "No", " ", "", "What?", "a b", "Yes. \t", "end!\n", "ü", None]
SCHEMA = "conv_id long, turn long, role string, text string, slot string, node int, first double, kind int, flaw int, letters string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 0.5, 3, 1, "l") for r in rows], SCHEMA)


def odd_rows(count, seed):
    random = np.random.default_rng(seed)
    roles = ["system", "user", "assistant", "tool", None, "", "User", "aide"]
    pick = lambda values, p=None: values[random.choice(len(values), p=p)]
    likely = [0.1, 0.35, 0.35, 0.05, 0.05, 0.03, 0.03, 0.04]
    rows = [(pick([1, 2, 3, 4, 5, 6, 7, None, 2**60 + 1]), pick([None, *range(9)]), pick(roles, likely), pick(TEXTS)) for _ in range(count)]
    return rows + rows[: count // 10]


@pytest.mark.parametrize("count", [0, 1, 60, 600])
@pytest.mark.parametrize(("segment", "fan"), [(12, 10), (2, 1)])
def test_odd_rows_in_segments_of_any_size(spark, count, segment, fan):
    """Nulls, blanks, ties, repeats, large ids, clashing columns; small segments go through several levels of the scan."""
    rows = odd_rows(count, count)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = expected(plain)
    df = table(spark, rows)
    summary, letters = plan_repair(df, segment, fan)
    sums = {r.conv_id: tuple(r[c] for c in COLUMNS[:6]) for r in summary.collect()}
    texts = {r.conv_id: (r.audit, r.repaired_sha256) for r in repaired_digests(df, letters).collect()}
    assert {conv: sums[conv] + texts[conv] for conv in sums} == {conv: w[:8] for conv, w in want.items()} and set(texts) == set(sums)
    repaired = defaultdict(list)
    for r in sorted(repaired_rows(df, letters).collect(), key=lambda r: r.place):
        assert r.place == len(repaired[r.conv_id])
        repaired[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: tuple(x) for c, x in repaired.items()} == {conv: w[8] for conv, w in want.items() if w[8]}


def test_one_conversation_may_hold_most_rows(spark):
    """30,000 rows of one conversation, half of them one repeated row, beside small ones."""
    random = np.random.default_rng(1)
    rows = [(1, int(t), ["user", "assistant"][int(t) % 2], f"Text {t}.") for t in random.permutation(15_000)]
    rows += [(1, 20_000, "user", "Again.")] * 15_000 + [(k, 0, "user", "Hi.") for k in range(2, 50)]
    df = table(spark, rows)
    summary, letters = plan_repair(df, segment_bits=6, fan_bits=3)
    got = {r.conv_id: r for r in summary.collect()}
    assert (got[1].gaps, got[1].duplicate, got[1].illegal, got[1].cost) == (5000, 14_999, 14_999, 14_999 * 4 + 3) and got[7].cost == 3
    audit = {r.conv_id: r.audit for r in repaired_digests(df, letters).collect()}
    # Sorted by turn; of the last rows one stays, which one makes no difference to the texts but the first one is not a duplicate.
    assert audit[1] == "K" * 15_001 + "D" * 14_999 and audit[7] == "KI" or audit[1].count("D") == 14_999


@given(st.lists(st.integers(0, 8), max_size=14))
@settings(max_examples=300, deadline=None)
def test_blocks_agree_with_single_rows(symbols):
    names = ["system", "user", "assistant", "tool"]
    rows = [(k, names[s % 4] if s < 8 else "user", "" if s == 8 else f"{k}" if s >= 4 else f"{k}.") for k, s in enumerate(symbols)]
    *_, cost, audit, _, lines = repair(rows)
    for block in (1, 3, 4):
        tables = Tables(block)
        places, front, raised = tables.boundaries(np.array(symbols, np.int64), 0)
        letters, state = tables.trace(places, 0)
        editor = Editor()
        editor.learn(letters)
        done = [edit for _, role, text in rows for edit in editor.take(role, text)] + list(editor.close())
        assert raised + tables.vectors[front][0] == cost and "".join(e for e, _, _ in done) == audit
        assert tuple(f"{role}:{text}" for e, role, text in done if e != "D") == lines
        assert tables.backward(np.array(symbols, np.int64))[0] == front
