"""Conversation repair against a plain search over all edits, on small frames and on the whole smallest table."""

import hashlib
import os
import random
import zlib

import pytest

from readloom.llm import queries, turns

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
BLANKS = set(" \t\n\v\f\r")
# states: nothing yet, after s, after u, after a
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        part = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if part == 1:
            text = ""
        if part == 2:
            text = "".join(c for c in text if c not in ".!?")
        if part == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(part, 1)
    return out


def repair(rows):
    """Cheapest edits of ``(role, text, must_go, truncated)`` rows by least (cost, audit) from the end, state by state."""
    def closed(best):
        for _ in range(3):
            for state, following in NEXT.items():
                for initial, to in following.items():
                    if initial != "s":
                        cost, audit, made = best[to]
                        best[state] = min(best[state], (cost + 5, "I" + audit, (("user" if initial == "u" else "assistant", ""), made)), key=lambda x: x[:2])
        return best

    never = (10 ** 9, "", None)
    best = closed({0: (0, "", None), 1: never, 2: never, 3: (0, "", None)})
    for role, text, must, cut in reversed(rows):
        new = {}
        for state, following in NEXT.items():
            cost, audit, made = best[state]
            options = [(cost + 2, "D" + audit, made)]
            if not must:
                if role[:1] in following:
                    cost, audit, made = best[following[role[:1]]]
                    options.append((cost + 5 * cut, "K" + audit, ((role, text), made)))
                for name in ("user", "assistant"):
                    if name[0] in following:
                        cost, audit, made = best[following[name[0]]]
                        options.append((cost + 1 + 5 * cut, "R" + audit, ((name, text), made)))
            new[state] = min(options, key=lambda x: x[:2])
        best = closed(new)
    cost, audit, made = best[0]
    lines = []
    while made:
        (role, text), made = made
        lines.append(f"{role}:{text}")
    return cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def brute(rows, damaged=None):
    damaged = damage(rows) if damaged is None else damaged
    out = []
    for conv in dict.fromkeys(r[0] for r in rows):
        mine = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, judged, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in mine:
            plain = [c for c in text if c not in BLANKS]
            fault = "blank" if not plain else "duplicate" if (role, text) in seen else "truncated" if plain[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out.append((conv, gaps, *faults.values(), illegal, *repair(judged)))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, block string, row_no int, m int")


def got(spark, rows, damaged=None, **sizes):
    df = frame(spark, rows)
    given = turns.damaged(df) if damaged is None else frame(spark, damaged)
    return sorted((tuple(r) for r in turns.audit_table(given, df.select("conv_id").distinct(), **sizes).select(COLUMNS).collect()), key=repr)


def conversation(r, conv, n):
    roles = ["user", "assistant", "system", "u", "a", "tool", "", "sage", "agent"]
    texts = ["Fine.", "Why?", "and so", "", " \n", "No!", "x ", "y.\u0085", "né. "]
    return [(conv, r.choice([None, *range(n)]), r.choice(roles[:r.choice([2, 9])]), r.choice([None, *texts, *(f"{k}." for k in range(9))])) for _ in range(n)]


@pytest.mark.parametrize("block_rows", [1, 3, 1024])
def test_repair_by_brute_force(spark, block_rows):
    r = random.Random(block_rows)
    rows = [row for conv in range(150) for row in conversation(r, None if conv == 7 else conv, r.choice([1, 2, 3, 5, 8, 13]))]
    assert got(spark, rows, block_rows=block_rows, ranges=5) == brute(rows)


def test_undamaged_rows_and_ids_without_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "user", "Hi."), (3, 5, "assistant", "Well."), (4, 0, "system", "Be."), (4, 1, "user", "A?")]
    kept = [r for r in rows if r[0] != 2]
    assert got(spark, rows, kept) == brute(rows, kept)
    found = {r[0]: r for r in got(spark, rows, kept)}
    assert found[1][6:8] == (0, "KK")
    assert found[2][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[3][6:8] == (2, "D")  # a lone answer goes
    assert found[4][6:8] == (2, "RR")  # cheaper than two deletions or an added answer


def test_one_long_conversation_over_many_blocks_and_ranges(spark):
    r = random.Random(3)
    rows = [(9, t, r.choice(["user", "assistant", "system"]), r.choice(["Same.", f"{t}.", "cut", ""])) for t in range(4000)]
    rows += [(k, 0, "user", "A.") for k in range(8)]
    want = brute(rows)
    assert got(spark, rows, block_rows=64, ranges=16) == want
    assert got(spark, rows) == want


def test_equal_rows_long_texts_and_no_rows(spark):
    rows = [(1, 0, "user", "a" * 3_000_000 + ".")] * 3 + [(None, None, None, None)] * 4 + [(2, 2 ** 62, "user", "x."), (2, -2 ** 62, "assistant", "y.")]
    assert got(spark, rows, damage(rows)) == brute(rows)
    ends = turns.audit_table(frame(spark, [(1, 2 ** 63 - 1, "user", "x."), (1, -2 ** 63, "user", "y.")]), frame(spark, [(1, 0, "", "")]).select("conv_id")).first()
    assert ends.gaps is None
    assert got(spark, []) == []


def test_repaired_rows_and_edits(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C."), (1, 3, "assistant", "C."), (2, 0, "assistant", "D.")]
    repair_ = turns.Repair(frame(spark, rows), block_rows=2)
    made = repair_.repaired().orderBy("conv_id", "block", "step").collect()
    assert [(r.conv_id, r.role, r.text) for r in made] == [(1, "user", "B."), (1, "assistant", "C.")]
    assert "".join(r.letter for r in repair_.edits().where("conv_id = 1").orderBy("block", "step").collect()) == "DKKD"


def test_query_on_the_whole_table(spark):
    raw = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.QUERIES["op11_turns"](spark, SF)
    assert sorted((tuple(r) for r in found.select(COLUMNS).collect()), key=repr) == brute(raw)
    kinds = dict(found.dtypes)
    assert {kinds[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} == {"bigint"}
