"""Conversation repair against a plain programme over audits."""
import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from keelson.llm import queries, turn_repair

SPACES = " \t\n\x0b\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation's rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        whole = text.rstrip(SPACES)
        faults.append("blank" if not whole else "duplicate" if (role, text) in seen else
                      "truncated" if whole[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    names = {2: "user", 3: "assistant"}

    @lru_cache(None)
    def best(i, state, inserts=0):
        options = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        if inserts < 2:
            to = 3 if state == 2 else 2
            c, a, o = best(i, to, inserts + 1)
            options.append((c + 2, "I" + a, (names[to] + ":", *o)))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, o = best(i + 1, state)
            options.append((c + 3, "D" + a, o))
            if faults[i] not in ("blank", "duplicate"):
                cut = int(faults[i] == "truncated")
                to = follows[state].get(role[:1])
                if to:
                    c, a, o = best(i + 1, to)
                    options.append((c + cut, "K" + a, (role + ":" + text, *o)))
                to = 3 if state == 2 else 2
                c, a, o = best(i + 1, to)
                options.append((c + 2 + cut, "R" + a, (names[to] + ":" + text, *o)))
        return min(options, default=(10**9, "", ()))

    for i in range(len(rows), 0, -1):  # keeps the recursion shallow
        for state in follows:
            best(i, state)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
    cost, audit, out = best(0, 0)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def conversations(seed, count, longest):
    rnd = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(rnd.randint(1, longest)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "Upper"])
            text = rnd.choice(["Yes.", "No!", "cut off", " ", "", "Why? \n", "\x0b", f"text {turn}.", f"{conv} {turn}"])
            rows.append((conv, turn * rnd.choice([1, 1, 2]) + conv % 3, role, text))
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def report(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def in_order(spark, rows):
    """Rows of each conversation as the operator orders them."""
    work = turn_repair.Repair(spark.createDataFrame(rows, SCHEMA))
    out = {}
    for r in work.rows.orderBy("pos").collect():
        out.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    work.drop()
    return out


@pytest.mark.parametrize("chunk_rows", [2, 7, 4096])
def test_repairs_equal_a_plain_programme(llm, chunk_rows):
    rows = conversations(5, 60, 14)
    got = report(turn_repair.repair_report(llm.createDataFrame(rows, SCHEMA), llm.createDataFrame(rows, SCHEMA), chunk_rows))
    ordered = in_order(llm, rows)
    assert got == {c: plain_repair(ordered[c]) for c in ordered}


def test_one_conversation_over_many_chunks_and_tasks(llm):
    rows = [(7, turn, role, text) for _, turn, role, text in conversations(11, 1, 1)]
    rnd = random.Random(3)
    rows += [(7, t, rnd.choice(["user", "assistant", "system"]), rnd.choice([f"say {t}.", f"cut {t}", ""])) for t in range(10, 400)]
    turns = llm.createDataFrame(rows, SCHEMA).repartition(5)
    got = report(turn_repair.repair_report(turns, turns, chunk_rows=16))
    assert got == {7: plain_repair(in_order(llm, rows)[7])}


def test_query_equals_a_plain_run(llm):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in llm.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by = {}
    for r in sorted(plain_damage(rows), key=lambda r: (r[0], r[1])):
        by.setdefault(r[0], []).append(r[1:])
    want = {c: plain_repair(by.get(c, [])) for c in {r[0] for r in rows}}
    assert report(queries.QUERIES["op11_turn_repair"](llm, path)) == want


def test_damage_deals_every_fate(llm):
    rows = [(c, t, "assistant", "One. Two! Three? four") for c in range(40) for t in [0, 1, None]] + [(None, 3, None, None)]
    got = sorted((tuple(r) for r in turn_repair.damaged(llm.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted(plain_damage(rows), key=str)


def test_odd_rows(llm):
    long = "word " * 200_000 + "end."
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "A."), (1, None, "user", "A."), (1, 2, "assistant", long),
            (2, 5, "", ""), (3, -(2**63), "user", "x."), (3, 2**63 - 1, "assistant", "y."), (1, 2, "assistant", long)]
    odd = llm.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", pos int, code int, seq int")
    ids = llm.createDataFrame([(9,), (None,), (1,), (2,), (3,)], "conv_id bigint")
    got = report(turn_repair.repair_report(odd, ids))
    ordered = in_order(llm, rows)
    want = {c: plain_repair(ordered.get(c, [])) for c in (9, None, 1, 2, 3)}
    want[3] = (None, *want[3][1:])  # the span doesn't fit
    assert got == want
    assert got[9] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = odd.limit(0)
    assert report(turn_repair.repair_report(empty, empty)) == {}


def test_repaired_rows_are_kept_as_rows(llm):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Again."), (1, 2, "user", "")]
    work = turn_repair.Repair(llm.createDataFrame(rows, SCHEMA))
    got = [(r.edit, r.role, r.text) for r in work.repaired().orderBy("seq", "step").collect()]
    work.drop()
    assert [x for x in got if x[0] != "D"] == [("R", "user", "Hello."), ("K", "assistant", "Again.")]
    assert [x[0] for x in got] == list("RKD")
