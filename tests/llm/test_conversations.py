import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from logweave.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, block int, audit string"
SPACE = " \t\n\x0b\x0c\r"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAME = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit) by relaxing (cost, audit) pairs over all states, row by row from the end; rows: (initial, fault)."""
    best = {0: (0, ""), 3: (0, "")}
    for initial, fault in [("end", None), *reversed(rows)]:
        now = {}
        for state in range(4):
            options = []
            if initial == "end":
                if state in best:
                    options.append(best[state])
            else:
                if state in best:
                    options.append((best[state][0] + 3, "D" + best[state][1]))
                if fault not in ("blank", "duplicate"):
                    for letter, to in NEXT[state].items():
                        if to in best:
                            extra = fault == "truncated"
                            if letter == initial:
                                options.append((best[to][0] + extra, "K" + best[to][1]))
                            elif letter != "s":
                                options.append((best[to][0] + 2 + extra, "R" + best[to][1]))
            if options:
                now[state] = min(options)
        for _ in range(6):  # insertions, until nothing changes
            for state in range(4):
                for letter, to in NEXT[state].items():
                    if letter != "s" and to in now:
                        option = (now[to][0] + 2, "I" + now[to][1])
                        if state not in now or option < now[state]:
                            now[state] = option
        best = now
    return best[0]


def brute(rows):
    """The contract, conversation by conversation, from (conv_id, turn, role, text) rows."""
    out = {}
    by_id = defaultdict(list)
    for conv, turn, role, text in rows:
        by_id[conv].append((turn, role, text))
    blank = lambda x: " " if x is None else str(x)
    for conv, turns in by_id.items():
        kept = []
        for turn, role, text in turns:
            kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
            role, text = blank(role), blank(text)
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in kept:
            inner = text.strip(SPACE)
            faults.append("blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else None)
            seen.add((role, text))
        numbers = [t for t, _, _ in kept if t is not None]
        initials = [r[:1] for _, r, _ in kept]
        cost, audit = cheapest(list(zip(initials, faults)))
        lines, at, last = [], 0, ""
        for edit in audit:
            expected = "a" if last == "u" else "u"
            if edit == "I":
                lines.append(NAME[expected] + ":")
                last = expected
                continue
            _, role, text = kept[at]
            at += 1
            if edit == "D":
                continue
            lines.append(f"{role if edit == 'K' else NAME[expected]}:{text}")
            last = role[0] if edit == "K" else expected
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                     *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(df, **kw):
    got = C.repair_conversations(C.damage(df), df, **kw).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def rows_of(seed, conversations, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "ux"]
    texts = ["Hi.", "What is it?", "no end", " ", "", None, "Yes!", "a\x85", "Done. \n", "Straße。", "so on..."]
    rows = []
    for conv in range(conversations):
        n, role = rng.randint(1, longest), rng.choice(["user", "system"])
        for turn in range(n):
            rows.append((conv, rng.choice([None, turn, turn]) if rng.random() < .1 else turn, rng.choice(roles) if rng.random() < .2 else role,
                         rng.choice(texts) if rng.random() < .5 else f"{rng.random()}.", 1, "x"))
            role = "assistant" if role == "user" else "user"
    return rows


def test_alignment_against_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        rows = [(rng.choice("suao" if rng.random() < .4 else "ua"), rng.choice([None, None, None, "truncated", "blank", "duplicate"])) for _ in range(rng.randint(1, 14))]
        codes = "".join("X" if f in ("blank", "duplicate") else i.upper() if f == "truncated" else i for i, f in rows)
        cost, audit, end = C.repair(codes, C.START, C.TO_END)
        assert (cost, audit + C.ENDING[end]) == cheapest([(i if i != "o" else "", f) for i, f in rows]), codes


@pytest.mark.parametrize("block", [2, 3, 7, 48])
def test_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(C, "FAN", 3)
    rows = rows_of(block, 40, 9) + [(1000, *r[1:]) for r in rows_of(99, 1, 60)] + [(None, 1, "user", "Hi.", 1, "x"), (None, None, "assistant", "Yo.", 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert repaired(df, block=block) == brute([r[:4] for r in rows])


def test_hot_conversation_of_repeated_turns(spark):
    rows = [(7, t, "user" if t % 2 else "assistant", "The same." if t % 3 else f"Turn {t}!", 1, "x") for t in range(400)]
    assert repaired(spark.createDataFrame(rows, SCHEMA)) == brute([r[:4] for r in rows])


def test_edge_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repaired(empty) == {}
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, gone, "user", "Hi.", 1, "x"), (6, 0, "user", "long " * 50000 + ".", 1, "x"), (6, 1, "assistant", "Ok.", 1, "x")]
    rows = rows + rows[1:2]
    got = repaired(spark.createDataFrame(rows, SCHEMA))
    assert got == brute([r[:4] for r in rows])
    assert got[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_query_on_the_given_table(spark):
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
           for r in C.op13_repair(spark, "/root/testdata/sf0.01").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert got == brute([tuple(r) for r in rows])
