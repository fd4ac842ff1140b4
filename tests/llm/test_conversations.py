"""Conversation repair against every audit of short conversations, and against plain strings."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from tillstar.llm import conversations, queries
from tillstar.llm.conversations import Edits

LEGAL = re.compile("(s?(ua)+)?")
COLUMNS = "conv_id long, turn long, role string, text string"


def flagged(rows):
    """(role, text, fault) of ordered (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows), keeping for each state the least (cost, audit) as plain strings."""
    following = {"": "u", "s": "u", "u": "a", "a": "u"}
    whole = {"u": "user", "a": "assistant"}

    def put_in(states):
        for _ in range(3):
            for state, (cost, audit, out) in list(states.items()):
                role = following[state]
                new = (cost + 3, audit + "I", [*out, f"{whole[role]}:"])
                states[role] = min(states.get(role, new), new, key=lambda x: x[:2])
        return states

    states = {"": (0, "", [])}
    for role, text, fault in rows:
        after = {}
        more = 3 * (fault == "truncated")
        for state, (cost, audit, out) in put_in(states).items():
            options = [(state, cost + 4, "D", out)]
            if fault not in ("blank", "duplicate"):
                to, initial = following[state], role[:1]
                options.append((to, cost + 3 + more, "R", [*out, f"{whole[to]}:{text}"]))
                if initial == to or initial == "s" and state == "":
                    options.append((initial, cost + more, "K", [*out, f"{role}:{text}"]))
            for to, total, edit, kept in options:
                new = (total, audit + edit, kept)
                after[to] = min(after.get(to, new), new, key=lambda x: x[:2])
        states = after
    return min((v for k, v in put_in(states).items() if k in ("", "a")), key=lambda x: x[:2])


def every_audit(rows):
    """(cost, audit) from all audits of up to two rows put in before each row and at the end."""
    found = []
    gaps = [0, 1, 2]
    for put in product(gaps, repeat=len(rows) + 1):
        for edits in product("KRD", repeat=len(rows)):
            cost, audit, roles = 3 * sum(put), "", ""
            for k, (role, _, fault) in enumerate(rows):
                audit += "I" * put[k] + edits[k]
                roles += "?" * put[k]
                if edits[k] == "D":
                    cost += 4
                    continue
                if fault in ("blank", "duplicate") or edits[k] == "K" and not role:
                    break
                cost += 3 * (fault == "truncated") + 3 * (edits[k] == "R")
                roles += role[:1] if edits[k] == "K" else "?"
            else:
                audit, roles = audit + "I" * put[-1], roles + "?" * put[-1]
                for fill in product("ua", repeat=roles.count("?")):
                    filled = iter(fill)
                    if LEGAL.fullmatch("".join(next(filled) if x == "?" else x for x in roles)):
                        found.append((cost, audit))
                        break
    return min(found)


def expected(rows):
    """The contract's columns but conv_id, of a conversation's rows after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    marked = flagged(rows)
    turns = {r[0] for r in rows} - {None}
    initials = [r[1][:1] for r in rows]
    cost, audit, out = cheapest(marked)
    faults = [x for _, _, x in marked]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def damaged(rows):
    """conv_id -> rows after damage."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        of = out.setdefault(conv, [])
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        of += [] if k == 0 else [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def some_rows(rnd, n):
    roles, texts = ["user", "assistant", "system", "tool", ""], ["Yes.", "No!", "cut off", " ", "Well?", "Hm."]
    return [(turn, rnd.choice(roles[: rnd.choice([2, 3, 5])]), rnd.choice(texts) + rnd.choice(["", "", f"{turn}."])) for turn in range(n)]


def test_plain_strings_agree_with_every_audit():
    rnd = random.Random(3)
    for _ in range(60):
        rows = flagged(some_rows(rnd, rnd.randint(0, 3)))
        assert cheapest(rows)[:2] == every_audit(rows), rows


@pytest.mark.parametrize("modulus", [Edits.MODULUS, 3])
def test_order_of_persistent_sequences(modulus):
    """Also where hashes collide."""
    rnd = random.Random(4)
    edits, held = Edits(modulus), [(0, ())]
    for _ in range(400):
        node, sequence = rnd.choice(held[-6:])
        symbol = rnd.choice([1, 2])
        held.append((edits.add(node, symbol), (*sequence, symbol)))
    for (a, x), (b, y) in zip(rnd.choices(held, k=3000), rnd.choices(held, k=3000), strict=True):
        assert edits.before(a, b) == (x < y) and tuple(edits.sequence(a)) == x


def answers(spark, rows):
    summaries, parts = conversations.repair(spark.createDataFrame(rows, COLUMNS))
    audits = {r["conv_id"]: (r["audit"], r["repaired_sha256"]) for r in conversations.digests(parts).collect()}
    return {r["conv_id"]: tuple(r)[1:] + audits[r["conv_id"]] for r in summaries.collect()}


@pytest.mark.parametrize("piece_rows", [1, 3, 1024])
def test_pieces_join_to_the_whole(spark, monkeypatch, piece_rows):
    monkeypatch.setattr(conversations, "PIECE_ROWS", piece_rows)
    rnd = random.Random(piece_rows)
    chats = {c: some_rows(rnd, rnd.randint(1, 40)) for c in range(60)}
    chats[60] = some_rows(rnd, 300)
    chats[None] = [(None, "user", "Hi."), (None, "user", "Hi."), (3, "usher", "a."), (3, "assistant", "b."), (3, "user", "c"), (9, "user", "Hi.")]
    chats[61] = [(t, "user", "Same.") for t in range(30)] * 3
    marked = {}
    for c, rows in chats.items():
        marked[c] = expected(rows)
    assert answers(spark, [(c, *r) for c, rows in chats.items() for r in rows]) == marked


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    nobody = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op11_persistent_audits(spark, sf).collect()}
    assert got == {c: expected(r) if r else nobody for c, r in damaged(rows).items()}


def test_odd_rows(spark, tmp_path):
    # Turns are looked for whose checksum drops or repeats them.
    hit = lambda k: next(t for t in range(500) if zlib.crc32(f"7:{t}".encode()) % 20 == k)
    rows = [
        (1, 1, None, None), (1, None, "user", "a" * 100_000), (2, 5, "system", "Be kind."), (None, 2, "user", "x."), (None, None, "assistant", ""),
        (7, hit(0), "user", "gone."), (8, 1, "user", "A."), (8, 1, "user", "A."), (8, 1, "assistant", "A."), (8, 2**40, "user", "Ä?"),
    ]
    path = f"{tmp_path}/conversations.parquet"
    clash = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'own' as conv", "'own' as no", "1 as copies", "'own' as audit", "'own' as n")
    clash.write.parquet(path)
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op11_persistent_audits(spark, str(tmp_path)).collect()}
    wanted = damaged(rows)
    assert wanted[7] == [] and got.pop(7)[:7] == (0, 0, 0, 0, 0, 0, "")
    assert got == {c: expected(r) for c, r in wanted.items() if c != 7}
    summaries, parts = conversations.repair(clash)
    assert summaries.columns == ["conv_id", "gaps", *conversations.COUNTS, "cost"] and summaries.count() == 5
    empty, none = conversations.repair(clash.where(F.lit(False)))
    assert empty.count() == 0 and none.count() == 0 and conversations.digests(none).count() == 0
