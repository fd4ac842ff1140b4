"""Conversation structure repair: cheapest edits found by a DP over persistent audits.

Rows of a conversation are kept, given another role, deleted, or get a row put before them,
until the initials of the roles read `(s?(ua)+)?`. What a valid beginning ends in is one of
four states (nothing, system, user, assistant), so the DP over rows keeps the cheapest audit
(the edits' initials K, R, D, I) per state; equal costs go to the audit least in ASCII.
Audits are linked nodes that share their prefixes (`Edits`). Each node has its ancestors at
powers of two and a rolling hash of all its symbols, so that two audits are compared by a
search for their longest common prefix in logarithmic time; equal hashes are verified.

A conversation may hold any share of all rows. So rows are sorted over all of them (by
conversation, turn, role and text, rows that are equal in all as one row with a count), cut
into pieces of bounded size, and each piece finds its cheapest audits from each state to each
state, as the audits of any rows end in a row's own edit: a row put in belongs to the row
after it. None of them is then a proper prefix of another, the first piece in which two
chains of pieces differ decides between them, and a second DP of the same kind joins the
pieces of a conversation by costs and by the audits' order within each piece.

Ties: rows of one turn go by role, their text's first 64 characters and its XXH64. Null turns
come first; null roles and texts are one space; a role without a first character is never
kept. Rows without a conversation id are one conversation. Repeated rows are duplicates;
texts may be of any length. A conversation without rows isn't there in the result, an empty
table gives an empty one, and further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillstar.llm.common import written

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = map(ord, "KRDI")
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
NAMES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: Rows and characters of a piece, about.
PIECE_ROWS, PIECE_CHARS = 1024, 8_000_000
WHITE = " \t\n\x0b\x0c\r"
COUNTS = ("blank", "duplicate", "truncated", "illegal")


class Edits:
    """Sequences of symbols as nodes that share their prefixes; node 0 is the empty one."""

    BASE, MODULUS = 1_000_003, (1 << 61) - 1

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.symbol, self.depth, self.hash = [-1], [0], [0]
        self.up = [[0]]  # up[k][node]: the node 2**k symbols before, or 0

    def add(self, node: int, symbol: int) -> int:
        new, depth = len(self.symbol), self.depth[node] + 1
        self.symbol.append(symbol)
        self.depth.append(depth)
        self.hash.append((self.hash[node] * self.BASE + symbol + 1) % self.modulus)
        if depth >> len(self.up):
            self.up.append([0] * new)
        at = node
        for ups in self.up:
            ups.append(at)
            at = ups[at]
        return new

    def prefix(self, node: int, depth: int) -> int:
        """The node of the first `depth` symbols."""
        drop = self.depth[node] - depth
        for ups in self.up:
            if drop & 1:
                node = ups[node]
            drop >>= 1
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth hold equal sequences."""
        if self.hash[a] != self.hash[b]:
            return False
        parent = self.up[0]
        while a != b:  # at once, but for collisions and sequences built twice
            if self.symbol[a] != self.symbol[b]:
                return False
            a, b = parent[a], parent[b]
        return True

    def before(self, a: int, b: int) -> bool:
        """Whether a's sequence is less than b's."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.prefix(a, depth), self.prefix(b, depth)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        for ups in reversed(self.up):
            if not self.same(ups[x], ups[y]):
                x, y = ups[x], ups[y]
        return self.symbol[x] < self.symbol[y]

    def sequence(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.symbol[node])
            node = self.up[0][node]
        return out[::-1]


def following(state: int) -> int:
    """The role that a row put in or given another role gets."""
    return ASSISTANT if state == USER else USER


def kept_as(state: int, initial: str) -> int | None:
    """The state after a kept row, None where it can't be kept."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def steps(best: dict, edits: Edits, initial: str, delete_only: bool, truncated: bool) -> dict:
    """state -> (cost, node) after one more row, from the same before it."""
    after: dict[int, tuple[int, int]] = {}

    def offer(state: int, cost: int, node: int, symbol: int) -> None:
        held = after.get(state)
        if held is None or cost < held[0]:
            after[state] = cost, edits.add(node, symbol)
        elif cost == held[0]:
            new = edits.add(node, symbol)
            if edits.before(new, held[1]):
                after[state] = cost, new

    more = TRUNCATED_COST if truncated else 0
    for origin, (cost, node) in best.items():
        state = origin
        for put_in in range(3 if origin in (START, SYSTEM) else 2):  # one more would lead back
            if put_in:
                state, cost, node = following(state), cost + INSERT_COST, edits.add(node, INSERT)
            offer(state, cost + DELETE_COST, node, DELETE)
            if not delete_only:
                kept = kept_as(state, initial)
                if kept is not None:
                    offer(kept, cost + more, node, KEEP)
                offer(following(state), cost + REROLE_COST + more, node, REROLE)
    return after


def faults(text: str, earlier: bool, copies: int) -> tuple[int, int, int]:
    """Blank, duplicate and truncated rows among `copies` equal ones."""
    rest = text.rstrip(WHITE)
    if not rest:
        return copies, 0, 0
    return 0, copies if earlier else copies - 1, int(not earlier and rest[-1] not in ".!?")


def _rows(piece: list[dict]) -> Iterator[tuple[str, bool, bool]]:
    """(initial, must go, truncated) of each row of a piece."""
    for row in piece:
        blank, duplicate, truncated = faults(row["text"], row["earlier"], row["copies"])
        initial = row["role"][:1]
        if row["copies"] > blank + duplicate:
            yield initial, False, bool(truncated)
        for _ in range(blank + duplicate):
            yield initial, True, False


def solve(piece: list[dict], alone: bool) -> dict:
    """What the pieces of a conversation are joined by: for each pair of states (4 * before +
    after) the least cost, the audit and its rank; the faults; both ends. `alone`: the piece
    begins a conversation."""
    costs, audits = [None] * 16, [None] * 16
    rows = list(_rows(piece))
    for entry in (START,) if alone else range(4):
        edits = Edits()
        best = {entry: (0, 0)}
        for row in rows:
            best = steps(best, edits, *row)
        for state, (cost, node) in best.items():
            costs[4 * entry + state] = cost
            audits[4 * entry + state] = "".join(map(chr, edits.sequence(node)))
    order = {a: i for i, a in enumerate(sorted({a for a in audits if a is not None}))}
    totals = [sum(x) for x in zip(*(faults(r["text"], r["earlier"], r["copies"]) for r in piece), strict=True)]
    initials = [r[0] for r in rows]
    turns = [r["turn"] for r in piece if r["turn"] is not None]
    return {
        "costs": costs, "ranks": [None if a is None else order[a] for a in audits], "audits": audits,
        **dict(zip(COUNTS, [*totals, sum(map(illegal, initials, initials[1:]))], strict=True)),
        "first": initials[0], "last": initials[-1],
        "turns": len(set(turns)), "least_turn": min(turns, default=None), "most_turn": max(turns, default=None),
    }


def illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def joined(pieces: list[dict]) -> tuple[dict, list[int], int]:
    """Of a conversation's pieces in order: its summary, the pair of states that each piece
    gets, and how many rows are put in at the end."""
    edits, pair = Edits(), {}
    best = {START: (0, 0)}
    for p in pieces:
        after: dict[int, tuple[int, int]] = {}
        for entry, (cost, node) in best.items():
            for state in range(4):
                k = 4 * entry + state
                if p["costs"][k] is None:
                    continue
                total, held = cost + p["costs"][k], after.get(state)
                if held is not None and total > held[0]:
                    continue
                new = edits.add(node, p["ranks"][k])
                pair[new] = k
                if held is None or total < held[0] or edits.before(new, held[1]):
                    after[state] = total, new
        best = after
    chosen = None
    for state, (cost, node) in best.items():
        tail = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]
        cost += INSERT_COST * tail
        if chosen is None or cost < chosen[0] or cost == chosen[0] and edits.before(node, chosen[1]):
            chosen = cost, node, tail
    cost, node, tail = chosen
    chain = []
    while node:
        chain.append(pair[node])
        node = edits.up[0][node]
    summary = {c: sum(p[c] for p in pieces) for c in COUNTS} | {"cost": cost}
    summary["illegal"] += sum(illegal(a["last"], b["first"]) for a, b in zip(pieces, pieces[1:], strict=False))
    numbered = [p for p in pieces if p["turns"]]
    turns = sum(p["turns"] for p in numbered) - sum(a["most_turn"] == b["least_turn"] for a, b in zip(numbered, numbered[1:], strict=False))
    summary["gaps"] = numbered[-1]["most_turn"] - numbered[0]["least_turn"] + 1 - turns if numbered else 0
    return summary, chain[::-1], tail


def applied(piece: list[dict], audit: str, state: int) -> list[str]:
    """The repaired rows of a piece as `role:text`; `audit` begins in `state`."""
    out = []
    rows = ((r["role"], r["text"]) for r in piece for _ in range(r["copies"]))
    for edit in map(ord, audit):
        if edit == INSERT:
            state = following(state)
            out.append(f"{NAMES[state]}:")
            continue
        role, text = next(rows)
        if edit == KEEP:
            state = kept_as(state, role[:1])
            out.append(f"{role}:{text}")
        elif edit == REROLE:
            state = following(state)
            out.append(f"{NAMES[state]}:{text}")
    return out


def _columns(kind: str) -> str:
    return (
        f"conv {kind}, no long, costs array<long>, ranks array<int>, audits array<string>, {_longs(*COUNTS)}, first string, last string, "
        f"{_longs('turns', 'least_turn', 'most_turn')}, rows array<struct<role string, text string, copies long>>"
    )


def _longs(*names: str) -> str:
    return ", ".join(f"{n} long" for n in names)


def _schema(columns: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(columns))


def _cut(kind: str):
    """A function from Arrow batches of sorted rows to a row per piece."""
    schema = _schema(_columns(kind))

    def run(batches):
        part, number, piece, copies, chars = TaskContext.get().partitionId(), 0, [], 0, 0
        begins = False  # unknown at a partition's start

        def full() -> pa.RecordBatch:
            row = {"conv": piece[0]["conv"], "no": (part << 32) + number, "rows": piece, **solve(piece, begins)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                other = bool(piece) and row["conv"] != piece[0]["conv"]
                if piece and (other or copies + row["copies"] > PIECE_ROWS or chars >= PIECE_CHARS):
                    yield full()
                    number, piece, copies, chars, begins = number + 1, [], 0, 0, other
                piece.append(row)
                copies += row["copies"]
                chars += len(row["text"])
        if piece:
            yield full()

    return run


def sorted_rows(df: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, copies (of rows that are equal in all, PIECE_ROWS at most a
    row) and earlier (whether role and text were there before), in order over partitions."""
    space = F.lit(" ")
    rows = df.select(
        F.col(id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text")
    )
    equal = written(rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n")), "rows")
    # Of what a conversation says more than once, the first turn; a null one comes first.
    again = (
        equal.groupBy("conv", "role", "text").agg(F.min(F.struct("turn")).alias("begin"), F.count("*").alias("times"))
        .where("times > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"), "begin")
    )
    met = equal.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t")), "left")
    later = F.col("begin").isNotNull() & ~F.col("begin.turn").eqNullSafe(F.col("turn"))
    split = met.select(
        "conv", "turn", "role", "text", "n", later.alias("later"), F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(PIECE_ROWS))).alias("at")
    ).select(
        "conv", "turn", "role", F.left("text", F.lit(64)).alias("head"), F.xxhash64("text").alias("hash"), "text", "at",
        F.least(F.col("n") - F.col("at"), F.lit(PIECE_ROWS)).alias("copies"), (F.col("later") | (F.col("at") > 0)).alias("earlier"),
    )
    key = ["conv", "turn", "role", "head", "hash"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return split.repartitionByRange(parts, *key, "at").sortWithinPartitions(*key, "text", "at").select("conv", "turn", "role", "text", "copies", "earlier")


def repair(df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(summaries, parts).

    summaries: a row per conversation with rows: `id`, gaps (turns left out between its first
    and last), blank, duplicate, truncated, illegal (neighbours whose roles don't follow each
    other) and cost. parts: `id`, no, audit and repaired (`role:text` of each row left): by no,
    the audits of a conversation one after the other are its audit, and its rows the repaired ones.
    """
    kind = df.schema[id].dataType.simpleString()
    pieces = written(sorted_rows(df, id, turn, role, text).mapInArrow(_cut(kind), _columns(kind)), "pieces")

    def choose(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda p: p["no"])
        summary, pairs, tail = joined(rows)
        out = [{"no": p["no"], "pair": k, "tail": tail if p is rows[-1] else 0, "conv": p["conv"]} for p, k in zip(rows, pairs, strict=True)]
        out[0] |= summary
        return pa.Table.from_pylist(out, schema=chosen_schema)

    columns = f"conv {kind}, no long, pair int, tail int, {_longs('gaps', *COUNTS, 'cost')}"
    chosen_schema = _schema(columns)
    chosen = written(pieces.drop("audits", "rows").groupBy("conv").applyInArrow(choose, columns), "chosen")
    summaries = chosen.where("cost is not null").select(F.col("conv").alias(id), "gaps", *COUNTS, "cost")

    def finish(batches):
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                audit = p["audit"] + "I" * p["tail"]
                out.append({"conv": p["conv"], "no": p["no"], "audit": audit, "repaired": applied(p["rows"], audit, p["pair"] // 4)})
            yield pa.RecordBatch.from_pylist(out, schema=part_schema)

    part_columns = f"conv {kind}, no long, audit string, repaired array<string>"
    part_schema = _schema(part_columns)
    parts = (
        pieces.select("conv", "no", "audits", "rows").join(chosen.select("no", "pair", "tail"), "no")
        .select("conv", "no", "rows", "pair", "tail", F.get("audits", F.col("pair")).alias("audit"))
        .mapInArrow(finish, part_columns)
    )
    return summaries, parts.withColumnRenamed("conv", id)


def digests(parts: DataFrame, id: str = "conv_id") -> DataFrame:
    """Per conversation: `id`, audit and repaired_sha256 (of its repaired rows, joined by line
    feeds). Parts stream by in order, so a conversation needs no more memory than its audit."""
    columns = f"conv {parts.schema[id].dataType.simpleString()}, audit string, repaired_sha256 string"
    schema = _schema(columns)

    def run(batches):
        conv, audit, sha, empty = None, None, None, True

        def done() -> dict:
            return {"conv": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}

        for batch in batches:
            out = []
            for p in batch.to_pylist():
                if audit is None or p["conv"] != conv:
                    if audit is not None:
                        out.append(done())
                    conv, audit, sha, empty = p["conv"], [], hashlib.sha256(), True
                audit.append(p["audit"])
                for line in p["repaired"]:
                    sha.update(line.encode() if empty else b"\n" + line.encode())
                    empty = False
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if audit is not None:
            yield pa.RecordBatch.from_pylist([done()], schema=schema)

    ordered = parts.withColumnRenamed(id, "conv").repartition("conv").sortWithinPartitions("conv", "no")
    return ordered.select("conv", "no", "audit", "repaired").mapInArrow(run, columns).withColumnRenamed("conv", id)
