"""Repair of conversations to the form ``(system? (user assistant)+)?`` at least cost, with an audit of the edits.

Rows are edited in the order of their turns: Keep (0), Rerole to user or assistant (1), Delete (2, and the only edit for
blank and duplicate rows), Insert of an empty user or assistant row anywhere (5); a truncated row that stays costs 5 more.
The audit is the initials of the cheapest edits; of equally cheap ones the least in ASCII order.

The programme goes over the rows with four states: nothing kept yet, a system row, a user row, an assistant row. An edit
is a node that points to the edit before it, so audits share their prefixes; a node knows its ancestors 1, 2, 4, ... steps
up and the rolling hash of all letters up to it. Of two equally cheap audits in a state the lesser is told behind their
longest common prefix, which the ancestors find in a logarithmic number of steps and which is then verified, up to the first
node that both share. What follows can't turn the order of two audits round: audits of equal cost over the same rows are
never each other's prefix, since a letter costs the same wherever it stands.

Spark's part. Rows are dealt out by ranges of (conversation, turn, role, text), so a conversation of any length lies in
several tasks, and equal rows are counted first and travel once. A task cuts its rows into blocks. A block that is a whole
conversation is solved on the spot. Blocks of other conversations give the cheapest audit from every state to every state,
and only these (packed, about a byte a row) meet in one task a conversation; the text stays in its blocks, which are
rewritten in parallel with the edits chosen. The digest of a repaired conversation is taken in one stream, block by block.

* Null conversations are one conversation of their own; null roles and texts are one space; null turns come first.
* Rows of one turn follow in the order of role and text, so copies of a row are neighbours.
* A conversation without rows has no audit, costs nothing and repairs to nothing. An empty table gives no row.
* Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_batches

BLANK, DUPLICATE, TRUNCATED, FINE = "blank", "duplicate", "truncated", ""
RULES = 20
#: States: nothing kept yet, then the initial of the row kept last.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Where a row with this initial may stand.
BEFORE = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
KEEP, REROLE, DELETE, INSERT, HALF = 0, 1, 2, 5, 5
#: Rows and characters of a block at most (one longer row is a block of its own).
ROWS, CHARACTERS = 4096, 1 << 20
MOD, BASE = (1 << 61) - 1, 0x1D8B3F5A7C91E64B


class Edit:
    """One edit behind those before it."""

    __slots__ = ("back", "depth", "hash", "letter", "up")

    def __init__(self, letter: str, back: Edit | None) -> None:
        self.letter, self.back = letter, back
        self.depth = depth(back) + 1
        #: Rolling hash of all letters up to this one.
        self.hash = ((back.hash if back else 0) * BASE + ord(letter)) % MOD
        #: up[k] is 2**k edits before this one.
        self.up: list[Edit] = []
        node = back
        while node is not None:
            self.up.append(node)
            k = len(self.up) - 1
            node = node.up[k] if k < len(node.up) else None

    def at(self, depth: int) -> Edit:
        """Its ancestor (or itself) that is so many letters long."""
        node, steps = self, self.depth - depth
        for k in reversed(range(steps.bit_length())):
            if steps >> k & 1:
                node = node.up[k]
        return node


def depth(edit: Edit | None) -> int:
    return 0 if edit is None else edit.depth


def letters(edit: Edit | None) -> str:
    out = []
    while edit is not None:
        out.append(edit.letter)
        edit = edit.back
    return "".join(reversed(out))


def common(a: Edit | None, b: Edit | None) -> int:
    """Length of the longest common prefix of two audits: both climb, in steps halved each time, as long as the hashes of
    what they reach differ. What the hashes take for equal is verified up to the first edit that both share."""
    n = min(depth(a), depth(b))
    if not n:
        return 0
    x, y = a.at(n), b.at(n)
    if x.hash != y.hash:
        for k in reversed(range(n.bit_length())):
            if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        x, y = x.back, y.back
    found = depth(x)
    while x is not y:
        if x.letter != y.letter:  # two prefixes of one hash
            found = x.depth - 1
        x, y = x.back, y.back
    return found


def less(a: Edit | None, b: Edit | None) -> bool:
    """Whether audit ``a`` comes before audit ``b``."""
    n = common(a, b)
    if n in (depth(a), depth(b)):
        return depth(a) < depth(b)
    return a.at(n + 1).letter < b.at(n + 1).letter


Best = dict[int, tuple[int, Edit | None]]


def better(best: Best, state: int, cost: int, edit: Edit | None) -> bool:
    old = best.get(state)
    if old is None or cost < old[0] or (cost == old[0] and less(edit, old[1])):
        best[state] = (cost, edit)
        return True
    return False


def inserted(best: Best) -> Best:
    """With as many inserted rows as help."""
    todo = list(best)
    while todo:
        state = todo.pop()
        cost, edit = best[state]
        for role in (USER, ASSISTANT):
            if state in BEFORE[role] and (role not in best or best[role][0] >= cost + INSERT) and better(best, role, cost + INSERT, Edit("I", edit)):
                todo.append(role)
    return best


def choices(initial: str, fault: str) -> Iterator[tuple[str, int | None, int]]:
    """(letter, initial that stays, cost) of the edits that a row may have."""
    yield "D", None, DELETE
    if fault not in (BLANK, DUPLICATE):
        more = HALF if fault == TRUNCATED else 0
        if initial in INITIALS:
            yield "K", INITIALS[initial], KEEP + more
        for role in ROLES:
            yield "R", role, REROLE + more


def solved(rows: list[tuple[str, str]], start: int) -> Best:
    """Cheapest audit of the rows (initial, fault) from a state to every other one. Inserts come before a row; those behind
    the last are left to the caller, so that audits of blocks can be joined."""
    best: Best = {start: (0, None)}
    for initial, fault in rows:
        before, best = inserted(best), {}
        for letter, role, price in choices(initial, fault):
            for state, (cost, edit) in before.items():
                if role is None or state in BEFORE[role]:
                    after = state if role is None else role
                    old = best.get(after)
                    if old is None or old[0] >= cost + price:
                        better(best, after, cost + price, Edit(letter, edit))
    return best


def ended(best: Best) -> tuple[int, Edit | None]:
    """The better of nothing kept and an assistant's row at the end."""
    best, out = inserted(best), {}
    for state in (START, ASSISTANT):
        if state in best:
            better(out, START, *best[state])
    return out[START]


def rewritten(rows: list[tuple], audit: str, state: int) -> tuple[list[str], int]:
    """The lines ``role:text`` that the edits leave of (role, text) rows, and the state behind them."""
    lines, at = [], 0
    for letter in audit:
        if letter == "I":
            state = ASSISTANT if state == USER else USER
            lines.append(f"{ROLES[state]}:")
            continue
        role, text = rows[at][:2]
        at += 1
        if letter == "K":
            state = INITIALS[role[:1]]
            lines.append(f"{role}:{text}")
        elif letter == "R":
            state = ASSISTANT if state == USER else USER
            lines.append(f"{ROLES[state]}:{text}")
    return lines, state


# --- Spark's part ---------------------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """The damage of the rule: (conv_id, turn, role, text, n copies), equal rows counted together."""
    turn = F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    number = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), turn).cast("binary")) % RULES
    base = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), number.alias("rule")).filter("rule != 0")
    role = F.when(F.col("rule") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("rule") == 1, "").when(F.col("rule") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    made = base.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("rule") == 3, 2).otherwise(1).cast("bigint").alias("n"))
    return made.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


#: Order of rows, nulls first.
_ORDER = ("conv_id", "turn", "role", "text")


def alike() -> Column:
    """Tells roles and texts of a conversation apart (a cryptographic digest; lengths keep role and text apart)."""
    return F.sha2(F.concat_ws(":", F.length("role").cast("string"), F.col("role"), F.col("text")).cast("binary"), 256)


def marked(rows: DataFrame) -> DataFrame:
    """Rows with ``again``: whether their role and text came at an earlier turn of the conversation."""
    keyed = rows.withColumn("alike", alike())
    # Nulls come first, so a group that has a row without turn begins there.
    first = keyed.groupBy(F.col("conv_id").alias("_conv"), F.col("alike").alias("_alike")).agg(F.min("turn").alias("_turn"), F.max(F.col("turn").isNull()).alias("_untimed"))
    joined = keyed.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("alike") == F.col("_alike")))
    again = F.when(F.col("turn").isNull(), F.lit(False)).otherwise(F.col("_untimed") | (F.col("turn") > F.col("_turn")))
    return joined.select(*_ORDER, "n", again.alias("again"))


def faulty(text: str, again: bool) -> str:
    words = text.strip(" \t\n\v\f\r")
    if not words:
        return BLANK
    if again:
        return DUPLICATE
    return FINE if words[-1] in ".!?" else TRUNCATED


BLOCK = "conv_id bigint, block bigint, whole boolean, n bigint, min_turn bigint, max_turn bigint, n_turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_role string, last_role string, first_turn bigint, last_turn bigint, cost bigint, audit string, repaired_sha256 string, costs array<bigint>, audits binary, role array<string>, text array<string>, repeats array<bigint>"


def summary(conv, number: int, rows: list[tuple], whole: bool) -> dict:
    """A block of (turn, role, text, n, again) rows: its counts, and its solution or what the solution needs."""
    edits: list[tuple[str, str]] = []
    counts = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
    illegal, last = 0, None
    for _, role, text, n, again in rows:
        fault, initial = faulty(text, again), role[:1]
        edits.append((initial, fault))
        rest = BLANK if fault == BLANK else DUPLICATE
        edits += [(initial, rest)] * (n - 1)
        if fault:
            counts[fault] += 1
        counts[rest] += n - 1
        illegal += (last is not None and (last, initial) not in LEGAL) + (n - 1) * ((initial, initial) not in LEGAL)
        last = initial
    turns = [r[0] for r in rows if r[0] is not None]
    out = {"conv_id": conv, "block": number, "whole": whole, "n": len(edits), "min_turn": min(turns, default=None), "max_turn": max(turns, default=None), "n_turns": len(set(turns))}
    out |= counts | {"illegal": illegal, "first_role": rows[0][1][:1], "last_role": last, "first_turn": rows[0][0], "last_turn": rows[-1][0]}
    if whole:
        cost, edit = ended(solved(edits, START))
        audit = letters(edit)
        lines, _ = rewritten([r[1:3] for r in rows for _ in range(r[3])], audit, START)
        return out | {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(), "costs": None, "audits": None, "role": None, "text": None, "repeats": None}
    costs, audits = [], []
    for start in range(4):
        best = solved(edits, start)
        costs += [best[s][0] if s in best else None for s in range(4)]
        audits += [letters(best[s][1]) if s in best else "" for s in range(4)]
    packed = zlib.compress(",".join(audits).encode(), 1)
    return out | {"cost": None, "audit": None, "repaired_sha256": None, "costs": costs, "audits": packed, "role": [r[1] for r in rows], "text": [r[2] for r in rows], "repeats": [r[3] for r in rows]}


def blocks(rows: DataFrame, most_rows: int = ROWS, most_characters: int = CHARACTERS) -> DataFrame:
    """Blocks of conversations in order. Only a conversation that neither begins a task's rows nor ends them is known to be
    whole; the others' blocks are joined later."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32

        def each() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "again")), strict=True)

        waiting, first, made = None, True, []

        def put(block: list[tuple], conv, whole: bool) -> Iterator[dict]:
            nonlocal number, made
            made.append(summary(conv, number, block, whole))
            number += 1
            if len(made) >= 256 or not whole:
                yield from flush()

        def flush() -> Iterator[dict]:
            nonlocal made
            if made:
                yield {k: [m[k] for m in made] for k in made[0]}
            made = []

        for conv, group in groupby(each(), lambda r: r[0]):
            if waiting is not None:
                yield from put(waiting[1], waiting[0], not first and not waiting[2])
                first = False
            block, size, cut = [], 0, False
            n = 0
            for row in group:
                parts = [row[1:]]
                while parts[-1][3] > most_rows:  # copies of one row fill blocks of their own
                    turn, role, text, k, again = parts.pop()
                    parts += [(turn, role, text, most_rows, again), (turn, role, text, k - most_rows, True)]
                for part in parts:
                    if block and (n + part[3] > most_rows or size + len(part[2]) > most_characters):
                        yield from put(block, conv, False)
                        block, size, n, cut, first = [], 0, 0, True, False
                    block.append(part)
                    size, n = size + len(part[2]), n + part[3]
            waiting = (conv, block, cut)
        if waiting is not None:
            yield from put(waiting[1], waiting[0], False)
        yield from flush()

    dealt = rows.repartitionByRange(*(F.col(c).asc_nulls_first() for c in _ORDER)).sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in _ORDER))
    return map_batches(dealt, body, BLOCK)


def chosen(found: DataFrame) -> DataFrame:
    """(conv_id, block, audit of the block, state before it, cost of the whole conversation) of conversations in several
    blocks; their packed audits are all that is gathered."""

    def body(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        ways: dict[int, tuple[int, tuple | None]] = {START: (0, None)}

        def audit(way: tuple) -> str:
            _, i, start, state = way
            return zlib.decompress(rows[i]["audits"]).decode().split(",")[4 * start + state]

        def joined(way: tuple | None) -> str:
            out = []
            while way is not None:
                out.append(audit(way))
                way = way[0]
            return "".join(reversed(out))

        def earlier(a: tuple | None, b: tuple | None) -> bool:
            one, two = [], []
            while a is not b:  # ways share their beginnings
                one.append(audit(a))
                two.append(audit(b))
                a, b = a[0], b[0]
            return "".join(reversed(one)) < "".join(reversed(two))

        for i, r in enumerate(rows):
            new: dict[int, tuple[int, tuple | None]] = {}
            for start, (cost, before) in ways.items():
                for state in range(4):
                    more = r["costs"][4 * start + state]
                    if more is not None:
                        way, old = (before, i, start, state), new.get(state)
                        if old is None or cost + more < old[0] or (cost + more == old[0] and earlier(way, old[1])):
                            new[state] = (cost + more, way)
            ways = new
        # Inserted behind the last row.
        tails = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
        cost, _, tail, way = min((cost + INSERT * len(tails[s]), joined(way) + tails[s], tails[s], way) for s, (cost, way) in ways.items())
        out = []
        while way is not None:
            out.append((rows[way[1]]["conv_id"], rows[way[1]]["block"], audit(way) + tail, way[2], cost))
            way, tail = way[0], ""
        types = {"conv_id": pa.int64(), "block": pa.int64(), "audit": pa.string(), "start": pa.int32(), "cost": pa.int64()}
        return pa.table({name: pa.array([r[k] for r in out], t) for k, (name, t) in enumerate(types.items())})

    return found.select("conv_id", "block", "costs", "audits").groupBy("conv_id").applyInArrow(body, "conv_id bigint, block bigint, audit string, start int, cost bigint")


def repaired_blocks(found: DataFrame, edits: DataFrame) -> DataFrame:
    """Blocks with their edits carried out: (conv_id, block, lines: the repaired rows joined by newlines, null if none)."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for i in range(len(batch["block"])):
                role, text, repeats, audit, start = (batch[c][i].as_py() for c in ("role", "text", "repeats", "audit", "start"))
                lines, _ = rewritten([(r, t) for r, t, n in zip(role, text, repeats, strict=True) for _ in range(n)], audit, start)
                yield {"conv_id": batch["conv_id"][i : i + 1], "block": batch["block"][i : i + 1], "audit": [audit], "cost": batch["cost"][i : i + 1], "lines": ["\n".join(lines) if lines else None]}

    keyed = edits.select("block", "audit", "start", "cost")  # blocks have numbers of their own
    return map_batches(found.select("conv_id", "block", "role", "text", "repeats").join(keyed, "block"), body, "conv_id bigint, block bigint, audit string, cost bigint, lines string")


def digests(parts: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, repaired_sha256): one stream over a conversation's blocks, in order."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        conv, digest, audit, cost, begun = None, None, [], 0, False

        def done() -> dict:
            return {"conv_id": [conv], "cost": [cost], "audit": ["".join(audit)], "repaired_sha256": [digest.hexdigest()]}

        for batch in batches:
            for i in range(len(batch["block"])):
                this = batch["conv_id"][i].as_py()
                if digest is None or this != conv:
                    if digest is not None:
                        yield done()
                    conv, digest, audit, begun = this, hashlib.sha256(), [], False
                cost = batch["cost"][i].as_py()
                audit.append(batch["audit"][i].as_py())
                lines = batch["lines"][i].as_py()
                if lines is not None:
                    digest.update(("\n" * begun + lines).encode())
                    begun = True
        if digest is not None:
            yield done()

    return map_batches(parts.repartition("conv_id").sortWithinPartitions("conv_id", "block"), body, "conv_id bigint, cost bigint, audit string, repaired_sha256 string")


COUNTS = (BLANK, DUPLICATE, TRUNCATED)


def totals(found: DataFrame) -> DataFrame:
    """Counts of conversations in several blocks, with what happens where two blocks meet."""
    meets = F.struct("block", "first_role", "last_role", "first_turn", "last_turn")
    sums = found.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in (*COUNTS, "illegal")), F.min("min_turn").alias("lo"), F.max("max_turn").alias("hi"), F.sum("n_turns").alias("n_turns"), F.array_sort(F.collect_list(meets)).alias("_at"))
    pairs = F.transform(F.slice("_at", 2, F.greatest(F.size("_at") - 1, F.lit(0))), lambda x, i: F.struct(F.col("_at")[i].alias("a"), x.alias("b")))
    legal = F.array(*(F.lit(a + b) for a, b in sorted(LEGAL)))
    # A turn that goes on in the next block was counted in both.
    shared = F.size(F.filter(pairs, lambda p: p["a"]["last_turn"] == p["b"]["first_turn"]))
    # An empty role makes no legal neighbour.
    wrong = F.size(F.filter(pairs, lambda p: ~F.array_contains(legal, F.concat(p["a"]["last_role"], p["b"]["first_role"]))))
    distinct = F.col("n_turns") - shared
    return sums.select("conv_id", F.coalesce(F.col("hi") - F.col("lo") + 1 - distinct, F.lit(0)).cast("bigint").alias("gaps"), *COUNTS, (F.col("illegal") + wrong).cast("bigint").alias("illegal"))


def repair(rows: DataFrame, most_rows: int = ROWS, most_characters: int = CHARACTERS) -> DataFrame:
    """A row for each conversation of ``rows`` (conv_id, turn, role, text): conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256. The rows are damaged by the rule first."""
    scratch = Scratch(rows.sparkSession, "conversations")
    rows = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    found = scratch.save(blocks(marked(damaged(rows)), most_rows, most_characters), "blocks")
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps")
    columns = ["conv_id", "gaps", *COUNTS, "illegal", "cost", "audit", "repaired_sha256"]
    alone = found.filter("whole").select("conv_id", gaps, *COUNTS, "illegal", "cost", "audit", "repaired_sha256")
    rest = found.filter("NOT whole")
    solved_ = digests(repaired_blocks(rest, chosen(rest))).withColumnRenamed("conv_id", "_conv")
    several = totals(rest).join(solved_, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(*columns)
    done = alone.unionByName(several)
    nothing = rows.select(F.col("conv_id").alias("_conv")).distinct()
    zero, none = F.lit(0).cast("bigint"), F.lit("")
    filled = [F.coalesce(c, none if c == "audit" else F.sha2(none.cast("binary"), 256) if c == "repaired_sha256" else zero).alias(c) for c in columns[1:]]
    return nothing.join(done, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(F.col("_conv").alias("conv_id"), *filled)
