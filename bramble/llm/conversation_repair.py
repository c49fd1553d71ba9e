"""Conversation structure repair: cheapest edits by depth-first branch-and-bound.

A conversation is a sequence of rows by turn. ``repair`` finds the edits that give it the
shape ``(s?(ua)+)?`` of role initials (an optional system row, then user and assistant in
turn, or nothing): Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert (an empty
user or assistant row) 3, and a truncated row that is not deleted 3 more. Blank rows and
duplicates must be deleted. Of equally cheap repairs the one whose audit (the initials of the
edits in order) is least in ASCII is taken; with the audit the roles are fixed.

The search goes depth first over an explicit stack. A node is (rows read, state of the shape);
its lower bound is what its prefix cost plus the least that the rows behind it can cost from
that state (a table of suffix bounds, filled from the back). A node is dropped when its bound
is above the incumbent's cost, when it equals it and its audit is no longer less, or when
the node's dominance table holds a prefix as cheap and no greater. Moves are tried by bound
and then letter; the search ends when the stack is empty, which proves the incumbent. The
suffix bounds are exact in cost, so the search goes back over ties only.

At scale: texts never reach the search. Spark derives each row's place, initial and faults
(duplicates by a grouped first place per role and text, with map-side combine, not by
collecting a conversation), and the search sees those few bytes a row. The edits then meet the
rows again in a sorted union, and the repaired text is hashed as a stream, so a task holds one
batch of text whatever a conversation's length. What one conversation returns, its audit and
its hash, is one value over all its rows in order, so its letters are held by one task and its
text passes through one.

Rows of a conversation are ordered by turn, nulls first, then role, then text. A null conv_id
is a conversation like others; null role, null text and, in the damage key, null conv_id or
turn read as one space; a role that starts with none of s, u and a can only be reroled or
deleted; repeated rows are duplicates; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from bramble.llm.shared import batches, utf8, write_shared

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # fixed costs
BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW = 1, 2, 3  # faults, 0 for none
# states of the shape: nothing yet, after the system row, after a user row, after an assistant row
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT_ROLE = "uuau"  # the role that Rerole and Insert give in each state
ACCEPTS = (0, 3)
ADDED = [AFTER[q, NEXT_ROLE[q]] for q in range(4)]
ROLE = {"u": "user", "a": "assistant"}
NEVER = 1 << 60


def suffix_bounds(initials: str, faults: list[int]) -> array:
    """bounds[4 * i + q]: the least cost of the rows from i on, starting in state q."""
    n = len(initials)
    bounds = array("q", bytes(32 * (n + 1)))
    here = [0 if q in ACCEPTS else NEVER for q in range(4)]
    for i in range(n, -1, -1):
        if i < n:
            rest, fault = here, faults[i]
            extra = TRUNCATED if fault == TRUNCATED_ROW else 0
            here = [DELETE + rest[q] for q in range(4)]
            if fault not in (BLANK_ROW, DUPLICATE_ROW):
                for q in range(4):
                    kept = AFTER.get((q, initials[i]))
                    here[q] = min(here[q], REROLE + extra + rest[ADDED[q]], NEVER if kept is None else extra + rest[kept])
        for _ in range(2):  # no more than two inserts in a row can be of use
            here = [min(here[q], INSERT + here[ADDED[q]]) for q in range(4)]
        bounds[4 * i:4 * i + 4] = array("q", here)
    return bounds


def search(initials: str, faults: list[int]) -> tuple[int, str]:
    """(cost, audit) of the best repair, by branch-and-bound."""
    n = len(initials)
    bounds = suffix_bounds(initials, faults)
    table = array("q", [NEVER]) * (4 * n + 4)  # dominance: cost of the best prefix at each node
    best_cost, best = bounds[0], None  # incumbent; deleting all rows is a repair, so the bound is attained
    path: list[str] = []
    agrees = 0  # leading letters that path and incumbent share
    stack = [(0, 0, 0, "")]  # (letters, node, cost, last letter)
    while stack:
        depth, node, cost, letter = stack.pop()
        if letter:
            del path[depth - 1:]
            path.append(letter)
            agrees = min(agrees, depth - 1)
            if best and agrees == depth - 1 and agrees < len(best) and best[agrees] == letter:
                agrees = depth
        bound = cost + bounds[node]
        less = best is None or bound < best_cost
        if not less and agrees < min(len(path), len(best)):
            less = path[agrees] < best[agrees]
        if bound > best_cost or not less:
            continue  # no repair below this node is cheaper, or as cheap with a lesser audit
        if table[node] < cost or table[node] == cost and best is None:
            continue
        table[node] = cost
        i, q = divmod(node, 4)
        if i == n and q in ACCEPTS:
            best_cost, best, agrees = cost, path.copy(), len(path)
            continue
        moves = [(depth + 1, 4 * i + ADDED[q], cost + INSERT, "I")]
        if i < n:
            extra = TRUNCATED if faults[i] == TRUNCATED_ROW else 0
            moves.append((depth + 1, node + 4, cost + DELETE, "D"))
            if faults[i] not in (BLANK_ROW, DUPLICATE_ROW):
                moves.append((depth + 1, 4 * i + 4 + ADDED[q], cost + REROLE + extra, "R"))
                kept = AFTER.get((q, initials[i]))
                if kept is not None:
                    moves.append((depth + 1, 4 * i + 4 + kept, cost + extra, "K"))
        moves = [(m[2] + bounds[m[1]], m[3], m) for m in moves if m[2] + bounds[m[1]] <= best_cost]
        stack += [m for *_, m in sorted(moves, reverse=True)]  # least bound and letter come off first
    return best_cost, "".join(best)


def edits(initials: str, audit: str):
    """For each row (letter, roles of rows inserted before it, role it gets); the last item has
    no letter and holds the rows inserted behind all others. Inserts in front of a deleted
    row count for the next one that stays."""
    q, before, i = 0, "", 0
    for letter in audit:
        if letter == "I":
            before += NEXT_ROLE[q]
            q = ADDED[q]
            continue
        role = ""
        if letter == "R":
            role = ROLE[NEXT_ROLE[q]]
            q = ADDED[q]
        elif letter == "K":
            q = AFTER[q, initials[i]]
        yield (letter, "", "") if letter == "D" else (letter, before, role)
        before = before if letter == "D" else ""
        i += 1
    yield "", before, ""


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) with known faults: the CRC-32 of
    ``conv_id:turn`` modulo 20 decides (0 drops the row, 1 empties the text, 2 removes its
    ``[.!?]``, 3 repeats the row, 4 makes the role user)."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    text, role = F.coalesce(F.col(text_col).cast("string"), space), F.coalesce(F.col(role_col).cast("string"), space)
    return (conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
            .where("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies")))


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def placed(rows: DataFrame) -> DataFrame:
    """Rows with their place, in the shared folder: a number that rises along the order of
    each conversation, from one sort by range, which splits a long conversation over tasks.
    Equal rows stand side by side; a row that is to appear twice stays one row with ``copies``."""
    ordered = rows.orderBy(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    return write_shared(ordered.withColumn("place", F.monotonically_increasing_id() + 1), "conversation-rows")


def features(rows: DataFrame) -> DataFrame:
    """(conv_id, place, initial, fault, copies): all that the search reads of a row."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    picked = rows.select("conv_id", "place", "role", F.substring("role", 1, 1).alias("initial"), "copies",
                         F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"),
                         F.when(last == "", BLANK_ROW).when(~last.isin(".", "!", "?"), TRUNCATED_ROW).otherwise(0).alias("own"))
    first = picked.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place")).select(
        F.col("conv_id").alias("c"), F.col("place").alias("p"))
    joined = picked.join(first, _same(F.col("conv_id"), F.col("c")) & (F.col("place") == F.col("p")), "left")
    fault = F.when(F.col("own") == BLANK_ROW, BLANK_ROW).when(F.col("p").isNull(), DUPLICATE_ROW).otherwise(F.col("own"))
    return joined.select("conv_id", "place", "initial", fault.alias("fault"), "copies")


def searched(rows: DataFrame) -> DataFrame:
    """For each conversation one row of place 0 (counts, cost, audit) and one for each row
    that stays or has rows inserted before it; the place behind the last row, for those
    inserted at the end."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    dealt = (rows.withColumn("copies", F.col("copies").cast("long")).withColumn("fault", F.col("fault").cast("long"))
             .repartition("conv_id").sortWithinPartitions("conv_id", "place"))
    names = ["place", "copy", "letter", "before", "role", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * 5, pa.string()]

    def run(it):
        kind, current, held = None, None, []

        def done():
            place = [p for p, _, _, copies in held for _ in range(copies)]
            copy = [k for _, _, _, copies in held for k in range(copies)]
            initials = "".join([c or " " for _, c, _, copies in held for _ in range(copies)])
            faults = [DUPLICATE_ROW if k and f != BLANK_ROW else f for _, _, f, copies in held for k in range(copies)]
            cost, audit = search(initials, faults)
            illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
            yield (current, 0, 0, None, None, None, *(faults.count(k) for k in (BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW)), illegal, cost, audit)
            for p, k, (letter, before, role) in zip([*place, place[-1] + 1], [*copy, 0], edits(initials, audit)):
                if before or letter in ("K", "R"):
                    yield (current, p, k, letter, before, role, *[None] * 6)

        def rows_out():
            nonlocal kind, current, held
            for b in batches(it):
                kind = b.schema.field("conv_id").type
                for c, *row in zip(*(b.column(n).to_pylist() for n in ("conv_id", "place", "initial", "fault", "copies"))):
                    if held and c != current:
                        yield from done()
                        held = []
                    current = c
                    held.append(row)
            if held:
                yield from done()

        for some in batched(rows_out(), 8192):
            cols = list(zip(*some))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(c, t) for c, t in zip(cols[1:], types))], names=["conv_id", *names])

    fields = ", ".join(f"{n} {'string' if pa.types.is_string(t) else 'bigint'}" for n, t in zip(names, types))
    return dealt.mapInArrow(run, f"conv_id {conv}, {fields}")


def repaired_lines(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Edits and the rows that they keep, one stream per conversation in order: an edit comes
    before its row. ``kind`` 0 is an edit, 1 a row."""
    steps = found.where("place > 0").select("conv_id", "place", F.lit(0).alias("kind"), "copy", "letter", "before",
                                            F.col("role").alias("new_role"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    none = [F.lit(None).cast(t).alias(n) for n, t in (("copy", "long"), ("letter", "string"), ("before", "string"), ("new_role", "string"))]
    kept = rows.select("conv_id", "place", F.lit(1).alias("kind"), *none, "role", "text")
    return steps.unionByName(kept).repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind", "copy")


def hashed(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of every conversation with a row: ``role:text`` of the
    repaired rows joined by line breaks, hashed as they stream by."""
    conv = lines.schema["conv_id"].dataType.simpleString()

    def run(it):
        kind, current, open_ = None, None, False
        digest, first, steps, at = None, True, [], None
        ready: list[tuple] = []

        def line(role: str, text: bytes):
            nonlocal first
            if not first:
                digest.update(b"\n")
            first = False
            digest.update(utf8(role) + b":")
            digest.update(text)

        def flush():  # inserts that no row follows
            for _, before, _ in steps:
                for r in before or "":
                    line(ROLE[r], b"")

        def batch():
            cols = list(zip(*ready))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[1], pa.string())], names=["conv_id", "repaired_sha256"])

        for b in batches(it):
            kind = b.schema.field("conv_id").type
            for c, place, is_row, letter, before, new_role, role, text in zip(
                    *(b.column(n).to_pylist() for n in ("conv_id", "place", "kind", "letter", "before", "new_role", "role", "text"))):
                if not open_ or c != current:
                    if open_:
                        flush()
                        ready.append((current, digest.hexdigest()))
                        if len(ready) >= 4096:
                            yield batch()
                            ready.clear()
                    current, open_, digest, first, steps = c, True, hashlib.sha256(), True, []
                if not is_row:
                    steps.append((letter, before, new_role))
                    continue
                for letter_, before_, new_role_ in steps:
                    for r in before_ or "":
                        line(ROLE[r], b"")
                    if letter_ in ("K", "R"):
                        line(new_role_ or role, utf8(text))
                steps = []
        if open_:
            flush()
            ready.append((current, digest.hexdigest()))
        if ready:
            yield batch()

    return lines.mapInArrow(run, f"conv_id {conv}, repaired_sha256 string")


def repair(conversations: DataFrame, damaged: DataFrame | None = None) -> DataFrame:
    """One row per conv_id of ``conversations``: faults, cost, audit and the hash of the repaired
    conversation, over the rows of ``damaged`` (those of ``damage`` where not given)."""
    rows = placed(damage(conversations) if damaged is None else damaged)
    found = write_shared(searched(features(rows)), "conversation-edits")
    turns = rows.groupBy("conv_id").agg(F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count_distinct("turn").alias("n")).select(
        "conv_id", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n"), F.lit(0)).cast("long").alias("gaps"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = [conversations.select("conv_id").distinct(), turns,
             found.where("place = 0").select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"),
             hashed(repaired_lines(rows, found))]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    return every.groupBy("conv_id").agg(
        *(F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
