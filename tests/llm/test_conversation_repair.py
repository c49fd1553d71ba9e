"""Conversation repair against an enumeration of all edit sequences."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from bramble.llm import conversation_repair as cr
from bramble.llm import queries
from conftest import SF_MID, SF_SMALL
from oracle_harness import duck

SHAPE = re.compile(r"(s?(ua)+)?")


def brute_search(initials, faults):
    """Least (cost, audit, output) over all edits; at most two inserts in a row."""
    best = [4 * len(initials), "D" * len(initials), []]

    def go(i, cost, audit, out, run):
        if cost > best[0]:
            return
        if i == len(initials) and SHAPE.fullmatch("".join(r for r, _ in out)) and (cost, audit) <= (best[0], best[1]):
            best[:] = [cost, audit, out]
        if run < 2:
            for r in "ua":
                go(i, cost + 3, audit + "I", [*out, (r, None)], run + 1)
        if i == len(initials):
            return
        go(i + 1, cost + 4, audit + "D", out, 0)
        if faults[i] in (1, 2):
            return
        extra = 3 * (faults[i] == 3)
        go(i + 1, cost + extra, audit + "K", [*out, (initials[i], i)], 0)
        for r in "ua":
            go(i + 1, cost + 3 + extra, audit + "R", [*out, (r, i)], 0)

    go(0, 0, "", [], 0)
    return best


def forward_search(initials, faults):
    """The same for longer conversations: the least repair of every prefix by what it ends in."""

    def grown(table, moves):
        out = {}
        for roles, (cost, audit, made) in table.items():
            for added, letter, role, k in moves(roles):
                key = roles if role is None else {"s": "s", "u": "u", "a": "a"}[role]
                item = (cost + added, audit + letter, made if role is None else [*made, (role, k)])
                if key not in out or item[:2] < out[key][:2]:
                    out[key] = item
        return out

    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    def with_inserts(table):
        for _ in range(3):
            more = grown(table, lambda last: [(3, "I", r, None) for r in follows[last] if r != "s"])
            table = {k: min((t[k] for t in (table, more) if k in t), key=lambda x: x[:2]) for k in {**table, **more}}
        return table

    table = {"": (0, "", [])}
    for i, (c, fault) in enumerate(zip(initials, faults)):
        def moves(last):
            out = [(4, "D", None, i)]
            if fault not in (1, 2):
                extra = 3 * (fault == 3)
                out += [(3 + extra, "R", r, i) for r in follows[last] if r != "s"]
                out += [(extra, "K", c, i)] if c in follows[last] else []
            return out
        table = grown(with_inserts(table), moves)
    table = with_inserts(table)
    return list(min((table[k] for k in ("", "a") if k in table), key=lambda x: x[:2]))


def test_search_equals_enumeration():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(0, 5)
        initials = "".join(rng.choice("suua x"[:5 + rng.randrange(2)]) for _ in range(n))
        faults = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        cost, audit, out = brute_search(initials, faults)
        assert cr.search(initials, faults) == (cost, audit), (initials, faults)
        assert tuple(forward_search(initials, faults)) == (cost, audit, out)
        made = []
        for k, (letter, before, role) in enumerate(cr.edits(initials, audit)):
            made += [(r, None) for r in before]
            if letter in ("K", "R"):
                made.append((role[:1] or initials[k], k))
        assert made == out


def test_search_is_linear_on_long_conversations():
    rng = random.Random(4)
    n = 100_000
    initials = "".join(rng.choice("sua ") for _ in range(n))
    cost, audit = cr.search(initials, [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)])
    assert cost > 0 and sum(c in "KRD" for c in audit) == n


def brute(rows):
    """conv_id -> result row, from (conv_id, turn, role, text)."""
    damaged, ids = defaultdict(list), {c for c, *_ in rows}
    for c, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged[c] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = set()
    for c in ids:
        own = sorted(damaged[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = "".join(role[:1] or " " for _, role, _ in own)
        turns = [t for t, *_ in own if t is not None]
        cost, audit, made = forward_search(initials, faults)
        lines = [f"{own[k][1] if k is not None and own[k][1][:1] == r else {'u': 'user', 'a': 'assistant'}[r]}:{'' if k is None else own[k][2]}" for r, k in made]
        out.add((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
                 sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                 hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def test_query_equals_enumeration(spark):
    for sf in (SF_SMALL, SF_MID):
        rows = duck(sf).execute("select conv_id, turn, role, text from conversations").fetchall()
        got = queries.op13_conversation_repair(spark, sf)
        assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 7 + ["string"] * 2
        assert set(map(tuple, got.collect())) == brute(rows)


def odd():
    rng = random.Random(9)
    rows = []
    for c in range(120):
        for t in range(rng.randrange(0, 6)):
            rows.append((c, rng.choice([t, t, t, None, t + 2]), rng.choice(["user", "assistant", "system", "", None, "Ünknown", "user"]),
                         rng.choice([None, "", " \t\x0b", "Yes.", "Yes.", "no", "end?  ", "🙂", "a.\xa0", "two\nlines!"])))
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (2 ** 40, -3, "system", "Be good.")]
    return rows


def test_odd_rows(spark):
    rows = odd()
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, place string, copies int")
    got = list(map(tuple, cr.repair(df).collect()))
    assert set(got) == brute(rows) and len(got) == len({r[0] for r in rows})
    assert cr.repair(df.limit(0)).count() == 0


def test_long_conversation_in_small_batches(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} " + "x" * 2000 + ".") for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = cr.repair(df).first()
    assert r.audit.count("K") > 1000 and r.cost > 0 and r.duplicate > 50
