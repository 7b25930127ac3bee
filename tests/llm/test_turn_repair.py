import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import pytest

from opinara.llm import turn_repair as t

LEGAL = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """Plain search, row by row and text by text: the least (cost, edits, rows) of one conversation."""
    goals = []
    heap = [(0, "", 0, "", ())]
    seen = set()
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if goals and cost > goals[0][0]:
            break
        state = (at, roles[-1:] or "-")
        if (*state, cost, audit) in seen:
            continue
        seen.add((*state, cost, audit))
        if at == len(rows) and LEGAL.fullmatch(roles):
            goals.append((cost, audit, out))
            continue
        def go(more, edit, ahead, role, text):
            now = roles + role[:1]
            if re.fullmatch("(s?(ua)*u?)?", now):
                heapq.heappush(heap, (cost + more, audit + edit, at + ahead, now, (*out, (role, text)) if role else out))
        if audit[-4:] != "IIII":
            for role in ("user", "assistant"):
                go(3, "I", 0, role, "")
        if at < len(rows):
            role, text, fault = rows[at]
            go(4, "D", 1, "", "")
            if fault not in ("blank", "duplicate"):
                dear = 3 * (fault == "truncated")
                go(dear, "K", 1, role, text) if role else None
                for new in ("user", "assistant"):
                    go(3 + dear, "R", 1, new, text)
    return min(goals)


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(table):
    """conv_id, turn, role, text rows to the digest's rows, for rows already damaged."""
    by = {}
    for conv, turn, role, text in table:
        by.setdefault(conv, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, rows in by.items():
        rows.sort()
        marked = faults([r[2:] for r in rows])
        count = Counter(f for *_, f in marked)
        turns = [n for known, n, *_ in rows if known]
        cost, audit, kept = cheapest(marked)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
ROLES = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "User"]
TEXTS = ["Yes.", "No!", "why?  \n", "cut", "", " \t", None, "ok. but", "x"]


def got(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_random_conversations_as_a_plain_search_finds_them(spark):
    r = random.Random(5)
    table = [
        (conv if conv else None, r.choice([None, *range(6)]), r.choice(ROLES), r.choice(TEXTS))
        for conv in range(250) for _ in range(r.randint(1, 6))
    ]
    docs = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    assert got(t.repair_digest(docs, docs)) == expected(table)


@pytest.mark.parametrize("partitions", [1, 9])
def test_long_runs_and_hot_conversations_over_many_tasks(spark, partitions):
    """One conversation holds most rows; segments are cut wherever tasks end."""
    r = random.Random(partitions)
    table = [(7, n, r.choice(["user", "user", "assistant"]), f"{n}." if n % 5 else f"{n}") for n in range(60)]
    table += [(8, n // 20, "user", "same.") for n in range(60)] + [(9, n, "assistant", f"{n}!") for n in range(40)]
    docs = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = t.place_turns(docs)
        assert placed.where("conv = 7").select("part").distinct().count() > (1 if partitions > 1 else 0)
        found = got(t.repair_digest(docs, docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    for conv, row in plain(table).items():
        assert found[conv] == row


def plain(table):
    """As ``expected``, by a row-by-row table of costs to go, for conversations too long to search."""
    out = {}
    for conv in {c for c, *_ in table}:
        rows = sorted((turn, role, text) for c, turn, role, text in table if c == conv)
        marked = faults([x[1:] for x in rows])
        nexts = {"-": "u", "s": "u", "u": "a", "a": "u"}
        end = {"-": 0, "s": 6, "u": 3, "a": 0}
        togo = [end]
        for role, _, fault in reversed(marked):
            after, here = togo[0], {}
            for q in "-sua":
                options = [4 + after[q]]
                if fault not in ("blank", "duplicate"):
                    dear = 3 * (fault == "truncated")
                    options.append(3 + dear + after[nexts[q]])
                    if role[:1] == nexts[q] or (role[:1] == "s" and q == "-"):
                        options.append(dear + after[role[:1]])
                here[q] = min(options)
            for _ in range(3):
                here = {q: min(here[q], 3 + here[nexts[q]]) for q in here}
            togo.insert(0, here)
        state, audit, kept, at = "-", "", [], 0
        while at < len(marked) or state in "su":
            cost = togo[at][state]
            if at < len(marked):
                role, text, fault = marked[at]
                dear = 3 * (fault == "truncated")
                fine = fault not in ("blank", "duplicate")
                legal = role[:1] == nexts[state] or (role[:1] == "s" and state == "-")
                if cost == 4 + togo[at + 1][state]:
                    audit, at = audit + "D", at + 1
                    continue
            if cost == 3 + togo[at][nexts[state]]:
                state, audit = nexts[state], audit + "I"
                kept.append(("user" if state == "u" else "assistant", ""))
            elif fine and legal and cost == dear + togo[at + 1][role[:1]]:
                state, audit, at = role[:1], audit + "K", at + 1
                kept.append((role, text))
            else:
                state, audit, at = nexts[state], audit + "R", at + 1
                kept.append(("user" if state == "u" else "assistant", text))
        count = Counter(f for *_, f in marked)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        turns = [x[0] for x in rows]
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)), count["blank"], count["duplicate"], count["truncated"], illegal,
            togo[0]["-"], audit, digest,
        )
    return out


def test_powers_of_long_runs_cost_few_products():
    work = t.Repairer()
    runs = [(3, 1_000_000), (5, 999_999), (0, 12)]
    assert len(work.fold(runs)) < 45
    product = work.fold(runs)[-1][0]
    q = min(range(4), key=lambda q: product.cost[t.START][q])
    audit = work.unroll(runs, t.START, q)
    assert sum({"D": 4, "I": 3, "K": 0, "R": 3}[e] for e in audit) == product.cost[t.START][q]
    assert sum(e != "I" for e in audit) == 2_000_011 and audit.endswith("D" * 12)


def test_damage_and_conversations_without_rows(spark):
    r = random.Random(2)
    table = [(c, n, r.choice(["user", "assistant"]), r.choice(["Hi. There", "Yes!", None])) for c in range(200) for n in range(r.randint(1, 3))]
    docs = spark.createDataFrame([(*x, 1.0, "z") for x in table], "conv_id long, turn long, role string, text string, place double, part string")
    hurt = []
    for c, n, role, text in table:
        text, kind = " " if text is None else text, zlib.crc32(f"{c}:{n}".encode()) % 20
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        hurt += [(c, n, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    want = expected(hurt)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = got(t.repair_digest(docs, t.damage(docs)))
    assert found == {c: want.get(c, nothing) for c in range(200)}
    assert nothing in found.values()
    empty = docs.where("false")
    assert t.repair_digest(empty, t.damage(empty)).count() == 0
