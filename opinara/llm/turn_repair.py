"""Repair of conversation structure by a run-length dynamic program.

A conversation's rows become symbols: must go (blank or seen earlier), or the role's
initial with or without a cut-off end. The legal orders of roles are a small automaton, so
the cheapest edits of a row are a matrix over its states in min-plus arithmetic. Equal
consecutive symbols are one run; a run advances by the binary powers of its matrix, which
a worker keeps. Matrices multiply associatively, so a conversation of any length is cut
into segments that many tasks reduce to a matrix each; products of these give the cost and
the states at the segments' ends, and each segment's choices are unrolled on their own.

Ties go to the least string of edits. Two equally dear strings over the same rows never
are prefixes of each other, so it is enough that a matrix keeps, for each start state,
the order of its end states' strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import small_batches
from opinara.session import stage

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
CUT_OFF = 3
#: States: nothing yet, after system, after user, after assistant; and where an inserted or renamed row leads.
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = range(4)
_TURN = (USER, USER, ASSISTANT, USER)
#: Inserts that end a conversation legally from each state.
_CLOSING = ("", "II", "I", "")
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_NEVER = 1 << 62
#: Symbols: 0 must go, else 1 + 2 * (place of the initial in "sua", 3: other) + (1: cut off).
_INITIALS = "sua"
#: Products that a worker remembers; only speed depends on it.
MEMORY = 200_000
_SPACE = r"\x20\x09-\x0D"


class Matrix:
    """Cheapest edits of some rows from each state to each: cost, the middle state, and the order of strings.

    ``texts`` holds a single row's strings; a product has its two factors instead.
    """

    def __init__(self, cost, order, mid=None, parts=None, texts=None):
        self.cost, self.order, self.mid, self.parts, self.texts = cost, order, mid, parts, texts
        self.then: dict[int, Matrix] = {}

    def times(self, other: Matrix) -> Matrix:
        cost, mid, order = [], [], []
        for p in _STATES:
            row, via, rank = self.cost[p], [], [0] * 4
            best = [min((row[r] + other.cost[r][q], self.order[p][r], r) for r in _STATES) for q in _STATES]
            via = [r for _, _, r in best]
            place = sorted(_STATES, key=lambda q: (self.order[p][via[q]], other.order[via[q]][q]))  # noqa: B023
            for k, q in enumerate(place):
                rank[q] = k
            cost.append([min(c, _NEVER) for c, _, _ in best])
            mid.append(via)
            order.append(rank)
        return Matrix(cost, order, mid, (self, other))

    def string(self, p: int, q: int) -> str:
        """The edits from state ``p`` to ``q``; balanced products of equal factors only."""
        if self.texts is not None:
            return self.texts[p][q]
        r = self.mid[p][q]
        return self.parts[0].string(p, r) + self.parts[1].string(r, q)


def row_matrix(symbol: int) -> Matrix:
    """Edits of a single row: inserts before it, then the row's own edit."""
    initial, cut = divmod(symbol - 1, 2)
    paths: list[list[tuple[int, str]]] = [[(_NEVER, "")] * 4 for _ in _STATES]
    for p in _STATES:
        state, cost, text = p, 0, ""
        for _ in range(3):
            ends = [(state, DELETE, "D")]
            if symbol:
                ends.append((_TURN[state], REROLE + CUT_OFF * cut, "R"))
                own = initial + 1 if initial < 3 else None
                if own is not None and (own == _TURN[state] or (own == SYSTEM and state == START)):
                    ends.append((own, KEEP + CUT_OFF * cut, "K"))
            for q, more, edit in ends:
                paths[p][q] = min(paths[p][q], (cost + more, text + edit))
            state, cost, text = _TURN[state], cost + INSERT, text + "I"
    order = []
    for row in paths:
        place = sorted(_STATES, key=lambda q: (row[q][0] >= _NEVER, row[q][1]))  # noqa: B023
        order.append([place.index(q) for q in _STATES])
    return Matrix([[c for c, _ in row] for row in paths], order, texts=[[t for _, t in row] for row in paths])


class Repairer:
    """Products of runs, through a worker's memory of binary powers and of shared beginnings."""

    def __init__(self):
        self.powers: list[list[Matrix]] = [[row_matrix(s)] for s in range(9)]
        self.forget()

    def forget(self) -> None:
        never = [[0 if p == q else _NEVER for q in _STATES] for p in _STATES]
        self.one = Matrix(never, [list(_STATES)] * 4, texts=[[""] * 4] * 4)
        self.kept = 0

    def power(self, symbol: int, k: int) -> Matrix:
        """Of ``2 ** k`` rows alike."""
        own = self.powers[symbol]
        while len(own) <= k:
            own.append(own[-1].times(own[-1]))
        return own[k]

    def fold(self, runs: list[tuple[int, int]]) -> list[tuple[Matrix, Matrix]]:
        """After each power of each run: the product so far, and the power."""
        if self.kept > MEMORY:
            self.forget()
        now, out = self.one, []
        for symbol, n in runs:
            for k in range(n.bit_length() - 1, -1, -1):
                if n >> k & 1:
                    key = symbol << 8 | k
                    after = now.then.get(key)
                    if after is None:
                        after = self.power(symbol, k) if now is self.one else now.times(self.power(symbol, k))
                        if now is self.one:
                            after = Matrix(after.cost, after.order, [[p] * 4 for p in _STATES], (self.one, after))
                        now.then[key] = after
                        self.kept += 1
                    now = after
                    out.append((now, self.power(symbol, k)))
        return out

    def unroll(self, runs: list[tuple[int, int]], p: int, q: int) -> str:
        """The edits of the runs from state ``p`` to ``q``, found from the last power to the first."""
        pieces = []
        for product, power in reversed(self.fold(runs)):
            before = product.mid[p][q]
            pieces.append(power.string(before, q))
            q = before
        return "".join(reversed(pieces))


_WORKERS: list[Repairer] = []


def _repairer() -> Repairer:
    if not _WORKERS:
        _WORKERS.append(Repairer())
    return _WORKERS[0]


def _join(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join where ``names`` are equal or both null; the right side's other columns follow the left's."""
    same = [F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}")) for n in names]
    return left.alias("l").join(right.alias("r"), same, how).select("l.*", *(f"r.{c}" for c in right.columns if c not in names))


def place_turns(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows in order with their faults, equal rows as one with ``copies``; staged.

    Columns: conv, turn, role, text, copies, fault (of the first copy: blank, duplicate,
    truncated or none; more copies are blank or duplicates), place (ascending in order of
    conv, turn, role, text, nulls first) and part: the segment of the conversation.
    """
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        *(F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(" ")).alias(a) for n, a in ((role, "role"), (text, "text"))),
    )
    lines = stage(
        rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("digest", F.sha2("text", 256)), "turns"
    )
    # The least turn of each text in a conversation; structs order nulls first.
    first = lines.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    joined = _join(lines, first, ["conv", "role", "digest"]).withColumn("again", F.struct("turn") > F.col("first"))
    fault = (
        F.when(~F.col("text").rlike(f"[^{_SPACE}]"), "blank").when(F.col("again"), "duplicate")
        .when(~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z"), "truncated").otherwise("")
    )
    order = ["conv", "turn", "role", "text"]
    placed = joined.select(*order, "copies", fault.alias("fault")).repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    return stage(placed.select("*", place.alias("place"), F.shiftright(place, 33).alias("part")), "turns-placed")


def _segments(placed: DataFrame) -> DataFrame:
    """Per conversation and part: its runs, the product of their matrices, and the initials at its ends; staged."""
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), 0).otherwise(
        1 + 2 * F.when(F.substring("role", 1, 1).isin(*_INITIALS), F.instr(F.lit(_INITIALS), F.substring("role", 1, 1)) - 1).otherwise(3)
        + (F.col("fault") == "truncated").cast("int")
    )
    rows = placed.select("conv", "part", "place", "copies", symbol.alias("symbol"), F.substring("role", 1, 1).alias("initial"))
    kind = placed.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, segment, owner = _repairer(), None, None
        runs: list[list[int]] = []
        ends = ["", ""]
        illegal = 0
        done: list[tuple] = []

        def finish() -> None:
            product = work.fold(list(map(tuple, runs)))[-1][0]
            done.append((*segment, *ends, illegal, np.array(runs, "<i8").tobytes(), sum(product.cost, []), sum(product.order, [])))

        def out() -> pa.RecordBatch:
            columns = list(zip(*done))
            types = [owner, pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _SEGMENT)

        for batch in batches:
            owner = batch.column(0).type
            for conv, part, _, copies, symbol, initial in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != (conv, part):
                    if segment:
                        finish()
                    segment, runs, ends, illegal = (conv, part), [], [initial, initial], 0
                else:
                    illegal += ends[1] + initial not in ("su", "ua", "au")
                ends[1] = initial
                illegal += copies - 1
                for s, n in ((symbol, 1), (0, copies - 1)):
                    if n and runs and runs[-1][0] == s:
                        runs[-1][1] += n
                    elif n:
                        runs.append([s, n])
            if done:
                yield out()
                done = []
        if segment:
            finish()
            yield out()

    dealt = rows.repartition("conv", "part").sortWithinPartitions("conv", "part", "place")
    schema = f"conv {kind}, part long, first string, last string, illegal long, runs binary, cost array<long>, orders array<int>"
    return stage(dealt.mapInArrow(run, schema), "turn-segments")


_SEGMENT = ["conv", "part", "first", "last", "illegal", "runs", "cost", "orders"]


def _states(segments: DataFrame) -> DataFrame:
    """Per conversation and part: the states at its ends, whether it is the last, the conversation's
    cost, and 1 if the roles where it meets the part before are illegal.

    A task holds the matrices of one conversation's segments, a row per partition at most.
    """
    rows = segments.select("conv", "part", "first", "last", "cost", "orders")
    kind = segments.schema["conv"].dataType.simpleString()

    def solve(own: list[tuple]) -> list[tuple]:
        fold: list[Matrix] = []
        for *_, cost, order in own:
            here = Matrix([cost[k : k + 4] for k in (0, 4, 8, 12)], [order[k : k + 4] for k in (0, 4, 8, 12)])
            fold.append(fold[-1].times(here) if fold else here)
        whole = fold[-1]
        total, _, state = min((whole.cost[START][q] + INSERT * len(_CLOSING[q]), whole.order[START][q], q) for q in _STATES)
        out = []
        for k in range(len(own) - 1, -1, -1):
            entry = fold[k].mid[START][state] if k else START
            meets = own[k - 1][3] + own[k][2] if k else "su"
            out.append((*own[k][:2], entry, state, k == len(own) - 1, total, int(meets not in ("su", "ua", "au"))))
            state = entry
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        owner = None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            types = [owner, pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["conv", "part", "entry", "exit", "is_last", "total", "meets"]
            )

        for batch in batches:
            owner = batch.column(0).type
            held += zip(*(c.to_pylist() for c in batch.columns))
            groups = [list(g) for _, g in groupby(held, key=lambda r: r[0])]
            held = groups.pop()
            if groups:
                yield out([r for g in groups for r in solve(g)])
        if held:
            yield out(solve(held))

    dealt = rows.repartition("conv").sortWithinPartitions("conv", "part")
    return dealt.mapInArrow(run, f"conv {kind}, part long, entry int, exit int, is_last boolean, total long, meets long")


def audits(segments: DataFrame) -> DataFrame:
    """Per conversation and part: the part's edits as a string, the state before it, and the figures of ``_states``; staged."""
    states = _states(segments)
    joined = _join(segments, states, ["conv", "part"]).select(
        "conv", "part", "runs", "entry", "exit", "is_last", "total", (F.col("illegal") + F.col("meets")).alias("illegal")
    )
    kind = segments.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _repairer()
        for batch in batches:
            pieces = []
            for runs, p, q, last in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5))):
                own = list(map(tuple, np.frombuffer(runs, "<i8").reshape(-1, 2).tolist()))
                pieces.append(work.unroll(own, p, q) + (_CLOSING[q] if last else ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(pieces, pa.string()), batch.column(6), batch.column(7)],
                ["conv", "part", "entry", "piece", "total", "illegal"],
            )

    return stage(joined.mapInArrow(run, f"conv {kind}, part long, entry int, piece string, total long, illegal long"), "turn-audits")


def _edited(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """The repaired rows: conv, place, seq (order within a place), turn, role, text, edit (K, R or I)."""
    rows = placed.select("conv", "part", F.lit(1).alias("kind"), "place", "copies", "turn", "role", "text")
    both = pieces.select("conv", "part", F.lit(0).alias("kind"), "entry", "piece").unionByName(rows, allowMissingColumns=True)
    dealt = both.select("conv", "part", "kind", "place", "copies", "turn", "role", "text", "entry", "piece").repartition(
        "conv", "part"
    ).sortWithinPartitions("conv", "part", "kind", "place")
    kinds = {n: placed.schema[n].dataType.simpleString() for n in ("conv", "turn")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, at, state, last, seq = "", 0, START, None, 0
        done: list[tuple] = []
        types: list[pa.DataType] = []

        def inserts() -> None:
            nonlocal at, state, seq
            while at < len(piece) and piece[at] == "I":
                state = _TURN[state]
                done.append((*last, seq, None, _ROLES[state], "", "I"))
                at, seq = at + 1, seq + 1

        for batch in batches:
            types = [batch.column(0).type, pa.int64(), pa.int64(), batch.column(5).type, *[pa.string()] * 3]
            for conv, _, kind, place, copies, turn, role, text, entry, own in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if last:
                        inserts()
                    piece, at, state, last, seq = own, 0, entry, None, 0
                    continue
                last, seq = (conv, place), 0
                for _ in range(copies):
                    inserts()
                    edit, at = piece[at], at + 1
                    if edit == "D":
                        continue
                    state = _INITIALS.index(role[0]) + 1 if edit == "K" else _TURN[state]
                    done.append((conv, place, seq, turn, role if edit == "K" else _ROLES[state], text, edit))
                    seq += 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], _EDITED)
                done = []
        if last:
            inserts()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], _EDITED)

    return dealt.mapInArrow(run, f"conv {kinds['conv']}, place long, seq long, turn {kinds['turn']}, role string, text string, edit string")


_EDITED = ["conv", "place", "seq", "turn", "role", "text", "edit"]


def repair(
    turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The cheapest legal form of each conversation: its rows, and a report per conversation.

    Legal orders of roles are nothing, or user and assistant in turn, ending with the
    assistant, with or without a system row in front. Rows that are blank or repeat an
    earlier role and text are deleted (4); others are kept (0), given the role of the
    place (3) or deleted; rows with empty text are inserted (3); rows that end without a
    closing mark cost 3 if they stay.

    The rows: conv, place and seq (their order), turn (null if inserted), role, text, edit.
    The report: conv, gaps, blank, duplicate, truncated, illegal, cost, audit (the edits'
    initials, the least of the cheapest).

    Rows are taken by turn, nulls first, ties by role and text. Null roles and texts are
    one blank. A null ``conv_id`` is a conversation of its own. Other columns are left out;
    an empty table gives no rows. No task holds a whole conversation, only its own segment
    and, in ``_states``, a matrix for each segment; the report's ``audit`` is one string.
    """
    small_batches(turns.sparkSession, 4096)
    placed = place_turns(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    pieces = audits(_segments(placed))
    copies, fault = F.col("copies"), F.col("fault")
    figures = placed.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(fault == "blank", copies).otherwise(0)).alias("blank"),
        F.sum(F.when(fault == "duplicate", copies).when(fault == "blank", 0).otherwise(copies - 1)).alias("duplicate"),
        F.sum((fault == "truncated").cast("long")).alias("truncated"),
    )
    edits = pieces.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.max("total").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "piece"))), lambda x: x["piece"]), "").alias("audit"),
    )
    report = _join(figures, edits, ["conv"]).select(
        "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    return _edited(placed, pieces), report


def line_digests(rows: DataFrame) -> DataFrame:
    """Per conversation of ``repair``'s rows: repaired_sha256 of ``role:text``, joined by line breaks.

    Rows stream through the digest in order, so a task holds a batch of them at a time.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    dealt = rows.select("conv", "place", "seq", "role", "text").repartition("conv").sortWithinPartitions("conv", "place", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, now = None, None
        owner = None

        def out(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (owner, pa.string()))], ["conv", "repaired_sha256"])

        for batch in batches:
            owner, done = batch.column(0).type, []
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4))):
                if digest is None or conv != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    digest, now = hashlib.sha256(), conv
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if done:
                yield out(done)
        if digest is not None:
            yield out([(now, digest.hexdigest())])

    return dealt.mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut off, repeated and given the user's role, by a hash of id and turn."""
    space = F.lit(" ")
    conv, turn, role, text = (F.coalesce(F.col(n).cast("string"), space) for n in ("conv_id", "turn", "role", "text"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    return turns.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("_"),
    ).drop("_")


def repair_digest(originals: DataFrame, damaged: DataFrame) -> DataFrame:
    """Every conversation of ``originals``: the report on ``damaged`` and the digest of the repaired rows.

    Conversations without rows have zeros, an empty audit and the empty string's digest.
    """
    rows, report = repair(damaged)
    digests = line_digests(rows)
    every = originals.select(F.col("conv_id").alias("conv")).distinct()
    joined = _join(_join(every, report, ["conv"], "left"), digests, ["conv"], "left")
    return joined.select(
        F.col("conv").alias("conv_id"),
        *(F.coalesce(n, F.lit(0)).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
