"""Repair of the turn structure of conversations by depth-first branch and bound.

A conversation's rows are kept, given another role or deleted, and rows without text are
inserted, so that the roles read: maybe a system row, then user and assistant in turn. The
search walks the tree of edit strings with an explicit stack, letters in ASCII order. A node is
(rows handled, role written last); its table entry is the least cost it was reached with. As the
walk is in the order of the strings, a prefix that comes to a node later at the same cost is a
greater string: it is dominated, like every dearer one. What a suffix costs at least is the sum
of its rows' own least costs and, for disjoint pairs of neighbours that cannot both stay as they
are, one more edit each. The incumbent (cost, audit) ends every branch that cannot beat it; when
the stack is empty it is proved to be the best.

Long conversations are searched in blocks of rows. At the end of a block the best prefix of each
role written last goes on: there are four at most, and none begins another, so their order is
that of the whole strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import scratch

START, SYSTEM, USER, ASSISTANT = range(4)  # the role written last
# A row's code: its role's initial (s, u, a, any other), and whether it must go or is truncated.
S, U, A, OTHER = range(4)
MUST_GO, TRUNCATED = 4, 8
NEXT = {(START, S): SYSTEM, (START, U): USER, (SYSTEM, U): USER, (USER, A): ASSISTANT, (ASSISTANT, U): USER}
WRITTEN = {START: U, SYSTEM: U, USER: A, ASSISTANT: U}  # what an insertion or a new role must be
ROLES = {U: "user", A: "assistant"}
LEGAL = {(S, U), (U, A), (A, U)}

BLOCK = 256
SHORT = 64  # rows of a conversation whose codes are looked up among those already solved
WHITE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Costs:
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1  # for each truncated row that stays

    def __post_init__(self) -> None:
        if min(self.rerole, self.delete, self.insert) < 1 or self.truncated < 0:
            raise ValueError("edits cost at least 1")


class _Bounds:
    """Least cost of the rows from the i-th on, by the role written last."""

    def __init__(self, codes: bytes, costs: Costs, last: bool) -> None:
        n = len(codes)
        self.codes, self.costs, self.last = codes, costs, last
        self.own, self.pairs, self.head = [0] * (n + 1), [0] * (n + 2), [n] * (n + 1)
        for i in range(n - 1, -1, -1):
            code = codes[i]
            if code & MUST_GO:
                self.own[i] = self.own[i + 1] + costs.delete
                self.pairs[i], self.head[i] = self.pairs[i + 1], self.head[i + 1]
                continue
            cut = costs.truncated * (code >= TRUNCATED)
            role, j = code & 3, self.head[i + 1]
            stay = cut + (costs.rerole if role == OTHER else 0)
            self.own[i] = self.own[i + 1] + min(costs.delete, stay)
            self.head[i] = i
            paired = 0
            if role != OTHER:
                if j == n:
                    paired = self._extra(i) if last and role != A else 0
                elif codes[j] & 3 != OTHER and (role, codes[j] & 3) not in LEGAL:
                    paired = min(self._extra(i), self._extra(j)) + self.pairs[j + 1]
            self.pairs[i] = max(self.pairs[i + 1], paired)

    def _extra(self, i: int) -> int:
        """What one edit at the row or beside it adds to the row's own least cost, at least."""
        stay = self.costs.truncated * (self.codes[i] >= TRUNCATED)
        return max(0, min(self.costs.insert, self.costs.rerole, self.costs.delete - stay))

    def __call__(self, i: int, state: int) -> int:
        n, h = len(self.codes), self.head[i]
        if h == n:
            missing = {SYSTEM: 2, USER: 1}.get(state, 0) if self.last else 0
            return self.own[i] + missing * self.costs.insert
        role, more = self.codes[h] & 3, self.pairs[i]
        if role != OTHER and (state, role) not in NEXT:
            more = max(more, self._extra(h) + self.pairs[h + 1])
        return self.own[i] + more


def _straight(codes: bytes, state: int, costs: Costs) -> int:
    """Cost of a plain repair that ends with an assistant's row (or nothing): an upper bound."""
    total = 0
    for code in codes:
        role, cut = code & 3, costs.truncated * (code >= TRUNCATED)
        if code & MUST_GO:
            total += costs.delete
        elif (state, role) in NEXT:
            total, state = total + cut, NEXT[state, role]
        elif role in (U, A):
            total, state = total + cut + costs.insert, ASSISTANT if role == A else USER
        elif costs.delete <= costs.rerole + cut:
            total += costs.delete
        else:
            total, state = total + costs.rerole + cut, NEXT[state, WRITTEN[state]]
    return total + {SYSTEM: 2, USER: 1}.get(state, 0) * costs.insert


def _audit(link: tuple | None) -> str:
    letters = []
    while link is not None:
        link, letter = link
        letters.append(letter)
    return "".join(reversed(letters))


def search(codes: bytes, entries: list[tuple[int, int]], costs: Costs, last: bool
           ) -> dict[int, tuple[int, int, str]]:
    """Best (cost, entry, audit) by the role written last. ``entries``: (role written last, cost so
    far), in the order of their audits. For the ``last`` block only what may be the end."""
    n, bound = len(codes), _Bounds(codes, costs, last)
    most = min(cost + _straight(codes, state, costs) for state, cost in entries)
    if last:
        most = min([most, *(cost + costs.delete * n for state, cost in entries if state == START)])
    # Beyond this a prefix is worse than another one with edits that make up for its state.
    slack = 0 if last else max(costs.insert, costs.delete)
    least: dict[tuple[int, int], int] = {}
    found: dict[int, tuple[int, int, tuple | None]] = {}
    proved = False
    stack = [(0, state, cost, None, e) for e, (state, cost) in reversed(list(enumerate(entries)))]
    while stack:
        i, state, cost, link, entry = stack.pop()
        if least.get((i, state), cost + 1) <= cost:
            continue
        reach = cost + bound(i, state)
        if reach > most + slack or (proved and reach >= most):
            continue
        least[i, state] = cost
        if i == n and (not last or state in (START, ASSISTANT)):
            if last:
                found, most, proved = {state: (cost, entry, link)}, cost, True
            else:
                found[state] = (cost, entry, link)
            continue
        # Pushed from the last letter to the first, so that they are taken in order.
        if i < n:
            code = codes[i]
            cut = costs.truncated * (code >= TRUNCATED)
            if not code & MUST_GO:
                stack.append((i + 1, NEXT[state, WRITTEN[state]], cost + costs.rerole + cut, (link, "R"), entry))
                if (to := NEXT.get((state, code & 3))) is not None:
                    stack.append((i + 1, to, cost + cut, (link, "K"), entry))
        stack.append((i, NEXT[state, WRITTEN[state]], cost + costs.insert, (link, "I"), entry))
        if i < n:
            stack.append((i + 1, state, cost + costs.delete, (link, "D"), entry))
    return {state: (cost, entry, _audit(link)) for state, (cost, entry, link) in found.items()}


class Solver:
    """Takes a conversation's codes one by one; a block is searched as soon as it is full."""

    def __init__(self, costs: Costs, block: int = BLOCK) -> None:
        self.costs, self.block = costs, block
        self.codes = bytearray()
        self.entries: list[tuple[int, int]] = [(START, 0)]
        self.done: list[list[tuple[int, str]]] = []  # of each block: (entry, audit) of its exits

    def add(self, code: int) -> None:
        if len(self.codes) == self.block:
            self._search(False)
        self.codes.append(code)

    def _search(self, last: bool) -> None:
        found = search(bytes(self.codes), self.entries, self.costs, last)
        ordered = sorted(found.items(), key=lambda s: s[1][1:])
        self.entries = [(state, cost) for state, (cost, _, _) in ordered]
        self.done.append([(entry, audit) for _, (_, entry, audit) in ordered])
        self.codes.clear()

    def end(self) -> tuple[int, str]:
        """Cost and audit of the whole conversation."""
        if not self.done and len(self.codes) <= SHORT:
            return _solved(bytes(self.codes), self.costs)
        self._search(True)
        at, parts = 0, []
        for exits in reversed(self.done):
            at, audit = exits[at]
            parts.append(audit)
        return self.entries[0][1], "".join(reversed(parts))


@lru_cache(maxsize=1 << 15)
def _solved(codes: bytes, costs: Costs) -> tuple[int, str]:
    ((cost, _, audit),) = search(codes, [(START, 0)], costs, True).values()
    return cost, audit


# ---- rows ----

KEYS = ["_conv", "_turn", "_role", "_sign"]  # a conversation's rows are taken in this order


def _named(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    said = F.coalesce(df[text], F.lit(""))
    return df.select(df[conv].alias("_conv"), df[turn].cast("long").alias("_turn"),
                     F.coalesce(df[role], F.lit("")).alias("_role"), said.alias("_text"),
                     F.unhex(F.sha2(said, 256)).alias("_sign"))


def _ends_well(text: Column) -> Column:
    end = F.rtrim(text, F.lit(WHITE))
    return end.endswith(".") | end.endswith("!") | end.endswith("?")


def report(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           costs: Costs = Costs()) -> DataFrame:
    """One row per conversation: ``conv``, gaps, blank, duplicate, truncated, illegal, cost (longs), audit.

    Rows are taken by turn (nulls first), of equal turns by role and then the text's SHA-256; null
    roles and texts count as empty. A row without anything but white space is blank; one with role
    and text of an earlier row is a duplicate; both must go. One that does not end in ``.``, ``!``
    or ``?`` is truncated. Only roles that begin with s, u or a are legal. audit has an initial
    per edit (Keep, Rerole, Delete, Insert): of the cheapest strings the least. gaps: turns missing
    between the first and the last, nulls ignored. A null conversation id is a conversation.
    Other columns play no part; without rows there is no conversation.

    Texts are not moved, only their digests. Equal rows are counted before they move. What one
    task holds of a conversation is a byte per row of a block and the audits of the blocks before.
    """
    rows = _named(df, conv, turn, role, text)
    rows = rows.select(*KEYS, (F.rtrim("_text", F.lit(WHITE)) == "").alias("blank"),
                       (~_ends_well(F.col("_text"))).alias("cut"))
    counted = rows.groupBy(*KEYS, "blank", "cut").agg(F.count("*").alias("n"))
    same = Window.partitionBy("_conv", "_role", "_sign").orderBy(F.col("_turn").asc_nulls_first())
    letter = F.instr(F.lit("sua"), F.substring("_role", 1, 1))
    coded = F.when((letter > 0) & (F.col("_role") != ""), letter - 1).otherwise(OTHER)
    ordered = counted.repartition("_conv").withColumn("first", F.row_number().over(same) == 1).select(
        "_conv", "_turn", "_role", "_sign", "n", "blank", "cut", "first", coded.cast("int").alias("role"))
    ordered = ordered.sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in KEYS)).drop("_role", "_sign")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = T.StructType([T.StructField("_conv", df.schema[conv].dataType),
                        *(T.StructField(c, T.LongType()) for c in counts), T.StructField("audit", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) or [[]] * 8
            types = [kind, *[pa.int64()] * 6, pa.string()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              names=out.names)

        def rows() -> Iterator[tuple]:
            nonlocal kind
            for b in batches:
                kind = b.schema.field("_conv").type
                yield from zip(*(b.column(c).to_pylist() for c in b.schema.names), strict=True)

        size = 0
        for found in _reports(rows(), costs):
            held.append(found)
            size += 100 + len(found[-1])
            if size > 1 << 22:
                yield batch()
                size = 0
        if held:
            yield batch()

    return ordered.mapInArrow(run, out).withColumnRenamed("_conv", conv)


def _reports(rows: Iterable[tuple], costs: Costs) -> Iterator[tuple]:
    """Rows (conversation, turn, copies, blank, cut, first, role) in order -> its report's columns."""
    now = solver = None
    for conv, turn, n, blank, cut, first, role in rows:
        if solver is None or conv != now:
            if solver is not None:
                yield _row(now, low, high, turns, faults, solver)
            now, solver = conv, Solver(costs)
            low = high = before = None
            turns, faults = 0, [0, 0, 0, 0]  # blank, duplicate, truncated, illegal
        if turn is not None:
            turns += turn != high
            low, high = turn if low is None else low, turn
        faults[3] += before is not None and (before, role) not in LEGAL
        faults[3] += (n - 1) * ((role, role) not in LEGAL)
        before = role
        if blank:
            faults[0] += n
        else:
            faults[1] += n - first
            if first:
                faults[2] += cut
                solver.add(role | TRUNCATED * cut)
        for _ in range(n if blank else n - first):
            solver.add(role | MUST_GO)
    if solver is not None:
        yield _row(now, low, high, turns, faults, solver)


def _row(conv, low: int | None, high: int | None, turns: int, faults: list[int], solver: Solver) -> tuple:
    cost, audit = solver.end()
    return conv, 0 if low is None else high - low + 1 - turns, *faults, cost, audit


def repaired(df: DataFrame, reports: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """The rows of the repaired conversations: ``conv``, position (from 0), ``role``, ``text``, by the
    audits of ``report`` over the same rows. A conversation with no rows left has none here.

    A conversation is one task's, row after row; a conversation's audit comes before its rows, so
    that nothing of them is held.
    """
    kind = df.schema[conv].dataType
    out = T.StructType([T.StructField(conv, kind), T.StructField("position", T.LongType()),
                        T.StructField(role, T.StringType()), T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer()
        for batch in batches:
            ids, roles, texts = [], [], []
            places: list[int] = []
            for c, n, r, t, audit in zip(*(batch.column(x).to_pylist() for x in STREAM), strict=True):
                for p, role_, text_ in writer.take(n, r, t, audit):
                    ids.append(c)
                    places.append(p)
                    roles.append(role_)
                    texts.append(text_)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field("_conv").type), pa.array(places, pa.int64()),
                     pa.array(roles, pa.string()), pa.array(texts, pa.string())], names=out.names)

    return _stream(df, reports, conv, turn, role, text).mapInArrow(run, out)


STREAM = ["_conv", "_part", "_role", "_text", "_audit"]


def _stream(df: DataFrame, reports: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """A conversation's audit (part 0), its rows in order (1) and an end mark (2)."""
    rows = _named(df, conv, turn, role, text).select(
        "_conv", F.lit(1).alias("_part"), "_turn", "_role", "_sign", "_text", F.lit(None).cast("string").alias("_audit"))
    marks = reports.select(
        F.col(conv).alias("_conv"), F.explode(F.array(F.lit(0), F.lit(2))).alias("_part"),
        F.lit(None).cast("long").alias("_turn"), F.lit(None).cast("string").alias("_role"),
        F.lit(None).cast("binary").alias("_sign"), F.lit(None).cast("string").alias("_text"),
        F.col("audit").alias("_audit"))
    order = ["_conv", "_part", "_turn", "_role", "_sign"]
    return rows.unionByName(marks).repartition("_conv").sortWithinPartitions(
        *(F.col(c).asc_nulls_first() for c in order)).select(*STREAM)


class _Writer:
    """Follows an audit along the rows of its conversation."""

    def take(self, part: int, role: str | None, text: str | None, audit: str | None) -> list[tuple[int, str, str]]:
        if part == 0:
            self.audit, self.at, self.state, self.place = audit, 0, START, 0
            return []
        out = []
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            out.append(self._put(WRITTEN[self.state], ROLES[WRITTEN[self.state]], ""))
            self.at += 1
        if part == 1:
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                out.append(self._put("sua".index(role[0]), role, text))
            elif letter == "R":
                out.append(self._put(WRITTEN[self.state], ROLES[WRITTEN[self.state]], text))
        return out

    def _put(self, initial: int, role: str, text: str) -> tuple[int, str, str]:
        self.state = NEXT[self.state, initial]
        self.place += 1
        return self.place - 1, role, text


def digests(df: DataFrame, reports: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text", out: str = "repaired_sha256") -> DataFrame:
    """``conv`` and the SHA-256 (lower-case hex) of its repaired rows: ``role:text``, one per line."""
    schema = T.StructType([T.StructField(conv, df.schema[conv].dataType), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, now = _Writer(), hashlib.sha256()
        for batch in batches:
            ids, found = [], []
            for c, n, r, t, audit in zip(*(batch.column(x).to_pylist() for x in STREAM), strict=True):
                if n == 0:
                    now = hashlib.sha256()
                for place, role_, text_ in writer.take(n, r, t, audit):
                    now.update(f"{chr(10) * (place > 0)}{role_}:{text_}".encode())
                if n == 2:
                    ids.append(c)
                    found.append(now.hexdigest())
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field("_conv").type), pa.array(found, pa.string())], names=schema.names)

    return _stream(df, reports, conv, turn, role, text).mapInArrow(run, schema)


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           costs: Costs = Costs()) -> tuple[DataFrame, DataFrame]:
    """(report, repaired rows); the report is stored, because the rows are written by it."""
    found = scratch.materialise(report(df, conv, turn, role, text, costs), "dialogue")
    return found, repaired(df, found, conv, turn, role, text)
