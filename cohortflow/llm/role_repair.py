"""Conversation structure repair: a generalised LR parse of the roles over a graph-structured stack, with weighted edits.

The role grammar's LR(0) automaton is built from its rules. Rows are read one by one; a row may be kept, get another role, or be
deleted, and turns may be inserted anywhere. Every action has a cost and an initial. Stacks share what lies below their tops; equal stack tops
merge to the smallest (cost, audit). So all repairs of a conversation are followed at once, by few stacks.

Rows are sorted over all tasks, so a conversation of any size is spread over several. A conversation inside one task is repaired there.
Of those that reach a task's edge, every part is parsed from every stack the grammar can have at its start, and the few parts are chained.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortflow.llm.text import SPACE_CLASS, WORD_CLASS, stored

#: (s?(ua)+)? as rules over the roles' initials.
GRAMMAR = (("talk", ()), ("talk", ("turns",)), ("talk", ("s", "turns")), ("turns", ("u", "a")), ("turns", ("turns", "u", "a")))
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows that one parse reads; longer stretches are chained.
SEGMENT = 512
#: Rows of one part of a conversation that reaches a task's edge.
PART_ROWS = 20_000

Weight = tuple[int, str]


class Automaton:
    """LR(0) states (numbers, 0 first) with their shifts, reductions and gotos."""

    def __init__(self, rules: Sequence[tuple[str, tuple[str, ...]]]):
        heads = {h for h, _ in rules}

        def closed(items: frozenset) -> frozenset:
            items = set(items)
            while True:
                next_heads = {rules[r][1][dot] for r, dot in items if dot < len(rules[r][1])} & heads
                new = {(r, 0) for r, (h, _) in enumerate(rules) if h in next_heads} - items
                if not new:
                    return frozenset(items)
                items |= new

        start = closed(frozenset((r, 0) for r, (h, _) in enumerate(rules) if h == rules[0][0]))
        states, self.step = [start], {}
        for at, state in enumerate(states):
            for symbol in sorted({rules[r][1][dot] for r, dot in state if dot < len(rules[r][1])}):
                target = closed(frozenset((r, dot + 1) for r, dot in state if dot < len(rules[r][1]) and rules[r][1][dot] == symbol))
                if target not in states:
                    states.append(target)
                self.step[at, symbol] = states.index(target)
        self.goal = len(states)
        self.step[0, rules[0][0]] = self.goal
        self.reductions = [[(rules[r][0], len(rules[r][1])) for r, dot in sorted(s) if dot == len(rules[r][1])] for s in states] + [[]]
        shifts = {at for at, symbol in self.step if symbol not in heads}
        self.live = shifts | {0}
        self.terminals = sorted({symbol for _, symbol in self.step} - heads)
        self.after = {target: symbol for (_, symbol), target in self.step.items()}  # the symbol that leads to a state


@cache
def automaton() -> Automaton:
    return Automaton(GRAMMAR)


#: A stack: its top state and the stack below, which all stacks over it share.
Stack = tuple[int, "Stack | None"]
START: Stack = (0, None)


def _put(tops: dict[Stack, Weight], stack: Stack, weight: Weight) -> bool:
    """Merge with an equal stack top: the smaller weight stays. Whether that was the new one."""
    old = tops.get(stack)
    if old is None or weight < old:
        tops[stack] = weight
        return True
    return False


def _close(tops: dict[Stack, Weight]) -> dict[Stack, Weight]:
    """Reduce and insert until nothing gets cheaper."""
    lr, new = automaton(), list(tops)
    while new:
        stack = new.pop()
        cost, audit = tops[stack]
        for head, length in lr.reductions[stack[0]]:
            below = stack
            for _ in range(length):
                below = below[1]
            state = lr.step.get((below[0], head))
            if state is not None and _put(tops, (state, below), (cost, audit)):
                new.append((state, below))
        for symbol in ROLES:
            state = lr.step.get((stack[0], symbol))
            if state is not None and _put(tops, (state, stack), (cost + INSERT, audit + "I")):
                new.append((state, stack))
    return tops


def _read(tops: dict[Stack, Weight], symbol: str) -> dict[Stack, Weight]:
    """The stack tops after one row. Its symbol: the role's initial (x for others), in capitals if truncated; D must go."""
    lr, found = automaton(), {}
    extra, initial = (TRUNCATED if symbol.isupper() else 0), symbol.lower()
    edits = [] if symbol == "D" else [(role, REROLE + extra, "R") for role in ROLES]
    if edits and initial in lr.terminals:
        edits.append((initial, KEEP + extra, "K"))
    for stack, (cost, audit) in tops.items():
        if stack[0] not in lr.live:
            continue
        _put(found, stack, (cost + DELETE, audit + "D"))
        for terminal, more, letter in edits:
            state = lr.step.get((stack[0], terminal))
            if state is not None:
                _put(found, (state, stack), (cost + more, audit + letter))
    return _close(found)


@lru_cache(maxsize=50_000)
def parse(symbols: str, stack: Stack = START) -> dict[Stack, Weight]:
    """stack after the symbols -> smallest (cost, audit), starting from ``stack``: those that can go on, and the complete parse."""
    tops = _close({stack: (0, "")})
    for symbol in symbols:
        tops = _read(tops, symbol)
    lr = automaton()
    return {s: w for s, w in tops.items() if s[0] in lr.live or s[0] == lr.goal}


def chained(symbols: str, start: dict[Stack, Weight]) -> dict[Stack, Weight]:
    """``parse`` of any number of symbols from weighted stacks, SEGMENT rows at a time."""
    for at in range(0, max(len(symbols), 1), SEGMENT):
        after: dict[Stack, Weight] = {}
        for stack, (cost, audit) in start.items():
            for target, (c, a) in parse(symbols[at : at + SEGMENT], stack).items():
                _put(after, target, (cost + c, audit + a))
        start = {s: w for s, w in after.items() if s[0] in automaton().live}
    return after


@cache
def boundary_stacks() -> dict[str, Stack]:
    """All stacks that can stand between two rows, by their text: finitely many, as the grammar nests nothing."""
    known, new = {START}, {START}
    while new:
        after = {t for stack in new for symbol in automaton().terminals for t in parse(symbol, stack) if t[0] in automaton().live}
        new, known = after - known, known | after
    return {str(s): s for s in known}


def finished(ends: dict[Stack, Weight]) -> Weight:
    """The smallest weight of a complete parse."""
    return ends[automaton().goal, START]


def last_role(stack: Stack) -> str:
    """The symbol on top: the initial of the row kept last, if that is what lies there."""
    return automaton().after.get(stack[0], "")


def applied(rows: Sequence[tuple[str, str]], audit: str, before: str = "") -> list[tuple[str, str, str]]:
    """(role, text, edit) of the repaired rows. ``before``: the initial of the row kept last."""
    out, at = [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES["a" if before == "u" else "u"]
        before = role[:1]
        out.append((role, text, edit))
    return out


def symbols_of(rows: Sequence[tuple[str, str]], faults: Sequence[str]) -> str:
    """A letter per row for ``parse``."""
    out = []
    for (role, _), fault in zip(rows, faults, strict=True):
        initial = role[:1] if role[:1] in automaton().terminals else "x"
        out.append("D" if fault in ("blank", "duplicate") else initial.upper() if fault == "truncated" else initial)
    return "".join(out)


def _row_columns(text: Column) -> tuple[Column, Column]:
    """Whether a text is blank; whether its last character that is no white space is not one of .!?"""
    blank = ~text.rlike(WORD_CLASS)
    return blank, ~blank & ~text.rlike(rf"[.!?]{SPACE_CLASS}*\z")


LEGAL = {"su", "ua", "au"}
SUMS = ("blank", "duplicate", "truncated", "illegal")
_STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_EDGE = "part long, at long, turn long, role string, text string, fault string"


class Repair(NamedTuple):
    """summary: conv_id, gaps, the faults, illegal, cost, audit. whole: conv_id, repaired (array of role, text, edit) of the
    conversations inside one task. parts: conv_id, part, at, role, text, edit of the others' repaired rows, in order."""

    summary: DataFrame
    whole: DataFrame
    parts: DataFrame


def faults_of(rows: Sequence[tuple[str, str]], plain: Sequence[str]) -> list[str]:
    """``plain`` (blank, truncated or nothing), with rows that are equal to an earlier one as duplicates."""
    seen, out = set(), []
    for row, fault in zip(rows, plain, strict=True):
        out.append("duplicate" if fault != "blank" and row in seen else fault)
        seen.add(row)
    return out


def counts(rows: Sequence[tuple[str, str]], turns: Sequence[int | None], faults: Sequence[str]) -> dict:
    """Counts of a stretch of rows and what its neighbours need to know."""
    known = [t for t in turns if t is not None]
    initials = [role[:1] for role, _ in rows]
    return {
        "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "low": known[0] if known else None, "high": known[-1] if known else None, "distinct": len({*known}),
        "first": initials[0], "last": initials[-1],
    }


def joined(x: dict, y: dict) -> dict:
    """Counts of two neighbouring stretches together."""
    out = {k: x[k] + y[k] for k in SUMS}
    out["illegal"] += x["last"] + y["first"] not in LEGAL
    out["low"], out["high"] = (y["low"] if x["low"] is None else x["low"]), (x["high"] if y["high"] is None else y["high"])
    out["distinct"] = x["distinct"] + y["distinct"] - (x["high"] is not None and x["high"] == y["low"])
    return out | {"first": x["first"], "last": y["last"]}


def _summary(c: dict, weight: Weight) -> dict:
    gaps = 0 if c["low"] is None else c["high"] - c["low"] + 1 - c["distinct"]
    return {"gaps": gaps, **{k: c[k] for k in SUMS}, "cost": weight[0], "audit": weight[1]}


def ordered_rows(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, turn, role, text, fault (blank, truncated or nothing), sorted over all tasks."""
    words = F.coalesce(F.col(text), F.lit(" "))
    blank, truncated = _row_columns(words)
    fault = F.when(blank, "blank").when(truncated, "truncated").otherwise("")
    found = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), words.alias("text"), fault.alias("fault"))
    # rows that agree in all of this are interchangeable; the last column spreads them
    order = ["conv_id", "turn", "role", F.substring("text", 1, 200), F.xxhash64("text")]
    return found.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)


def _parsed(ordered: DataFrame) -> DataFrame:
    """Conversations inside a task, repaired; the single rows of the first and the last one, which others may continue."""
    kind = ordered.schema["conv_id"].dataType.simpleString()
    whole = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]))
    longs = ("gaps", *SUMS, "cost", "part", "at", "turn")

    def inside(rows: list[tuple]) -> dict:
        pairs, turns = [(r, t) for _, r, t, _ in rows], [r[0] for r in rows]
        faults = faults_of(pairs, [r[3] for r in rows])
        weight = finished(chained(symbols_of(pairs, faults), {START: (0, "")}))
        return _summary(counts(pairs, turns, faults), weight) | {"repaired": [{"role": r, "text": t, "edit": e} for r, t, e in applied(pairs, weight[1])]}

    def at_edge(rows: list[tuple], first_part: int) -> Iterator[dict]:
        for start in range(0, len(rows), PART_ROWS):
            some = rows[start : start + PART_ROWS]
            faults = faults_of([(r, t) for _, r, t, _ in some], [r[3] for r in some])
            for at, ((turn, role, text, _), fault) in enumerate(zip(some, faults, strict=True)):
                yield {"part": first_part + start // PART_ROWS, "at": at, "turn": turn, "role": role, "text": text, "fault": fault}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, rows, last, first, out, ids, schema, held = TaskContext.get().partitionId() << 32, 0, [], None, True, [], [], None, 0

        def close(edge: bool) -> None:
            made = list(at_edge(rows, task + number)) if edge else [inside(rows)]
            out.extend(made)
            ids.extend([last] * len(made))

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist([{"conv_id": i, **r} for i, r in zip(ids, out, strict=True)], schema)
            out.clear()
            ids.clear()
            return batch

        for batch in batches:
            kinds = {"conv_id": batch.schema.field("conv_id").type, **{c: pa.int64() for c in longs}, "repaired": whole}
            schema = schema or pa.schema([(c, kinds.get(c, pa.string())) for c in names])
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault")]
            for conv, *row in zip(*columns, strict=True):
                if rows and conv != last:
                    close(edge=first)
                    number, first, rows = (number + 1 + len(rows) // PART_ROWS if first else number), False, []
                    if held >= 2048:
                        yield flushed()
                        held = 0
                last = conv
                rows.append(tuple(row))
                held += 1
        if rows:
            close(edge=True)
            yield flushed()

    schema_text = f"conv_id {kind}, {_STATS}, repaired array<struct<role:string,text:string,edit:string>>, {_EDGE}"
    names = ["conv_id", *(x.split()[0] for x in _STATS.split(", ")), "repaired", *(x.split()[0] for x in _EDGE.split(", "))]
    return ordered.mapInArrow(run, schema_text)


def _moves(key: tuple, rows: pa.Table) -> pa.Table:
    """One part of a conversation: its counts, and its cheapest repairs from every stack to every stack."""
    rows = rows.sort_by("at")
    pairs = list(zip(rows["role"].to_pylist(), rows["text"].to_pylist(), strict=True))
    faults = rows["fault"].to_pylist()
    symbols = symbols_of(pairs, faults)
    moves = [
        {"source": str(stack), "target": str(target), "cost": cost, "audit": audit}
        for stack in boundary_stacks().values()
        for target, (cost, audit) in chained(symbols, {stack: (0, "")}).items()
    ]
    c = counts(pairs, rows["turn"].to_pylist(), faults)
    move = pa.struct([("source", pa.string()), ("target", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
    kinds = {"first": pa.string(), "last": pa.string()}
    return pa.table({
        "conv_id": rows["conv_id"].slice(0, 1), "part": rows["part"].slice(0, 1),
        **{k: pa.array([v], kinds.get(k, pa.int64())) for k, v in c.items()}, "moves": pa.array([moves], pa.list_(move)),
    })


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts, sorted by conversation and part -> a summary for each conversation and the edits of each part.

    Only the weights of the stacks that can stand at the present edge are held."""
    last, state, total, begun = None, {}, None, False

    def done() -> list[dict]:
        cost, audit, trail = state[str((automaton().goal, START))]
        out, end = [{"conv_id": last, **_summary(total, (cost, audit))}], len(audit)
        while trail:
            trail, start, stack, part = trail
            out.append({"conv_id": last, "part": part, "before": last_role(stack), "edits": audit[start:end]})
            end = start
        return out

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if begun and row["conv_id"] != last:
                out += done()
            if not begun or row["conv_id"] != last:
                state, total = {str(START): (0, "", None)}, None
            begun, last = True, row["conv_id"]
            total = row if total is None else joined(total, row)
            after: dict = {}
            stacks = boundary_stacks()
            for move in row["moves"]:
                if move["source"] in state:
                    cost, audit, trail = state[move["source"]]
                    weight = (cost + move["cost"], audit + move["audit"])
                    if move["target"] not in after or weight < after[move["target"]][:2]:
                        after[move["target"]] = (*weight, (trail, len(audit), stacks[move["source"]], row["part"]))
            state = after
        yield _chained_batch(out, batch)
    if begun:
        yield _chained_batch(done(), batch)


def _chained_batch(rows: list[dict], like: pa.RecordBatch) -> pa.RecordBatch:
    fields = [("conv_id", like.schema.field("conv_id").type), *((c, pa.int64()) for c in ("gaps", *SUMS, "cost")), ("audit", pa.string()), ("part", pa.int64()), ("before", pa.string()), ("edits", pa.string())]
    return pa.RecordBatch.from_pylist(rows, pa.schema(fields))


def _edited(rows: pa.Table, edits: pa.Table) -> pa.Table:
    """The repaired rows of one part."""
    rows = rows.sort_by("at")
    found = applied(list(zip(rows["role"].to_pylist(), rows["text"].to_pylist(), strict=True)), edits["edits"][0].as_py(), edits["before"][0].as_py())
    n = len(found)
    spread = lambda c: pa.chunked_array([pa.concat_arrays([edits[c].slice(0, 1).combine_chunks()] * n)]) if n else edits[c].slice(0, 0)
    role, text, edit = ([r[k] for r in found] for k in range(3))
    return pa.table({"conv_id": spread("conv_id"), "part": spread("part"), "at": pa.array(range(n), pa.int64()), "role": pa.array(role, pa.string()), "text": pa.array(text, pa.string()), "edit": pa.array(edit, pa.string())})


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Faults of every conversation and its cheapest repair into system?, (user, assistant)+ or nothing.

    Rows go by turn (nulls first), then role, text; equal rows are interchangeable. A null role or text is one space; rows without a
    conversation id are one conversation. A role counts by its first character; an empty role cannot be kept. First fault of a row: blank,
    duplicate (role and text seen earlier), truncated (ends without .!?). Among the cheapest repairs the one with the smallest
    audit counts; role edits and inserts take the role that the grammar wants. No rows give no conversations.
    """
    kind = rows.schema[conv_id].dataType.simpleString()
    found = stored(_parsed(ordered_rows(rows, conv_id, turn, role, text)), "repairs")
    stats = ["conv_id", "gaps", *SUMS, "cost", "audit"]
    closed, edge = found.filter("part IS NULL"), found.filter("part IS NOT NULL").select("conv_id", "part", "at", "turn", "role", "text", "fault")
    # a part has marked its own repeats: at most one row of a key and part is left
    open_ = ~F.col("fault").isin("blank", "duplicate")
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy("part")
    marked = edge.filter(open_).withColumn("fault", F.when(F.row_number().over(earlier) > 1, "duplicate").otherwise(F.col("fault")))
    edge = stored(marked.unionByName(edge.filter(~open_)), "edges")
    sums = ", ".join(f"{c} long" for c in (*SUMS, "low", "high", "distinct"))
    moves = edge.groupBy("conv_id", "part").applyInArrow(_moves, f"conv_id {kind}, part long, {sums}, first string, last string, moves array<struct<source:string,target:string,cost:long,audit:string>>")
    chain = moves.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_chain, f"conv_id {kind}, {_STATS}, part long, before string, edits string")
    chain = stored(chain, "chains")
    edits = chain.filter("part IS NOT NULL").select("conv_id", "part", "before", "edits")
    parts = edge.groupBy("conv_id", "part").cogroup(edits.groupBy("conv_id", "part")).applyInArrow(_edited, f"conv_id {kind}, part long, at long, role string, text string, edit string")
    return Repair(closed.select(*stats).unionByName(chain.filter("part IS NULL").select(*stats)), closed.select("conv_id", "repaired"), parts)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation -> one running hash at a time."""
    last, digest = None, None
    for batch in batches:
        ids, out = [], []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if digest is not None and conv != last:
                ids.append(last)
                out.append(digest.hexdigest())
                digest = None
            if digest is None:
                digest, last = hashlib.sha256(), conv
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        kind = batch.schema.field("conv_id").type
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(out, pa.string())], ["conv_id", "repaired_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last], kind), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])


def checksums(found: Repair) -> DataFrame:
    """conv_id, repaired_sha256 of the lines role:text. Conversations with no row left after the repair are missing, if they lie at an edge."""
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    whole = found.whole.select("conv_id", F.sha2(lines, 256).alias("repaired_sha256"))
    kind = found.whole.schema["conv_id"].dataType.simpleString()
    rows = found.parts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
    return whole.unionByName(rows.mapInArrow(_hashed, f"conv_id {kind}, repaired_sha256 string"))
