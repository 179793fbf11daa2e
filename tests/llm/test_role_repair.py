"""Conversation repair against every edit sequence, and its split over tasks against the whole."""

import hashlib
import itertools
import random
import re

import pytest

from cohortflow.llm import role_repair
from cohortflow.llm.queries import _repair_sql


def brute(symbols):
    """The cheapest edits by trying all: up to two inserts in every gap."""
    goal = re.compile(r"(s?(ua)+)?")
    gaps = ["", "u", "a", "ua", "au", "uu", "aa"]
    best = None
    for fill in itertools.product(gaps, repeat=len(symbols) + 1):
        for edits in itertools.product("KuaD", repeat=len(symbols)):
            roles, audit, cost = fill[0], "I" * len(fill[0]), 3 * len(fill[0])
            for symbol, edit, more in zip(symbols, edits, fill[1:], strict=True):
                if edit != "D" and symbol == "D" or edit == "K" and symbol in "xX":
                    break
                roles += {"D": "", "K": symbol.lower()}.get(edit, edit) + more
                audit += ("R" if edit in "ua" else edit) + "I" * len(more)
                cost += {"D": 4, "K": 0}.get(edit, 3) + 3 * len(more) + (3 if edit != "D" and symbol.isupper() else 0)
            else:
                if goal.fullmatch(roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


@pytest.mark.parametrize("length", [0, 1, 2])
def test_every_short_conversation(length):
    for symbols in map("".join, itertools.product("suaxSUAXD", repeat=length)):
        assert role_repair.finished(role_repair.chained(symbols, {role_repair.START: (0, "")})) == brute(symbols), symbols


def test_some_longer_ones():
    rng = random.Random(3)
    for _ in range(3):
        symbols = "".join(rng.choice("suaxSUAXD") for _ in range(3))
        assert role_repair.finished(role_repair.chained(symbols, {role_repair.START: (0, "")})) == brute(symbols), symbols


def test_segments_do_not_matter(monkeypatch):
    rng = random.Random(5)
    symbols = "".join(rng.choice("suauauaxSUAD") for _ in range(300))
    whole = role_repair.parse(symbols)
    for size in (1, 7, 64):
        monkeypatch.setattr(role_repair, "SEGMENT", size)
        assert role_repair.finished(role_repair.chained(symbols, {role_repair.START: (0, "")})) == role_repair.finished(whole)


def rows_of(rng, n_conversations, longest):
    rows = []
    for conv in [*range(n_conversations), None]:
        for turn in range(rng.randrange(1, longest)):
            text = rng.choice(["", " \t", "Hm", "Yes.", "No!\n ", "a. b", None, f"t{rng.randrange(9)}?"])
            rows.append((conv, rng.choice([turn, turn, None]), rng.choice(["user", "assistant", "system", "tool", "", None]), text))
    return rows


def expected(rows):
    """Every conversation by itself, in one list."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        plain = ["blank" if not x.strip(" \t\n\v\f\r") else "" if x.rstrip(" \t\n\v\f\r")[-1] in ".!?" else "truncated" for _, _, x in mine]
        pairs, seen, faults = [(r, x) for _, r, x in mine], set(), []
        for pair, fault in zip(pairs, plain, strict=True):
            faults.append("duplicate" if fault != "blank" and pair in seen else fault)
            seen.add(pair)
        cost, audit = role_repair.finished(role_repair.parse(role_repair.symbols_of(pairs, faults)))
        turns = [t for t, _, _ in mine if t is not None]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        lines = "\n".join(f"{r}:{x}" for r, x, _ in role_repair.applied(pairs, audit))
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return out


@pytest.mark.parametrize(("parts", "part_rows", "longest"), [(1, 20_000, 9), (9, 5, 60), (23, 20_000, 200)])
def test_conversations_over_several_tasks(spark, monkeypatch, parts, part_rows, longest):
    monkeypatch.setattr(role_repair, "PART_ROWS", part_rows)
    rows = rows_of(random.Random(parts), 7, longest)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, fault string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = role_repair.repair(frame)
        sums = {r["conv_id"]: r["repaired_sha256"] for r in role_repair.checksums(found).collect()}
        empty = hashlib.sha256(b"").hexdigest()
        got = {r["conv_id"]: (*r[1:], sums.get(r["conv_id"], empty)) for r in found.summary.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == expected(rows)


def test_no_rows(spark):
    found = role_repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert found.summary.count() == role_repair.checksums(found).count() == 0


def test_sql_has_no_holes():
    assert "None" not in _repair_sql()
