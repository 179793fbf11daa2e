"""Mixing sources to target weights: entropy balancing by Newton steps on the convex dual, then rounding into copies."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortflow.llm.text import WORD_CLASS, stored
from cohortflow.plans.lineage import BROADCAST_ROWS

#: Documents that are rounded together; a source is dealt into as many groups as it needs.
GROUP_ROWS = 20_000
#: Steps of at most two documents that correct a group's rounding.
FLIPS = 50
#: Share of a group's words up to which its rounding may be off while copies stay next to their rates.
NEAR = 0.002
#: Documents, and words of all their copies, up to which the nearest reachable sum is found exactly if flips do not come near.
FEW, FEW_WORDS = 64, 1 << 20


def capped_shares(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = 2.0) -> list[float]:
    """Share ``total`` by weight; nobody gets more than ``most`` times its size, the excess is shared again by weight."""
    out, open_, left = [0.0] * len(sizes), [i for i in range(len(sizes))], float(total)
    while open_:
        all_weights = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / all_weights for i in open_}
        full = [i for i in open_ if share[i] > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = share[i]
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if i not in full]
    return out


def entropy_balance(cells: DataFrame, mass: str, targets: Mapping[str, Mapping], steps: int = 50, tolerance: float = 1e-10) -> dict[str, dict]:
    """Multipliers by constraint column and value, so that mass * exp(sum of a row's multipliers) meets every target.

    Minimises the relative entropy of the tilted masses to the given ones under the constraints: Newton steps on its convex dual
    sum(mass * exp(x . m)) - target . m. ``cells`` has one row per combination of the constraint columns; each step is one
    Spark aggregate that gives the gradient and the Hessian, whose size is bounded by the number of constraints. Cells with no mass or a
    target of 0 get a multiplier of -inf (rate 0). Constraints that contradict each other end at the closest step.
    """
    columns = list(targets)
    keys = {c: [k for k, t in targets[c].items() if t > 0] for c in columns}
    place = {(c, k): n for n, (c, k) in enumerate((c, k) for c in columns for k in keys[c])}
    goal = np.array([targets[c][k] for c, k in place])
    m = np.zeros(len(place))
    spark = cells.sparkSession
    live = cells.filter(F.col(mass) > 0)
    for c in columns:
        live = live.filter(F.col(c).isin(keys[c]))

    def moments(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        rows = live.withColumn("_m", F.lit(0.0))
        for c in columns:
            table = spark.createDataFrame([(k, float(m[place[c, k]])) for k in keys[c]], f"{c} {dict(cells.dtypes)[c]}, _step double")
            rows = rows.join(F.broadcast(table), c).withColumn("_m", F.col("_m") + F.col("_step")).drop("_step")
        found = rows.groupBy(*columns).agg(F.sum(F.col(mass) * F.exp("_m")).alias("w")).collect()
        g, h = -goal.copy(), np.zeros((len(m), len(m)))
        for row in found:
            at = [place[c, row[c]] for c in columns]
            for a in at:
                g[a] += row["w"]
                for b in at:
                    h[a, b] += row["w"]
        return g, h, sum(row["w"] for row in found) - float(goal @ m)

    if len(place):
        g, h, value = moments(m)
        for _ in range(steps):
            if np.max(np.abs(g) / goal) < tolerance:
                break
            step, size = np.linalg.lstsq(h, -g, rcond=1e-12)[0], 1.0
            for _ in range(40):  # halve until the dual falls
                new = moments(m + size * np.clip(step, -5, 5))
                if new[2] <= value + 1e-9 * abs(value):
                    break
                size /= 2
            m = m + size * np.clip(step, -5, 5)
            g, h, value = new
    return {c: {k: (float(m[place[c, k]]) if (c, k) in place else float("-inf")) for k in targets[c]} for c in columns}


def _nearest_flips(sizes: np.ndarray, more: np.ndarray, less: np.ndarray, error: float) -> tuple[list[int], list[int]]:
    """Places of a document to take once more and of one to take once less that bring ``error`` (words still wanted) nearest to 0; one, both or
    none.

    ``more``, ``less``: the places that may change so. Pairs are found by bisection.
    """
    best, chosen = abs(error), ([], [])
    for places, sign in ((more, 1), (less, -1)):
        if len(places):
            rest = np.abs(error - sign * sizes[places])
            if rest.min() < best:
                best, one = float(rest.min()), [int(places[rest.argmin()])]
                chosen = (one, []) if sign > 0 else ([], one)
    if len(more) and len(less):
        by_size = less[np.argsort(sizes[less], kind="stable")]
        at = np.searchsorted(sizes[by_size], sizes[more] - error)
        for shift in (0, 1):
            other = by_size[np.clip(at - shift, 0, len(by_size) - 1)]
            rest = np.abs(error - sizes[more] + sizes[other])
            if rest.min() < best:
                best, chosen = float(rest.min()), ([int(more[rest.argmin()])], [int(other[rest.argmin()])])
    return chosen


def _nearest_sum(sizes: list[int], rates: list[float], wanted: float, most: int) -> list[int]:
    """Copies from 0 to ``most`` of each document whose words come nearest to ``wanted``; of several choices, copies near the rates.

    The reachable sums are bits of a number, one number per document, so this is for few documents with few words.
    """
    reach = [1]
    for size in sizes:
        bits = reach[-1]
        for k in range(1, most + 1):
            bits |= reach[-1] << k * size
        reach.append(bits)
    base, last = int(wanted), reach[-1].bit_length()
    near = (n for d in range(max(base, last) + 1) for n in sorted({base - d, base + d + 1}, key=lambda n: abs(n - wanted)) if 0 <= n < last and reach[-1] >> n & 1)
    left, copies = next(near), [0] * len(sizes)
    for at in range(len(sizes) - 1, -1, -1):
        fits = [k for k in range(most + 1) if k * sizes[at] <= left and reach[at] >> (left - k * sizes[at]) & 1]
        copies[at] = min(fits, key=lambda k: abs(k - rates[at]))
        left -= copies[at] * sizes[at]
    return copies


def _rounded(sizes: np.ndarray, rates: np.ndarray, most: float) -> np.ndarray:
    """Whole copies next to each rate, from the largest document down: each takes the error so far into account. Then single documents and pairs
    are rounded the other way as long as that brings the words nearer to their share; if that is still far off, as where there are few
    documents, copies may leave their rate's neighbours."""
    error, copies = 0.0, np.zeros(len(sizes), np.int64)
    for at, (size, rate) in enumerate(zip(sizes.tolist(), rates.tolist(), strict=True)):
        wanted = rate + (error / size if size else 0.0)
        copies[at] = min(max(round(wanted), math.floor(rate)), math.ceil(rate))
        error += (rate - copies[at]) * size
    near = NEAR * float((rates * sizes).sum())
    for low, high, enough in ((np.floor(rates), np.ceil(rates), 0.0), (0, math.floor(most), near)):
        for _ in range(FLIPS):
            if abs(error) <= enough:
                break
            up, down = _nearest_flips(sizes, np.flatnonzero((copies < high) & (sizes > 0)), np.flatnonzero((copies > low) & (sizes > 0)), error)
            if not up and not down:
                break
            copies[up] += 1
            copies[down] -= 1
            error += float(sizes[down].sum() - sizes[up].sum())
    if abs(error) > near and len(sizes) <= FEW and math.floor(most) * int(sizes.sum()) <= FEW_WORDS:
        return np.array(_nearest_sum(sizes.tolist(), rates.tolist(), float((rates * sizes).sum()), math.floor(most)), np.int64)
    return copies


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), total: float = 1.5, most: float = 2.0, text: str = "text", source: str = "source") -> DataFrame:
    """Every row of ``docs`` (without its text) with size, source_size, target, rate, copies and taken.

    Size: the words of the text, 0 for null and empty ones. Sources in code point order, null last as a source of its own, get
    ``weights`` in turn. Rates are the same for all documents of a source, exp(multiplier); no document is taken more than ``most``
    times (a whole number). Repeated rows are rows of their own. Reruns agree: rounding goes by size and a hash of
    the row. Number of sources: as many as constraints fit in a dense Newton step (hundreds).
    """
    added = ("size", "source_size", "target", "rate", "copies", "taken")
    rest = [c for c in docs.columns if c != text and c not in added]
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_CLASS + "+")).cast("long")
    hashed = [c for c, kind in docs.select(*rest).dtypes if "map<" not in kind] + [F.col(text)]
    # a null source sorts after all others: "1" follows "0..."
    key = F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))
    rows = stored(
        docs.select(F.struct(*rest).alias("_rest"), size.alias("size"), key.alias("_source"), F.xxhash64(*hashed).alias("_order")), "sizes"
    )
    cells = rows.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")).orderBy("_source")
    found = cells.collect()
    sizes = [r["source_size"] for r in found]
    targets = capped_shares(sizes, [weights[i % len(weights)] for i in range(len(found))], total * sum(sizes), most)
    spark = docs.sparkSession
    schema = "_source string, source_size long, target double, n long"
    known = spark.createDataFrame([(r["_source"], r["source_size"], float(t), r["n"]) for r, t in zip(found, targets, strict=True)], schema)
    tilt = entropy_balance(known.select("_source", "source_size"), "source_size", {"_source": {r["_source"]: t for r, t in zip(found, targets, strict=True)}})["_source"]
    rates = spark.createDataFrame(
        [(r["_source"], r["source_size"], float(t), r["n"], min(float(np.exp(tilt[r["_source"]])), most)) for r, t in zip(found, targets, strict=True)],
        schema + ", rate double",
    )
    rates = F.broadcast(rates) if len(found) <= BROADCAST_ROWS else rates
    groups = F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP_ROWS))
    rated = rows.join(rates, "_source").withColumn("_group", F.pmod(F.col("_order"), groups))
    round_in = rated.select("_source", "_group", "size", "rate", "_order", F.struct("_rest", "source_size", "target", "rate", "size").alias("_row"))
    kind = round_in.schema["_row"].dataType.simpleString()

    def round_group(rows: pa.Table) -> pa.Table:
        order = rows.sort_by([("size", "descending"), ("_order", "ascending")]).select(["_row", "size", "rate"])
        return pa.table({"_row": order["_row"], "copies": _rounded(order["size"].to_numpy(), order["rate"].to_numpy(), most)})

    rounded = round_in.groupBy("_source", "_group").applyInArrow(round_group, f"_row {kind}, copies long")
    return rounded.select(
        *[F.col("_row")["_rest"][c].alias(c) for c in rest],
        *[F.col("_row")[c].alias(c) for c in ("size", "source_size", "target", "rate")],
        "copies",
        (F.col("copies") * F.col("_row")["size"]).alias("taken"),
    )
