"""Hard-negative mining: threshold joins of anchors with all rows, over indexes that leave out what the thresholds allow.

An anchor asks for the best rows inside score windows. Rows lie in blocks; a block's rows are held by one task and the anchors stream past. The
block's index takes the dimensions in falling order of energy and omits, row by row, the last ones, as long as their norm times
the largest anchor's norm stays below the lowest threshold. Scores add up dimension by dimension; a pair is pruned once its
partial score plus the product of the remaining norms is below the anchor's threshold, what survives is scored in full. Thresholds start near
the top of the windows and fall until the windows are full; later rows of the block then have to beat what the windows hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortflow.llm.text import stored

#: Rows of a block at least and at most; rows and anchors that are compared in one step.
LEAST_ROWS, MOST_ROWS = 2048, 131_072
STEP_ROWS, STEP_ANCHORS = 4096, 256
#: Thresholds as shares of the way from a window's top to its bottom.
FALLS = (0.25, 0.375, 0.5, 1.0)
#: Shares of the dimensions after which pairs are pruned.
STOPS = (0.5, 0.75, 1.0)
#: Pairs left, as a share of all, from which on only they are added up.
SPARSE = 0.25
_SAFE = 1.000001


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Lists of whole numbers as rows of equal width; shorter ones are filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), max(width, int(sizes.max(initial=0)))))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def tails(values: np.ndarray) -> np.ndarray:
    """Norms of what lies at and after each dimension, one column more than there are dimensions."""
    squares = np.cumsum(values[:, ::-1] ** 2, axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(values), 1))], axis=1))


@dataclass
class Step:
    """Rows of one comparison step: their index and what bounds the rest."""

    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    norms: np.ndarray

    def indexed(self, lowest: float, longest: float) -> np.ndarray:
        """How many leading dimensions of each row the index needs: what follows cannot reach ``lowest`` with any anchor."""
        return np.count_nonzero(self.norms[:, :-1] * (longest * _SAFE) >= lowest, axis=1) if lowest > 0 else np.full(len(self.ids), self.values.shape[1])

    def pairs(self, anchors: np.ndarray, norms: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """row, anchor and score of all pairs whose score reaches the anchor's threshold."""
        width = self.values.shape[1]
        need = self.indexed(float(thresholds.min()), float(norms[:, 0].max()))
        live = np.flatnonzero(need > 0) if thresholds.min() > 0 else np.arange(len(self.ids))
        if not len(live) or not len(anchors):
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        values, tail = self.values[live], self.norms[live]
        index = np.where(np.arange(width) < need[live, None], values, 0)
        score, at, rows, cols = None, 0, None, None
        for stop in sorted({max(1, round(width * s)) for s in STOPS}) if width else [0]:
            if rows is None:
                part = index[:, at:stop] @ anchors[:, at:stop].T
                score = part if score is None else score + part
                # omitted dimensions before the stop count to the rest
                rest = tail[np.arange(len(live)), np.minimum(stop, need[live])][:, None] * norms[None, :, stop]
                late = need[live] < stop
                if late.any():
                    rest[late] = tail[late, need[live][late]][:, None] * norms[:, need[live][late]].T
                alive = score + rest * _SAFE + 1e-6 >= thresholds
                if stop == width or np.count_nonzero(alive) < SPARSE * alive.size:
                    rows, cols = np.nonzero(alive)
                    score = score[rows, cols]
            else:
                score = score + np.einsum("ij,ij->i", index[rows, at:stop], anchors[cols, at:stop])
                begun = np.minimum(stop, need[live][rows])
                keep = score + tail[rows, begun] * norms[cols, begun] * _SAFE + 1e-6 >= thresholds[cols]
                rows, cols, score = rows[keep], cols[keep], score[keep]
            at = stop
        full = np.einsum("ij,ij->i", values[rows], anchors[cols])
        keep = full >= thresholds[cols]
        return live[rows[keep]], cols[keep], full[keep]


def _best(anchor: np.ndarray, window: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k rows of every (anchor, window): higher scores first, then smaller ids."""
    order = np.lexsort((ids, -scores, window, anchor))
    a, w = anchor[order], window[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (w[1:] != w[:-1]))) if len(order) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


def search(steps: list[Step], ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> tuple[np.ndarray, ...]:
    """anchor (place), window, row id and score of the block's first ``k`` rows in every window.

    ``low``, ``high``: one row per anchor, one column per window; a window with low > high takes nothing.
    """
    norms = tails(anchors)
    reach = norms[:, 0] * max(float(s.norms[:, 0].max()) for s in steps) * _SAFE + 1
    open_ = low <= high
    top = np.where(open_, np.minimum(high, reach[:, None]), -np.inf)
    bottom = np.where(open_, np.maximum(low, -reach[:, None]), -np.inf)
    held = tuple(np.zeros(0, t) for t in (int, int, np.int64, float))
    full = np.zeros(low.shape, bool)
    for step in steps:
        # the score to reach in each window: the last of those held once the window is full
        floor = bottom.copy()
        count = np.zeros(low.shape, int)
        if len(held[0]):
            np.add.at(count, (held[0], held[1]), 1)
            least = np.full(low.shape, np.inf)
            np.minimum.at(least, (held[0], held[1]), held[3])
            full = count >= k
            floor[full] = np.maximum(floor, least)[full]
        todo = np.flatnonzero((open_ & (top >= floor)).any(axis=1))
        for fall in FALLS:
            if not len(todo):
                break
            # full windows take their own floor at once, open ones fall step by step
            wanted = np.where(full[todo], floor[todo], np.maximum(top[todo] - fall * (top[todo] - bottom[todo]), bottom[todo]))
            wanted = np.where(open_[todo], wanted, np.inf)
            rows, cols, scores = step.pairs(anchors[todo], norms[todo], np.ceil(wanted.min(axis=1) - 1e-6))
            place = todo[cols]
            fits = (step.ids[rows] != ids[place]) & ((step.labels[rows] == labels[place]) == same)
            rows, place, scores = rows[fits], place[fits], scores[fits]
            found = [], [], [], []
            for w in range(low.shape[1]):
                inside = open_[place, w] & (scores >= low[place, w]) & (scores <= high[place, w])
                for out, new in zip(found, (place[inside], np.full(np.count_nonzero(inside), w), step.ids[rows[inside]], scores[inside]), strict=True):
                    out.append(new)
            fresh = tuple(np.concatenate(x) for x in found)
            # a window is done if this threshold gave it enough, or if it lies at its bottom
            got = np.zeros(low.shape, int)
            np.add.at(got, (fresh[0], fresh[1]), 1)
            done = full[todo] | ~open_[todo] | (got[todo] >= k) | (fall == FALLS[-1])
            settled = done.all(axis=1)
            use = np.isin(fresh[0], todo[settled])
            merged = tuple(np.concatenate([h, f[use]]) for h, f in zip(held, fresh, strict=True))
            best = _best(*merged, k)
            held = tuple(m[best] for m in merged)
            todo = todo[~settled]
    return held


def windows_joined(rows: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """anchor_id, window, row_id, score: for every anchor and window the first ``k`` rows (higher scores, then smaller ids) inside it.

    ``rows``: id, label, v. ``anchors``: id, label, v and windows (array of key, low, high); the rows' label equals the anchor's
    if ``same``, else differs. Every block gives its first k; a window function cuts them together.
    """
    spark = rows.sparkSession
    n = rows.count()
    per_block = min(MOST_ROWS, max(LEAST_ROWS, -(-n // (2 * spark.sparkContext.defaultParallelism))))
    blocks = max(1, -(-n // per_block))
    kind = "array<struct<key:long,low:long,high:long>>"
    held = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.lit(0).alias("tag"), "id", "label", "v", F.lit(None).cast(kind).alias("windows"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("tag"), "id", "label", "v", F.col("windows").cast(kind))
    dealt = held.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "tag")

    def blocked(batches: list[pa.RecordBatch]) -> tuple[list[Step], np.ndarray]:
        table = pa.Table.from_batches(batches).combine_chunks()
        values = matrix(table["v"].combine_chunks())
        order = np.argsort(-(values**2).sum(axis=0), kind="stable")
        values, ids, labels = values[:, order], table["id"].to_numpy(), table["label"].to_numpy()
        cut = range(0, len(values), STEP_ROWS)
        return [Step(ids[s : s + STEP_ROWS], labels[s : s + STEP_ROWS], values[s : s + STEP_ROWS], tails(values[s : s + STEP_ROWS])) for s in cut], order

    def ask(steps: list[Step], order: np.ndarray, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, labels, windows = (batch.column(c) for c in ("id", "label", "windows"))
        width = len(order)
        values = matrix(batch.column("v"), width)[:, :width][:, order]  # dimensions that no row has add nothing
        sizes = np.diff(windows.offsets.to_numpy())
        most = max(int(sizes.max(initial=0)), 1)
        low, high, keys = np.ones((len(ids), most)), np.zeros((len(ids), most)), np.zeros((len(ids), most), np.int64)
        flat = windows.flatten()
        row, at = np.repeat(np.arange(len(ids)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        low[row, at], high[row, at], keys[row, at] = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("low", "high", "key"))
        anchor, window, found, score = search(steps, ids.to_numpy(), labels.to_numpy(), values, low, high, same, k)
        return pa.RecordBatch.from_arrays([pa.array(ids.to_numpy()[anchor]), pa.array(keys[anchor, window]), pa.array(found), pa.array(score.astype(np.int64))], ["anchor_id", "window", "row_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ready = None, [], None
        for batch in batches:
            numbers, tags = batch.column("block").to_numpy(), batch.column("tag").to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], (numbers[1:] != numbers[:-1]) | (tags[1:] != tags[:-1])))) if batch.num_rows else []
            for start, end in zip(edges, [*edges[1:], batch.num_rows], strict=True):
                if numbers[start] != block:
                    block, held, ready = numbers[start], [], None
                part = batch.slice(start, end - start)
                if not tags[start]:
                    held.append(part)
                elif held:
                    ready = ready or blocked(held)
                    for at in range(0, part.num_rows, STEP_ANCHORS):
                        yield ask(*ready, part.slice(at, STEP_ANCHORS))

    local = dealt.mapInArrow(run, "anchor_id long, window long, row_id long, score long")
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "row_id")
    return local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: id (long), label (long), v (array of whole numbers; shorter vectors count as filled with zeros). An anchor's positives are its
    first rows of the same label; for each, the first rows of other labels whose score is ``least`` to ``most`` percent of the positive's are
    its negatives. Scores are inner products, exact up to 2^53; ties go to the smaller id. Rows with a null in id, label, v or a component
    take no part; rows of one id count once (the smallest by label and vector). Empty tables give no rows.
    """
    whole = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull()), F.lit(False)))
    picked = whole.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    known = stored(picked, "vectors")
    anchors = known.filter(is_anchor)
    edge = 1 << 60
    anything = F.array(F.struct(F.lit(0).cast("long").alias("key"), F.lit(-edge).alias("low"), F.lit(edge).alias("high")))
    first = stored(windows_joined(known, anchors.withColumn("windows", anything), same=True, k=positives), "positives")
    low, high = F.ceil(F.col("score") * least / 100), F.floor(F.col("score") * most / 100)
    asked = first.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct(F.col("row_id").alias("key"), low.alias("low"), high.alias("high"))).alias("windows"))
    found = windows_joined(known, anchors.join(asked, "id"), same=False, k=negatives)
    scores = first.select("anchor_id", F.col("row_id").alias("window"), F.col("score").alias("positive_score"))
    return found.join(scores, ["anchor_id", "window"]).select(
        "anchor_id", F.col("window").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
