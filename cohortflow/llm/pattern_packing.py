"""Best-fit packing: a configuration linear program over the length histogram, rounded into sequences of one capacity.

Texts become token pieces of at most ``capacity`` ids. The program asks how often each pattern (a multiset of lengths that fits) is used so
that every length is covered once. Its dual prices start at a power of length / capacity and fall multiplicatively with the share of a length that
is covered; the dearest pattern under the prices is a knapsack, found by dynamic programming. Whole uses are kept, the few pieces that
are left are packed best fit. All of that works on the histogram, whose size the capacity bounds, not the data. The pieces then find their
places by their rank among the pieces of their length: no shuffle of ids, no order of all pieces.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from cohortflow.llm.text import slices, stored
from cohortflow.plans.lineage import broadcast_if_small

CAPACITY = 1024
#: Strength of the prices' reaction, how far below the best pattern another one may lie to be used at the same prices, and the power of
#: (length / capacity) that prices start with: above 1, so that long pieces, which fit least, are used first.
REACTION, NEAR, LONG_FIRST = 1.0, 0.002, 1.3
#: Uses of a pattern with room left that are held back for best fit, which bounds the pieces packed one by one.
HELD = 16
#: Characters that both libraries class alike (Latin letters and signs). A text with others goes to the tokenizer's own library.
_OTHER = re.compile(r"[^\x00-ɏ]").search


def encoder(path: str, ranks: str | None = None, pattern: str | None = None):
    """text -> ids as ``tokenizers`` gives them for ``path``, without added special tokens.

    ``ranks``: the same vocabulary as ranks, with its splitting ``pattern``; a faster library then encodes the texts
    on which both agree. Special tokens inside texts are recognised, as by the tokenizer's default.
    """
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    whole = lambda text: library.encode(text, add_special_tokens=False).ids
    if ranks is None:
        return whole
    import tiktoken

    with open(ranks, "rb") as lines:
        known = {base64.b64decode(token): int(number) for token, number in map(bytes.split, lines)}
    special = {token.content: number for number, token in library.get_added_tokens_decoder().items() if token.special}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens=special)

    def encode(text: str) -> list[int]:
        if _OTHER(text):
            return whole(text)
        try:
            return fast.encode(text, allowed_special="all")
        except ValueError:  # too long a run of white space for its pattern engine
            return whole(text)

    return encode


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of a text's pieces: full ones, but for the first."""
    first = length % capacity or capacity
    edges = [0, *range(min(first, length), length + 1, capacity)]
    return list(pairwise(edges)) or [(0, length)]


def token_pieces(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY, ranks: str | None = None, pattern: str | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit), _part and _rank (from 0 among the task's pieces of that length)."""
    schema = docs.select(F.col(doc_id).alias("doc_id")).schema
    for name, kind in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("_part", T.IntegerType()), ("_rank", T.LongType())):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(path, ranks, pattern), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            rows: list[tuple] = []
            for at, whole in enumerate(batch.column("text").to_pylist()):
                ids = np.array([*encode(whole or ""), end_id], "<u4")
                for number, (start, end) in enumerate(cuts(len(ids), capacity)):
                    rows.append((at, number, start, end - start, ids[start:end].tobytes(), int(seen[end - start])))
                    seen[end - start] += 1
            owner, number, start, length, ids, rank = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array([part] * len(rows), pa.int32()), pa.array(rank, pa.int64())],
                schema.names,
            )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def dearest(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: the highest sum of prices that fits into c; last[c]: place of a length that a best choice for c ends with, -1 for a unit left empty."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c, fitting in enumerate(np.searchsorted(lengths, np.arange(1, capacity + 1), "right"), 1):
        best[c] = best[c - 1]
        if fitting:
            gains = prices[:fitting] + best[c - lengths[:fitting]]
            at = int(gains.argmax())
            if gains[at] > best[c]:
                best[c], last[c] = gains[at], at
    return best, last


def solve(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[float, dict[int, int]]]:
    """(uses, pattern) with sum(uses * pattern) = histogram: a near-optimal fractional solution of the configuration program.

    Every round prices the lengths, finds the best value of every capacity by the knapsack, and uses the best pattern around each length
    that comes close to the best of all, until one of its lengths is covered.
    """
    lengths = np.array(sorted(k for k, n in histogram.items() if n and k < capacity))
    found = [(float(histogram[capacity]), {capacity: 1})] if histogram.get(capacity) else []
    demand = np.array([float(histogram[int(k)]) for k in lengths])
    left = demand.copy()
    while len(lengths):
        covered = 1 - left / demand
        prices = (lengths / capacity) ** LONG_FIRST * np.exp(-REACTION * (covered - covered.mean()))
        best, last = dearest(lengths, prices, capacity)
        values = prices + best[capacity - lengths]
        for at in np.argsort(-values):
            if values[at] < (1 - NEAR) * best[capacity]:
                break
            if left[at] <= 0:
                continue
            chosen, rest = Counter([int(at)]), capacity - int(lengths[at])
            while rest > 0:
                if last[rest] < 0:
                    rest -= 1
                else:
                    chosen[int(last[rest])] += 1
                    rest -= int(lengths[last[rest]])
            places, counts = np.array([*chosen]), np.array([*chosen.values()])
            whole = np.minimum(counts, np.ceil(demand[places]))  # a pattern holds no more pieces than there are
            uses = float(np.min(left[places] / whole))
            if uses <= 0:
                continue
            left[places] -= uses * whole
            left[left < 1e-9 * demand] = 0
            found.append((uses, {int(lengths[p]): int(n) for p, n in zip(places, whole, strict=True)}))
        open_ = left > 0
        lengths, demand, left = lengths[open_], demand[open_], left[open_]
    return found


def best_fit(pieces: Mapping[int, int], capacity: int) -> Counter:
    """pattern (sorted pairs of length and count) -> uses: the longest piece first, into the fullest sequence that still has room."""
    room: list[tuple[int, int]] = []
    held: list[Counter] = []
    for length in sorted(pieces, reverse=True):
        for _ in range(pieces[length]):
            at = bisect_left(room, (length, -1))
            if at < len(room):
                free, where = room.pop(at)
            else:
                free, where = capacity, len(held)
                held.append(Counter())
            held[where][length] += 1
            insort(room, (free - length, where))
    return Counter(tuple(sorted(c.items())) for c in held)


def _rounded(uses_of: Mapping[tuple, float], histogram: Mapping[int, int], capacity: int, held: int) -> Counter:
    """pattern -> whole uses: rounded, less ``held`` where room is left; the rest is packed best fit."""
    left, out = dict(histogram), Counter()
    for pattern, uses in sorted(uses_of.items(), key=lambda x: (-x[1], x[0])):
        back = 0 if sum(k * n for k, n in pattern) == capacity else held
        times = max(min(int(uses + 0.5) - back, *(left[k] // n for k, n in pattern)), 0)
        if times:
            out[pattern] += times
            for k, n in pattern:
                left[k] -= times * n
    out.update(best_fit({k: n for k, n in left.items() if n}, capacity))
    return out


def whole_patterns(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(uses, pattern) in whole numbers that hold every piece once: the program's solution rounded, its rest packed best fit.

    Rounding leaves less than one use of each pattern. It is done twice, once with HELD uses of each pattern with room left given back as well, and
    the result with fewer sequences counts.
    """
    demand = {int(k): int(n) for k, n in histogram.items() if n}
    merged: Counter = Counter()
    for uses, pattern in solve(demand, capacity):
        merged[tuple(sorted(pattern.items()))] += uses
    out = min((_rounded(merged, demand, capacity, held) for held in (0, HELD)), key=lambda c: c.total())
    return [(n, dict(p)) for p, n in sorted(out.items())]


def places(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces a sequence, first sequence, offset) for every length of every pattern."""
    rows, next_rank, sequence = [], Counter(), 0
    for uses, pattern in patterns:
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            first = next_rank[length]
            rows.append((length, first, first + uses * n, n, sequence, offset))
            next_rank[length] += uses * n
            offset += length * n
        sequence += uses
    return rows


def pack(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY, ranks: str | None = None, pattern: str | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset: every piece of every text with its place in a sequence.

    A null or empty text is one piece, its end id. Only texts longer than ``capacity`` are cut. Repeated rows, rows of one id and rows without an
    id are texts of their own. Equal lengths are interchangeable; which of them gets which place follows the order of files and rows. No
    text gives no rows.
    """
    pieces = stored(token_pieces(docs, path, end_id, capacity, ranks, pattern, text, doc_id), "pieces")
    counts = stored(pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # at most one row per length
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = docs.sparkSession.createDataFrame(places(whole_patterns(histogram, capacity)), "length long, _from long, _to long, _each long, _sequence long, _offset long")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    placed = pieces.join(broadcast_if_small(stored(starts, "starts")), ["_part", "length"]).withColumn("_rank", F.col("_before") + F.col("_rank"))
    # the slots' number is bounded by the patterns of the program, not by the data
    own = (placed["length"] == slots["length"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    step = F.col("_rank") - F.col("_from")
    return placed.join(F.broadcast(slots), own).select(
        "doc_id", "piece", "start", placed["length"], "ids",
        (F.col("_sequence") + F.floor(step / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + step % F.col("_each") * placed["length"]).alias("offset"),
    )
