"""Language-model scores: prediction by partial matching over byte contexts, next to a smoothed word model.

The trie of byte contexts is a table. One pass counts, per task, every (context of ``order`` bytes, next symbol) and every word of
the training texts; sums of these counts give all shorter contexts. Escapes and exclusions depend on a context's
counts only, so each (context, symbol) that occurs anywhere gets its final log-probability once, and a document's code
length is a sum of look-ups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortflow.llm.text import WordHashes, as_bytes, fold, slices, stored

#: Symbols: 0 stands before a text, 1-256 are bytes, 257 ends it; 9 bits hold one.
END, ALPHABET, BITS = 257, 257, 9
#: Entries of one look-up table in a task's memory; a larger model is looked up in several passes.
ENTRIES = 12_000_000
GRAM, WORD = 0, 1
#: The hash key of the end token: no word is empty.
END_TOKEN = b""


def symbols_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """One key per symbol to predict, all texts in a row, and each text's number of symbols.

    From the highest bits: the last symbol, the one before it, ... (``order`` of them), then the predicted one.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    flat = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int64) + 1
    ends = np.cumsum(sizes)
    flat[ends - 1] = END
    key = flat.copy()
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    for back in range(1, order + 1):
        # what lies before a text is symbol 0
        earlier = np.zeros_like(flat)
        earlier[back:] = flat[:-back]
        earlier[place < back] = 0
        key |= earlier << (BITS * (order + 1 - back))
    return key, sizes


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    at = np.argsort(key, kind="stable")
    key, count = key[at], count[at]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.append(first, len(keys)))


class _Tally:
    """Counts by key, merged whenever many have gathered."""

    def __init__(self, most: int = 3_000_000):
        self.keys, self.counts, self.held, self.most = [], [], 0, most

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > self.most:
            key, count = _merge(self.keys, self.counts)
            self.keys, self.counts, self.held = [key], [count], 0

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        return _merge(self.keys, self.counts) if self.keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def corpus_counts(docs: DataFrame, order: int) -> DataFrame:
    """kind, key, n: how often each gram and word occurs in training texts. ``docs``: text, train.

    Grams that only other texts have come with 0, so that every gram of any text finds an entry.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words, hashes = _Tally(), _Tally(), WordHashes()
        end = np.uint64(hashes[END_TOKEN])
        for batch in slices(batches, "text"):
            texts = [t.lower() for t in as_bytes(batch, "text")]
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            key, sizes = symbols_of(texts, order)
            key, n = _counted(key << 1 | np.repeat(~train, sizes))
            grams.add(key >> 1, np.where(key & 1, 0, n))
            known = [hashes.of(t.split()) for t, use in zip(texts, train, strict=True) if use]
            if known:
                words.add(*_counted(np.concatenate([*known, np.full(len(known), end)]).view(np.int64)))
        for kind, tally in ((GRAM, grams), (WORD, words)):
            key, n = tally.take()
            for at in range(0, len(key), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key[part]), kind, np.int32)), pa.array(key[part]), pa.array(n[part].astype(np.int64))], ["kind", "key", "n"]
                )

    partial = docs.select("text", "train").mapInArrow(run, "kind int, key long, n long")
    return partial.groupBy("kind", "key").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class ShortContexts:
    """Counts of contexts of one symbol (rows) and none, dense: at most 258 x 258."""

    pairs: np.ndarray

    @property
    def single(self) -> np.ndarray:
        return self.pairs.sum(axis=0)


def _per_group(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sum of ``values`` over rows of the same group, in every row."""
    _, at = np.unique(group, return_inverse=True)
    return np.bincount(at, values)[at]


def code_lengths(keys: np.ndarray, counts: np.ndarray, order: int, short: ShortContexts) -> np.ndarray:
    """log10 P(symbol | context) of each distinct key, escapes by the number of distinct symbols (method C), with exclusion.

    ``keys`` must hold all grams that share their last two context symbols with one of them. Going from a context to the next
    shorter one, the symbols already seen in the longer one are taken out of the shorter one's counts.
    """
    sym = keys & ((1 << BITS) - 1)
    last = keys >> (BITS * order)
    out, found = np.zeros(len(keys)), np.zeros(len(keys), bool)
    seen_above, distinct_above, context_above = np.zeros(len(keys), bool), np.zeros(len(keys)), None
    for j in range(order, -1, -1):
        if j >= 2:
            context = keys >> (BITS * (order + 1 - j))
            pair = context << BITS | sym
            c = _per_group(pair, counts.astype(float))
            first = np.zeros(len(keys), bool)
            first[np.unique(pair, return_index=True)[1]] = True
            n = _per_group(context, counts.astype(float))
            d = _per_group(context, (first & (c > 0)).astype(float))
        elif j == 1:
            c, n, d = short.pairs[last, sym], short.pairs.sum(axis=1)[last], (short.pairs > 0).sum(axis=1)[last]
            first = None
        else:
            single = short.single
            c, n, d = single[sym], np.full(len(keys), single.sum()), np.full(len(keys), (single > 0).sum())
        # the counts here of the symbols that the longer context has seen
        if context_above is None:
            excluded = np.zeros(len(keys))
        elif j >= 1:
            excluded = _per_group(context_above, np.where(seen_above, c, 0).astype(float))
        else:
            excluded = np.where(short.pairs > 0, short.single, 0).sum(axis=1)[last].astype(float)
        total, fresh = n - excluded, d - distinct_above
        hit, miss = ~found & (c > 0), ~found & (c == 0) & (n > 0) & (fresh > 0)
        out[hit] += np.log10(c[hit] / (total[hit] + fresh[hit]))
        out[miss] += np.log10(fresh[miss] / (total[miss] + fresh[miss]))
        found |= hit
        distinct_above = d.astype(float)
        context_above, seen_above = (context, first & (c > 0)) if j >= 2 else (last, c > 0)
    unseen = ALPHABET - (short.single > 0).sum()
    out[~found] -= np.log10(max(unseen, 1))
    return out


def train(counts: DataFrame, order: int) -> DataFrame:
    """key, value: the log-probability of every gram of ``counts`` (key, n), dealt out by the last two context symbols."""
    low = (1 << BITS) - 1
    pairs = counts.groupBy(F.shiftright("key", BITS * order).alias("last"), F.col("key").bitwiseAND(F.lit(low).cast("long")).alias("sym")).agg(F.sum("n").alias("n"))
    dense = np.zeros((ALPHABET + 1, ALPHABET + 1), np.int64)
    for row in pairs.collect():  # at most 258 x 258
        dense[row["last"], row["sym"]] = row["n"]
    short = ShortContexts(dense)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([*batches], pa.schema([("key", pa.int64()), ("n", pa.int64())]))
        if table.num_rows:
            keys = table["key"].to_numpy()
            yield from pa.table({"key": keys, "value": code_lengths(keys, table["n"].to_numpy(), order, short).astype(np.float32)}).to_batches(100_000)

    dealt = counts.select("key", "n").repartition(F.shiftright("key", BITS * (order - 1)))
    return dealt.mapInArrow(run, "key long, value float")


@dataclass
class Lookup:
    """Sorted mixed keys with a directory of their top bits: a few bytes an entry, and one or two probes a look-up."""

    keys: np.ndarray
    values: np.ndarray
    heads: np.ndarray
    shift: int

    @classmethod
    def build(cls, keys: np.ndarray, values: np.ndarray) -> Lookup:
        mixed = _mixed(keys)
        at = np.argsort(mixed)
        mixed = mixed[at]
        bits = max(1, min(24, int(np.ceil(np.log2(max(len(keys), 2))))))
        heads = np.searchsorted(mixed, np.arange((1 << bits) + 1, dtype=np.uint64)[:-1] << np.uint64(64 - bits))
        return cls(mixed, values[at], np.append(heads, len(keys)).astype(np.int32), 64 - bits)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each key (0 where there is none), and whether there is one."""
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        mixed = _mixed(keys)
        top = (mixed >> np.uint64(self.shift)).astype(np.int64)
        at, stop = self.heads[top], self.heads[top + 1]
        ok = self.keys[np.minimum(at, len(self.keys) - 1)] == mixed
        ok &= at < stop
        open_ = np.flatnonzero(~ok & (at + 1 < stop))
        while len(open_):
            at[open_] += 1
            hit = self.keys[at[open_]] == mixed[open_]
            ok[open_[hit]] = True
            open_ = open_[~hit]
            open_ = open_[at[open_] + 1 < stop[open_]]
        return np.where(ok, self.values[np.minimum(at, len(self.keys) - 1)], 0), ok


def _mixed(keys: np.ndarray) -> np.ndarray:
    x = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs; every run has a member."""
    return np.add.reduceat(values, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0)


PARTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("n_tokens", T.LongType())]
    + [T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType())]
)


def _score(order: int, grams, words) -> Callable:
    """Sums over the entries of one shard: ``grams`` and ``words`` are broadcast (keys, values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram_table, word_table, hashes = Lookup.build(*grams.value), Lookup.build(*words.value), WordHashes()
        end = np.uint64(hashes[END_TOKEN])
        for batch in slices(batches, "text", 1 << 20):
            texts = [t.lower() for t in as_bytes(batch, "text")]
            key, sizes = symbols_of(texts, order)
            score = _sums(gram_table.find(key)[0].astype(float), sizes)
            tokens = [hashes.of(t.split()) for t in texts]
            n = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
            flat = np.concatenate([x for t in tokens for x in (t, [end])]).astype(np.uint64).view(np.int64)
            value, known = word_table.find(flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(n), pa.array(_sums(known.astype(np.int64), n)), pa.array(_sums(value, n)), pa.array(score)],
                PARTS.names,
            )

    return run


def language_scores(
    docs: DataFrame, order: int = 4, modulus: int = 5, held: int = 1, text: str = "text", doc_id: str = "doc_id", entries: int = ENTRIES
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Learns from the rows whose id's crc32 leaves another remainder than ``held``; a null id counts as training. Null and empty
    texts consist of their end alone. A-Z are lower-cased. With nothing to learn from all symbols are equally likely. Repeated rows are
    learnt and scored as often as they occur. ``entries`` bounds the model entries that a task holds at a time; a model of n
    entries takes n / entries passes over the texts.
    """
    spark = docs.sparkSession
    part = fold(F.col(doc_id), modulus)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("text"), F.coalesce(part == held, F.lit(False)).alias("held_out"))
    counts = stored(corpus_counts(rows.select("text", (~F.col("held_out")).alias("train")), order), "counts")
    words = counts.filter(F.col("kind") == WORD).select("key", "n")
    grams = stored(train(counts.filter(F.col("kind") == GRAM), order), "grams")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    below = total["n"] + 0.5 * (total["v"] + 1)
    shards = max(1, -(-(grams.count() + total["v"]) // entries))

    def share(table: DataFrame, column: str, k: int) -> tuple[np.ndarray, np.ndarray]:
        """One shard, at most about ``entries`` rows, into the driver's memory to be broadcast."""
        mine = table if shards == 1 else table.filter(F.pmod(F.xxhash64("key"), F.lit(shards)) == k)
        found = mine.select("key", column).toArrow()
        return found["key"].to_numpy(), found[column].to_numpy()

    keyed = rows.select("doc_id", F.xxhash64("text").alias("row"), "text")
    parts = []
    for k in range(shards):
        key, n = share(words, "n", k)
        word_part = spark.sparkContext.broadcast((key, np.log10((n + 0.5) / below)))
        gram_part = spark.sparkContext.broadcast(share(grams, "value", k))
        scored = keyed.mapInArrow(_score(order, gram_part, word_part), PARTS)
        if shards > 1:
            scored = stored(scored, "scores")
            word_part.destroy()
            gram_part.destroy()
        parts.append(scored)
    scored = parts[0]
    if shards > 1:
        for other in parts[1:]:
            scored = scored.unionByName(other)
        # every row is in every part once; equal rows get equal sums
        sums = scored.groupBy("doc_id", "row").agg(
            (F.count(F.lit(1)) / shards).cast("int").alias("_times"), F.max("n_tokens").alias("n_tokens"),
            *[(F.sum(c) / (F.count(F.lit(1)) / shards)).alias(c) for c in ("n_known", "base", "score")],
        )
        scored = sums.withColumn("_", F.explode(F.sequence(F.lit(1), "_times")))
    unknown = float(np.log10(0.5 / below))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), modulus) == held, F.lit(False)).alias("held_out"),
        "n_tokens",
        F.col("n_known").cast("long").alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + (F.col("n_tokens") - F.col("n_known")) * F.lit(unknown)).alias("base_score"),
        "score",
    )
