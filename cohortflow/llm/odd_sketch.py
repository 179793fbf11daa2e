"""Near duplicates: MinHash bands find candidates, odd sketches judge them, full shingle sets confirm the links.

Every text becomes a set of shingles. Equal sets are one class from then on. A class's MinHash samples give its bands and, folded
into a parity bitmap, its odd sketch: the XOR of two sketches counts the samples in which they differ. Candidates whose sketches
cannot belong to a similar pair are left; the others are compared as full sets.

With 32 bands of 4 samples a pair at similarity 0.8 meets in no band with a chance of 5e-8; the sketch turns such a pair away with
a chance below 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from cohortflow.llm.components import components
from cohortflow.llm.text import WordHashes, as_bytes, slices, stored
from cohortflow.plans.lineage import broadcast_if_small

#: Samples that fold into the sketch; the first BANDS * ROWS of them also make the bands.
SAMPLES, SKETCH_BITS = 256, 1024
BANDS, ROWS = 32, 4
#: Rounds in which a bucket's members are compared with one of them, before what is left is compared block by block.
ROUNDS = 2
#: Members of a bucket, and shingles of theirs, that one comparison step holds on each side.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
#: Members up to which a bucket's likely pairs are listed (at most so many per member); larger buckets confirm inside their blocks.
LISTED = 32
_RNG = np.random.default_rng(20240229)
_FLIP = _RNG.integers(0, 1 << 32, SAMPLES, np.uint32)
_STRETCH = _RNG.integers(0, 1 << 32, SAMPLES, np.uint32) | np.uint32(1)
_PLACE = _RNG.integers(1, 1 << 63, 32, np.uint64) | np.uint64(1)
_SLOT = _RNG.integers(1, 1 << 63, SAMPLES, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mix: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingles of ``width`` words (A-Z lower-cased, ASCII white space between). Fewer words make one shingle."""
    words = hashes.of(text.lower().split())
    n = len(words)
    if not n:
        return words
    if n < width:
        return _mix(np.array([np.bitwise_xor.reduce(_mix(words * _PLACE[:n] + np.arange(n, dtype=np.uint64))) + np.uint64(n)]))
    total = words[: n - width + 1] * _PLACE[0]
    for k in range(1, width):
        total = total + words[k : n - width + 1 + k] * _PLACE[k]
    total = np.sort(_mix(total))
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def minhash(found: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of the permutations."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    best = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        part = low[at : at + 2048, None] ^ _FLIP
        part *= _STRETCH
        np.minimum(best, part.min(axis=0), out=best)
    return best


def bands_of(samples: np.ndarray) -> np.ndarray:
    """A 64-bit key per row and band."""
    grouped = samples[:, : BANDS * ROWS].astype(np.uint64).reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), grouped.shape[:2])
    for k in range(ROWS):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return key


def sketches(samples: np.ndarray) -> np.ndarray:
    """Rows of SKETCH_BITS bits: bit = parity of the (slot, sample) pairs that fall on it."""
    at = _mix(samples.astype(np.uint64) + _SLOT) % np.uint64(SKETCH_BITS)
    flat = np.arange(len(samples), dtype=np.int64)[:, None] * SKETCH_BITS + at.astype(np.int64)
    parity = np.bincount(flat.ravel(), minlength=len(samples) * SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(-1, SKETCH_BITS), axis=1).view(np.int64)


def estimate(differing_bits: np.ndarray | float) -> np.ndarray | float:
    """Similarity from the number of ones in the XOR of two sketches."""
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * np.asarray(differing_bits) / SKETCH_BITS, 1e-9))


def most_bits(similarity: float) -> int:
    """Ones in the XOR that a pair at ``similarity`` exceeds with a chance below 1e-9.

    The estimate's spread: binomial in the samples, plus collisions in the bitmap.
    """
    differ = SAMPLES * (1 - similarity)
    spread = np.sqrt(SAMPLES * similarity * (1 - similarity))
    far = 2 * min(SAMPLES, differ + 6.5 * spread + 3)
    return int(np.ceil(SKETCH_BITS / 2 * (1 - np.exp(-2 * far / SKETCH_BITS))))


def signatures(docs: DataFrame, width: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, digest (128 bits of the set; null if empty), bands, sketch of every whole text."""
    schema = docs.select(F.col(doc_id).alias("doc_id")).schema
    for name, kind in (("n_shingles", T.LongType()), ("digest", T.BinaryType()), ("bands", T.ArrayType(T.LongType())), ("sketch", T.ArrayType(T.LongType()))):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            samples, sizes, digests = np.empty((batch.num_rows, SAMPLES), np.uint32), [], []
            for at, whole in enumerate(as_bytes(batch, "text")):
                found = shingles(whole, width, hashes)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                samples[at] = minhash(found)
            band = pa.FixedSizeListArray.from_arrays(pa.array(bands_of(samples).view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
            sketch = pa.FixedSizeListArray.from_arrays(pa.array(sketches(samples).ravel()), SKETCH_BITS // 64).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), band, sketch], schema.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share at least ``percent`` of their union."""
    both = np.sort(np.concatenate((x, y)))
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _sets(docs: DataFrame, ids: DataFrame, width: int, text: str, doc_id: str) -> DataFrame:
    """doc_id, found: the full shingle sets of the documents that ``ids`` names, one row each."""
    needed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(broadcast_if_small(ids), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            found = [shingles(t, width, hashes).tobytes() for t in as_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "found"])

    schema = docs.select(F.col(doc_id).alias("doc_id")).schema.add("found", T.BinaryType())
    return stored(needed.mapInArrow(run, schema), "sets").dropDuplicates(["doc_id"])


def _confirmed(docs: DataFrame, pairs: DataFrame, width: int, percent: int, text: str, doc_id: str) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. Only texts that occur in a pair are read into sets."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    known = _sets(docs, ids, width, text, doc_id)
    left, right = known.select(F.col("doc_id").alias("a"), F.col("found").alias("of_a")), known.select(F.col("doc_id").alias("b"), F.col("found").alias("of_b"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(iter([whole]), "of_a"):
                ok = []
                for one, two in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist(), strict=True):
                    ok.append(_similar(np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64), percent))
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    return stored(pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b").mapInArrow(judge, pairs.select("a", "b").schema), "links")


class _Union:
    """Components known inside one comparison step."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            x = y
        return x


def _blocked(buckets: DataFrame, limit: int, percent: int, confirm: bool) -> DataFrame:
    """Links (a, b) between members of one bucket that lie in different components; within a step, links that join nothing new are left out.

    ``buckets``: band, doc_id, component, n_shingles, sketch, bands and found (the full set). A large bucket is dealt
    into blocks by a hash of the id, and each step compares two blocks in memory: sketches first, then full sets. Without ``confirm`` all pairs with close sketches are given, for later confirmation, and no sets are needed. So a bucket
    of any size becomes many bounded steps, and only links are emitted. A pair that meets in several bands is compared in its first one.
    """
    sizes = buckets.groupBy("band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("parts")
    )
    member = F.struct("doc_id", "component", "n_shingles", "sketch", "bands", *(["found"] if confirm else []))
    blocks = buckets.join(sizes, "band").withColumn("block", F.pmod(F.xxhash64("doc_id"), "parts"))
    blocks = blocks.groupBy("band", "block").agg(F.collect_list(member).alias("rows"), F.max("parts").alias("parts"))
    empty = F.lit(None).cast(blocks.schema["rows"].dataType)
    whole = blocks.select("band", "rows", empty.alias("rows_b"))
    large = blocks.filter("parts > 1")
    other = large.select("band", F.col("block").alias("block_b"), F.col("rows").alias("rows_b"))
    across = large.join(other, "band").filter("block < block_b").repartition("band", "block", "block_b").select("band", "rows", "rows_b")

    def side(rows) -> tuple:
        wide = lambda c: rows.field(c).flatten().to_numpy().view(np.uint64).reshape(len(rows), -1)
        return (*(rows.field(c).to_numpy() for c in ("doc_id", "component", "n_shingles")), wide("sketch"), wide("bands"), rows.field("found") if confirm else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at, band in enumerate(batch.column("band").to_pylist()):
                ids, comp, n, sk, keys, found = side(batch.column("rows")[at].values)
                second = batch.column("rows_b")[at].values
                ids2, comp2, n2, sk2, keys2, found2 = (ids, comp, n, sk, keys, found) if second is None else side(second)
                bits = np.zeros((len(ids), len(ids2)), np.uint16)
                for w in range(sk.shape[1]):
                    bits += np.bitwise_count(sk[:, None, w] ^ sk2[None, :, w])
                ok = (bits <= limit) & (comp[:, None] != comp2) & (100 * np.minimum(n[:, None], n2) >= percent * np.maximum(n[:, None], n2))
                ok &= (ids[:, None] < ids2) if second is None else (ids[:, None] != ids2)
                for k in range(int(np.argmax(keys[0] == np.int64(band).view(np.uint64)))):
                    ok &= keys[:, None, k] != keys2[None, :, k]  # else an earlier band has compared the pair
                if not confirm:
                    x, y = np.nonzero(ok)
                    out += zip(np.minimum(ids[x], ids2[y]).tolist(), np.maximum(ids[x], ids2[y]).tolist(), strict=True)
                    continue
                known, sets = _Union(), {}
                for x, y in zip(*(v.tolist() for v in np.nonzero(ok)), strict=True):
                    one, two = known.root(int(comp[x])), known.root(int(comp2[y]))
                    if one == two:
                        continue
                    for k, ids_of, where in (((0, x), found, x), ((1, y), found2, y)):
                        if k not in sets:
                            sets[k] = np.frombuffer(ids_of[where].as_py(), np.uint64)
                    if _similar(sets[0, x], sets[1, y], percent):
                        known.up[max(one, two)] = min(one, two)
                        out.append((int(min(ids[x], ids2[y])), int(max(ids[x], ids2[y]))))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return whole.unionByName(across).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; ids are whole numbers.

    Links join texts whose sets share at least ``percent`` of their union. component_id is the smallest id reachable. Null and
    empty texts link with nothing and are kept. Rows of one id are one document; a row without an id follows its class but names none.

    A bucket first compares its members with its smallest one, then, in further rounds, with others drawn by a hash as long
    as it has members in different components. What then still lies apart is compared block by block, without regard to bucket
    size. Nothing is capped; a group of copies takes a few comparisons per member.
    """
    limit = most_bits(percent / 100)
    found = stored(signatures(docs, width, text, doc_id), "signatures")
    # equal sets have equal bands and sketches
    classes = stored(
        found.filter("n_shingles > 0").groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    named = classes.filter(F.col("doc_id").isNotNull())
    members = named.select("doc_id", F.explode("bands").alias("band"))
    crowded = members.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    placed = stored(members.join(crowded, "band").withColumn("component", F.col("doc_id")), "buckets")
    sketch = named.select("doc_id", "n_shingles", "sketch")
    side = lambda c: sketch.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    bits = sum((F.bit_count(F.get("s_a", F.lit(w)).bitwiseXOR(F.get("s_b", F.lit(w)))) for w in range(SKETCH_BITS // 64)), F.lit(0))
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    tested = links = None
    labels = docs.sparkSession.createDataFrame([], "node long, component long")

    for turn in range(ROUNDS + 1):
        if turn < ROUNDS:
            order = F.col("doc_id") if turn == 0 else F.xxhash64(F.lit(turn), "band", "doc_id")
            pivot = F.min_by(F.struct("doc_id", "component"), order).alias("pivot")
            open_ = placed.groupBy("band").agg(pivot, F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
            open_ = stored(open_.select("band", "pivot"), "pivots")
            if not open_.limit(1).count():
                break
            apart = placed.join(open_, "band").filter("component <> pivot.component")
            pairs = apart.select(F.least("doc_id", "pivot.doc_id").alias("a"), F.greatest("doc_id", "pivot.doc_id").alias("b")).distinct()
            likely = pairs.join(side("b"), "b").join(side("a"), "a").filter(sizes & (bits <= limit)).select("a", "b")
            likely = stored(likely if tested is None else likely.join(tested, ["a", "b"], "left_anti"), "pairs")
            tested = likely if tested is None else tested.unionByName(likely)
            found_links = _confirmed(docs, likely, width, percent, text, doc_id)
        else:
            open_ = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("band")
            rest = stored(placed.join(open_, "band", "left_semi"), "rest")
            small, large = rest.filter(F.col("members") <= LISTED), rest.filter(F.col("members") > LISTED)
            short = named.select("doc_id", "n_shingles", "sketch", "bands")
            likely = _blocked(small.join(short, "doc_id"), limit, percent, confirm=False)
            likely = stored(likely if tested is None else likely.join(tested, ["a", "b"], "left_anti"), "pairs")
            found_links = _confirmed(docs, likely, width, percent, text, doc_id)
            full = _sets(docs, large.select("doc_id").distinct(), width, text, doc_id)
            inside = _blocked(large.join(short.join(full, "doc_id"), "doc_id"), limit, percent, confirm=True)
            found_links = found_links.unionByName(stored(inside, "links"))
        if links is not None and not found_links.limit(1).count():
            continue
        links = found_links if links is None else links.unionByName(found_links)
        labels = components(links)
        known = labels.select(F.col("node").alias("doc_id"), F.col("component").alias("_component"))
        if turn < ROUNDS:
            placed = stored(placed.join(known, "doc_id", "left").withColumn("component", F.coalesce("_component", "doc_id")).drop("_component"), "buckets")
    reached = classes.join(labels.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    reached = reached.select("digest", F.coalesce("component", "doc_id").alias("_component"))
    rows = found.select("doc_id", "n_shingles", "digest").join(reached, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, with all their columns: one document of each group. Rows that repeat a kept id are dropped as well.

    Every row without an id is a document of its own. It is compared like all others, under a number above the largest id, so
    in a group a document with an id stays.
    """
    number = F.col(doc_id).cast("long")
    named = docs.filter(F.col(doc_id).isNotNull())
    largest = F.lit(named.agg(F.coalesce(F.max(number), F.lit(0)).alias("n")).first()["n"])
    unnamed = stored(docs.filter(F.col(doc_id).isNull()).withColumn("_unnamed", largest + 1 + F.monotonically_increasing_id()), "unnamed")
    all_rows = named.select(number.alias("doc_id"), F.col(text).alias("text")).unionByName(unnamed.select(F.col("_unnamed").alias("doc_id"), F.col(text).alias("text")))
    judged = stored(near_duplicates(all_rows, width, percent), "judged")
    gone = broadcast_if_small(judged.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct())
    kept = named.join(gone, number == F.col("_gone"), "left_anti")
    repeats = judged.filter("kept").groupBy("doc_id").count().filter("count > 1").limit(1).count()
    kept = kept.dropDuplicates([doc_id]) if repeats else kept
    return kept.unionByName(unnamed.join(gone, F.col("_unnamed") == F.col("_gone"), "left_anti").drop("_unnamed"))
