"""Benchmark decontamination: latent semantic retrieval, then subsequence and answer checks.

Passages of all documents become TF-IDF rows over the benchmark's words. A distributed randomised SVD gives the latent basis; passages
and benchmark texts are compared there, and what comes close is judged by the longest common subsequence of words.

A word's weight is log(1 + blocks / occurrences), whose spread is bounded: a text that many documents share keeps its weight next to rarer
words. The basis is fitted on all documents together with the benchmark texts, which weigh more than they do; every passage of every
document is then compared in the truncated space. A passage's norm counts at most as much as the benchmark text's own: other words
beside a copy lower nothing. Words are compared in folded case and composed form.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortflow.llm.license_scan import words_of
from cohortflow.llm.text import as_bytes, slices, stored
from cohortflow.plans.lineage import broadcast_if_small

#: A passage is two neighbouring blocks of so many words; passages overlap by one block.
BLOCK_WORDS = 32
#: Latent directions beyond one for each benchmark stretch of a run.
RANK, OVERSAMPLE = 56, 8
#: Lowest latent product of a candidate with a benchmark text, over the text's norm and the smaller of both norms.
COSINE = 0.35
#: Share of a benchmark text's words found in order: a copy; a paraphrase, if its answer is found as well.
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.75
#: Words of benchmark texts searched in one run, which bounds what is broadcast.
RUN_WORDS = 12_000
#: A word in more than this share of all blocks tells nothing.
COMMON = 0.05
#: Energy of the benchmark texts in the fit, in shares of the passages'.
PROBE_SHARE = 4.0
#: Bytes of coded documents that a task works on at once: their rows of the basis take some hundred times as much.
SLICE_BYTES = 1 << 19
#: Candidates whose words are counted in one step.
STEP_PAIRS = 2048
#: Rows that one step of a sum adds, which stay in a core's cache, and the most rows that one group of a sum adds before its parts are added in turn.
STEP_ROWS, GROUP_ROWS = 512, 64


def folded_words(text: bytes) -> list[bytes]:
    """Words in folded case and composed form."""
    if text.isascii():
        return words_of(text)
    return words_of(unicodedata.normalize("NFC", text.decode("utf-8", "replace").casefold()).encode())


@dataclass(frozen=True)
class Probe:
    """A stretch of a benchmark text as word numbers; the last third counts as its answer."""

    item: int
    words: tuple[int, ...]

    @property
    def answer(self) -> tuple[int, ...]:
        return self.words[-max(1, len(self.words) // 3) :]


def probes_of(items: Sequence[tuple[int, bytes]]) -> tuple[list[Probe], dict[bytes, int]]:
    """Benchmark texts as probes of at most two blocks of words, and the numbers (from 1) of their words."""
    vocabulary: dict[bytes, int] = {}
    probes, most = [], 2 * BLOCK_WORDS
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in folded_words(text)]
        starts = [*range(0, max(len(ids) - most, 0), most), max(len(ids) - most, 0)]
        probes += [Probe(item, tuple(ids[s : s + most])) for s in dict.fromkeys(starts) if ids]
    return probes, vocabulary


def masks_of(words: Sequence[int]) -> dict[int, int]:
    found: dict[int, int] = {}
    for at, w in enumerate(words):
        found[w] = found.get(w, 0) | 1 << at
    return found


def common_subsequence(masks: dict[int, int], length: int, text: Sequence[int]) -> int:
    """Length of the longest common subsequence, one step of bit arithmetic per word of ``text``."""
    row = full = (1 << length) - 1
    for w in text:
        mask = masks.get(w)
        if mask:
            u = row & mask
            row = ((row + u) | (row - u)) & full
    return length - row.bit_count()


def _coded(docs: DataFrame, vocabulary: dict[bytes, int], text: str, doc_id: str) -> DataFrame:
    """doc_id, ids: every word of every text as its number, 0 for words no benchmark text has; texts without any are left out."""
    kind = np.uint16 if len(vocabulary) < 65_535 else np.uint32
    schema = docs.select(F.col(doc_id).alias("doc_id")).schema.add("ids", T.BinaryType())
    get = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = get.value.get
        for batch in slices(batches, "text", 1 << 20):
            found = []
            for whole in as_bytes(batch, "text"):
                words = folded_words(whole)
                ids = np.fromiter(map(number, words, repeat(0)), kind, len(words))
                found.append(ids.tobytes() if ids.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema).filter(F.col("ids").isNotNull())


def summed_rows(of: np.ndarray, groups: int, picks: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Per group the sum of the rows ``picks`` of ``table``, in the order given; ``of`` is the group of each pick.

    Groups are ranked by their size, so that the n-th rows of all groups that have so many are added at once, to a run of sums without gaps.
    """
    counts = np.bincount(of, minlength=groups)
    order = np.argsort(of, kind="stable")
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    if len(of) and counts.max() > GROUP_ROWS:
        parts = -(-counts // GROUP_ROWS)
        part = np.repeat(np.cumsum(parts) - parts, counts) + nth // GROUP_ROWS
        return summed_rows(np.repeat(np.arange(groups), parts), groups, np.arange(parts.sum()), summed_rows(part, int(parts.sum()), picks[order], table))
    ranked = np.argsort(-counts, kind="stable")
    place = np.empty(groups, np.int64)
    place[ranked] = np.arange(groups)
    picks = picks[order[np.argsort(nth * groups + place[of[order]], kind="stable")]]
    sums, some, at = np.zeros((groups, table.shape[1]), table.dtype), np.empty((STEP_ROWS, table.shape[1]), table.dtype), 0
    for size in np.bincount(nth).tolist():
        for start in range(0, size, STEP_ROWS):
            stop = min(start + STEP_ROWS, size)
            np.take(table, picks[at + start : at + stop], axis=0, out=some[: stop - start], mode="clip")
            sums[start:stop] += some[: stop - start]
        at += size
    return sums[place]


class Rows:
    """A slice of documents as sparse rows: per weighted word its number and block; blocks of different documents stay apart."""

    def __init__(self, texts: list[bytes], weight: np.ndarray, kind: type):
        ids = [np.frombuffer(t, kind) for t in texts]
        self.sizes = np.array([len(x) for x in ids])
        self.blocks = -(-self.sizes // BLOCK_WORDS)
        self.first = np.cumsum(self.blocks) - self.blocks
        flat = np.concatenate(ids).astype(np.int64)
        starts = np.cumsum(self.sizes) - self.sizes
        use = np.flatnonzero(weight[flat])
        owner = np.searchsorted(starts, use, "right") - 1
        self.words = flat[use]
        self.of = self.first[owner] + (use - starts[owner]) // BLOCK_WORDS
        self.total = int(self.blocks.sum())
        last = np.zeros(self.total, bool)
        last[self.first + self.blocks - 1] = True
        self.last, self.ids, self.flat, self.starts = last, ids, flat, starts

    def around(self, owners: np.ndarray, at: np.ndarray, before: np.ndarray, longest: int) -> np.ndarray:
        """Word numbers of each passage ``at`` (block in its document) with ``before`` words on either side, 0 where the text ends."""
        first, wide = at * BLOCK_WORDS - before, 2 * BLOCK_WORDS + 2 * longest
        place = first[:, None] + np.arange(wide)
        inside = (place >= 0) & (place < self.sizes[owners, None]) & (np.arange(wide) < (2 * BLOCK_WORDS + 2 * before)[:, None])
        return np.where(inside, self.flat[np.where(inside, self.starts[owners, None] + place, 0)], 0)

    def passages(self, table: np.ndarray) -> np.ndarray:
        """The passages' rows times ``table`` (one row per word): block sums, each with its successor in the same document."""
        sums = summed_rows(self.of, self.total, self.words, table)
        more = np.flatnonzero(~self.last)
        both = sums.copy()
        both[more] += sums[more + 1]
        return both

    def transposed(self, rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """word, its row of (passages transposed times ``rows``)."""
        each = rows.copy()  # a block lies in its own passage and in the one before
        each[1:][~self.last[:-1]] += rows[:-1][~self.last[:-1]]
        known, number = np.unique(self.words, return_inverse=True)
        return known, summed_rows(number, len(known), self.of, each) * weight[known, None]


def _summed(coded: DataFrame, width: int, weight: np.ndarray, kind: type, step) -> dict[int, np.ndarray]:
    """Sums of step(rows) -> (keys, vectors) over all documents: dense in a task, then by key in Spark. Keys and width are bounded."""
    columns = [f"c{n}" for n in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in slices(batches, "ids", SLICE_BYTES):
            rows = Rows(batch.column("ids").to_pylist(), weight, kind)
            if len(rows.words):
                keys, vectors = step(rows)
                total = np.zeros((len(weight), width)) if total is None else total
                total[keys] += vectors
        if total is not None:
            keys = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(c) for c in total[keys].T)], ["key", *columns])

    schema = "key long, " + ", ".join(f"{c} double" for c in columns)
    found = coded.select("ids").mapInArrow(run, schema).groupBy("key").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    values = np.stack([found[c].to_numpy() for c in columns], axis=1) if found.num_rows else np.zeros((0, width))
    return dict(zip(found["key"].to_pylist(), values, strict=True))


def _dense(found: dict[int, np.ndarray], rows: int, width: int) -> np.ndarray:
    out = np.zeros((rows, width))
    for key, vector in found.items():
        out[key] = vector
    return out


def word_weights(coded: DataFrame, n_words: int, probes: Sequence[Probe], kind: type) -> tuple[np.ndarray, float]:
    """log(1 + blocks / occurrences) per word number; 0 for words that no document has and for common ones, unless a probe has few others.

    Also the sum of the squared weights over all occurrences.
    """
    ones = np.ones(n_words + 1)
    ones[0] = 0
    counts = _dense(_summed(coded, 1, ones, kind, lambda r: (lambda w, n: (w, n[:, None].astype(float)))(*np.unique(r.words, return_counts=True))), n_words + 1, 1)[:, 0]
    size = coded.agg(F.coalesce(F.sum(F.ceil(F.octet_length("ids") / F.lit(BLOCK_WORDS * np.dtype(kind).itemsize))), F.lit(0)).alias("n")).first()["n"]
    common = counts > COMMON * size
    for probe in probes:
        rare = {w for w in probe.words if not common[w] and counts[w]}
        if len(rare) < 5:
            common[list(probe.words)] = False
    weight = np.where((counts > 0) & ~common, np.log1p(size / np.maximum(counts, 1)), 0)
    return weight, float((counts * weight**2).sum())


def randomised_svd(coded: DataFrame, weight: np.ndarray, kind: type, rank: int, energy: float, probes: np.ndarray | None = None, power: int = 1, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors (words x rank) and singular values of all passages' weighted counts, over those of ``probes``.

    Each round is one pass over all documents: rows times the current basis, and back. The driver orthogonalises a words x rank matrix, whose
    size the texts of one run bound. The last round's product also gives the singular values (a Nystrom approximation over the same span as one
    more orthogonalised basis), so no further pass counts them. ``energy`` is the sum of the squared weights of all words; ``probes`` are scaled to
    PROBE_SHARE times the passages' energy, so that the basis holds them well.
    """
    n, width = len(weight), min(rank + OVERSAMPLE, max(1, int((weight > 0).sum())))
    own = 0.0 if probes is None else float((probes**2).sum())
    share = PROBE_SHARE * 2 * energy / own if own else 0.0  # a block lies in two passages
    added = (lambda b: share * (probes.T @ (probes @ b))) if share else (lambda b: 0.0)
    product = np.random.default_rng(seed).normal(size=(n, width)) * (weight > 0)[:, None]
    for _ in range(1 + power):
        basis = np.linalg.qr(product)[0]
        table = (weight[:, None] * basis).astype(np.float32)
        product = _dense(_summed(coded, width, weight, kind, lambda r, t=table: r.transposed(r.passages(t), weight)), n, width) + added(basis)
    core = basis.T @ product
    values, turn = np.linalg.eigh((core + core.T) / 2)
    known = values > 1e-6 * max(float(values[-1]), 0.0)  # less than that is the rounding of single-precision sums
    vectors, singular = np.linalg.svd(product @ (turn[:, known] / np.sqrt(values[known])), full_matrices=False)[:2]
    return vectors[:, :rank], singular[:rank]


HITS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("first_word", T.LongType()), T.StructField("shared", T.DoubleType()), T.StructField("answer", T.DoubleType()), T.StructField("cosine", T.DoubleType())])


def _search(coded: DataFrame, probes: Sequence[Probe], weight: np.ndarray, energy: float, kind: type, rank: int) -> DataFrame:
    """doc_id, item_id, first_word, shared, answer, cosine of every leak found, maybe several per document and item."""
    queries = np.zeros((len(probes), len(weight)))
    for at, p in enumerate(probes):
        np.add.at(queries[at], list(p.words), weight[list(p.words)])
    basis = randomised_svd(coded, weight, kind, rank + len(probes), energy, queries)[0]
    latent = queries @ basis
    member = np.zeros(queries.shape, bool)
    for at, p in enumerate(probes):
        member[at, list(p.words)] = True
    norms = np.maximum(np.linalg.norm(latent, axis=1), 1e-12)
    latent /= norms[:, None]
    model = coded.sparkSession.sparkContext.broadcast(
        ((weight[:, None] * basis).astype(np.float32), latent.astype(np.float32).T.copy(), norms.astype(np.float32), member, [(p.item, len(p.words), masks_of(p.words), len(p.answer), masks_of(p.answer)) for p in probes])
    )
    schema = coded.select("doc_id").schema
    for field in HITS:
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, wanted, norms, member, checks = model.value
        for batch in slices(batches, "ids", SLICE_BYTES):
            rows = Rows(batch.column("ids").to_pylist(), weight, kind)
            passages = rows.passages(table)
            size = np.linalg.norm(passages, axis=1)
            live = np.flatnonzero(size > 0)
            cosine = np.minimum((passages[live] @ wanted) / np.minimum(size[live, None], norms), 1)
            where, probe = np.nonzero(cosine >= COSINE)
            owners = np.searchsorted(rows.first, live[where], "right") - 1
            lengths = np.array([c[1] for c in checks])
            # a subsequence is no longer than the number of words there that the benchmark text has
            enough = np.zeros(len(where), bool)
            for s in range(0, len(where), STEP_PAIRS):
                o, p = owners[s : s + STEP_PAIRS], probe[s : s + STEP_PAIRS]
                near = rows.around(o, live[where[s : s + STEP_PAIRS]] - rows.first[o], lengths[p], int(lengths.max()))
                enough[s : s + STEP_PAIRS] = np.count_nonzero(member[p[:, None], near], axis=1) >= PARAPHRASE * lengths[p]
            where, probe, owners = where[enough], probe[enough], owners[enough]
            out = []
            for w, p, owner in zip(where.tolist(), probe.tolist(), owners.tolist(), strict=True):
                item, length, masks, tail, tail_masks = checks[p]
                start = (int(live[w]) - int(rows.first[owner])) * BLOCK_WORDS
                around = rows.ids[owner][max(0, start - length) : start + 2 * BLOCK_WORDS + length].tolist()
                shared = common_subsequence(masks, length, around) / length
                if shared >= PARAPHRASE:
                    answer = common_subsequence(tail_masks, tail, around) / tail
                    if shared >= COPY or answer >= ANSWER:
                        out.append((owner, item, start, shared, answer, float(cosine[w, p])))
            taken = batch.column("doc_id").take(pa.array([o[0] for o in out], pa.int64()))
            rest = [pa.array([o[n] for o in out], k) for n, k in ((1, pa.int64()), (2, pa.int64()), (3, pa.float64()), (4, pa.float64()), (5, pa.float64()))]
            yield pa.RecordBatch.from_arrays([taken, *rest], ["doc_id", *HITS.names])

    return coded.mapInArrow(run, schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", rank: int = RANK) -> DataFrame:
    """doc_id, item_id, first_word, shared, answer, cosine: the best place of each benchmark text in each document that leaks it.

    ``benchmark``: item_id and text; null and empty texts are never found. It is searched in runs of RUN_WORDS words, each against all
    documents. Null, empty and foreign documents have no rows; rows without an id are judged under the null id.
    """
    items = [(r["item_id"], (r["text"] or "").encode()) for r in benchmark.select("item_id", "text").filter(F.col("item_id").isNotNull()).orderBy("item_id", "text").toLocalIterator()]
    runs: list[list[tuple[int, bytes]]] = [[]]
    held = 0
    for item in items:
        held += len(item[1].split())
        if held > RUN_WORDS and runs[-1]:
            runs.append([])
            held = len(item[1].split())
        runs[-1].append(item)
    parts = []
    for chosen in runs:
        probes, vocabulary = probes_of(chosen)
        coded = stored(_coded(docs, vocabulary, text, doc_id), "coded")
        kind = np.uint16 if len(vocabulary) < 65_535 else np.uint32
        weight, energy = word_weights(coded, len(vocabulary), probes, kind) if probes else (np.zeros(1), 0.0)
        if not weight.any():
            weight, probes = np.zeros(len(vocabulary) + 1), []
        parts.append(_search(coded, probes, weight, energy, kind, rank) if probes else coded.limit(0).select("doc_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in HITS]))
    found = parts[0]
    for other in parts[1:]:
        found = found.unionByName(other)
    best = F.max(F.struct("shared", "answer", "cosine", (-F.col("first_word")).alias("_at"))).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", (-F.col("b")["_at"]).alias("first_word"), "b.shared", "b.answer", "b.cosine")


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", rank: int = RANK) -> DataFrame:
    """doc_id, contaminated, n_items, items (numbers, rising), shared for every row of ``docs``."""
    leaks = find_leaks(docs, benchmark, text, doc_id, rank)
    by_doc = leaks.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("shared").alias("shared"))
    rows = docs.select(F.col(doc_id).alias("doc_id"))
    joined = rows.join(broadcast_if_small(stored(by_doc, "leaks")).withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return joined.select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items"), F.lit(0)).alias("n_items"),
        F.array_join(F.coalesce(F.col("items"), F.array().cast("array<long>")).cast("array<string>"), ",").alias("items"),
        F.coalesce("shared", F.lit(0.0)).alias("shared"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", rank: int = RANK) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no benchmark text was found. Rows without an id stay."""
    gone = broadcast_if_small(stored(find_leaks(docs, benchmark, text, doc_id, rank).filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("_gone")).distinct(), "leaks"))
    return docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")
