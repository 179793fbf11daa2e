"""Quality classifier: Bradley-Terry ranking. Scores are learnt from pairs (better, worse) and cut at a quantile."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortflow.llm.text import as_bytes, fold, slices, stored

#: Most labelled rows that a fit reads: the one bounded sample; everything else covers all rows.
FIT_ROWS = 20_000
CUT = 0.3
#: Steps per measure: where on its range of training values a measure lies.
STEPS = 10

_GROUPS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "newline": (10,), "blank": (32, 9), "stop": (46,), "comma": (44,),
    "bang": (33,), "ask": (63,), "bar": (124,), "symbol": tuple(b"#*$%&<>@^~_=+/\\"), "other": tuple(b"\"'():;-[]{}`"), "control": (*range(9), *range(11, 32), 127),
}
_CLASS = np.full(256, len(_GROUPS), np.int64)  # the last class: bytes of characters beyond ASCII
for _at, _bytes in enumerate(_GROUPS.values()):
    _CLASS[list(_bytes)] = _at
MEASURES = [
    *_GROUPS, "beyond_ascii", "log_words", "mean_word", "distinct_words", "distinct_pairs", "log_lines", "distinct_lines", "words_per_line",
    "longest_word", "marked_words", "squeezed", "longest_again", "one_letter",
]


def measure(text: bytes) -> list[float]:
    """Shares of character classes and signs of repetition of a whole text; an empty text has zeros."""
    if not text:
        return [0.0] * len(MEASURES)
    classes = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=len(_GROUPS) + 1) / len(text)
    words = text.split()
    n = max(len(words), 1)
    seen = {*words}
    lines = [x for x in text.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    marked = sum(1 for w in words if w[-1:] in b"*$%&#!|")
    squeezed = len(zlib.compress(text, 1)) / len(text)
    again = words.count(max(seen, key=lambda w: (len(w), w))) / n if words else 0.0
    return [
        *classes.tolist(),
        float(np.log1p(len(words))),
        float(lengths.mean()) if words else 0.0,
        len(seen) / n,
        len({*zip(words, words[1:], strict=False)}) / n,
        float(np.log1p(len(lines))),
        len({*lines}) / max(len(lines), 1),
        float(np.log1p(n / max(len(lines), 1))),
        float(np.log1p(lengths.max())) if words else 0.0,
        marked / n,
        squeezed,
        again,
        float((lengths == 1).mean()) if words else 0.0,
    ]


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, measures: the whole text in a few dozen numbers, taken once."""
    schema = docs.select(F.col(doc_id).alias("doc_id")).schema.add("measures", T.ArrayType(T.FloatType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = pa.array([measure(t) for t in as_bytes(batch, "text")], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], ["doc_id", "measures"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class PairRank:
    """``edges``: steps per measure; ``weights``: one per measure and step; ``threshold``: the raw score at the quantile."""

    edges: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def raw(self, values: np.ndarray) -> np.ndarray:
        return _steps(values, self.edges) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        """0 to 1, CUT at the threshold."""
        z = (self.raw(values) - self.threshold) * self.scale + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _steps(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One-hot steps: how the score may bend with a measure."""
    rows, measures = values.shape
    out = np.zeros((rows, measures, edges.shape[1] + 1), np.float32)
    for m in range(measures):
        out[np.arange(rows), m, np.searchsorted(edges[m], values[:, m])] = 1
    return out.reshape(rows, -1)


def fit_pairs(values: np.ndarray, labels: np.ndarray, epochs: int = 30, pairs: int = 40_000, penalty: float = 1e-4, seed: int = 7) -> PairRank:
    """Logistic loss on the difference of two documents' features, the better one first, by Adam over drawn pairs.

    The threshold is the quantile of the training scores that leaves as large a share below as the labels have of 0. With one class
    only, there is no pair: every score equals the class.
    """
    if not len(values):
        values = np.zeros((1, len(MEASURES)), np.float32)
        labels = np.ones(1, np.int64)
    edges = np.quantile(values, np.linspace(0, 1, STEPS + 1)[1:-1], axis=0).T.astype(np.float32)
    x, good, bad = _steps(values, edges), np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    w = np.zeros(x.shape[1], np.float32)
    if not len(good) or not len(bad):
        return PairRank(edges, w, -1.0 if len(good) else 1.0, 5.0)
    rng, m, v, step, size = np.random.default_rng(seed), np.zeros_like(w), np.zeros_like(w), 0, 2000
    for _ in range(epochs):
        for _ in range(pairs // size):
            d = x[rng.choice(good, size)] - x[rng.choice(bad, size)]
            gradient = -(d.T @ (1 / (1 + np.exp(np.clip(d @ w, -30, 30))))) / size + penalty * w
            step += 1
            m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
            w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    raw = x @ w
    return PairRank(edges, w, float(np.quantile(raw, (labels == 0).mean())), 1.0)


def fit(measures: DataFrame, labels: DataFrame, label: str, fit_rows: int = FIT_ROWS) -> PairRank:
    """Fit on the labelled rows, at most ``fit_rows`` of them by a hash of the id. ``labels``: doc_id and ``label``."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    known = known.withColumn("_draw", F.xxhash64("doc_id")).orderBy("_draw", "doc_id").limit(fit_rows)
    once = measures.join(F.broadcast(known.select("doc_id", "_label")), "doc_id").groupBy("doc_id").agg(
        F.max("measures").alias("measures"), F.max("_label").alias("_label")
    )
    table = once.orderBy("doc_id").toArrow()
    values = np.array(table["measures"].to_pylist(), np.float32).reshape(-1, len(MEASURES))
    return fit_pairs(values, table["_label"].to_numpy())


def apply_model(measures: DataFrame, model: PairRank) -> DataFrame:
    """doc_id, score for every row."""
    schema = measures.select("doc_id").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("measures").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(flat).astype(float))], ["doc_id", "score"])

    return measures.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", modulus: int = 5, held: int = 0, label: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Learns from labels whose id's crc32 leaves another remainder than ``held``. Null and empty texts are scored like any text with no
    words; a null id is not held out; repeated rows are scored each; tables without labels give the score of "good".
    Only doc_id and text of ``docs`` are read, so further columns can't clash.
    """
    measures = stored(measured(docs, text), "measures")
    part = fold(F.col("doc_id"), modulus)
    model = fit(measures, labels.filter(part != held), label, fit_rows)
    return apply_model(measures, model).select(
        "doc_id", F.coalesce(part == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


def keep_quality(docs: DataFrame, labels: DataFrame, text: str = "text", modulus: int = 5, held: int = 0, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are predicted to be of quality 1; it learns as ``quality_scores`` does."""
    labels = labels.filter(fold(F.col("doc_id"), modulus) != held)
    model = fit(measured(docs.join(_sampled(labels, fit_rows), "doc_id", "left_semi"), text), labels, "quality", fit_rows)
    kind = docs.select(F.struct(*docs.columns).alias("_row"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            values = np.array([measure(t) for t in as_bytes(batch, "_text")], np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(model.score(values).astype(float))], ["_row", "score"])

    scored = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text")).mapInArrow(run, kind)
    return scored.filter(F.col("score") >= CUT).select("_row.*")


def _sampled(labels: DataFrame, fit_rows: int) -> DataFrame:
    ids = labels.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return F.broadcast(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
