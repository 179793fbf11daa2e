"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy, over all overlapping windows.

A word enters as its own vector (words of the training texts) next to the mean of its character n-grams' vectors, so that words never
seen before still have their characters. A document scores as its worst window.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortflow.llm.text import as_bytes, fold, slices

#: Most labelled rows of each class that a fit reads: the one bounded sample.
FIT_ROWS = 1_200
CUT = 0.3
WINDOW, STRIDE = 24, 16
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 8
BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
#: Words of the training texts with a vector of their own: at most so many, the most frequent first.
VOCABULARY = 20_000
#: Distinct words that a task remembers before it starts anew.
REMEMBERED = 200_000
_TABLE = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters and characters beyond ASCII."""
    return text.decode("utf-8", "replace").lower().encode().translate(_TABLE).split()


def char_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all character n-grams of the words with their edges, one word after the other, and their number per word."""
    marked = [f"<{w.decode('utf-8', 'replace')}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    code = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(code))  # characters up to the word's end
    owner = np.repeat(np.arange(len(words)), sizes)
    found, owners = [], []
    for n in GRAMS:
        key = np.zeros(max(len(code) - n + 1, 0), np.uint64)
        for k in range(n):
            key = key * np.uint64(1_000_003) + code[k : len(code) - n + 1 + k]
        inside = left[: len(key)] >= n
        key = (key[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        found.append((key >> np.uint64(48)).astype(np.int64) % BUCKETS)
        owners.append(owner[: len(inside)][inside])
    at = np.concatenate(owners)
    order = np.argsort(at, kind="stable")
    return np.concatenate(found)[order], np.bincount(at, minlength=len(words))


def window_starts(n: int) -> range | list[int]:
    """Starts of all windows over n words; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    starts = list(range(0, n - WINDOW, STRIDE))
    return [*starts, n - WINDOW]


def windows(ids: np.ndarray) -> np.ndarray:
    """A row of word ids per window; a shorter text is one row filled up with -1."""
    if len(ids) < WINDOW:
        return np.concatenate([ids, np.full(WINDOW - len(ids), -1, ids.dtype)])[None]
    return ids[np.asarray(window_starts(len(ids)))[:, None] + np.arange(WINDOW)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Network:
    """``dense``: the weights of both directions, of the attention and of the output; ``vocabulary``: word -> row of ``words``."""

    vocabulary: dict[bytes, int]
    words: np.ndarray
    chars: np.ndarray
    dense: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def fresh(cls, vocabulary: dict[bytes, int], rng: np.random.Generator) -> Network:
        draw = lambda *shape: (rng.normal(0, 1 / np.sqrt(shape[0]), shape)).astype(np.float32)
        dense = {}
        for side in "fb":
            dense |= {f"W{side}": draw(WORD_DIM + CHAR_DIM, 3 * HIDDEN), f"U{side}": draw(HIDDEN, 3 * HIDDEN), f"b{side}": np.zeros(3 * HIDDEN, np.float32)}
        dense |= {"A": draw(2 * HIDDEN, HIDDEN), "v": draw(HIDDEN), "o": draw(2 * HIDDEN), "c": np.zeros(1, np.float32)}
        words = 0.05 * rng.normal(size=(len(vocabulary) + 1, WORD_DIM)).astype(np.float32)
        words[-1] = 0  # of words without a vector
        return cls(vocabulary, words, 0.05 * rng.normal(size=(BUCKETS, CHAR_DIM)).astype(np.float32), dense)

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Input vector per word; its row, its n-grams and their number, for the gradients. A bounded number of words at a time."""
        rows = np.fromiter((self.vocabulary.get(w, len(self.vocabulary)) for w in words), np.int32, len(words))
        grams, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 10_000):
            g, n = char_grams(words[at : at + 10_000])
            grams.append(g.astype(np.int32))
            sizes.append(n)
        grams, sizes = np.concatenate(grams), np.concatenate(sizes)
        return self.vectors(rows, grams, sizes), rows, grams, sizes

    def vectors(self, rows: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), WORD_DIM + CHAR_DIM), np.float32)
        ends = np.cumsum(sizes)
        for at in range(0, len(rows), 10_000):
            here = slice(at, at + 10_000)
            first = ends[at] - sizes[at]
            starts = ends[here] - sizes[here] - first
            out[here, WORD_DIM:] = np.add.reduceat(self.chars[grams[first : ends[here][-1]]], starts) / np.sqrt(sizes[here])[:, None]
        out[:, :WORD_DIM] = self.words[rows]
        return out

    def projected(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Each direction's input part of the gates; the last row is that of "no word"."""
        return {s: np.concatenate([x @ self.dense[f"W{s}"] + self.dense[f"b{s}"], np.zeros((1, 3 * HIDDEN), np.float32)]) for s in "fb"}

    def forward(self, parts: dict[str, np.ndarray], ids: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logit per window. ``ids``: windows x WINDOW places in ``parts``; -1 is no word and leaves the state as it is."""
        n, cache = len(ids), {}
        states = np.empty((WINDOW, n, 2 * HIDDEN), np.float32)
        padded = bool((ids[:, -1] < 0).any())
        live = (ids >= 0).T[:, :, None].astype(np.float32) if padded else None
        for s in "fb":
            u, h, steps = self.dense[f"U{s}"], np.zeros((n, HIDDEN), np.float32), []
            columns = slice(0, HIDDEN) if s == "f" else slice(HIDDEN, 2 * HIDDEN)
            for t in range(WINDOW) if s == "f" else range(WINDOW - 1, -1, -1):
                x, hu = parts[s][ids[:, t]], h @ u
                gates = _sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
                after = new + z * (h - new)
                if padded:
                    after = h + live[t] * (after - h)
                if keep:
                    steps.append((t, h, z, r, new, hu[:, 2 * HIDDEN :]))
                h = states[t][:, columns] = after
                h = after
            cache[s] = steps
        inner = np.tanh(states @ self.dense["A"])
        weight = inner @ self.dense["v"]
        if padded:
            weight = np.where(live[:, :, 0] > 0, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states, optimize=False)
        return pooled @ self.dense["o"] + self.dense["c"][0], cache | {"states": states, "inner": inner, "weight": weight, "pooled": pooled, "live": live}

    def gradients(self, parts: dict[str, np.ndarray], ids: np.ndarray, d_logit: np.ndarray, cache: dict) -> tuple[dict, dict]:
        """Of the dense weights, and of each place in ``parts``."""
        g = {k: np.zeros_like(v) for k, v in self.dense.items()}
        states, inner, weight, live = cache["states"], cache["inner"], cache["weight"], cache["live"]
        g["o"], g["c"] = cache["pooled"].T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * self.dense["o"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("nh,tnh->tn", d_pooled, states)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["v"] = np.einsum("tn,tnh->h", d_energy, inner)
        d_inner = d_energy[:, :, None] * self.dense["v"] * (1 - inner**2)
        g["A"] = np.einsum("tni,tnj->ij", states, d_inner)
        d_states += d_inner @ self.dense["A"].T
        d_parts = {s: np.zeros_like(parts[s]) for s in "fb"}
        for s in "fb":
            u, d_h = self.dense[f"U{s}"], np.zeros((len(ids), HIDDEN), np.float32)
            columns = slice(0, HIDDEN) if s == "f" else slice(HIDDEN, 2 * HIDDEN)
            for t, h, z, r, new, hu in reversed(cache[s]):
                d_out = d_h + d_states[t][:, columns]
                keep = 0.0
                if live is not None:
                    keep = (1 - live[t]) * d_out
                    d_out = live[t] * d_out
                d_new = d_out * (1 - z) * (1 - new**2)
                d_z = d_out * (h - new) * z * (1 - z)
                d_r = d_new * hu * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_new], axis=1)
                d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g[f"U{s}"] += h.T @ d_hu
                d_h = d_out * z + d_hu @ u.T + keep
                np.add.at(d_parts[s], ids[:, t], d_x)
        return g, d_parts

    def document_scores(self, logits: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """0 to 1 per document from its worst window; ``counts``: windows per document. CUT lies where the calibration put it."""
        worst = np.maximum.reduceat(logits, np.cumsum(counts) - counts)
        z = self.slope * (worst - self.shift) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _select(logits: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The worst window of each document."""
    first = np.cumsum(counts) - counts
    return np.array([f + int(np.argmax(logits[f : f + c])) for f, c in zip(first, counts, strict=True)], np.int64)


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 12, seed: int = 3) -> Network:
    """Learn from whole texts with a label each: in every round the worst window of each text, and a random one of each text
    labelled 0, are trained on. A fifth of the texts is kept apart to place the cut."""
    rng = np.random.default_rng(seed)
    tokens = [words_of(t) for t in texts]
    counted = Counter(w for t in tokens for w in {*t})
    common = sorted((w for w, c in counted.items() if c >= 3), key=lambda w: (-counted[w], w))[:VOCABULARY]
    net = Network.fresh({w: n for n, w in enumerate(common)}, rng)
    if len({*labels.tolist()}) < 2:
        net.shift = -10.0 if len(labels) and labels[0] == 1 else 10.0
        return net
    place: dict[bytes, int] = {}
    coded = [np.array([place.setdefault(w, len(place)) for w in t], np.int32) for t in tokens]
    known = list(place)
    _, rows, grams, sizes = net.inputs(known)
    del tokens, texts, counted
    first_gram = np.cumsum(sizes) - sizes
    # first guess: how much more often a word and an n-gram stand in texts labelled 1
    use = {y: np.bincount(np.concatenate([c for c, l in zip(coded, labels, strict=True) if l == y] or [np.zeros(0, np.int64)]), minlength=len(known)).astype(float) for y in (0, 1)}

    def odds(n1: np.ndarray, n0: np.ndarray) -> np.ndarray:
        p1, p0 = n1 / max(n1.sum(), 1), n0 / max(n0.sum(), 1)
        floor = 10 / max(n1.sum() + n0.sum(), 1)
        return np.clip(np.log((p1 + floor) / (p0 + floor)), -2, 4).astype(np.float32)

    by_word = odds(use[1], use[0])
    by_gram = odds(*(np.bincount(grams, np.repeat(use[y], sizes), minlength=BUCKETS) for y in (1, 0)))
    net.words[rows[rows < len(common)], 0] = by_word[rows < len(common)] / 2
    net.chars[:, 0] = by_gram / 4
    guess = np.maximum(by_word, np.add.reduceat(by_gram[grams], first_gram) / np.sqrt(sizes)).astype(np.float32)

    parts = rng.random(len(coded)) < 0.8
    all_windows = [windows(c) for c in coded]
    counts = np.array([len(w) for w in all_windows])
    ids = np.concatenate(all_windows)
    label = np.asarray(labels, np.float32)
    score = np.where(ids >= 0, guess[ids], np.float32(-9)).max(axis=1)
    mine = np.flatnonzero(parts)
    first = np.cumsum(counts) - counts
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.dense.items()}
    squares = {"words": np.full(len(net.words), 1e-6, np.float32), "chars": np.full(BUCKETS, 1e-6, np.float32)}
    step = 0
    for epoch in range(epochs):
        worst = _select(score, counts)
        random = first + (rng.random(len(counts)) * counts).astype(np.int64)
        chosen = np.concatenate([worst[mine], random[mine][label[mine] == 0]])
        truth = np.concatenate([label[mine], np.zeros(int((label[mine] == 0).sum()), np.float32)])
        order = rng.permutation(len(chosen))
        for at in range(0, len(order), 128):
            batch = order[at : at + 128]
            raw = ids[chosen[batch]]
            here, back = np.unique(raw, return_inverse=True)
            back = back.reshape(raw.shape)
            if here[0] < 0:  # "no word" is the last row
                here, back = here[1:], back - 1
            inside = np.concatenate([np.arange(first_gram[w], first_gram[w] + sizes[w]) for w in here])
            g_ids, owner = grams[inside], np.repeat(np.arange(len(here)), sizes[here])
            scale = (1 / np.sqrt(sizes[here])).astype(np.float32)
            chars = np.zeros((len(here), CHAR_DIM), np.float32)
            np.add.at(chars, owner, net.chars[g_ids])
            vectors = np.concatenate([net.words[rows[here]], chars * scale[:, None]], axis=1)
            projected = net.projected(vectors)
            logit, cache = net.forward(projected, back, keep=True)
            d_logit = ((_sigmoid(logit) - truth[batch]) / len(batch)).astype(np.float32)
            g, d_parts = net.gradients(projected, back, d_logit, cache)
            d_vectors = np.zeros_like(vectors)
            for s in "fb":
                d = d_parts[s][:-1]
                g[f"W{s}"], g[f"b{s}"] = vectors.T @ d, d.sum(axis=0)
                d_vectors += d @ net.dense[f"W{s}"].T
            step += 1
            for k, v in g.items():
                m1, m2 = moment[k]
                m1 += 0.1 * (v - m1)
                m2 += 0.001 * (v * v - m2)
                net.dense[k] -= 0.01 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
            for table, at_rows, d in (("words", rows[here], d_vectors[:, :WORD_DIM]), ("chars", g_ids, (d_vectors[:, WORD_DIM:] * scale[:, None])[owner])):
                np.add.at(squares[table], at_rows, (d * d).mean(axis=1))
                np.add.at(getattr(net, table), at_rows, -0.03 * d / np.sqrt(squares[table][at_rows])[:, None])
            net.words[-1] = 0
        table = net.projected(net.vectors(rows, grams, sizes))
        score = np.concatenate([net.forward(table, ids[at : at + 2048])[0] for at in range(0, len(ids), 2048)])
    apart = np.flatnonzero(~parts) if len({*label[~parts].tolist()}) == 2 else np.arange(len(label))
    worst = np.maximum.reduceat(score, first)
    net.shift, net.slope = _cut(worst[apart], label[apart]), 1.0
    return net


def _cut(score: np.ndarray, label: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with the fewest errors."""
    order = np.argsort(score)
    s, y = score[order], label[order]
    wrong = np.concatenate(([0], np.cumsum(y))) + np.concatenate((np.cumsum((1 - y)[::-1])[::-1], [0]))
    edges = np.concatenate(([s[0] - 1], s, [s[-1] + 1]))
    best = np.flatnonzero(wrong <= wrong.min())
    at = best[np.argmax(edges[best + 1] - edges[best])]
    return float((edges[at] + edges[at + 1]) / 2)


def fit(docs: DataFrame, labels: DataFrame, label: str, fit_rows: int = FIT_ROWS, text: str = "text") -> Network:
    """Train on at most ``fit_rows`` labelled texts of each class, chosen by a hash of the id."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    drawn = known.withColumn("_draw", F.xxhash64("doc_id"))
    one, two = (drawn.filter(F.col("_label") == y).orderBy("_draw", "doc_id").limit(fit_rows) for y in (1, 0))
    sample = F.broadcast(one.unionByName(two).select("doc_id", "_label"))
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_text")).join(sample, "doc_id").dropDuplicates(["doc_id"])
    table = rows.orderBy("doc_id").toArrow()
    return train(table["_text"].cast(pa.binary()).to_pylist(), table["_label"].to_numpy())


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, text: str = "text", modulus: int = 4, held: int = 2, label: str = "toxic", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``, over all windows of its whole text.

    Learns from labels whose id's crc32 leaves another remainder than ``held``. Null and empty texts, and texts without a
    letter, are one empty window. A null id is not held out; repeated rows are scored each. Without labels of both classes every score
    is that of the one class. Only doc_id and text of ``docs`` are read.
    """
    part = fold(F.col("doc_id"), modulus)
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, labels.filter(part != held), label, fit_rows, text))
    schema = docs.select("doc_id").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Network = net.value
        place: dict[bytes, int] = {}
        table = model.projected(model.inputs([])[0])
        for batch in slices(batches, "_text", 1 << 20):
            tokens = [words_of(t) for t in as_bytes(batch, "_text")]
            new = list({w for t in tokens for w in t if w not in place})
            if new:
                if len(place) > REMEMBERED:
                    place, new = {}, list({w for t in tokens for w in t})
                    table = model.projected(model.inputs([])[0])
                place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
                added = model.projected(model.inputs(new)[0])
                table = {s: np.concatenate([table[s][:-1], added[s]]) for s in "fb"}
            coded = [np.fromiter(map(place.__getitem__, t), np.int32, len(t)) for t in tokens]
            all_windows = [windows(c) for c in coded]
            counts, ids = np.array([len(w) for w in all_windows]), np.concatenate(all_windows)
            logits = np.empty(len(ids), np.float32)
            short = ids[:, -1] < 0
            for chosen in (np.flatnonzero(~short), np.flatnonzero(short)):
                for at in range(0, len(chosen), 4096):
                    here = chosen[at : at + 4096]
                    logits[here] = model.forward(table, ids[here])[0]
            scores = model.document_scores(logits, counts).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    scored = docs.select("doc_id", F.col(text).alias("_text")).mapInArrow(run, schema)
    return scored.select(
        "doc_id", F.coalesce(part == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
