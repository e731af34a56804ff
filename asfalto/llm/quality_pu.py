"""Quality classifier learned from trusted positives and unlabelled text (non-negative PU risk).

A text becomes shares of byte-class pairs, taken as square roots, and a few ratios (distinct words,
distinct lines, lengths). A small network is fitted by minimising
    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),
the non-negative form of the unbiased risk, with logistic loss, so its output is a probability.
The prior is estimated first, by a classifier of trusted against unlabelled texts: of two held-out
shares above a threshold, unlabelled over trusted, the least over many thresholds is the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asfalto.llm.batches import crc32_mod, split_words, text_parts, texts_of

# Bounds of the sample that the classifier is fitted on.
TRUSTED_TEXTS = 4_000
UNLABELLED_TEXTS = 8_000
THRESHOLD = 0.3
PRIOR = 0.5  # taken where there are too few texts to estimate one

_GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r\v\f",
           ".", ",", "!", "?;:", "\"'`", "()[]{}", "|", "#", "$", "%", "&", "*", "@", "/\\", "-_", "=+<>", "^~")
_CLASSES = len(_GROUPS) + 3  # and control characters, first bytes and later bytes of other characters
_CLASS_OF = np.full(256, len(_GROUPS), np.int64)
for _number, _group in enumerate(_GROUPS):
    _CLASS_OF[list(_group.encode())] = _number
_CLASS_OF[0x80:0xC0] = len(_GROUPS) + 1
_CLASS_OF[0xC0:] = len(_GROUPS) + 2
N_FEATURES = _CLASSES**2 + 7


def features(texts: pa.Array) -> np.ndarray:
    """One row per text, float32; an empty text has zeros throughout."""
    count = len(texts)
    sizes = pc.binary_length(texts).to_numpy(False).astype(np.int64)
    data = np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8)
    kinds, owner = _CLASS_OF[data], np.repeat(np.arange(count), sizes)
    inside = owner[1:] == owner[:-1]
    pairs = (owner[1:] * _CLASSES + kinds[:-1]) * _CLASSES + kinds[1:]
    seen = np.bincount(pairs[inside], minlength=count * _CLASSES**2).reshape(count, -1)
    places, _, offsets = split_words(texts)
    words = np.diff(offsets)
    lines = np.array([t.count("\n") + 1 for t in texts.to_pylist()])
    few = [len(set(t.split("\n"))) for t in texts.to_pylist()]
    whole = np.maximum(1, sizes)
    rows = np.zeros((count, N_FEATURES), np.float32)
    rows[:, : _CLASSES**2] = np.sqrt(seen / np.maximum(1, seen.sum(axis=1, keepdims=True)))
    owner = np.repeat(np.arange(count), words)
    again = owner[1:][(places[1:] == places[:-1]) & (owner[1:] == owner[:-1])]
    rows[:, -7] = np.bincount(again, minlength=count) / np.maximum(1, words)
    distinct = np.bincount(np.unique((owner << 32) | places) >> 32, minlength=count)
    rows[:, -6] = distinct / np.maximum(1, words)
    rows[:, -5] = np.array(few) / lines
    rows[:, -4] = np.log1p(words) / 10
    rows[:, -3] = np.log1p(sizes / np.maximum(1, lines)) / 10
    rows[:, -2] = np.log1p(sizes / np.maximum(1, words)) / 3
    rows[:, -1] = np.log1p(whole - 1) / 10
    rows[sizes == 0] = 0
    return rows


@dataclass
class Model:
    """One hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    prior: float = 0.5

    def logits(self, rows: np.ndarray) -> np.ndarray:
        inner = np.tanh((rows - self.mean) * self.scale @ self.hidden + self.hidden_bias)
        return inner @ self.out + self.out_bias

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(rows).astype(np.float64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _fit(trusted, unlabelled, slope, steps: int, seed: int, units: int = 16) -> Model:
    """Adam over batches of both kinds; `slope(f_p, f_u)` gives the risk's derivatives by the outputs."""
    rng = np.random.default_rng(seed)
    together = np.concatenate([trusted, unlabelled])
    mean, spread = together.mean(axis=0), together.std(axis=0)
    # features that hardly ever vary must not be blown up
    scale = (1 / np.maximum(spread, 0.01)).astype(np.float32)
    n = together.shape[1]
    weights = [
        rng.normal(0, n**-0.5, (n, units)).astype(np.float32), np.zeros(units, np.float32),
        rng.normal(0, units**-0.5, units).astype(np.float32), np.zeros(1, np.float32),
    ]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    p_rows, u_rows = (trusted - mean) * scale, (unlabelled - mean) * scale
    for step in range(1, steps + 1):
        p = p_rows[rng.integers(0, len(p_rows), 256)]
        u = u_rows[rng.integers(0, len(u_rows), 512)]
        x = np.concatenate([p, u])
        inner = np.tanh(x @ weights[0] + weights[1])
        f = inner @ weights[2] + weights[3]
        d = np.concatenate(slope(f[: len(p)], f[len(p) :])).astype(np.float32)
        back = d[:, None] * weights[2] * (1 - inner**2)
        grads = [x.T @ back + 1e-4 * weights[0], back.sum(axis=0), inner.T @ d, d.sum(keepdims=True)]
        for w, g, m, v in zip(weights, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, *weights[:3], float(weights[3][0]))


def estimate_prior(trusted: np.ndarray, unlabelled: np.ndarray, seed: int = 0) -> float:
    """Share of positives among the unlabelled, at least 0.05 and at most 0.95.

    PRIOR where either kind has less than two texts: one half is held out.
    """
    if min(len(trusted), len(unlabelled)) < 2:
        return PRIOR
    half_p, half_u = len(trusted) // 2, len(unlabelled) // 2

    def slope(f_p, f_u):  # plain logistic risk, both kinds with equal weight
        return -_sigmoid(-f_p) / (2 * len(f_p)), _sigmoid(f_u) / (2 * len(f_u))

    model = _fit(trusted[:half_p], unlabelled[:half_u], slope, 300, seed)
    held_p, held_u = np.sort(model.logits(trusted[half_p:])), np.sort(model.logits(unlabelled[half_u:]))
    # above any threshold lies at least the prior's share of what lies there of the positives
    at = held_p[(np.linspace(0.01, 0.8, 80) * len(held_p)).astype(int)]
    above_p = 1 - np.searchsorted(held_p, at) / len(held_p)
    above_u = 1 - np.searchsorted(held_u, at) / len(held_u)
    return float(np.clip((above_u / above_p).min(), 0.05, 0.95))


def fit(trusted: np.ndarray, unlabelled: np.ndarray, steps: int = 1000, seed: int = 0) -> Model | None:
    """Minimise the non-negative risk; None where either kind of text is missing."""
    if not len(trusted) or not len(unlabelled):
        return None
    prior = estimate_prior(trusted, unlabelled, seed)

    def slope(f_p, f_u):
        as_negative = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
        d_p = -prior * _sigmoid(-f_p) / len(f_p)
        if as_negative < 0:
            # overfitted: step back on this part alone
            return prior * _sigmoid(f_p) / len(f_p), -_sigmoid(f_u) / len(f_u)
        return d_p - prior * _sigmoid(f_p) / len(f_p), _sigmoid(f_u) / len(f_u)

    model = _fit(trusted, unlabelled, slope, steps, seed)
    model.prior = prior
    return model


def _sampled(
    docs: DataFrame, labels: DataFrame, trusted_texts: int, unlabelled_texts: int
) -> tuple[np.ndarray, np.ndarray]:
    """Features of trusted and of unlabelled texts outside fold 0, chosen by hash of the id."""
    seed_hash = F.xxhash64("doc_id", F.lit(9))
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q"))
        .where((F.col("q") == 1) & (crc32_mod(F.col("doc_id"), 5) != 0))
        .select("doc_id").distinct()
        .orderBy(seed_hash).limit(trusted_texts)  # so the join below broadcasts no more ids than that
        .withColumn("_trusted", F.lit(True))
    )
    rows = docs.count()
    share = min(1.0, 1.2 * unlabelled_texts / max(1, rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    candidates = (
        texts.where(crc32_mod(F.col("doc_id"), 5) != 0)
        .join(F.broadcast(chosen), "doc_id", "left")
        .withColumn("_trusted", F.coalesce("_trusted", F.lit(False)))
        .withColumn("_web", F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1_000_000)) < share * 1_000_000)
        .where(F.col("_trusted") | F.col("_web"))
    )

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches, most=2 << 20):
            rows = [r.tobytes() for r in features(texts_of(part)).astype(np.float16)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("_trusted"), part.column("_web"),
                 pa.array(rows, pa.binary())],
                names=["doc_id", "_trusted", "_web", "features"],
            )

    # a repeated doc_id may match more than once: the limit bounds what reaches the driver
    found = (
        candidates.mapInArrow(described, "doc_id long, _trusted boolean, _web boolean, features binary")
        .limit(2 * (trusted_texts + unlabelled_texts))
        .collect()
    )
    found.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))

    def matrix(flag: str, most: int) -> np.ndarray:
        data = b"".join(bytes(r["features"]) for r in found if r[flag])
        rows = np.frombuffer(data, np.float16).reshape(-1, N_FEATURES).astype(np.float32)
        return np.random.default_rng(0).permutation(rows)[:most]

    return matrix("_trusted", trusted_texts), matrix("_web", unlabelled_texts)


def train(
    docs: DataFrame,
    labels: DataFrame,
    trusted_texts: int = TRUSTED_TEXTS,
    unlabelled_texts: int = UNLABELLED_TEXTS,
) -> Model | None:
    """Fit on at most so many texts of each kind; None if there are no trusted ones.

    Reads of `labels` only which documents outside fold 0 (crc32 of the id mod 5) have quality 1.
    """
    return fit(*_sampled(docs, labels, trusted_texts, unlabelled_texts))


def score(model: Model | None, text: Column) -> Column:
    """Probability that a text is of the trusted kind; null counts as empty, no model gives 0.5."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [model.scores(features(texts_of(p))) for p in text_parts([batch], most=2 << 20)]
        return pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    return scored(text)


def score_documents(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out (fold 0), score, predicted; a row for every row of `docs`."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        (crc32_mod(doc_id, 5) == 0).alias("held_out"),
        score(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject_low(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` whose text scores `threshold` or more, all columns as they are."""
    return docs.where(score(model, F.col("text")) >= threshold)
