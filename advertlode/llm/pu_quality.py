"""Quality scores by positive-unlabelled learning.

Learns from trusted positives (`quality` = 1) and unlabelled text only: labels of 0 are never used. A first model
tells positives from unlabelled texts; on held-back rows of both its scores bound the share of positives among the
unlabelled (best bin estimate of the class prior). The final model minimises the non-negative unbiased risk
    prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)])
with the logistic loss, so that its score estimates the probability of label 1. Features are statistics of the whole text:
shares of byte classes, of kinds of words, lengths and repetition. Fitting is on the driver, on at most POSITIVES and
UNLABELLED ids, those of the least hashes, with one text each, whatever repeats; a text has features of
some 70 numbers. Scoring reads each text once and shuffles nothing.

Where fewer than FEW drawn texts are unlabelled, labelled ones join them without their labels. Without positives nothing can be
learned: every text with a word then scores 0.5.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import find_words, shingle_hashes, slices

#: Bounds on the rows that the model is fitted on.
POSITIVES, UNLABELLED = 12_000, 24_000
FEW = 64
THRESHOLD = 0.3
HIDDEN, ROUNDS, BATCH, RATE = 24, 24, 512, 0.004

_CLASSES = np.zeros(256, np.int64)  # 0: controls
for _i, _c in enumerate(string.punctuation):
    _CLASSES[ord(_c)] = 1 + _i
_OTHER = 1 + len(string.punctuation)
for _i, _set in enumerate((string.digits, string.ascii_lowercase, string.ascii_uppercase, " ", "\n\r", "\t\f\v")):
    _CLASSES[[ord(_c) for _c in _set]] = _OTHER + _i
_CLASSES[0x80:] = _OTHER + 6
_N_CLASSES = _OTHER + 7
_KINDS = 12
N_FEATURES = 2 * _N_CLASSES + _KINDS


def _share_of_first(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distinct keys over keys of each text; 1 where there are none."""
    out = np.ones(len(first) - 1)
    for i in range(len(out)):
        own = np.sort(keys[first[i]:first[i + 1]])
        if len(own):
            out[i] = (1 + np.count_nonzero(own[1:] != own[:-1])) / len(own)
    return out


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of N_FEATURES numbers for each text, and its number of words."""
    n = len(at) - 1
    size = np.maximum(np.diff(at), 1)[:, None]
    text = np.repeat(np.arange(n), np.diff(at))
    kind = _CLASSES[data]
    shares = np.bincount(text * _N_CLASSES + kind, minlength=n * _N_CLASSES).reshape(n, _N_CLASSES) / size
    words = find_words(data, at)
    count = np.maximum(words.counts, 1)[:, None]
    own = words.text_of()
    length = words.end - words.start
    last = np.bincount(own * _N_CLASSES + kind[words.end - 1], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES) / count \
        if len(own) else np.zeros((n, _N_CLASSES))
    upper = np.concatenate(([0], np.cumsum(kind == _OTHER + 2)))
    lower = np.concatenate(([0], np.cumsum(kind == _OTHER + 1)))
    ups, lows = upper[words.end] - upper[words.start], lower[words.end] - lower[words.start]
    hashes = words.hashes(lower=True)
    pairs, pairs_first = shingle_hashes(hashes, words.first, 2)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(own, values, n) / count[:, 0]

    lines = np.bincount(text, data == 10, n) + 1
    average = mean(length)
    more = np.stack([mean((ups > 1) & (lows == 0)), mean((ups == 1) & (lows > 0)), mean((ups == 0) & (lows == 0)),
                     mean(length == 1), average / 10, mean(length > 12), np.sqrt(np.maximum(mean(length.astype(float) ** 2) - average ** 2, 0)) / 5,
                     np.log1p(words.counts) / 8, np.log1p(words.counts / lines) / 5, _share_of_first(hashes, words.first),
                     _share_of_first(pairs, pairs_first), np.log1p(np.diff(at)) / 10], 1)
    return np.concatenate([np.sqrt(shares), np.sqrt(last), more], 1).astype(np.float32), words.counts


@dataclass(frozen=True)
class Model:
    """A network with one hidden layer over standardised features."""

    middle: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return _forward(self.weights, _standard(x, self.middle, self.scale))[1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(float), -40, 40)))


def _standard(x: np.ndarray, middle: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - middle) / scale, -8, 8).astype(np.float32)


def _forward(weights, x):
    hidden = np.maximum(x @ weights[0] + weights[1], 0)
    return hidden, hidden @ weights[2] + x @ weights[3] + weights[4]


def _train(positive: np.ndarray, unlabelled: np.ndarray, gradient, seed: int) -> tuple[np.ndarray, ...]:
    """Adam on `gradient(logits of positives, logits of unlabelled)`, which gives the risk's derivative for each."""
    rng = np.random.default_rng(seed)
    d = positive.shape[1]
    weights = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
               rng.normal(0, 0.1, HIDDEN).astype(np.float32), np.zeros(d, np.float32), np.zeros((), np.float32)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for epoch in range(ROUNDS):
        order_p, order_u = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        batches = max(1, (len(positive) + len(unlabelled)) // BATCH)
        rate = RATE * (1 - epoch / ROUNDS)
        for part_p, part_u in zip(np.array_split(order_p, batches), np.array_split(order_u, batches)):
            if not len(part_p) or not len(part_u):
                continue
            x = np.concatenate([positive[part_p], unlabelled[part_u]])
            hidden, out = _forward(weights, x)
            g = np.concatenate(gradient(out[:len(part_p)], out[len(part_p):])).astype(np.float32)
            back = np.outer(g, weights[2]) * (hidden > 0)
            grads = [x.T @ back, back.sum(0), hidden.T @ g, x.T @ g, g.sum()]
            step += 1
            for i, grad in enumerate(grads):
                grad = grad + (1e-4 * weights[i] if np.ndim(weights[i]) else 0)
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                weights[i] = weights[i] - np.float32(rate) * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return tuple(np.asarray(w, np.float32) for w in weights)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from scores of rows that the scoring model was not fitted on.

    Above any score lie at least prior * (share of positives above it) of the unlabelled; the score where that bound is
    tightest, allowing for chance, gives the estimate.
    """
    cuts = np.unique(np.concatenate([positive, unlabelled]))
    above_p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    slack = np.sqrt(np.log(40) / (2 * len(positive))) + np.sqrt(np.log(40) / (2 * len(unlabelled)))
    usable = above_p > 0.02
    best = np.argmin((above_u[usable] + slack) / above_p[usable])
    return float(np.clip(above_u[usable][best] / above_p[usable][best], 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, *, seed: int = 7) -> Model:
    """A model from feature rows of positives and of unlabelled texts."""
    if not len(positive) or not len(unlabelled):
        raise ValueError("learning needs positives and unlabelled texts")
    both = np.concatenate([positive, unlabelled])
    middle, scale = both.mean(0), np.maximum(both.std(0), 0.02)
    p, u = _standard(positive, middle, scale), _standard(unlabelled, middle, scale)

    def apart(zp, zu):  # ordinary logistic loss, both sides of equal weight
        return (_sigmoid(zp) - 1) / len(zp), _sigmoid(zu) / len(zu)

    held = np.random.default_rng(seed).random
    fit_p, fit_u = held(len(p)) < 0.6, held(len(u)) < 0.6
    if fit_p.all() or fit_u.all() or not fit_p.any() or not fit_u.any():
        fit_p, fit_u = np.ones(len(p), bool), np.ones(len(u), bool)
        test_p, test_u = fit_p, fit_u
    else:
        test_p, test_u = ~fit_p, ~fit_u
    first = _train(p[fit_p], u[fit_u], apart, seed)
    prior = class_prior(_forward(first, p[test_p])[1], _forward(first, u[test_u])[1])

    def risk(zp, zu):
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        on_p, on_u = -prior * _sigmoid(zp) / len(zp), _sigmoid(zu) / len(zu)
        if negative < 0:  # that part may not go below zero: climb back instead
            return -on_p, -on_u
        return prior * (_sigmoid(zp) - 1) / len(zp) + on_p, on_u

    return Model(middle, scale, _train(p, u, risk, seed + 1), prior)


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """The model that `docs` and their labels give; without positives one that gives all texts the same score."""
    positive, unlabelled = sample(docs, labels)
    if len(positive) and len(unlabelled):
        return fit(positive, unlabelled)
    weights = np.zeros((N_FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(N_FEATURES), np.zeros(())
    return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), tuple(w.astype(np.float32) for w in weights), 0.5)


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, to, data, at in slices(batch.column(2)):
            x, _ = features(data, at)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), N_FEATURES).cast(pa.list_(pa.float32()))
            yield pa.record_batch([batch.column(0).slice(row, to - row), batch.column(1).slice(row, to - row), flat], ["kind", "rank", "x"])


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of positives and of unlabelled documents, the same ones on every call.

    Positives: ids with no label but 1, that are not held out. Unlabelled: ids without a label, and
    if they have fewer than FEW texts also labelled ones that are not held out. The ids of the positives are at most POSITIVES, so they are broadcast.
    Of rows that repeat an id the least text counts. Hashes first leave out most ids, so that few are sorted.
    """
    labelled = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    good = labelled.groupBy("doc_id").agg(F.min("quality").alias("q")).where((F.col("q") == 1) & ~held_out(F.col("doc_id")))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL AND text <> ''")
    hashed = F.xxhash64("doc_id", F.lit(11))
    rank = F.pmod(hashed, F.lit(1 << 30))

    def rate(most: int, total: int) -> int:
        return (1 << 30) * min(most, total) // max(1, total)

    def one_each(rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id").agg(F.min("text").alias("text")).withColumn("rank", F.struct(rank.alias("rank"), hashed.alias("hash")))

    chosen = good.where(rank < rate(POSITIVES * 5 // 4, good.count())).orderBy(rank, hashed).limit(POSITIVES).select("doc_id")
    # Held-out ids, a fifth, are drawn in vain, and the number of ids is known within some hundredths.
    drawn = rate(UNLABELLED * 3 // 2, docs.agg(F.approx_count_distinct(F.col(id_col), 0.02)).first()[0])
    few = one_each(texts.where((rank < drawn) & ~held_out(F.col("doc_id"))))
    positive = one_each(texts.join(F.broadcast(chosen), "doc_id", "left_semi")).select(F.lit(1).alias("kind"), "rank", "text")
    known = labelled.select("doc_id", F.lit(2).alias("known")).distinct()  # 2: labelled, for want of others
    unlabelled = few.join(known, "doc_id", "left").select(F.coalesce("known", F.lit(0)).alias("kind"), "rank", "text")
    wanted = "kind int, rank struct<rank: bigint, hash: bigint>, x array<float>"
    others = unlabelled.mapInArrow(_feature_rows, wanted).orderBy("rank").limit(UNLABELLED)
    rows = positive.mapInArrow(_feature_rows, wanted).unionByName(others).drop("rank").toArrow()
    kind, x = rows.column("kind").to_numpy(), rows.column("x").combine_chunks().values.to_numpy().reshape(-1, N_FEATURES)
    order = np.lexsort(x.T[::-1])  # whatever the order of tasks
    kind, x = kind[order], x[order]
    return x[kind == 1], x[kind != 1] if np.count_nonzero(kind == 0) < FEW else x[kind == 0]


def scored(docs: DataFrame, model: Model, score_col: str, *, text_col: str = "text") -> DataFrame:
    """`docs` with the score of each text in the new column `score_col`. Texts without a word score 0."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at_text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.empty(0)]
            for _, _, data, at in slices(batch.column(at_text)):
                x, words = features(data, at)
                parts.append(np.where(words > 0, model.scores(x), 0.0))
            yield pa.record_batch([*batch.columns, pa.array(np.concatenate(parts))], [*batch.schema.names, score_col])

    return docs.mapInArrow(run, f"{kinds}, `{score_col}` double")


def quality_scores(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`<id_col>, held_out, score, predicted` for each row."""
    rows = scored(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), model, "_score", text_col="_text")
    return rows.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), F.col("_score").alias("score"),
                       (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
