"""Quality: positive-unlabelled learning with the non-negative risk estimator.

Only trusted positives carry labels; the other class is learned from unlabelled
web text, which is a mixture of both. With class prior p and logistic loss l the
unbiased risk is p E_P[l(g, 1)] + (E_U[l(g, 0)] - p E_P[l(g, 0)]); its second part
estimates a loss and cannot be negative, so whenever a batch drives it below nought
that part alone is ascended instead of descended. The prior is estimated first:
the share of unlabelled text in any region is at least p times that of the
positives, so p is the least ratio of the two over the score regions of a first
classifier that tells positives from unlabelled. The unlabelled rows of each region are
counted over all documents that may be learned from, in one pass.

g is a network with one hidden layer over some twenty figures of the text: shares
of byte classes, repeated words, word and line lengths. Training takes at most
``max_documents`` texts of each kind, in hash order; scoring is one pass without
a shuffle and sends a few hundred floats to each task.

Defined cases: null and empty texts have figures of nought and are scored like
any other; labels, language, source and id are never inputs of a score; rows whose
label is null are unlabelled, and of several labels of one id the largest counts;
without positives, or without unlabelled text, every score is 0 or 1; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lakeferry.llm import words
from lakeferry.llm.common import ship
from lakeferry.llm.toxicity import labelled_ids, learnable_ids, texts_of

MAX_DOCUMENTS, HIDDEN, CHUNK_BYTES = 5_000, 16, 2_000_000

#: Byte classes whose shares of a text are figures.
CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "space": b" ",
    "line": b"\n", "stop": b".", "comma": b",", "bar": b"|", "shout": b"!", "symbol": b"#$%&*@^~=+_<>{}[]\\/",
    "quote": b"\"'`()", "other": bytes(range(128, 256)),
}
_CLASS = np.full(256, len(CLASSES), dtype=np.uint8)
for _i, _members in enumerate(CLASSES.values()):
    _CLASS[list(_members)] = _i


def figures(texts: pa.Array) -> np.ndarray:
    """One row of figures per text."""
    space, edge = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    padded = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), edge), edge, space)
    _, offsets, raw = padded.buffers()
    all_bounds = np.frombuffer(offsets, dtype=np.int64)[padded.offset : padded.offset + len(padded) + 1]
    everything = np.frombuffer(raw, dtype=np.uint8)
    out, start = [np.empty((0, len(CLASSES) + 9))], 0
    while start < len(padded):
        stop = max(start + 1, int(np.searchsorted(all_bounds, all_bounds[start] + CHUNK_BYTES, side="right")) - 1)
        bounds = all_bounds[start : stop + 1] - all_bounds[start]
        out.append(_figures(everything[all_bounds[start] : all_bounds[stop]], bounds))
        start = stop
    return np.concatenate(out)


def _figures(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n = len(bounds) - 1
    size = np.maximum(np.diff(bounds) - 1, 1).astype(float)
    text = np.repeat(np.arange(n), np.diff(bounds))
    kinds = np.bincount(text * (len(CLASSES) + 1) + _CLASS[data], minlength=n * (len(CLASSES) + 1)).reshape(n, -1)
    starts, ends, of = words.spans(data, bounds)
    code = words.hashes(data, starts, ends)
    count = np.bincount(of, minlength=n)
    per_word = np.maximum(count, 1).astype(float)
    length = np.bincount(of, ends - starts, minlength=n) / per_word
    square = np.bincount(of, (ends - starts) ** 2, minlength=n) / per_word
    again = np.bincount(of[1:][(code[1:] == code[:-1]) & (of[1:] == of[:-1])], minlength=n) / per_word
    order = np.lexsort((code, of))
    fresh = np.concatenate([[True], (code[order][1:] != code[order][:-1]) | (of[order][1:] != of[order][:-1])])[: len(code)]
    distinct = np.bincount(of[order][fresh], minlength=n)
    upper = (data[starts] >= 65) & (data[starts] <= 90) if len(starts) else np.zeros(0, bool)
    last = data[np.maximum(ends - 1, 0)] if len(ends) else np.zeros(0, np.uint8)
    odd = np.isin(_CLASS[last], [list(CLASSES).index(k) for k in ("symbol", "shout", "bar")])
    alone = (ends - starts == 1) & odd
    return np.column_stack([
        kinds[:, :-1] / size[:, None], np.log1p(size), np.log1p(count), length, np.sqrt(np.maximum(square - length**2, 0)),
        again, distinct / per_word, np.bincount(of, upper, minlength=n) / per_word,
        np.bincount(of, odd, minlength=n) / per_word, np.bincount(of, alone, minlength=n) / per_word,
    ])


@dataclass(frozen=True)
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    prior: float = float("nan")

    def logit(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.inner + self.inner_bias)
        return hidden @ self.outer + self.outer_bias

    def logits(self, texts: pa.Array) -> np.ndarray:
        return self.logit(figures(texts))

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -500, 500)))


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int, seed: int) -> QualityModel:
    """Adam on the non-negative risk, or, without a prior, on plain positives against unlabelled."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    centre, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    p, u = (positive - centre) / scale, (unlabelled - centre) / scale
    weights = [
        rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        xp, xu = p[rng.integers(len(p), size=256)], u[rng.integers(len(u), size=256)]
        x = np.concatenate([xp, xu])
        hidden = np.tanh(x @ weights[0] + weights[1])
        g = hidden @ weights[2] + weights[3][0]
        odds = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        gp, gu = odds[:256], odds[256:]
        if prior is None:
            slope = np.concatenate([(gp - 1) / 256, gu / 256]) / 2
        else:
            # Loss as a negative is -log(1 - odds); its slope is odds.
            negative = -np.log1p(-np.minimum(gu, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(gp, 1 - 1e-12)).mean()
            if negative >= 0:
                slope = np.concatenate([prior * (gp - 1) / 256 - prior * gp / 256, gu / 256])
            else:
                slope = -np.concatenate([-prior * gp / 256, gu / 256])
        d_hidden = np.outer(slope, weights[2]) * (1 - hidden**2)
        grads = [x.T @ d_hidden, d_hidden.sum(axis=0), hidden.T @ slope, np.array([slope.sum()])]
        rate = 0.01 * (1 - step / (steps + 1)) + 0.0005
        for i, grad in enumerate(grads):
            grad = grad + 1e-4 * weights[i]
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad**2
            weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (
                np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
            )
    return QualityModel(centre, scale, weights[0], weights[1], weights[2], float(weights[3][0]), prior or float("nan"))


def regions(positive: np.ndarray, least: float = 0.1) -> np.ndarray:
    """Scores from which on regions begin; each holds at least ``least`` of the positives."""
    return np.quantile(positive, np.linspace(0, 1 - least, 60))


def class_prior(positive: np.ndarray, cuts: np.ndarray, shares: np.ndarray, n: int) -> float:
    """Share of positives in unlabelled text, from scores of a first classifier.

    Over the regions "score at least t", t in ``cuts``, the smallest ratio of the shares
    of unlabelled (``shares``, of ``n`` rows) and of positive rows, with one standard
    error added for the smaller regions.
    """
    p, u = np.array([(positive >= t).mean() for t in cuts]), shares
    error = np.sqrt(u * (1 - u) / n + p * (1 - p) / len(positive)) / np.maximum(p, 1e-9)
    return float(np.clip(np.min(u / np.maximum(p, 1e-9) + error), 0.01, 0.99))


def train(
    positive: pa.Array, unlabelled: pa.Array, counted: Callable[[QualityModel, np.ndarray], tuple[np.ndarray, int]],
    steps: int = 3_000, seed: int = 5,
) -> QualityModel:
    """``counted(model, cuts)`` tells the shares of all unlabelled rows that reach each cut, and their number."""
    p, u = figures(positive), figures(unlabelled)
    half_p, half_u = len(p) // 2, len(u) // 2
    first = _descend(p[:half_p] if half_p else p, u[:half_u] if half_u else u, None, steps // 3, seed)
    held = first.logit(p[half_p:])
    cuts = regions(held)
    return _descend(p, u, class_prior(held, cuts, *counted(first, cuts)), steps, seed)


def counts(docs: DataFrame, text_col: str = "text"):
    """For ``train``: counts over all rows of ``docs``, in one pass."""

    def counted(model: QualityModel, cuts: np.ndarray) -> tuple[np.ndarray, int]:
        logits = docs.select(_told(docs, model, "logits")(F.col(text_col)).alias("x"))
        found = logits.agg(
            F.count("*").alias("n"), *[F.count_if(F.col("x") >= F.lit(float(t))).alias(f"c{i}") for i, t in enumerate(cuts)]
        ).first()
        return np.array(found[1:], dtype=float) / max(found["n"], 1), max(found["n"], 1)

    return counted


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    label: str = "quality",
    max_documents: int = MAX_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 5,
) -> QualityModel:
    """Train on at most ``max_documents`` trusted positives and as many unlabelled texts."""
    learn = F.lit(True) if learn is None else learn

    def some(ids: DataFrame, salt: int) -> pa.Array:
        chosen = ids.orderBy(F.xxhash64(F.lit(salt), "_id"), "_id").limit(max_documents)
        return texts_of(docs, chosen, id_col, text_col)

    positive = some(labelled_ids(docs, labels, label, learn, id_col).where("label = 1"), seed)
    unlabelled = some(learnable_ids(docs, learn, id_col), seed + 1)
    if len(positive) < 2 or len(unlabelled) < 2:
        width = len(CLASSES) + 9
        nothing = np.zeros(width)
        sure = 500.0 if len(positive) else -500.0
        return QualityModel(nothing, nothing + 1, np.zeros((width, 1)), np.zeros(1), np.zeros(1), sure)
    return train(positive, unlabelled, counts(docs.where(learn), text_col), seed=seed)


def scorer(docs: DataFrame, model: QualityModel):
    """A function from a column of texts to scores."""
    return _told(docs, model, "score")


def _told(docs: DataFrame, model: QualityModel, what: str):
    """A function from a column of texts to what a method of the model gives."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def judged(texts: pa.Array) -> pa.Array:
        found = pa.array(getattr(shared.value, what)(texts))
        pa.default_memory_pool().release_unused()
        return found

    return judged


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    return docs.select(F.col(id_col).alias("doc_id"), scorer(docs, model)(F.col(text_col)).alias("score"))
