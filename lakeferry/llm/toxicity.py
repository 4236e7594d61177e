"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly.

A document is the average of the embeddings of all character n-grams of its words;
a linear layer and a softmax follow; embeddings and layer are trained together
with Adagrad in numpy. Words never seen in training, misspellings among them,
share n-grams with words that were, and so their vectors.

Training takes at most ``max_documents`` labelled rows (whole texts), chosen in
hash order and half of them from the rarer class where there are as many; that
bound is what the driver holds. Scoring needs, per n-gram bucket, only the
difference of the two classes' products with its embedding, one float: the model
sent to tasks is 4 bytes per bucket. Scoring is one pass without a shuffle.

Defined cases: null and empty texts have no n-grams and get the score of the bias
alone; labels, language, source and id are never inputs of a score; labelled rows
are rows whose id has a non-null label, and of several labels of one id the largest
counts; without labels of both kinds every score is the share of positives (0
without labels); extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeferry.llm import subwords
from lakeferry.llm.common import crc_of_id, give_back, ship

SIZES, BITS, DIMENSIONS = (3, 4, 5, 6), 18, 4
MAX_DOCUMENTS, DAMPING = 4_000, 1e-9
#: Bytes of training texts whose n-grams are counted at once.
BAG_BYTES = 100_000
#: Scores from which a document counts as toxic.
TOXIC_FROM = 0.3


@dataclass(frozen=True)
class ToxicityModel:
    """weights: per bucket, product of its embedding with the layer's class difference."""

    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        out = []
        for data, bounds in subwords.chunks(texts):
            total, count = np.zeros(len(data) + 1), np.zeros(len(data) + 1)
            for at, bucket in subwords.buckets(data, SIZES, BITS):
                total[at] += self.weights[bucket]
                count[at] += 1
            sums, counts = np.add.reduceat(total, bounds[:-1]), np.add.reduceat(count, bounds[:-1])
            out.append(self.bias + sums / np.maximum(counts, 1))
        logit = np.concatenate(out) if out else np.empty(0)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece of the texts: the buckets of its texts, one text after the other, how often each is there, and the bounds of the texts."""
    for data, bounds in subwords.chunks(texts, BAG_BYTES):
        found = list(subwords.buckets(data, SIZES, BITS))
        at, bucket = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        row = np.searchsorted(bounds, at, side="right") - 1
        key, count = np.unique(row << BITS | bucket, return_counts=True)
        cuts = np.searchsorted(key, np.arange(len(bounds), dtype=np.int64) << BITS)
        yield (key & ((1 << BITS) - 1)).astype(np.int32), count, cuts


def frequent(texts: pa.Array, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(texts with each bucket; buckets, counts, bounds and number of all n-grams of the texts).

    Of the texts only buckets are kept that ``least`` texts have. What they take is known
    after a first pass, so that they lie in one array each and not in pieces that keep
    the driver's memory from being given back.
    """
    texts_with, most = np.zeros(1 << BITS, dtype=np.int64), 0
    for bucket, count, _ in bags(texts):
        texts_with += np.bincount(bucket, minlength=len(texts_with))
        most = max(most, int(count.max(initial=0)))
    kept = texts_with >= least
    size = int(texts_with[kept].sum())
    buckets, times = np.empty(size, dtype=np.int32), np.empty(size, dtype=np.min_scalar_type(most))
    ends, totals, start = [np.zeros(1, dtype=np.int64)], [], 0
    for bucket, count, cuts in bags(texts):
        keep = kept[bucket]
        end = start + np.concatenate([[0], np.cumsum(keep)])[cuts[1:]]
        stop = int(end[-1])
        buckets[start:stop], times[start:stop] = bucket[keep], count[keep]
        ends.append(end)
        totals.append(np.diff(np.concatenate([[0], np.cumsum(count)])[cuts]))
        start = stop
    return texts_with, buckets, times, np.concatenate(ends), np.maximum(np.concatenate(totals), 1)


def train(
    texts: pa.Array,
    labels: np.ndarray,
    epochs: int | None = None,
    batch: int = 64,
    rate: float = 20.0,
    least: int | None = None,
    positives: float | None = None,
    seed: int = 3,
) -> ToxicityModel:
    """Joint Adagrad on embeddings and layer. ``rate`` is large since shares are small.

    ``DAMPING`` keeps the first steps of rare buckets in proportion to their gradient.
    Few texts are gone through more often: about 12,000 texts in all, 5 to 30 times each.

    ``positives`` is their share where the model is used, if the sample's differs:
    the bias moves by the difference of the log odds.

    Buckets that fewer than ``least`` training texts have (one in 400, 3 at least)
    would be learned by heart; their embedding is nought.
    """
    rng = np.random.default_rng(seed)
    epochs = epochs or min(30, max(5, 12_000 // len(texts)))
    least = least or max(3, len(texts) // 400)
    texts_with, buckets, times, bounds, totals = frequent(texts, least)
    cells, n = [slice(*b) for b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], 1 << BITS
    embedding = [rng.normal(0, 0.1, n).astype(np.float32) for _ in range(DIMENSIONS)]
    layer = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    base = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    bias = np.array([0.0, np.log(base / (1 - base))], dtype=np.float32)
    g_embedding = [np.full(n, DAMPING, dtype=np.float32) for _ in range(DIMENSIONS)]
    g_layer, g_bias = np.full_like(layer, 1e-6), np.full_like(bias, 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(cells))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            index = np.concatenate([buckets[cells[i]] for i in chosen])
            share = np.concatenate([(times[cells[i]] / totals[i]).astype(np.float32) for i in chosen])
            lengths = bounds[chosen + 1] - bounds[chosen]
            doc = np.repeat(np.arange(len(chosen)), lengths)
            hidden = np.stack(
                [np.bincount(doc, share * e[index], minlength=len(chosen)) for e in embedding], axis=1
            )
            logits = hidden @ layer + bias
            logits -= logits.max(axis=1, keepdims=True)
            odds = np.exp(logits)
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), labels[chosen].astype(int)] -= 1
            error /= len(chosen)
            d_layer, d_bias, d_hidden = hidden.T @ error, error.sum(axis=0), error @ layer.T
            used, inverse = np.unique(index, return_inverse=True)
            for k in range(DIMENSIONS):
                step = np.bincount(inverse, share * d_hidden[doc, k], minlength=len(used)).astype(np.float32)
                g_embedding[k][used] += step * step
                embedding[k][used] -= rate * step / np.sqrt(g_embedding[k][used])
            g_layer += d_layer * d_layer
            layer -= (0.05 * d_layer / np.sqrt(g_layer)).astype(np.float32)
            g_bias += d_bias * d_bias
            bias -= (0.1 * d_bias / np.sqrt(g_bias)).astype(np.float32)
    difference = layer[:, 1] - layer[:, 0]
    weights = sum(d * e for d, e in zip(difference, embedding))
    shift = np.log(positives / (1 - positives)) - np.log(base / (1 - base)) if positives else 0.0
    return ToxicityModel(
        np.where(texts_with >= least, weights, 0).astype(np.float32), float(bias[1] - bias[0] + shift)
    )


def labelled_ids(docs: DataFrame, labels: DataFrame, label: str, learn: Column, id_col: str) -> DataFrame:
    """(_id, label) of the labelled documents that may be learned from, each id once."""
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(F.col(label).cast("int")).alias("label")
    )
    return known.join(learnable_ids(docs, learn, id_col), "_id")


def learnable_ids(docs: DataFrame, learn: Column, id_col: str) -> DataFrame:
    """_id of the documents for which ``learn`` holds, each once; no text is read."""
    return docs.where(learn).select(F.col(id_col).alias("_id")).distinct()


def texts_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> pa.Array:
    """Whole texts of the ``chosen`` ids, in order of id; of repeated rows the least text.

    ``chosen`` is limited by its caller, so that it may be sent to every task.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen.select("_id")), "_id").groupBy("_id").agg(F.min("text").alias("text"))
    table = found.toArrow().sort_by("_id")
    return table["text"].combine_chunks() if len(table) else pa.array([], pa.string())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    label: str = "toxic",
    max_documents: int = MAX_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 3,
) -> ToxicityModel:
    """Train on at most ``max_documents`` labelled rows for which ``learn`` holds."""
    ids = labelled_ids(docs, labels, label, F.lit(True) if learn is None else learn, id_col)
    order = [F.xxhash64(F.lit(seed), "_id"), F.col("_id")]
    counts = {r["label"]: r["n"] for r in ids.groupBy((F.col("label") == 1).alias("label")).agg(F.count("*").alias("n")).collect()}
    half = max_documents // 2
    positive = texts_of(docs, ids.where("label = 1").orderBy(*order).limit(half), id_col, text_col)
    negative = texts_of(docs, ids.where("label <> 1").orderBy(*order).limit(max_documents - half), id_col, text_col)
    if not len(positive) or not len(negative):
        return ToxicityModel(np.zeros(1 << BITS, dtype=np.float32), 500.0 if len(positive) else -500.0)
    truth = np.concatenate([np.zeros(len(negative)), np.ones(len(positive))])
    texts = pa.concat_arrays([negative, positive])
    del negative, positive
    model = train(texts, truth, positives=counts[True] / sum(counts.values()), seed=seed)
    del texts
    give_back()
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    return docs.select(F.col(id_col).alias("doc_id"), scorer(docs, model)(F.col(text_col)).alias("score"))


def scorer(docs: DataFrame, model: ToxicityModel):
    """A function from a column of texts to scores."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def judged(texts: pa.Array) -> pa.Array:
        scores = pa.array(shared.value.score(texts))
        # Workers live on after their task; what they do not need goes back.
        pa.default_memory_pool().release_unused()
        return scores

    return judged


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id, modulo ``parts``, is ``part``."""
    return crc_of_id(id_col) % parts == part
