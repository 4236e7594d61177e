"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows C (vectors minus their mean) are brought to bidiagonal form: from a
unit vector v, products C v and Cᵀ u alternate, each made orthogonal to all before it,
C V = U B with B upper bidiagonal. The small B's singular value decomposition gives
the components, V times its right vectors, and the deviations.

A left vector u has an entry per row of the table, so it is never stored: u = C g
with a short g that the driver keeps. A step is one pass: every task forms its rows'
entries of C p and multiplies them back, and sends ``dimension`` partial sums. All that
full reorthogonalisation needs follows from these sums: Uᵀ(C p) = Gᵀ(Cᵀ C p) for the
left side, Vᵀ w for the right one, twice. The mean is subtracted from the whole
numbers before anything is multiplied.

Steps end when the wanted components are found to rounding and the variance outside
the vectors so far is less than that of the last wanted component, so that none can
be hidden there; at the latest after as many steps as there are dimensions. Where the
space of a start is used up, a new start orthogonal to all before goes on.

Defined cases: vectors that are null, or hold a null, a non-finite number or one of
more than 52 bits when scaled, take no part (``vectors``); vectors of different
dimension are fitted apart; components without variance (below 1e-13 of the largest)
cannot be whitened and are left out, so that equal vectors, one vector or empty ones
have no rows; fewer dimensions than components give as many components; null ids and
repeated rows are rows like others; deviations beyond 64 bits are held at a long's
end; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeferry.llm.vectors import blocked, decimals, exact_sum, matrices, usable_rows

#: Residual of a component, relative to the largest deviation; variance that counts as none.
RESIDUAL, NOTHING = 1e-14, 1e-13
#: Entries of B, relative to the norm of C, that a product of doubles cannot tell from nought.
SMALLEST = 1e-7


@dataclass(frozen=True)
class Centre:
    """Number of vectors and sum of each dimension, exact."""

    n: int
    sums: tuple[int, ...]

    def rows(self, numbers: np.ndarray) -> np.ndarray:
        """``numbers`` minus the mean; whole parts are subtracted as whole numbers."""
        whole, rest = self._mean()
        return (numbers - whole).astype(np.float64) - rest

    def deviations(self, numbers: np.ndarray) -> list[int]:
        """Per row the sum of (n * x - sum) squared, exact, at most a long's end."""
        whole = self._mean()[0]
        rest = np.array([s - self.n * int(w) for s, w in zip(self.sums, whole)], dtype=np.int64)
        away = numbers - whole
        rough = ((self.n * away.astype(np.float64) - rest) ** 2).sum(axis=1)
        short = rough < 2.0**62
        exact = np.where(short[:, None], away, 0) * np.int64(self.n) - np.where(short[:, None], rest, 0)
        out = (exact * exact).sum(axis=1).tolist()
        for i in np.flatnonzero(~short):
            out[i] = min(sum((self.n * int(a) - int(r)) ** 2 for a, r in zip(away[i], rest)), 2**63 - 1)
        return out

    def _mean(self) -> tuple[np.ndarray, np.ndarray]:
        whole = [s // self.n for s in self.sums]
        rest = [(s - self.n * w) / self.n for s, w in zip(self.sums, whole)]
        return np.array(whole, dtype=np.int64), np.array(rest)


@dataclass(frozen=True)
class Whitening:
    """components: a unit column each; deviations: square roots of the eigenvalues."""

    centre: Centre
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray

    def apply(self, numbers: np.ndarray) -> np.ndarray:
        return self.centre.rows(numbers) @ self.components / self.deviations


def _summed(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
    """Sum over all blocks of ``part(numbers)``, ``length`` numbers: added up in each task, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            for _, _, _, numbers in matrices(batch):
                total += part(numbers)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length), pa.int32()), pa.array(total)], names=["place", "x"])

    found = blocks.mapInArrow(run, "place int, x double").groupBy("place").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(length)
    for r in found:
        out[r["place"]] = r["x"]
    return out


def centres(blocks: DataFrame) -> dict[int, Centre]:
    """Count and sums of the vectors of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for _, _, _, numbers in matrices(batch):
                kind = np.int64 if float(np.abs(numbers).max(initial=0)) * len(numbers) < 2.0**62 else object
                cell = held.setdefault(numbers.shape[1], [0, np.zeros(numbers.shape[1], dtype=object)])
                cell[0] += len(numbers)
                cell[1] = cell[1] + numbers.astype(kind).sum(axis=0).astype(object)
        for dim, (n, sums) in held.items():
            cells = [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), decimals(sums), pa.array([n] * dim, pa.int64())]
            yield pa.RecordBatch.from_arrays(cells, names=["dim", "place", "total", "n"])

    partial = blocks.mapInArrow(run, "dim int, place int, total string, n long")
    summed = partial.groupBy("dim", "place").agg(exact_sum("total").alias("total"), F.sum("n").alias("n")).collect()
    out: dict[int, dict] = {}
    for r in summed:
        out.setdefault(r["dim"], {})[r["place"]] = (int(r["total"]), r["n"])
    return {dim: Centre(cells[0][1], tuple(cells[i][0] for i in range(dim))) for dim, cells in out.items()}


def bidiagonalise(
    product: Callable[[np.ndarray], tuple[np.ndarray, float]], dim: int, all_variance: float, wanted: int, seed: int = 7
) -> tuple[np.ndarray, np.ndarray]:
    """(V, B) with C V = U B; ``product(p)`` gives Cᵀ C p and the square of |C p|.

    ``all_variance`` is the sum of squares of C.
    """
    rng = np.random.default_rng(seed)
    right: list[np.ndarray] = []
    short: list[np.ndarray] = []  # g of every left vector u = C g
    back: list[np.ndarray] = []  # Cᵀ u
    b = np.zeros((dim, dim))
    largest = np.sqrt(all_variance)

    def apart(w: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for v in right:
                w = w - (v @ w) * v
        return w

    def start() -> np.ndarray:
        w = apart(rng.normal(size=dim))
        return w / np.linalg.norm(w)

    v, beta = start(), 0.0
    for k in range(dim):
        right.append(v)
        p = v - (beta * short[-1] if beta else 0.0)
        w, square = product(p)
        # Twice, like the right side: u minus what it has of the left vectors before it.
        for _ in range(2):
            share = [g @ w for g in short]
            for s, g, c in zip(share, short, back):
                p, w, square = p - s * g, w - s * c, square - s * s
        alpha = np.sqrt(max(p @ w, 0.0))
        if alpha <= SMALLEST * largest:
            # C v is in the space of the left vectors already: an empty row of B, and a new start.
            short.append(np.zeros(dim))
            back.append(np.zeros(dim))
            beta, rest = 0.0, None
        else:
            b[k, k] = alpha
            short.append(p / alpha)
            back.append(w / alpha)
            rest = apart(back[-1] - alpha * v)
            beta = np.linalg.norm(rest)
        if k + 1 == dim:
            break
        small = b[: k + 1, : k + 1]
        left, sigma, _ = np.linalg.svd(small)
        outside = all_variance - float((small * small).sum())
        if outside <= NOTHING * all_variance:
            break
        if k + 1 >= wanted and outside < sigma[wanted - 1] ** 2:
            if (beta * np.abs(left[k, :wanted]) <= RESIDUAL * sigma[0]).all():
                break
        if rest is None or beta <= 1e-12 * largest:
            v, beta = start(), 0.0
        else:
            v = apart(rest / beta)
            v, b[k, k + 1] = v / np.linalg.norm(v), beta
    k = len(right)
    return np.stack(right, axis=1), b[:k, :k]


def fit(blocks: DataFrame, centre: Centre, components: int, seed: int = 7) -> Whitening:
    """Components of the vectors of one dimension."""
    dim = len(centre.sums)
    variance = _summed(blocks, lambda x: np.array([(centre.rows(x) ** 2).sum()]), 1)[0]

    def product(p: np.ndarray) -> tuple[np.ndarray, float]:
        def part(numbers: np.ndarray) -> np.ndarray:
            rows = centre.rows(numbers)
            u = rows @ p
            return np.append(u @ rows, u @ u)

        found = _summed(blocks, part, dim + 1)
        return found[:dim], found[dim]

    empty = Whitening(centre, np.zeros((dim, 0)), np.zeros(0), np.zeros(0))
    if variance == 0:
        return empty
    wanted = min(components, dim)
    right, b = bidiagonalise(product, dim, variance, wanted, seed)
    _, sigma, turned = np.linalg.svd(b)
    keep = [i for i in range(min(wanted, len(sigma))) if sigma[i] ** 2 > NOTHING * sigma[0] ** 2]
    vectors = right @ turned[keep].T
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))])
    return Whitening(centre, vectors, sigma[keep] / np.sqrt(centre.n), sigma[keep] ** 2 / variance)


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """The largest entry by which the covariance of the whitened vectors is not the identity."""
    k, n = model.components.shape[1], model.centre.n
    if not k:
        return 0.0
    mean = _summed(blocks, lambda x: model.apply(x).sum(axis=0), k) / n

    def products(numbers: np.ndarray) -> np.ndarray:
        rows = model.apply(numbers) - mean
        return (rows.T @ rows).ravel()

    return float(np.abs(_summed(blocks, products, k * k).reshape(k, k) / n - np.eye(k)).max())


def whiten(
    vectors: DataFrame,
    components: int = 8,
    scale: int = 1024,
    offset: int = 100_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, dict[int, Whitening]]:
    """(a row per usable vector and component; the fitted models by dimension)."""
    blocks = blocked(usable_rows(vectors, scale, offset, id_col, vector_col), "vectors")
    models, errors = {}, {}
    for dim, centre in centres(blocks).items():
        own = blocks.where(F.col("dim") == dim)
        models[dim] = fit(own, centre, components)
        errors[dim] = identity_error(own, models[dim])
    shared = vectors.sparkSession.sparkContext.broadcast((models, errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, errors = shared.value
        for batch in batches:
            for _, ids, _, numbers in matrices(batch):
                dim = numbers.shape[1]
                if dim not in models or not len(models[dim].deviations):
                    continue
                model, k = models[dim], len(models[dim].deviations)
                rows = len(ids)
                each = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(each), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                        pa.array(np.full(rows * k, model.centre.n), pa.int64()),
                        pa.array(model.centre.deviations(numbers), pa.int64()).take(each),
                        pa.array(model.apply(numbers).ravel()), pa.array(np.tile(model.explained, rows)),
                        pa.array(np.full(rows * k, errors[dim])),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return blocks.mapInArrow(run, schema), models
