"""Vector codes and whitening against brute force, and the metric trees by themselves."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from check import compare, connect
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeferry.llm import metric_trees, queries, vectors, whitening
from lakeferry.llm.vector_codes import compress
from lakeferry.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<double>, label int"
ODD = [
    (900, None, 1), (901, [1.0, None, 2.0, 0.5], 1), (902, [float("nan")] * 4, 2), (903, [float("inf"), 0.0, 0.0, 1.0], 2),
    (904, [1e300, 0.0, 0.0, 1.0], 2),
]


def squares(points, entries):
    return ((points[:, None, :].astype(object) - entries[None].astype(object)) ** 2).sum(axis=-1)


@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(0, 4), st.integers(1, 20), st.sampled_from([1, 3, 50, 2**30, 2**51]))
@settings(max_examples=60, deadline=None)
def test_trees_find_the_nearest_entry_and_the_sums(seed, n, width, k, scale):
    rng = np.random.default_rng(seed)
    points, entries = (np.floor(rng.uniform(-1, 1, (m, width)) * scale).astype(np.int64) for m in (n, k))
    points[:: rng.integers(1, 5)] = points[0]
    tree = metric_trees.grow(points)
    want = squares(points, entries).argmin(axis=1) if width else np.zeros(n, dtype=int)
    assert (metric_trees.nearest(tree, entries) == want).all()
    sums, counts = metric_trees.totals(tree, entries)
    assert counts.tolist() == np.bincount(want, minlength=k).tolist()
    for entry in range(k):
        assert sums[entry].tolist() == points[want == entry].astype(object).sum(axis=0).tolist() or not counts[entry]
    for ball in range(len(tree.first)):
        inside = tree.points[tree.first[ball] : tree.last[ball]]
        assert (tree.sums[ball] == inside.astype(object).sum(axis=0)).all()


def test_balls_are_owned_as_a_whole():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(16, 4)) * 1_000
    points = np.floor(centres[rng.integers(0, 16, 4_000)] + rng.normal(size=(4_000, 4))).astype(np.int64)
    _, measured, (left, _) = metric_trees.walk(metric_trees.grow(points), np.floor(centres).astype(np.int64))
    assert measured < 4_000 and not len(left)


def brute_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [
        (i, label, [int(np.floor(scale * x)) for x in v]) for i, v, label in rows
        if v is not None and all(x is not None and np.isfinite(x) and abs(x) * scale < 2**52 for x in v)
    ]
    out = []
    for dim in {len(v) for _, _, v in kept}:
        own = sorted([k for k in kept if len(k[2]) == dim], key=lambda k: (k[0] is None, k[0] or 0, k[2]))
        cuts = [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]
        books = [[v[a:b] for _, _, v in own[:entries]] for a, b in cuts]

        def assigned():
            return [
                [min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), k) for k, e in enumerate(book)) for (a, b), book in zip(cuts, books)]
                for _, _, v in own
            ]

        for _ in range(rounds):
            found, fresh = assigned(), [list(b) for b in books]
            for p, (a, b) in enumerate(cuts):
                for e in range(len(books[p])):
                    mine = [v[a:b] for (_, _, v), f in zip(own, found) if f[p][1] == e]
                    if mine:
                        fresh[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
            books = fresh
        digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for (i, label, _), f in zip(own, assigned()):
            out.append((i, label, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), digest))
    errors = defaultdict(int)
    for _, label, _, error, _ in out:
        errors[label] += error
    return sorted(((i, code, error, errors[label], digest) for i, label, code, error, digest in out), key=repr)


def test_codes_equal_brute_force_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 2_000)  # several blocks
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=32).tolist(), None if i % 7 == 0 else i % 3) for i in range(150)]
    rows += ODD + [(i, [0.25] * 32, 0) for i in range(200, 260)] + [(None, [0.5] * 32, 1), (3, [-0.5] * 32, 1), (3, [-0.5] * 32, 1)]
    rows += [(i, rng.normal(size=5).tolist(), 9) for i in range(400, 410)] + [(500, [], 9), (501, [3e9] * 5, 9), (502, [-3e9] * 5, 9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit(1), "mark": F.lit("clash"), "code": F.lit("x")})
    got = compress(df, entries=20)[0]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_codes(rows, entries=20)


def test_codes_equal_sql_on_given_vectors(spark, sf_dir):
    assert compare(queries.op11_vector_codes(spark, sf_dir), connect(sf_dir), queries.ORACLES["op11_vector_codes"]) is None


def brute_white(x, k):
    """(eigenvalues, whitened rows, trace) by an eigendecomposition of the covariance."""
    centred = x - x.mean(axis=0)
    values, columns = np.linalg.eigh(centred.T @ centred / len(x))
    order = np.argsort(-values)[:k]
    return values[order], centred @ columns[:, order] / np.sqrt(values[order]), values.sum()


@pytest.mark.parametrize("shape", ["flat", "spiky", "clusters", "equal pairs"])
def test_whitening_equals_an_eigendecomposition(spark, shape, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 20_000)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 24))
    if shape == "spiky":
        x = x * np.logspace(0, -3, 24)
    elif shape == "clusters":
        x = 0.2 * x + rng.normal(size=(6, 24))[rng.integers(0, 6, 400)]
    elif shape == "equal pairs":  # every eigenvalue twice, up to rounding to whole numbers
        half = x[:, :12] * np.linspace(3, 1, 12)
        x = np.block([[half, np.zeros((400, 12))], [np.zeros((400, 12)), half]])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows + ODD[:4], SCHEMA)
    result, models = whiten(df)
    got = defaultdict(dict)
    for r in result.collect():
        got[r["vec_id"]][r["component"]] = r
    whole = np.floor(x * 1024) + 100_000
    values, white, trace = brute_white(whole, 8)
    assert set(got) == set(range(len(x))) and all(set(g) == set(range(1, 9)) for g in got.values())
    table = np.array([[got[i][c]["whitened"] for c in range(1, 9)] for i in range(len(x))])
    np.testing.assert_allclose([got[0][c]["explained"] for c in range(1, 9)], values / trace, rtol=1e-9)
    np.testing.assert_allclose(np.cov(table.T, bias=True), np.eye(8), atol=1e-9)
    if shape != "equal pairs":
        np.testing.assert_allclose(table * np.sign((table * white).sum(axis=0)), white, atol=1e-7)
    sums = [int(s) for s in whole.sum(axis=0)]
    for i in range(0, len(x), 37):
        assert got[i][1]["deviation"] == sum((len(x) * int(a) - s) ** 2 for a, s in zip(whole[i], sums))
    assert got[0][1]["n"] == len(x) and got[0][1]["identity_error"] < 1e-9
    # Full reorthogonalisation: components are at right angles to rounding.
    components = models[24].components
    np.testing.assert_allclose(components.T @ components, np.eye(8), atol=1e-12)


def test_whitening_of_odd_tables(spark):
    def count(rows):
        return whiten(spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit(1), "id": F.lit("clash")}))[0].count()

    assert count([(1, [0.5] * 4, 0)] * 5 + ODD) == 0  # no variance
    assert count([(1, [0.5, 1.0], 0)]) == count([(1, [], 0), (2, [], 0)]) == 0
    assert count([(None, [0.5, 1.0], 0), (None, [0.5, 1.0], 0), (2, [1.0, 1.0], None)]) == 3  # one component
    # Rank 2 of 4, and vectors of another dimension apart.
    rng = np.random.default_rng(1)
    flat = rng.integers(-4, 5, (30, 2)) @ rng.integers(-3, 4, (2, 4))
    rows = [(i, (v / 4).tolist(), 0) for i, v in enumerate(flat)] + [(100 + i, [float(i), 0.0, 1.0], 0) for i in range(3)]
    assert count(rows) == 30 * 2 + 3 * 1


def test_deviations_beyond_a_long_are_held(spark):
    centre = whitening.Centre(4, (0, 0))
    assert centre.deviations(np.array([[1, 2], [2**40, 0]])) == [16 * 5, 2**63 - 1]
    assert whitening.Centre(3, (10, -7)).deviations(np.array([[2**29, -5]])) == [(3 * 2**29 - 10) ** 2 + (3 * -5 + 7) ** 2]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert compress(empty)[0].count() == whiten(empty)[0].count() == 0
