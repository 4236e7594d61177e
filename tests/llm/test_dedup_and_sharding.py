"""Exact deduplication, sharding, and what both do with odd rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict
from math import comb

import pytest
from pyspark.sql import functions as F

from lakeferry.llm.exact_dedup import drop_copies, exact_groups
from lakeferry.llm.sharding import communication_matrix, hypergeometric, shard

ODD = [
    (1, "Same Text", "x"), (2, "same text", "y"), (3, "SAME TEXT", "z"), (4, "", "a"), (5, None, "b"), (6, "É", "c"),
    (7, "é", "d"), (8, "other", "e"), (8, "other", "e"), (None, "same text", "f"), (None, "alone", "g"), (9, "long " * 50_000, "h"),
]
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


@pytest.fixture
def odd(spark):
    # Extra columns with names the operators use themselves.
    return spark.createDataFrame(ODD, "doc_id long, text string, hash string").withColumns(
        {"norm": F.lit(1), "keep_id": F.lit(2), "part": F.lit(3), "row": F.lit(4), "shard": F.lit(5)}
    )


@pytest.mark.parametrize("keep, best", [("largest", max), ("smallest", min)])
def test_groups_are_equal_texts(odd, keep, best):
    members = defaultdict(list)
    for i, text, _ in ODD:
        members[(text or "").translate(UPPER)].append(i)
    want = Counter()
    for i, text, _ in ODD:
        norm = (text or "").translate(UPPER)
        known = [m for m in members[norm] if m is not None]
        first = best(known) if known else None
        want[i, first, len(members[norm]), i == first, hashlib.sha256(norm.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in exact_groups(odd, keep=keep).collect()) == want


def test_one_row_of_each_text_stays(odd):
    left = drop_copies(odd, keep="largest")
    assert left.columns == odd.columns
    assert sorted((r["doc_id"] or 0, r["hash"]) for r in left.collect()) == [
        (0, "g"), (3, "z"), (5, "b"), (6, "c"), (7, "d"), (8, "e"), (9, "h"),
    ]


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    assert exact_groups(none).count() == drop_copies(none).count() == shard(none).count() == 0


def test_half_of_the_rows_are_one_text(spark):
    rows = spark.range(2_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    groups = exact_groups(rows, keep="largest")
    assert groups.where("kept").count() == 1_001
    assert groups.where("keep_id = 1998").count() == 1_000


@pytest.mark.parametrize("total, marked, drawn", [(10, 4, 5), (60, 7, 31), (1, 1, 1), (5, 0, 3), (9, 9, 4), (8, 3, 8)])
def test_hypergeometric_quantiles(spark, total, marked, drawn):
    grid = [(i + 0.5) / 200 for i in range(200)]
    rows = spark.createDataFrame([(u, total, marked, drawn) for u in grid], "u double, n long, k long, d long")
    got = [r[0] for r in rows.select(hypergeometric(F.col("u"), F.col("n"), F.col("k"), F.col("d"))).collect()]
    low, high = max(0, drawn - (total - marked)), min(marked, drawn)
    share = {x: comb(marked, x) * comb(total - marked, drawn - x) / comb(total, drawn) for x in range(low, high + 1)}
    counts = Counter(got)
    assert set(counts) <= set(share)
    for x, p in share.items():  # an even grid meets each value's share to one step on either side
        assert abs(counts[x] / 200 - p) <= 0.0101


def test_matrix_has_both_margins(spark):
    sizes = [700, 0, 123, 9, 2_001]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(sizes) if n], "part long, n long")
    total = sum(sizes)
    shards = [total // 7 + (j < total % 7) for j in range(7)]
    counts = {r["part"]: list(r["counts"]) for r in communication_matrix(rows, 5, shards, 3).collect()}
    assert [sum(counts.get(i, [0])) for i in range(5)] == sizes
    assert [sum(c[j] for c in counts.values()) for j in range(7)] == shards
    assert min(min(c) for c in counts.values()) >= 0


def test_shards_are_gapless_and_even(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(7)
    rows = shard(docs, shards=40, slice_rows=10).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    assert Counter(r["doc_id"] for r in rows) == Counter(list(texts))
    slots = defaultdict(list)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} <= {len(rows) // 40, len(rows) // 40 + 1}


def test_odd_rows_are_dealt_too(odd):
    rows = shard(odd, shards=5).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _, _ in ODD)
    assert Counter(r["shard"] for r in rows) == {0: 3, 1: 3, 2: 2, 3: 2, 4: 2}


def test_every_place_is_equally_likely(spark):
    docs = spark.range(0, 12, 1, 3).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    met = Counter()
    for seed in range(30):
        met.update((r["doc_id"], r["shard"]) for r in shard(docs, shards=3, seed=seed).collect())
    # 30 draws with chance 1/3 each: 10 on average, standard deviation 2.6.
    assert all(1 <= met[i, s] <= 20 for i in range(12) for s in range(3))
