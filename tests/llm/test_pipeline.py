"""The pipeline's stages, each held against plain Python on its own input."""

from __future__ import annotations

import importlib
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_similarity import shingles
from test_text_models import library

import corpus_pipeline
from lakeferry.llm import toxicity
from lakeferry.llm.common import stored
from lakeferry.llm.queries import QUERIES

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """Input and output of every stage, as ``run`` chains them."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, sf_dir), "step")
        out.append((name, docs, result))
        docs = result
    return out


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_are_named_and_keep_the_columns(spark, sf_dir, steps):
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert [n for n, _, _ in steps] == [n for n, _ in corpus_pipeline.STAGES]
    assert all(result.columns == columns for _, _, result in steps[:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, sf_dir, steps):
    _, before, after = steps[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    left = ids(after)
    judged = before.join(labels, "doc_id").select("doc_id", "toxic", toxicity.held_out("doc_id", 4, 2).alias("held")).collect()
    gone = [r for r in judged if r["doc_id"] not in left]
    clean = [r for r in judged if not r["toxic"]]
    assert sum(r["toxic"] for r in gone) >= 0.75 * sum(r["toxic"] for r in judged)
    assert sum(not r["toxic"] for r in gone) <= 0.03 * len(clean)


def test_one_document_of_each_text_stays(steps):
    _, before, after = steps[1]
    best = {}
    for r in before.select("doc_id", "text").collect():
        key = (r["text"] or "").translate(UPPER)
        best[key] = max(best.get(key, -1), r["doc_id"])
    assert ids(after) == Counter(best.values())


def test_one_document_of_each_group_stays(steps):
    _, before, after = steps[2]
    rows = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
    left = ids(after)
    owners = defaultdict(set)
    for i, t in rows:
        for x in shingles(t):
            owners[x].add(i)
    close = Counter((a, b) for o in owners.values() for a in o for b in o if a < b)
    partners = {i for pair in close for i in pair}
    # Documents that share nothing with another all stay.
    assert all(left[i] == 1 for i, _ in rows if i not in partners)
    sets = dict(rows)
    for (a, b), n in close.items():
        x, y = shingles(sets[a]), shingles(sets[b])
        if 100 * n >= 80 * len(x | y):
            assert left[b] == 0  # a smaller id is in its group


def test_mixing_takes_its_share_once(steps):
    _, before, after = steps[3]
    words = F.sum(F.size(F.split(F.trim("text"), r"\s+")))
    share = after.select(words).first()[0] / before.select(words).first()[0]
    assert 0.75 <= share <= 0.81
    assert max(ids(after).values()) == 1 and not ids(after) - ids(before)


def test_tokens_equal_the_library(spark, sf_dir, steps):
    _, before, after = steps[4]
    texts = {r["doc_id"]: r["text"] for r in before.select("doc_id", "text").collect()}
    assert {r["doc_id"]: tuple(r)[1:] for r in after.collect()} == {i: library(t) for i, t in texts.items()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, after.collect()))


ODD = [
    (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, "A b c d e f", "en", None, None), (4, "a B c d e f", "en", "b", 6),
    (5, "word " * 20_000, "de", "b", 1), (6, "x", "fr", "c", 1), (6, "x", "fr", "c", 1), (None, "no id at all here", "en", "a", 1),
]


def test_stages_take_odd_rows_and_empty_tables(spark, sf_dir):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(1) for c in ("row", "leaf", "whole", "mark", "score", "label", "_sha")})
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, rows, sf_dir)
            assert result.columns == docs.columns, name
            assert not ids(result) - ids(rows), name
        assert corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).count() == rows.count()


def test_nothing_else_needs_the_subpackage(monkeypatch):
    """Without llm and the pipeline the other queries stay."""
    sys.modules.pop("__spark_entry__", None)
    find = importlib.util.find_spec
    hidden = ("lakeferry.llm", "corpus_pipeline")
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n.startswith(hidden) else find(n, *a))
    entry = importlib.import_module("__spark_entry__")
    assert "merge_upsert" in entry.queries() and not any(n.startswith("op") or n == "pipeline" for n in entry.queries())
    monkeypatch.undo()
    sys.modules.pop("__spark_entry__", None)
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {
        n if n == "pipeline" else n.split("_")[0] + "_" for n in importlib.import_module("__spark_entry__").queries()
    }
    others = [p for p in Path("lakeferry").rglob("*.py") if "llm" not in p.parts]
    assert not any("lakeferry.llm" in p.read_text() for p in others)


def test_what_op2_calls_toxic_goes(spark, sf_dir, steps):
    toxic = QUERIES["op2_toxicity"](spark, sf_dir).where("predicted = 1")
    assert set(ids(toxic)) and not set(ids(toxic)) & set(ids(steps[0][2]))


def test_rows_of_one_id_are_told_apart(spark, sf_dir):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [
        (1, a), (5, f"{a} end"), (5, "a text that no other row is like"),
        (7, b), (7, f"{b} end"), (8, f"{b} other"), (9, "twice the same id and text"), (9, "twice the same id and text"),
        (1, "also of the first id but on its own"), (1, "also of the first id and twice there"), (2, "also of the first id and twice there"),
        (None, a),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = Counter(map(tuple, corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()))
    seven = {t for i, t in left if i == 7}
    assert len(seven) == 1 and seven <= {b, f"{b} end"}
    assert Counter({k: n for k, n in left.items() if k[0] != 7}) == Counter(
        [rows[0], rows[2], rows[6], rows[8], rows[9], rows[11]]
    )
