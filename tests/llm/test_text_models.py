"""Toxicity, quality and BPE: held-out accuracy, and the tokenizers library as judge."""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeferry.llm import bpe, quality, subwords, toxicity
from lakeferry.llm.queries import QUERIES, TOKENIZER, digests

PATH = public_tokenizers.path(TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = bpe.load_vocabulary(PATH)
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "aaa aaaa hahahaha" + "ha" * 400), (5, "<|endoftext|>x<|startoftext|> y <|endoftext|>"),
    (6, "It's we'll they'RE 'S I'm''s"), (7, "ΣΑΣ ΌΣΟΣ İ ẞ"), (8, "x\u0085y z\x1cq\x1fw"), (9, "é é 가"), (9, "twice"), (9, "twice"),
    (None, "日本語 👩‍👩‍👧 ½ ² 123"), (11, "word " * 60_000),
]


def auc(scores, truth):
    rank = np.argsort(np.argsort(scores)) + 1
    good = truth == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


@pytest.mark.parametrize("name, label, least", [("op2_toxicity", "toxic", 0.75), ("op3_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, sf_dir, name, label, least):
    scored = QUERIES[name](spark, sf_dir)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    assert scored.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", label)
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    scores, truth = np.array([r["score"] for r in rows]), np.array([r[label] for r in rows])
    assert ((scores >= 0) & (scores <= 1)).all()
    assert auc(scores, truth) >= least


def test_unseen_misspellings_score_high(spark):
    rude, plain = ["idiot", "moron"], ["table", "river", "window", "garden", "yellow", "market"]
    rng = np.random.default_rng(1)

    def text(bad):
        words = list(rng.choice(plain, 12)) + ([rng.choice(rude)] if bad else [])
        return " ".join(rng.permutation(words))

    rows = [(i, text(i % 2), i % 2) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    probe = [(1, "river table idioot window garden"), (2, "river table silver window garden"), (3, "yellow mor0n moronn table")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(probe, "doc_id long, text string"), model).collect()}
    assert got[1] > 0.5 > got[2] and got[3] > 0.5


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_models_take_odd_rows(spark, module, label):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({"score": F.lit("clash"), "label": F.lit(7)})
    for labels in ([], [(4, 1), (4, 0), (6, None)], [(4, 1), (5, 0), (6, 1), (7, 1)]):
        table = spark.createDataFrame(labels, f"doc_id long, {label} int")
        model = module.fit(docs, table)
        rows = module.score(docs, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
        assert module.score(docs.limit(0), model).count() == 0


def own_mb():
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_fit_gives_its_memory_back(spark):
    rng = np.random.default_rng(4)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnopqrst"), (3_000, 6))]
    rows = [(i, " ".join(rng.choice(words, 450)), i % 2) for i in range(1_200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    del rows
    toxicity.fit(docs.select("doc_id", "text").limit(20), docs.select("doc_id", "toxic"))
    before = own_mb()
    toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert own_mb() - before < 25


def test_pieces_of_training_texts_do_not_show(monkeypatch):
    rng = np.random.default_rng(6)
    texts = pa.array([None, "", *(" ".join(rng.choice(["idiot", "river", "window", "x" * 300], 30)) for _ in range(40))])
    truth, whole = rng.integers(0, 2, 42).astype(float), None
    counted = [dict(zip(*np.unique(b, return_counts=True))) for b in map(plain_buckets, texts.to_pylist())]
    for size in (100_000, 50):
        monkeypatch.setattr(toxicity, "BAG_BYTES", size)
        texts_with, buckets, times, bounds, totals = toxicity.frequent(texts, 3)
        for i, bag in enumerate(counted):
            kept = {b: n for b, n in bag.items() if sum(b in other for other in counted) >= 3}
            cell = slice(bounds[i], bounds[i + 1])
            assert dict(zip(buckets[cell], times[cell])) == kept and totals[i] == max(sum(bag.values()), 1)
        model = toxicity.train(texts, truth, epochs=2)
        assert whole is None or (model.weights == whole.weights).all() and model.bias == whole.bias
        whole = model


def plain_buckets(text):
    """Buckets of all n-grams of one text, by itself."""
    data, _ = subwords.spaced_bytes(pa.array([text], pa.string()))
    return np.concatenate([b for _, b in subwords.buckets(data, toxicity.SIZES, toxicity.BITS)])


def test_prior_is_estimated():
    rng = np.random.default_rng(3)
    positive = rng.normal(2, 1, 4_000)
    mixture = np.concatenate([rng.normal(2, 1, 2_800), rng.normal(-2, 1, 1_200)])
    cuts = quality.regions(positive)
    shares = np.array([(mixture >= t).mean() for t in cuts])
    assert abs(quality.class_prior(positive, cuts, shares, len(mixture)) - 0.7) < 0.08


def test_prior_counts_every_document_that_may_be_learned_from(spark, sf_dir):
    """Not only those of the sample, and none of the held-out ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(
        spark.createDataFrame([(-1, None, "xx", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long"),
        allowMissingColumns=True,
    )
    learn = ~toxicity.held_out("doc_id", 3, 1)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn=learn, max_documents=60)
    texts = [r["text"] or "" for r in docs.where(learn).collect()]
    cuts = np.array([-2.0, 0.0, 1.5])
    shares, n = quality.counts(docs.where(learn))(model, cuts)
    logits = model.logits(pa.array(texts))
    assert n == len(texts) > 60 and np.allclose(shares, [(logits >= t).mean() for t in cuts])


TEXTS = ["You st*pid, STUPID fool!", "", "a", "plain words here\nand a second line", "ÄÖ ü ß é", "x" * 50, "id1ot (moron)", "1 2 3, four. five!"]


def test_toxicity_score_equals_a_plain_loop():
    """Every n-gram of 3 to 6 bytes within a word and its edges, one after the other, under the same weights."""
    rng = np.random.default_rng(2)
    model = toxicity.ToxicityModel(rng.normal(size=1 << toxicity.BITS).astype(np.float32), -0.3)

    def bucket(symbols):
        code = symbols[0]
        for n, s in enumerate(symbols[1:], start=2):
            code = (code * 0x01000193 + s + n) & 0xFFFFFFFF
        code ^= code >> 15
        return (code * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - toxicity.BITS)

    def plain(text):
        data = f" {text.lower()} ".encode()
        apart = [subwords.SEPARATES[b] for b in data]
        symbols = [32 if a else b for a, b in zip(apart, data)]
        found = [
            model.weights[bucket(symbols[i : i + n])]
            for n in toxicity.SIZES for i in range(len(data) - n + 1) if not any(apart[i + 1 : i + n - 1])
        ]
        mean = sum(map(float, found)) / len(found) if found else 0.0
        return 1 / (1 + np.exp(-(model.bias + mean)))

    got = model.score(pa.array([*TEXTS, None]))
    # Long texts and several pieces give the same.
    np.testing.assert_allclose(got, [plain(t) for t in [*TEXTS, ""]], rtol=1e-6)
    many = model.score(pa.array(TEXTS * 3_000))
    np.testing.assert_allclose(many, np.tile(got[:-1], 3_000), rtol=1e-6)


def test_quality_score_equals_a_plain_loop():
    """Figures counted word by word and byte by byte, and the network written out."""
    rng = np.random.default_rng(4)
    width = len(quality.CLASSES) + 9
    model = quality.QualityModel(
        rng.normal(size=width), rng.uniform(0.5, 2, width), rng.normal(size=(width, 3)), rng.normal(size=3), rng.normal(size=3), 0.2
    )

    def plain(text):
        data = text.encode()
        size = max(len(data), 1)
        words_ = [w for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
        n = max(len(words_), 1)
        padded = data + b" "
        lengths = [len(w) for w in words_]
        mean = sum(lengths) / n
        odd_bytes = quality.CLASSES["symbol"] + quality.CLASSES["shout"] + quality.CLASSES["bar"]
        odd = [w[-1] in odd_bytes for w in words_]
        x = [sum(b in members for b in padded) / size for members in quality.CLASSES.values()]
        x += [np.log1p(size), np.log1p(len(words_)), mean, np.sqrt(max(sum(k * k for k in lengths) / n - mean**2, 0))]
        x += [sum(a == b for a, b in zip(words_, words_[1:])) / n, len(set(words_)) / n, sum(65 <= w[0] <= 90 for w in words_) / n]
        x += [sum(odd) / n, sum(o and len(w) == 1 for o, w in zip(odd, words_)) / n]
        z = (np.array(x) - model.centre) / model.scale
        hidden = [np.tanh(sum(z[i] * model.inner[i, j] for i in range(width)) + model.inner_bias[j]) for j in range(3)]
        return 1 / (1 + np.exp(-(sum(h * o for h, o in zip(hidden, model.outer)) + model.outer_bias)))

    np.testing.assert_allclose(model.score(pa.array([*TEXTS, None])), [plain(t) for t in [*TEXTS, ""]], rtol=1e-9)


def library(text):
    found = LIBRARY.encode(text or "", add_special_tokens=False)
    ids = found.ids
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), digest(" ".join(map(str, ids))), digest(LIBRARY.decode(ids, skip_special_tokens=False))


def test_bpe_equals_the_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("doc_id", F.col("doc_id") + 1_000_000)
    rows = docs.unionByName(odd)
    got = sorted(map(tuple, digests(rows.withColumn("ids", F.lit("clash")), VOCABULARY).collect()), key=str)
    assert got == sorted(((r["doc_id"], *library(r["text"])) for r in rows.collect()), key=str)
    assert digests(docs.limit(0), VOCABULARY).count() == 0
    # Decoding by itself, from stored ids.
    ids = bpe.encode(rows, VOCABULARY)
    texts = ids.select("ids", bpe.decode(VOCABULARY, spark)("ids").alias("text")).collect()
    assert all(r["text"] == LIBRARY.decode(r["ids"], skip_special_tokens=False) for r in texts)
    none = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r[0] for r in none.select(bpe.decode(VOCABULARY, spark)("ids")).collect()] == ["", ""]


def test_memory_of_words_does_not_show(monkeypatch):
    texts = [f"hello world {i} thethe {i % 7}" for i in range(300)]
    encoder = bpe.Encoder(VOCABULARY)
    whole, _ = encoder.encode(texts)
    monkeypatch.setattr(bpe, "MAX_WORDS", 5)
    encoder, pieces = bpe.Encoder(VOCABULARY), []
    for start in range(0, 300, 13):
        pieces.append(encoder.encode(texts[start : start + 13])[0])
    assert np.array_equal(whole, np.concatenate(pieces))


ALPHABET = st.sampled_from("aábBcehtTinIN 'sreld1²٣ \t\n.,!#<|>~ßİΣςé´…가日")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), max_size=5))
def test_any_text_equals_the_library(texts):
    ids, ends = bpe.Encoder(VOCABULARY).encode(texts)
    starts = [0, *ends.tolist()]
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
