"""URL filter: path rules first, then gradient-boosted trees on lexical features.

Features are DataFrame expressions over the URL alone: lengths, path depth, digit
ratio, hyphens, character entropy, parameter count, vowel ratio, and how often
labelled URLs with the same suffix (last label of the host; extension of the
path) were bad, counted over all labelled rows. The trees are Spark ML's, fitted on
at most ``max_labelled`` distinct labelled URLs taken in hash order, so the same
table gives the same model.

``decide`` has no Python: the trees travel with the task, their size is bounded by
number and depth, and the suffix rates are joined (broadcast only where Spark's own
size check allows it).

Defined cases: a null URL, or one without ``://``, has an empty host and path and
is judged by the model on those; a rule needs its host or a subdomain of it and a
path that begins with its own; of several the longest wins, then the smaller
text. With no labelled URL, or labels of one kind only, every URL without a rule
gets that kind (allow, where there is no label). Rules are configuration: a list
of up to some hundreds, held in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from lakeferry.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MAX_LABELLED = 20_000

#: Host words that name the usual spam trades.
SPAM_WORDS = (
    "ads", "adult", "bets", "betting", "bonus", "casino", "cheap", "clicks", "farm", "free", "gambling", "loans",
    "lottery", "pills", "poker", "porn", "replica", "spam", "track", "tracker", "viagra", "win", "xxx",
)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def match(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; nulls where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def has_spam_word(host: Column, words: Sequence[str] = SPAM_WORDS) -> Column:
    """Whether a part of the host, between dots and hyphens, is one of ``words``."""
    return F.arrays_overlap(F.split(host, "[.-]"), F.array(*map(F.lit, words)))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.split(text, "")
    return F.aggregate(
        F.transform(
            F.array_distinct(letters),
            lambda c: F.size(F.filter(letters, lambda x: x == c)) / F.size(letters).cast("double"),
        ),
        F.lit(0.0),
        lambda a, share: a - share * F.log2(share),
    )


def _share(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1)).cast("double")


LEXICAL = {
    "url_length": lambda url, host, path: F.length(url),
    "host_length": lambda url, host, path: F.length(host),
    "host_labels": lambda url, host, path: F.size(F.split(host, "[.]")),
    "longest_label": lambda url, host, path: F.array_max(F.transform(F.split(host, "[.]"), F.length)),
    "depth": lambda url, host, path: F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
    "digit_ratio": lambda url, host, path: _share(url, "[^0-9]"),
    "hyphens": lambda url, host, path: F.length(F.regexp_replace(host, "[^-]", "")),
    "vowel_ratio": lambda url, host, path: _share(host, "[^aeiou]"),
    "entropy": lambda url, host, path: _entropy(host),
    "parameters": lambda url, host, path: F.size(
        F.filter(F.split(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "&"), lambda p: p != "")
    ),
}
SUFFIXES = {
    "host_suffix": lambda host, path: F.element_at(F.split(host, "[.]"), -1),
    "path_suffix": lambda host, path: F.regexp_extract(path, r"\.([^./]*)$", 1),
}
FEATURES = [*LEXICAL, *(f"{name}_rate" for name in SUFFIXES)]


def featurise(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """``urls`` with one struct column ``_f``: host, path, features, suffixes."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    parts = urls.withColumn("_f", F.struct(host_of(url).alias("host"), path_of(url).alias("path")))
    host, path = F.col("_f.host"), F.col("_f.path")
    cells = [make(url, host, path).cast("double").alias(name) for name, make in LEXICAL.items()]
    cells += [F.coalesce(make(host, path), F.lit("")).alias(name) for name, make in SUFFIXES.items()]
    return parts.withColumn("_f", F.struct(host.alias("host"), path.alias("path"), *cells))


class UrlModel:
    """Fitted suffix statistics and trees; ``bad`` gives the probability of a bad URL."""

    def __init__(self, constant: float | None, rates: dict[str, DataFrame], prior: float, trees=None):
        self.constant, self.rates, self.prior, self.trees = constant, rates, prior, trees

    def _vector(self, rows: DataFrame) -> DataFrame:
        for name in SUFFIXES:
            known = self.rates[name].select(F.col("suffix").alias(f"_{name}"), F.col("rate").alias(f"_x_{name}_rate"))
            rows = rows.join(known, F.col(f"_f.{name}") == F.col(f"_{name}"), "left").drop(f"_{name}")
        return rows.withColumns(
            {f"_x_{name}": F.col(f"_f.{name}") for name in LEXICAL}
            | {f"_x_{name}_rate": F.coalesce(f"_x_{name}_rate", F.lit(self.prior)) for name in SUFFIXES}
        )

    def bad(self, rows: DataFrame) -> DataFrame:
        """``rows`` of ``featurise`` with a column ``_bad``."""
        if self.constant is not None:
            return rows.withColumn("_bad", F.lit(self.constant))
        assembled = VectorAssembler(
            inputCols=[f"_x_{n}" for n in FEATURES], outputCol="_features", handleInvalid="keep"
        ).transform(self._vector(rows))
        judged = self.trees.transform(assembled)
        return judged.withColumn("_bad", vector_to_array("_probability")[1]).drop(
            "_features", "_probability", "_raw", "_prediction", *[f"_x_{n}" for n in FEATURES]
        )


def _lowest(urls: DataFrame, n: int, seed: int) -> DataFrame:
    return urls.orderBy(F.xxhash64(F.lit(seed), "url"), "url").limit(n)


def fit(
    labelled: DataFrame,
    url_col: str = "url",
    label_col: str = "label",
    max_labelled: int = MAX_LABELLED,
    trees: int = 20,
    depth: int = 4,
    smoothing: float = 20.0,
    seed: int = 7,
) -> UrlModel:
    """Fit on rows of (url, label 1 = bad).

    Suffix rates count all rows and are shrunk towards the overall rate by ``smoothing``
    rows. The trees learn from at most ``max_labelled`` distinct URLs, taken in hash
    order; a URL's label is that of most of its rows. Where all of them are of one kind,
    each kind gives half.
    """
    known = labelled.where(F.col(label_col).isNotNull()).select(
        F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("_label")
    )
    counts = {
        name: stored(
            featurise(known).groupBy(F.col(f"_f.{name}").alias("suffix")).agg(
                F.count("*").alias("n"), F.sum("_label").alias("bad")
            ),
            "suffixes",
        )
        for name in SUFFIXES
    }
    whole = counts["host_suffix"].agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    prior = whole["bad"] / whole["n"] if whole["n"] else 0.0
    if prior in (0.0, 1.0):
        return UrlModel(prior, {}, 0.0)
    rates = {
        name: stored(
            rows.select("suffix", ((F.col("bad") + prior * smoothing) / (F.col("n") + smoothing)).alias("rate")),
            "rates",
        )
        for name, rows in counts.items()
    }
    urls = stored(
        known.groupBy("url").agg((F.avg("_label") >= 0.5).cast("double").alias("_label")), "urls"
    )
    chosen = stored(_lowest(urls, max_labelled, seed), "sample")
    if chosen.agg(F.countDistinct("_label")).first()[0] < 2:
        half = max_labelled // 2
        chosen = stored(
            _lowest(urls.where("_label = 1"), half, seed).union(_lowest(urls.where("_label = 0"), max_labelled - half, seed)),
            "sample",
        )
    sample = featurise(chosen).persist()
    try:
        model = UrlModel(None, rates, prior)
        assembled = VectorAssembler(inputCols=[f"_x_{n}" for n in FEATURES], outputCol="_features").transform(
            model._vector(sample)
        )
        model.trees = GBTClassifier(
            featuresCol="_features", labelCol="_label", maxIter=trees, maxDepth=depth, seed=seed,
            predictionCol="_prediction",
        ).fit(assembled).setProbabilityCol("_probability").setRawPredictionCol("_raw")
        return model
    finally:
        sample.unpersist()


def decide(
    pages: DataFrame,
    model: UrlModel,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, bad (the model's probability)."""
    rows = featurise(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
    text, verdict = match(rules, F.col("_f.host"), F.col("_f.path"))
    judged = model.bad(rows)
    return judged.select(
        "page_id",
        F.col("_f.host").alias("host"),
        F.col("_f.path").alias("path"),
        text.alias("rule"),
        F.coalesce(verdict, F.when(F.col("_bad") >= threshold, "block").otherwise("allow")).alias("verdict"),
        F.col("_bad").alias("bad"),
    )
