"""Mixing against DuckDB and plain Python, URL rules against plain Python."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from check import compare, connect
from pyspark.sql import functions as F

from lakeferry.llm import url_filter
from lakeferry.llm.mixing import budgets, mix, mixed_rows, word_count
from lakeferry.llm.queries import ORACLES, QUERIES, RULES


@pytest.fixture
def tree(spark):
    levels = {"domain": F.col("d"), "lang": F.col("l"), "source": F.col("s")}
    return levels, {"domain": F.lit(1), "lang": F.lit(1), "source": F.expr("if(source = 'none', 0, 1)")}



@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, d string, l string, s string, text string")


def test_shortage_goes_to_siblings_first(spark, tree):
    supply = [("a", "en", "1", 10), ("a", "en", "2", 1_000), ("a", "de", "3", 1_000), ("b", "en", "4", 1_000)]
    leaves = spark.createDataFrame(supply, "domain string, lang string, source string, supply long").withColumn("n", F.lit(1))
    got = {r["source"]: r["budget"] for r in budgets(leaves, list(tree[0]), tree[1], 800, 1).collect()}
    # a and b 400 each; en and de 200 each; source 1 has only 10, its sibling 2 takes the 90 it cannot use.
    assert got == {"1": 10, "2": 190, "3": 200, "4": 400}
    supply[1] = ("a", "en", "2", 20)
    leaves = spark.createDataFrame(supply, leaves.schema.names[:4]).withColumn("n", F.lit(1))
    got = {r["source"]: r["budget"] for r in budgets(leaves, list(tree[0]), tree[1], 800, 1).collect()}
    # All of a/en is short: a/de takes the rest of domain a, b keeps its share.
    assert got == {"1": 10, "2": 20, "3": 370, "4": 400}


def test_odd_rows(spark, tree):
    rows = [
        (1, "a", "en", "1", "one two three"), (2, "a", "en", None, None), (3, None, None, None, "  lead and trail  "),
        (None, "a", "en", "1", "no id"), (5, "a", "en", "none", "weightless source"), (6, "a", "en", "1", ""),
        (7, "a", "en", "1", "twice"), (7, "a", "en", "1", "twice"), (8, "a", "en", "1", "w " * 30_000),
    ]
    docs = docs_of(spark, rows).withColumns({"whole": F.lit("x"), "last": F.lit("y"), "_id": F.lit("z"), "row": F.lit(1)})
    taken = mix(docs, *tree, max_epochs=2).collect()
    assert all(r["tokens"] == len((dict((a, e) for a, _, _, _, e in rows)[r["doc_id"]] or "").split()) for r in taken if r["doc_id"] != 7)
    assert not any(r["source"] == "none" for r in taken)
    back = mixed_rows(docs, *tree, max_epochs=2)
    assert back.columns == docs.columns
    assert Counter(r["doc_id"] for r in back.collect()) == Counter(r["doc_id"] for r in taken)
    assert mix(docs.limit(0), *tree).count() == mixed_rows(docs.limit(0), *tree).count() == 0


def test_one_leaf_holds_most_rows_and_ranges_are_cut(spark, tree):
    docs = spark.range(4_000).select(
        F.col("id").alias("doc_id"), F.lit("a").alias("d"), F.lit("en").alias("l"),
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("s"), F.lit("five words in each text").alias("text"),
    )
    few = mix(docs, *tree, target=4_000, max_epochs=3, range_rows=50)
    got = Counter((r["source"], r["epoch"]) for r in few.collect())
    assert got == {("hot", 0): 400, ("cold", 0): 400}
    ids = {range_rows: Counter((r["doc_id"], r["epoch"]) for r in mix(docs, *tree, target=11_000, max_epochs=3, range_rows=range_rows).collect()) for range_rows in (10, 10_000)}
    assert ids[10] == ids[10_000]  # how ranges are cut does not show
    assert Counter(e for _, e in ids[10].elements()) == {0: 1_500, 1: 400, 2: 300}


def test_words_are_counted_between_white_space(spark):
    texts = ["", None, " ", "a", " a", "a ", " a  b\t\nc ", "\x0b\x0cx\x0d"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in rows.select(word_count(F.col("text"))).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


URLS = [
    "http://a.example.net/en/1", "https://EXAMPLE.net/de/2?x=/en/", "http://x.example.com/de/", "http://x.org/fr/#a", "ftp://net",
    "http://net/", "http://annet/", "no scheme", None, "", "http://example.com?de/", "http://a.com//de/", "x://org/fr", "://org/fr/",
    "http://notexample.com/de/1", "http://a.b.example.com/de/1?y", "http://casino-win.org/x", "http://ÄÖ.Net/", "http://h/" + "p" * 9_000,
]


def judged(url):
    url = url or ""
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url)
    host, path = (found.group(1), found.group(2)) if found else ("", "")
    host = host.translate({ord(c): c.lower() for c in url_filter.UPPER})
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(r.text), r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else None


def test_rules_against_plain_python(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame(list(enumerate(URLS, start=10_000)), "page_id long, url string")
    pages = pages.unionByName(odd).withColumn("host", F.lit("clash"))
    labelled = pages.select("url", url_filter.has_spam_word(url_filter.host_of(F.col("url"))).cast("int").alias("label"))
    rows = {r["page_id"]: r for r in url_filter.decide(pages, url_filter.fit(labelled), RULES).collect()}
    for page in pages.collect():
        host, path, rule, verdict = judged(page["url"])
        got = rows[page["page_id"]]
        assert (got["host"], got["path"], got["rule"]) == (host, path, rule)
        assert got["verdict"] == (verdict or got["verdict"]) and got["verdict"] in ("allow", "block")


def test_trees_learn_the_labels(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    bad = url_filter.has_spam_word(url_filter.host_of(F.col("url"))).cast("int")
    learn = F.crc32(F.col("page_id").cast("string")) % 3 != 0
    model = url_filter.fit(pages.where(learn).select("url", bad.alias("label")))
    truth = pages.where(~learn).select("page_id", bad.alias("label"))
    right = url_filter.decide(pages.where(~learn), model, ()).join(truth, "page_id")
    share = right.select(F.avg(((F.col("verdict") == "block") == (F.col("label") == 1)).cast("double"))).first()[0]
    assert share > 0.95


def test_without_labels_everything_is_allowed(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (2, None)], "page_id long, url string")
    none = pages.select("url", F.lit(None).cast("int").alias("label"))
    assert {r["verdict"] for r in url_filter.decide(pages, url_filter.fit(none), ()).collect()} == {"allow"}
    only_bad = pages.select("url", F.lit(1).alias("label"))
    assert {r["verdict"] for r in url_filter.decide(pages, url_filter.fit(only_bad), ()).collect()} == {"block"}
    assert url_filter.decide(pages.limit(0), url_filter.fit(only_bad), RULES).count() == 0


def labelled_pages(spark, n, suffixes, suffix_bad):
    """Hosts alike in form; only the suffix tells the label."""
    number = F.format_string("%06d", (F.col("id") * 7919) % 1_000_000)
    suffix = F.concat(F.lit("s"), F.format_string("%03d", F.col("id") % suffixes))
    return spark.range(n).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://site"), number, F.lit("."), suffix, F.lit("/x")).alias("url"),
        suffix_bad(F.col("id") % suffixes).cast("int").alias("label"),
    )


def test_rare_suffixes_have_their_own_rate(spark):
    pages = labelled_pages(spark, 8_000, 400, lambda s: F.crc32(s.cast("string")) % 2 == 0)
    model = url_filter.fit(pages.select("url", "label"), max_labelled=1_000)
    right = url_filter.decide(pages, model, ()).join(pages.select("page_id", "label"), "page_id")
    assert right.where((F.col("verdict") == "block") == (F.col("label") == 1)).count() >= 0.95 * 8_000


def test_one_url_on_a_third_of_the_rows(spark):
    pages = labelled_pages(spark, 2_000, 10, lambda s: s % 2 == 0)
    hot = pages.orderBy(F.xxhash64(F.lit(7), "url")).limit(1).select("url", "label").first()
    known = pages.select("url", "label").union(spark.range(1_000).select(F.lit(hot["url"]), F.lit(hot["label"])))
    model = url_filter.fit(known, max_labelled=500)
    right = url_filter.decide(pages, model, ()).join(pages.select("page_id", "label"), "page_id")
    assert right.where((F.col("verdict") == "block") == (F.col("label") == 1)).count() >= 0.95 * 2_000
