"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lakeferry.llm import bpe, quality, toxicity, url_filter
from lakeferry.llm.common import table
from lakeferry.llm.exact_dedup import exact_groups
from lakeferry.llm.fingerprints import fingerprint_documents
from lakeferry.llm.mixing import mix
from lakeferry.llm.ngram_join import similar_documents
from lakeferry.llm.sharding import shard
from lakeferry.llm.substring_dedup import repeats
from lakeferry.llm.topk import top_k
from lakeferry.llm.vector_codes import compress
from lakeferry.llm.whitening import whiten

TOKENIZER = "word_bpe_49k.json"


def op1_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def _scored(spark, sf_dir, module, parts, part, threshold):
    docs = table(spark, sf_dir, "documents")
    model = module.fit(docs, table(spark, sf_dir, "labels"), learn=~toxicity.held_out("doc_id", parts, part))
    return docs.select(
        "doc_id", toxicity.held_out("doc_id", parts, part).alias("held_out"),
        module.scorer(docs, model)("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_toxicity(spark, sf_dir):
    return _scored(spark, sf_dir, toxicity, 4, 2, toxicity.TOXIC_FROM)


def op3_quality(spark, sf_dir):
    return _scored(spark, sf_dir, quality, 3, 1, 0.5)


def mix_tree():
    """Levels and weights of op4 and of the pipeline: two domains by a digit of the source's hash."""
    levels = {
        "domain": F.expr("if(substring(md5(coalesce(source, '')), 1, 1) < '8', 'web', 'curated')"),
        "lang": F.col("lang"),
        "source": F.col("source"),
    }
    weights = {
        "domain": F.expr("if(domain = 'web', 3, 2)"),
        "lang": F.expr("case lang when 'en' then 5 when 'de' then 2 when 'fr' then 2 else 1 end"),
        "source": F.lit(1),
    }
    return levels, weights


MIX_EPOCHS = 3


def op4_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mix(docs, *mix_tree(), max_epochs=MIX_EPOCHS, seed=11)


def digests(docs, vocabulary):
    """Encode, decode what was encoded, and reduce both to digests."""
    return bpe.encode(docs, vocabulary, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op5_bpe(spark, sf_dir):
    vocabulary = bpe.load_vocabulary(public_tokenizers.path(TOKENIZER))
    return digests(table(spark, sf_dir, "documents"), vocabulary)


def op6_substring_dedup(spark, sf_dir):
    return repeats(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark, sf_dir):
    return similar_documents(table(spark, sf_dir, "documents"), size=5, percent=80)


def op8_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)


def op9_url_filter(spark, sf_dir):
    """Labels are weak: a URL is bad if its host has one of the listed spam words."""
    pages = table(spark, sf_dir, "pages")
    labelled = pages.select(
        "url", url_filter.has_spam_word(url_filter.host_of(F.col("url"))).cast("int").alias("label")
    )
    return url_filter.decide(pages, url_filter.fit(labelled), RULES)


def op10_sharding(spark, sf_dir):
    return shard(table(spark, sf_dir, "documents"), shards=40)


def op11_vector_codes(spark, sf_dir):
    return compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)[0]


def op12_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"), components=8, scale=1024, offset=100_000)[0]


def op13_fingerprints(spark, sf_dir):
    return fingerprint_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_bpe": op5_bpe,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_ngram_join": op7_ngram_join,
    "op8_top_k": op8_top_k,
    "op9_url_filter": op9_url_filter,
    "op10_sharding": op10_sharding,
    "op11_vector_codes": op11_vector_codes,
    "op12_whitening": op12_whitening,
    "op13_fingerprints": op13_fingerprints,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op1_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
        FROM n""",
}

#: A level's share of its parents' budgets; the children that are full take what they have.
_LEVEL = """
    {name}_n AS (SELECT {path}, sum(capacity)::HUGEINT AS capacity, any_value({weight})::HUGEINT AS weight
        FROM leaves GROUP BY {path}),
    {name}_b AS (SELECT {nodes}, n.capacity, n.weight, p.budget,
            coalesce(sum(n.capacity) OVER w, 0)::HUGEINT AS before_c, coalesce(sum(n.weight) OVER w, 0)::HUGEINT AS before_w,
            (sum(n.weight) OVER (PARTITION BY {parent}))::HUGEINT AS all_w
        FROM {name}_n n JOIN {above} p ON {on}
        WINDOW w AS (PARTITION BY {parent} ORDER BY n.capacity::DOUBLE / n.weight::DOUBLE, n.{level}
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    {name}_f AS (SELECT *, capacity * (all_w - before_w) <= (budget - before_c) * weight AS filled FROM {name}_b),
    {name} AS (SELECT {path}, CASE WHEN filled THEN capacity ELSE
            ((budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER f)::HUGEINT * weight)
            // (sum(CASE WHEN filled THEN 0 ELSE weight END) OVER f)::HUGEINT END AS budget
        FROM {name}_f WINDOW f AS (PARTITION BY {own}))"""

ORACLES["op4_mixing"] = f"""
    WITH docs AS (SELECT doc_id, CASE WHEN substr(md5(coalesce(source, '')), 1, 1) < '8' THEN 'web' ELSE 'curated' END AS domain,
            coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(doc_id::VARCHAR, '') AS id,
            md5(coalesce(text, '')) AS digest,
            len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
        FROM documents),
    leaves AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS supply, {MIX_EPOCHS} * sum(tokens)::HUGEINT AS capacity
        FROM docs GROUP BY ALL),
    root AS (SELECT 0 AS z, sum(supply)::HUGEINT AS budget FROM leaves),
    {_LEVEL.format(name="d", path="domain", nodes="n.domain", own="1", parent="p.z", level="domain", above="root", on="true",
                   weight="CASE WHEN domain = 'web' THEN 3 ELSE 2 END")},
    {_LEVEL.format(name="l", path="domain, lang", nodes="n.domain, n.lang", own="domain", parent="n.domain", level="lang",
                   above="d", on="n.domain = p.domain", weight="CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END")},
    {_LEVEL.format(name="s", path="domain, lang, source", nodes="n.domain, n.lang, n.source", own="domain, lang",
                   parent="n.domain, n.lang", level="source", above="l", on="n.domain = p.domain AND n.lang = p.lang", weight="1")},
    gives AS (SELECT domain, lang, source, (budget // supply)::BIGINT AS whole, (budget % supply)::BIGINT AS rest
        FROM s JOIN leaves USING (domain, lang, source) WHERE supply > 0),
    placed AS (SELECT d.*, whole, rest, sum(tokens) OVER (PARTITION BY domain, lang, source
            ORDER BY md5('11:' || whole || ':' || id || ':' || digest)) AS upto
        FROM docs d JOIN gives g USING (domain, lang, source)),
    epochs AS (SELECT doc_id, domain, lang, source, tokens,
            unnest(range(whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS epoch FROM placed)
    SELECT doc_id, domain, lang, source, tokens, epoch::INTEGER AS epoch FROM epochs"""

ORACLES["op8_top_k"] = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM s QUALIFY rank <= 10"""

#: One part's nearest entry: squared distances to all entries, ties to the lower one.
_NEAREST = """
    {to} AS MATERIALIZED (SELECT vec_id, part, arg_min(entry, d * 64 + entry) AS entry, min(d) AS d
        FROM (SELECT p.vec_id, p.part, b.entry,
                list_sum(list_transform(list_zip(p.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d
            FROM parts p JOIN {books} b USING (part)) GROUP BY ALL)"""
#: The floor of the mean of what is nearest to an entry; unused entries stay.
_MEANS = """
    {to} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM {books} b LEFT JOIN (
        SELECT part, entry, list(floor_mean ORDER BY k) AS v
        FROM (SELECT part, entry, k, (sum(x)::HUGEINT - ((sum(x)::HUGEINT % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
            FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS k FROM {near} JOIN parts USING (vec_id, part))
            GROUP BY part, entry, k) GROUP BY part, entry) m USING (part, entry))"""

ORACLES["op11_vector_codes"] = f"""
    WITH whole AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS v
        FROM whole, (SELECT unnest(range(16)) AS part)),
    c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM parts
        QUALIFY entry < 64),
    {_NEAREST.format(to="n0", books="c0")}, {_MEANS.format(to="c1", books="c0", near="n0")},
    {_NEAREST.format(to="n1", books="c1")}, {_MEANS.format(to="c2", books="c1", near="n1")},
    {_NEAREST.format(to="n2", books="c2")},
    coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
        FROM n2 GROUP BY vec_id),
    digest AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, k)) AS codebooks_sha256
        FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS k FROM c2))
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM coded JOIN whole USING (vec_id), digest"""

#: Links by counting the shingles that two documents share; components by following links.
ORACLES["op7_ngram_join"] = f"""
    WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    shingles AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 4], ' ')) AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * c >= 80 * (x.n + y.n - c)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (SELECT doc_id AS node, doc_id AS label FROM documents
        UNION SELECT edges.b, reached.label FROM reached JOIN edges ON reached.node = edges.a)
    SELECT d.doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(label) AS component_id
    FROM documents d JOIN reached ON node = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id GROUP BY d.doc_id"""
