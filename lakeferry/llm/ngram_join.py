"""Self-join of documents on the Jaccard similarity of their word n-grams.

Exact: every pair of similarity t or more is connected in the result. The filters
all rest on prefixes. Put a document's n shingles in any order that is the same
for all documents; two documents that are similar enough then share a shingle
among the first n - ceil(t n) + 1 of each, and k of them among the first
n - ceil(t n) + k.

1. One order by hash finds the documents that can have a partner at all. A quarter
   of each document's shingles is dealt out by hash; a document stays only if
   enough of its own are met elsewhere. Map tasks combine repeated shingles first,
   so that a shingle in a third of all documents is one entry per task.
2. Among these, equal sets are one node. Shingles are counted, and several orders
   put rarer shingles first (by the logarithm of the count) and differ among equally
   rare ones. A candidate pair must share a prefix shingle under each order.
3. Pairs are not spelled out inside a group of copies. Each shingle first links its
   documents to one of them only, these links are verified, and so are links between
   documents that fail it in the same way; what they connect
   becomes one component. Then only pairs across components are candidates, and of
   them only those with an end outside the shingle's largest component are met.
   Pairs inside a component need no verdict: they are connected already. The documents
   of a shingle that very many have are met by classes first (size, place of the shingle),
   and pairs are spelled out only of classes that can match.

Shingles are compared by 64-bit hash (see ``words``), sets by 128 bits.

Defined cases: null and empty texts, and texts without words, have no shingles and
are linked with nothing; a text with fewer words than a shingle is one shingle;
rows that share an id keep their own counts and sets; rows without an id get counts
but take no part in links, their component is null unless copies give one; extra
columns are not read; an empty table gives an empty result. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lakeferry.llm import words
from lakeferry.llm.common import ship, stored
from lakeferry.llm.components import components
from lakeferry.llm.meeting import deal, met
from lakeferry.llm.subwords import sliced

CHUNK_BYTES = 500_000
#: Orders that a candidate pair must pass.
ORDERS = 3
#: Documents of a shingle up to which they are met one by one.
FEW = 64
#: Documents whose ids and set marks, some 50 bytes each, may be sent to every task.
LISTED_NODES = 200_000
#: Hashes under which nodes that lack the same of a third one are brought together.
MINIMA = 8


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, distinct shingles in ascending order, bounds) for pieces of the texts."""
    space, edge = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    start = 0
    for piece in sliced(texts, CHUNK_BYTES):
        lowered = pc.ascii_lower(pc.fill_null(piece.cast(pa.large_string()), edge))
        padded = pc.binary_join_element_wise(lowered, edge, space)
        _, offsets, raw = padded.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[padded.offset : padded.offset + len(padded) + 1]
        data, bounds = np.frombuffer(raw, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]
        stop = start + len(piece)
        begins, finishes, of = words.spans(data, bounds)
        code, of = words.shingles(words.hashes(data, begins, finishes), of, size)
        order = np.lexsort((code, of))
        code, of = code[order], of[order]
        fresh = np.ones(len(code), dtype=bool)
        fresh[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
        code, of = code[fresh], of[fresh]
        yield start, code, np.searchsorted(of, np.arange(stop - start + 1))
        start = stop


def text_sha(text: Column) -> Column:
    """What tells the texts of rows with the same id apart."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def _described(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, sha (of the text), n (distinct shingles), mark (128 bits of the set; null without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, marks = [], []
            for _, code, bounds in shingle_sets(batch.column(1), size):
                counts.append(np.diff(bounds))
                marks += [
                    hashlib.md5(code[a:b].tobytes()).digest() if b > a else None
                    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
                ]
            n = np.concatenate(counts) if counts else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n), pa.array(marks, pa.binary())],
                names=["doc_id", "sha", "n", "mark"],
            )
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text", text_sha(F.col("text")).alias("sha")).mapInArrow(
        run, "doc_id long, sha string, n long, mark binary"
    )


def _least_overlap(n, percent: int):
    """ceil(percent / 100 * n) in whole numbers."""
    return -(-n * percent // 100)


def _prefixes(size: int, percent: int):
    """(shingle, text number) of the hash-order prefixes, for ``meeting.deal``."""

    def entries(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        seen = set()
        for first, code, bounds in shingle_sets(texts, size):
            found = []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                whole = hashlib.md5(code[a:b].tobytes()).digest()
                if b > a and whole not in seen:  # equal sets met in this task speak with one voice
                    seen.add(whole)
                    found.append((first + i, code[a : b - _least_overlap(b - a, percent) - (a - b) // 20]))
            if found:
                yield (
                    np.concatenate([p for _, p in found]),
                    np.repeat(np.array([i for i, _ in found]), [len(p) for _, p in found]),
                )

    return entries


def _tokens(docs: DataFrame, size: int) -> DataFrame:
    """(node, n, tokens) of documents whose set is the one their node stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(2).to_pylist()
            for first, code, bounds in shingle_sets(batch.column(1), size):
                keep = [
                    i
                    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                    if b > a and hashlib.md5(code[a:b].tobytes()).digest() == marks[first + i]
                ]
                lists = [code[bounds[i] : bounds[i + 1]].view(np.int64) for i in keep]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                flat = np.concatenate(lists) if lists else np.empty(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([first + i for i in keep], pa.int64())),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ],
                    names=["node", "n", "tokens"],
                )
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "node long, n long, tokens array<long>")


def prefix_sets(tokens: DataFrame, percent: int) -> DataFrame:
    """(node, n, weight, shared, pre0, pre1, ...) of nodes that can have a partner.

    ``weight`` is the mean logarithm of its shingles' counts;
    ``shared`` are the shingles that at least two nodes have; ``pre`` are the
    prefixes under the orders, without the shingles that only this node has, which
    come first in every order.
    """
    one = tokens.select("node", "n", F.explode("tokens").alias("token"))
    count = one.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    rarity = F.floor(F.log2("df")).cast("int")
    met = one.join(count, "token").groupBy("node", "n").agg(
        F.collect_list(F.struct(rarity.alias("rarity"), "token")).alias("met")
    )
    least = F.ceil(F.col("n") * percent / F.lit(100.0))
    first = (F.size("met") - least + 1).cast("int")

    def prefix(k: int) -> Column:
        ordered = F.array_sort(
            F.transform("met", lambda m: F.struct(m["rarity"], F.xxhash64(F.lit(k), m["token"]), m["token"].alias("token")))
        )
        return F.slice(F.transform(ordered, lambda m: m["token"]), F.lit(1), first)

    return met.where(F.size("met") >= least).select(
        "node", "n",
        (F.aggregate("met", F.lit(0), lambda a, m: a + m["rarity"]) / F.col("n")).alias("weight"),
        F.array_sort(F.transform("met", lambda m: m["token"])).alias("shared"),
        *[prefix(k).alias(f"pre{k}") for k in range(ORDERS)],
    )


def _joined(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.select(*[F.col(c).alias(f"a_{c}") for c in sets.columns])
    two = sets.select(*[F.col(c).alias(f"b_{c}") for c in sets.columns])
    return pairs.join(one, pairs["a"] == one["a_node"]).join(two, F.col("b") == two["b_node"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass all orders and are similar enough."""
    joined = _joined(pairs, sets)
    for k in range(ORDERS):
        joined = joined.where(F.arrays_overlap(f"a_pre{k}", f"b_pre{k}"))
    both = F.size(F.array_intersect("a_shared", "b_shared"))
    return joined.where(both * 100 >= (F.col("a_n") + F.col("b_n") - both) * percent).select("a", "b")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, place of a's shingle) with ``both``, ``similar`` and ``lacks``.

    ``lacks`` are minima, under ``MINIMA`` hashes, of a's shingles that b has not. Those
    that come before the shingle that brought them together are left out: being rarer,
    they are a's own.
    """
    both = F.size(F.array_intersect("a_shared", "b_shared"))
    passes = F.lit(True)
    for k in range(ORDERS):
        passes = passes & F.arrays_overlap(f"a_pre{k}", f"b_pre{k}")
    own = F.slice("a_pre0", F.lit(1), (F.col("place") - F.col("a_n") + F.size("a_shared")).cast("int"))
    lacking = F.array_except(F.array_except("a_shared", "b_shared"), own)
    minima = F.array(*[F.array_min(F.transform(lacking, lambda t, i=i: F.xxhash64(F.lit(i), t))) for i in range(MINIMA)])
    return _joined(pairs, sets).select(
        "a", "b", both.alias("both"),
        (passes & (both * 100 >= (F.col("a_n") + F.col("b_n") - both) * percent)).alias("similar"), minima.alias("lacks"),
    )


def _alike(compared: DataFrame) -> DataFrame:
    """Pairs of nodes that lack the same of the node they were compared with.

    Copies of one text that were each edited once differ from any of them in two places,
    which may be too much; those edited in the same place are similar. A node goes by the
    one it has most in common with, and meets the first of those with the same minimum.
    """
    nearest = compared.groupBy("b").agg(F.max(F.struct("both", "a", "lacks")).alias("m"))
    lacks = nearest.select("b", "m.a", F.posexplode("m.lacks").alias("i", "least")).where("least is not null")
    first = lacks.groupBy("a", "i", "least").agg(F.min("b").alias("c"), F.count("*").alias("n")).where("n > 1")
    return lacks.join(first, ["a", "i", "least"]).where("b <> c").select(F.col("c").alias("a"), "b").distinct()


def _postings(sets: DataFrame) -> DataFrame:
    """(token, node, n, place, weight): prefix shingles of the first order, placed in the whole set's order."""
    return sets.select("node", "n", "weight", F.size("shared").alias("met"), F.posexplode("pre0").alias("i", "token")).select(
        "token", "node", "n", (F.col("n") - F.col("met") + F.col("i")).alias("place"), "weight"
    )


def _may_match(percent: int) -> Column:
    """Whether a and b can be similar if this shingle is the first that they share.

    Shingles before it are not shared, so the overlap is at most what follows on
    either side; it must reach t / (1 + t) of both sizes together. That holds for the
    smaller set as a whole too.
    """
    least = (F.col("a_n") + F.col("b_n")) * percent
    return ((F.col("a_n") - F.col("a_place")) * (100 + percent) >= least) & (
        (F.col("b_n") - F.col("b_place")) * (100 + percent) >= least
    )


def _side(postings: DataFrame, name: str, *more: str) -> DataFrame:
    return postings.select("token", *more, *[F.col(c).alias(f"{name}_{c}") for c in ("node", "n", "place", "label")])


def _across(postings: DataFrame, one: DataFrame, percent: int) -> DataFrame:
    """Pairs of a shingle's nodes with different labels that may match.

    ``one`` are the nodes outside the largest label, or these with ``b_n`` and
    ``b_place``, the classes of nodes they may match.
    """
    classes = [c for c in ("b_n", "b_place") if c in one.columns]
    two = _side(postings, "b").join(postings.select("token", "main").distinct(), "token")
    left = one.select("token", *[F.col(c).alias(f"a_{c}") for c in ("node", "n", "place", "label")], *classes)
    return left.join(two, ["token", *classes]).where(
        "a_label <> b_label and (b_label = main or a_node < b_node)"
    ).where(_may_match(percent))


def _matching_classes(postings: DataFrame, percent: int) -> DataFrame:
    """Nodes outside their shingle's largest label, once for every class that may match.

    A class is all nodes of a shingle that agree in size and in the shingle's place, which
    is all that ``_may_match`` looks at. Classes are far fewer than nodes: where a million
    documents from one template share a shingle, their pairs are never spelled out unless
    their classes match.
    """
    kinds = postings.groupBy("token", "n", "place").agg(F.max(F.expr("label <> main")).alias("outside"))
    one = kinds.where("outside").select("token", F.col("n").alias("a_n"), F.col("place").alias("a_place"))
    two = kinds.select("token", F.col("n").alias("b_n"), F.col("place").alias("b_place"))
    met = one.join(two, "token").where(_may_match(percent))
    met = met.withColumnsRenamed({"a_n": "n", "a_place": "place"})
    return postings.where("label <> main").join(met, ["token", "n", "place"])


def _star(postings: DataFrame, percent: int) -> DataFrame:
    """(a, b, place): the nodes of a shingle and kind with the heaviest of them, where they may match.

    The heaviest node, the one most of whose shingles are widely met, is the likeliest
    original of the others.
    """
    heaviest = postings.groupBy("token", "kind").agg(
        F.max(F.struct("weight", "node", "n", "place")).alias("m"), F.count("*").alias("nodes")
    ).where("nodes > 1")
    leaders = heaviest.select("token", "kind", "m.node", "m.n", "m.place").toDF("token", "kind", "a_node", "a_n", "a_place")
    return (
        _side(postings, "b", "kind")
        .join(leaders, ["token", "kind"])
        .where((F.col("a_node") != F.col("b_node")) & _may_match(percent))
        .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), F.col("a_place").alias("place"))
    )


def _sized(postings: DataFrame) -> DataFrame:
    """Postings of the shingles that many nodes have, by two kinds each: sizes within a quarter, and within a quarter of a shifted scale.

    Where a large document holds the text of many small ones it is the heaviest, but too
    large for them.
    """
    hot = postings.groupBy("token").agg(F.count("*").alias("nodes")).where(F.col("nodes") > FEW).select("token")
    scale = F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))
    kinds = F.array(F.floor(scale) * 2 + 1, F.floor(scale + 0.5) * 2 + 2)
    return postings.join(hot, "token").withColumn("kind", F.explode(kinds.cast("array<int>")))


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Verified pairs (a, b) that connect all nodes that similar pairs connect."""
    postings = stored(_postings(sets).withColumn("label", F.col("node")), "postings")
    star = (
        _star(postings.withColumn("kind", F.lit(0)), percent)
        .union(_star(_sized(postings), percent))
        .groupBy("a", "b").agg(F.min("place").alias("place"))
    )
    compared = stored(_compared(star, sets, percent), "compared")
    first = stored(
        compared.where("similar").select("a", "b").union(_verified(_alike(compared), sets, percent)), "links"
    )
    named = stored(
        postings.drop("label").join(components(first), "node", "left").withColumn(
            "label", F.coalesce("label", "node")
        ),
        "postings",
    )
    spread = named.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    sizes = named.join(spread.select("token"), "token").groupBy("token", "label").agg(F.count("*").alias("size"))
    largest = stored(
        sizes.groupBy("token").agg(
            F.max(F.struct("size", "label")).alias("most"), F.sum("size").alias("nodes")
        ).select("token", F.col("most.label").alias("main"), "nodes"),
        "largest",
    )
    few, many = (named.join(largest.where(c), "token").drop("nodes") for c in (f"nodes <= {FEW}", f"nodes > {FEW}"))
    across = (
        _across(few, few.where("label <> main"), percent)
        .union(_across(many, _matching_classes(many, percent), percent))
        .select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))
        .distinct()
    )
    return first.union(stored(_verified(across, sets, percent), "links"))


def similar_documents(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id that links reach)."""
    return linked_rows(docs, size, percent, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def linked_rows(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``similar_documents`` with sha (see ``text_sha``) and component, which differs between
    components that share their smallest id; null without a partner."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    described = stored(_described(texts, size), "sets")
    total, rows, ids = described.agg(
        F.sum("n"), F.count("doc_id"), F.countDistinct("doc_id")
    ).first()
    known = texts.where("doc_id is not null")
    # A quarter of the shingles goes through step 1.
    shared = met(deal(known, _prefixes(size, percent), (total or 0) // 4))
    alive = described.join(shared, "doc_id").where(
        F.col("shared") >= F.greatest(F.lit(1), F.ceil(F.col("n") * percent / F.lit(2000.0)))
    )
    nodes = stored(
        alive.groupBy("mark").agg(F.min("doc_id").alias("doc_id")).select(
            F.monotonically_increasing_id().alias("node"), "doc_id", "mark"
        ),
        "nodes",
    )
    # Texts stay where they are as long as the chosen ids are few enough to be sent to every task.
    listed = F.broadcast(nodes) if nodes.count() <= LISTED_NODES else nodes
    chosen = known.join(listed, "doc_id").select("node", "text", "mark")
    tokens = _tokens(chosen, size)
    if rows != ids:  # repeated ids may bring a node's set more than once
        tokens = tokens.dropDuplicates(["node"])
    sets = stored(prefix_sets(stored(tokens, "tokens"), percent), "shared")
    labels = components(links(sets, percent))
    marks = described.where("mark is not null").groupBy("mark").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies")
    )
    of_mark = marks.join(nodes.join(labels, "node").select("mark", "label"), "mark", "left").where(
        "copies > 1 or label is not null"
    )
    smallest = of_mark.where("label is not null").groupBy("label").agg(F.min("first").alias("least"))
    of_mark = stored(
        of_mark.join(smallest, "label", "left").select(
            "mark", F.coalesce("least", "first").alias("least"),
            F.coalesce(F.concat(F.lit("n"), F.col("label").cast("string")), F.hex("mark")).alias("component"),
        ),
        "components",
    )
    return described.join(of_mark, "mark", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), "sha", "component"
    )
