"""Vector code compression: a codebook for every part of a vector, fitted with metric trees.

A vector of whole numbers is cut into ``parts`` consecutive parts of equal length (of
lengths that differ by one at most, if the dimension is no multiple). Each part has a
codebook; a vector's code is the number of the nearest entry of every part.

Blocks of vectors get one metric tree per part (``metric_trees``), built once and
stored. A round passes the codebooks down all trees, adds cached sums and counts of
owned balls and sends one partial sum per entry and task; Spark adds these up. The
driver holds codebooks only, entries x dimension numbers.

Defined cases: vectors that are null, or hold a null, a non-finite number or one of
more than 52 bits when scaled, take no part (``vectors``); an empty vector has empty
parts, entry 0 and error 0; vectors of different dimension have codebooks of their
own; codebooks start with the smallest ids, null ids last, equal ids by vector, and
are shorter where there are fewer vectors; repeated rows count each; entries that
nothing is nearest to stay; ties go to the lower entry; distances beyond 64 bits are
held at a long's end; rows with a null label are one label; extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from lakeferry.llm.common import stored
from lakeferry.llm.metric_trees import Tree, exact_squares, grow, nearest, totals
from lakeferry.llm.vectors import as_long, blocked, decimals, exact_sum, matrices, usable_rows
from lakeferry.operators.joins import join_lookup

#: For every dimension, one array of entries (rows) per part.
Codebooks = dict[int, list[np.ndarray]]


def cuts(dim: int, parts: int) -> list[tuple[int, int]]:
    return [(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]


def _whole(numbers: list[list[int]], width: int) -> np.ndarray:
    """Entries as an array; 52 bits at most, as they are means of such numbers."""
    return np.array(numbers, dtype=np.int64).reshape(len(numbers), width)


def _written(trees: list[Tree]) -> bytes:
    out = io.BytesIO()
    for tree in trees:
        for cell in tree:
            if cell.dtype == object:  # sums beyond 64 bits, as text
                cell = cell.astype("U40")
            np.save(out, cell, allow_pickle=False)
    return out.getvalue()


def _read(data: bytes, parts: int) -> list[Tree]:
    source, trees = io.BytesIO(data), []
    for _ in range(parts):
        cells = [np.load(source, allow_pickle=False) for _ in Tree._fields]
        if cells[-1].dtype.kind == "U":
            cells[-1] = np.array([[int(x) for x in row] for row in cells[-1].tolist()], dtype=object).reshape(cells[-1].shape)
        trees.append(Tree(*cells))
    return trees


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """The same numbers in the shortest type that holds them."""
    return numbers.astype(np.result_type(np.min_scalar_type(numbers.min(initial=0)), np.min_scalar_type(numbers.max(initial=0)), np.int8))


def plant(blocks: DataFrame, parts: int) -> DataFrame:
    """Blocks with the trees of their parts in place of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, _, numbers in matrices(batch):
                trees = [grow(numbers[:, a:b]) for a, b in cuts(numbers.shape[1], parts)]
                trees = [t._replace(points=_narrow(t.points)) for t in trees]
                kept = [batch.column(c).slice(i, 1) for c in range(3)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([_written(trees)], pa.binary())], names=["dim", "ids", "marks", "trees"])

    schema = StructType([*blocks.schema.fields[:3], StructField("trees", BinaryType())])
    return stored(blocks.mapInArrow(run, schema), "trees")


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """Parts of the vectors with the smallest ids; equal ids by vector."""
    out: Codebooks = {}
    for dim in sorted(r[0] for r in rows.select(F.size("v")).distinct().collect()):
        first = rows.where(F.size("v") == dim).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries)
        vectors = _whole([r["v"] for r in first.select("v").collect()], dim)
        out[dim] = [vectors[:, a:b] for a, b in cuts(dim, parts)]
    return out


def next_codebooks(planted: DataFrame, codebooks: Codebooks) -> Codebooks:
    """One round: every entry becomes the floor of the mean of what is nearest to it."""
    shared = planted.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            for dim, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                books = shared.value[dim]
                for part, tree in enumerate(_read(data.as_buffer(), len(books))):
                    sums, counts = totals(tree, books[part])
                    held = found.setdefault((dim, part), [np.zeros(sums.shape, dtype=object), np.zeros(len(sums), dtype=np.int64)])
                    held[0], held[1] = held[0] + sums.astype(object), held[1] + counts
        for (dim, part), (sums, counts) in found.items():
            entry, place = (x.ravel() for x in np.indices(sums.shape))
            used = counts[entry] > 0
            entry, place = entry[used], place[used]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(entry), dim), pa.int32()), pa.array(np.full(len(entry), part), pa.int32()),
                    pa.array(entry, pa.int32()), pa.array(place, pa.int32()),
                    decimals(sums[entry, place]), pa.array(counts[entry], pa.int64()),
                ],
                names=["dim", "part", "entry", "place", "total", "n"],
            )

    partial = planted.select("dim", "trees").mapInArrow(run, "dim int, part int, entry int, place int, total string, n long")
    summed = partial.groupBy("dim", "part", "entry", "place").agg(exact_sum("total").alias("total"), F.sum("n").alias("n"))
    out = {dim: [book.copy() for book in books] for dim, books in codebooks.items()}
    for r in summed.collect():
        out[r["dim"]][r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    shared.unpersist()
    return out


def encode(planted: DataFrame, codebooks: Codebooks) -> DataFrame:
    """id, mark, code (two hex digits a part), error of every vector, and the digest of its codebooks."""
    digests = {dim: codebooks_sha256(books) for dim, books in codebooks.items()}
    shared = planted.sparkSession.sparkContext.broadcast((codebooks, digests))
    largest = 2**63 - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books_of, digest_of = shared.value
        for batch in batches:
            for dim, ids, marks, data in zip(batch.column(0).to_pylist(), *(batch.column(c) for c in (1, 2, 3))):
                books, n = books_of[dim], len(ids.values)
                code, error = np.zeros((n, len(books)), dtype=np.int64), np.zeros(n, dtype=object)
                for part, tree in enumerate(_read(data.as_buffer(), len(books))):
                    code[:, part] = nearest(tree, books[part])
                    chosen = code[tree.order, part]
                    for entry in np.unique(chosen):
                        at = np.flatnonzero(chosen == entry)
                        squares = exact_squares(tree.points[at].astype(np.int64), books[part][entry : entry + 1])[:, 0]
                        error[tree.order[at]] += squares.astype(object)
                digits = max(2, (int(code.max(initial=0)).bit_length() + 3) // 4)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values, marks.values,
                        pa.array(["".join(f"{c:0{digits}x}" for c in row) for row in code.tolist()], pa.string()),
                        pa.array([min(int(e), largest) for e in error], pa.int64()),
                        pa.array([digest_of[dim]] * n, pa.string()),
                    ],
                    names=["id", "mark", "code", "error", "codebooks_sha256"],
                )

    fields = planted.schema["ids"].dataType.elementType, planted.schema["marks"].dataType.elementType
    schema = StructType(
        [StructField("id", fields[0]), StructField("mark", fields[1])]
    ).add("code", "string").add("error", "long").add("codebooks_sha256", "string")
    return planted.mapInArrow(run, schema)


def codebooks_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in books for entry in book for x in entry).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, code, error, label_error and codebooks_sha256 of every usable vector; the codebooks)."""
    rows = usable_rows(vectors, scale, 0, id_col, vector_col, label_col)
    planted = plant(blocked(rows, "vectors"), parts)
    codebooks = first_codebooks(rows, parts, entries)
    for _ in range(rounds):
        codebooks = next_codebooks(planted, codebooks)
    codes = stored(encode(planted, codebooks), "codes")
    by_mark = codes.groupBy("mark").agg(as_long(exact_sum("error")).alias("label_error"))
    joined = join_lookup(codes, by_mark, {"mark": "mark"}, ["id", "code"], null_safe=True)
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256"), codebooks
