"""Blocks of whole-number vectors, as the passes over all vectors read them.

A vector becomes whole numbers, floor(scale * x) + offset. It is usable if it is not
null and all its components are numbers of at most 52 bits when scaled, so that a
double holds them exactly; a component beyond that counts like a non-finite one.
Usable vectors of one dimension stand in blocks of some ``BLOCK_BYTES``, one row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from lakeferry.llm.common import ship, stored

BLOCK_BYTES = 2_000_000
LARGEST = 2.0**52


def whole_numbers(vector: Column, scale: int, offset: int = 0) -> tuple[Column, Column]:
    """(whether the vector is usable, its whole numbers)."""
    vector = vector.cast("array<double>")
    scaled = lambda x: F.floor(x * F.lit(float(scale)))
    fits = lambda x: x.isNotNull() & (F.abs(x * F.lit(float(scale))) < F.lit(LARGEST))
    usable = vector.isNotNull() & F.coalesce(F.forall(vector, fits), F.lit(False))
    return usable, F.transform(vector, lambda x: scaled(x).cast("long") + F.lit(offset).cast("long"))


def usable_rows(vectors: DataFrame, scale: int, offset: int, id_col: str, vector_col: str, mark_col: str | None = None) -> DataFrame:
    """id, mark, v (whole numbers) of every usable vector."""
    usable, numbers = whole_numbers(F.col(vector_col), scale, offset)
    mark = F.col(mark_col) if mark_col else F.lit(None).cast("int")
    return vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), mark.alias("mark"), numbers.alias("v"))


def blocked(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` in stored blocks: dim, ids, marks and the matrix (64-bit numbers, row by row)."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}

        def flush(dim: int) -> pa.RecordBatch:
            ids, marks, parts = zip(*waiting.pop(dim))
            ids, marks = pa.concat_arrays(ids), pa.concat_arrays(marks)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in (ids, marks)]
            matrix = pa.array([np.concatenate(parts).tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *lists, matrix], names=["dim", "ids", "marks", "matrix"])

        for batch in batches:
            lists = batch.column(2)
            length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(length)
            for dim in np.unique(length):
                at = np.flatnonzero(length == dim)
                cells = (ends[at] - dim)[:, None] + np.arange(dim)
                step = max(1, BLOCK_BYTES // max(8 * int(dim), 8))
                for a in range(0, len(at), step):
                    chosen = pa.array(at[a : a + step], pa.int64())
                    held = waiting.setdefault(int(dim), [])
                    held.append((batch.column(0).take(chosen), batch.column(1).take(chosen), flat[cells[a : a + step]]))
                    if sum(len(h[0]) for h in held) >= step:
                        yield flush(int(dim))
        for dim in list(waiting):
            yield flush(dim)

    schema = StructType(
        [
            StructField("dim", IntegerType()),
            StructField("ids", ArrayType(LongType())),
            StructField("marks", ArrayType(rows.schema["mark"].dataType)),
            StructField("matrix", BinaryType()),
        ]
    )
    return stored(rows.mapInArrow(run, schema), name)


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, pa.Array, np.ndarray]]:
    """(row of the batch, ids, marks, whole numbers) of every block."""
    dims, ids, marks, matrix = (batch.column(i) for i in range(4))
    for i in range(len(batch)):
        dim, values = dims[i].as_py(), ids[i].values
        numbers = np.frombuffer(matrix[i].as_buffer(), np.int64).reshape(len(values), dim)
        yield i, values, marks[i].values, numbers


def decimals(numbers) -> pa.Array:
    """Whole numbers of any size as text; Spark sums them as decimals."""
    return pa.array([str(int(x)) for x in numbers], pa.string())


def exact_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,0)"))


def as_long(number: Column) -> Column:
    """A decimal as a long, held at its ends."""
    low, high = (F.lit(x).cast("decimal(38,0)") for x in (str(-(2**63)), str(2**63 - 1)))
    return F.least(F.greatest(number, low), high).cast("long")
