"""Which documents share a hashed token with another one, without gathering any token's documents.

Tokens are dealt out by hash into groups of bounded expected size. A map task first
settles what it can by itself: a token that several of its documents have is counted
for them there, and goes on as a single entry without an owner, so that the others
learn of it. A token held by a third of all documents is therefore one entry per
task, and no group grows with it.

Inside a group only 32 bits of a token are kept; the few chance meetings make the
result a slight superset, which is what a filter may be.

``met`` tells how many shared tokens each document has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeferry.llm import words
from lakeferry.llm.common import ceil_div

#: Entries of one group as expected, and the least number of groups.
GROUP_ENTRIES, MIN_GROUPS = 1_000_000, 64
#: Stands for the owner of a token whose owners have been counted already.
NOBODY = np.iinfo(np.int64).min

Entries = Callable[[pa.Array], Iterator[tuple[np.ndarray, np.ndarray]]]


def deal(texts: DataFrame, entries: Entries, expected: int) -> DataFrame:
    """Entries of (doc_id, text) rows in groups.

    ``entries`` yields (tokens, numbers of their texts), no pair twice unless one text
    is to make a token shared by itself.
    """
    groups = max(MIN_GROUPS, ceil_div(expected, GROUP_ENTRIES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = [(t, ids[of].astype(np.int64)) for t, of in entries(batch.column(1)) if len(t)]
            if not found:
                continue
            token, owner = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            times = np.diff(np.append(first, len(token)))
            own, count = np.unique(owner[np.repeat(times > 1, times)], return_counts=True)
            yield _rows([-1 - int(token[0] % np.uint64(groups))], [own], [count])
            token, owner = token[first], np.where(times > 1, NOBODY, owner[first])
            group = (words.mixed(token) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            token, owner, group = token[order].astype(np.uint32), owner[order], group[order]
            cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            yield _rows(group[cuts].tolist(), np.split(token, cuts[1:]), np.split(owner, cuts[1:]))

    return texts.mapInArrow(run, "part int, tokens binary, owners binary")


def _rows(parts: list[int], tokens: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(parts, pa.int32()),
            pa.array([t.tobytes() for t in tokens], pa.binary()),
            pa.array([o.astype(np.int64).tobytes() for o in owners], pa.binary()),
        ],
        names=["part", "tokens", "owners"],
    )


def _meet(table: pa.Table) -> pa.Table:
    counted = table.column("part")[0].as_py() < 0

    def joined(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(x.as_buffer(), dtype=kind) for x in table.column(name)])

    owner = joined("owners", np.int64)
    if counted:  # settled by a map task: ids and their counts
        ids, counts = joined("tokens", np.int64), owner
    else:
        token = joined("tokens", np.uint32)
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        times = np.diff(np.append(first, len(token)))
        ids, counts = np.unique(owner[np.repeat(times > 1, times) & (owner != NOBODY)], return_counts=True)
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "shared": pa.array(counts, pa.int64())})


def met(dealt: DataFrame) -> DataFrame:
    """(doc_id, shared): how many of a document's tokens another document has."""
    found = dealt.groupBy("part").applyInArrow(_meet, "doc_id long, shared long")
    return found.groupBy("doc_id").agg(F.sum("shared").alias("shared"))
