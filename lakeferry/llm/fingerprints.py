"""Document fingerprints from prefix polynomial hashes.

A fingerprint is what a text's prefix array (``prefix_hashes``) says about

- the whole text: its length and 62-bit hash, so that equal texts have equal
  fingerprints and others different ones;
- its beginnings and endings of the lengths in ``steps`` (four per doubling): an array
  of prefixes short enough to be kept, in which the common beginning and ending of two
  texts are found by binary search;
- its spans of ``SPAN`` code points: the ``MARKS`` least of their hashes, which every
  place of the text has the same chance to be among.

The likeness of two fingerprints is 1 for equal texts. Else it is the greater of two
shares: that of the longer text which the common beginning and ending cover, and that
of common spans, 2 J / (1 + J) for a Jaccard similarity J, estimated from the least
hashes of both. It is 0 if one text is empty and the other is not.

``with_next`` pairs each document with the next one. Whole rows are shuffled once, by
ranges of the order whose bounds are known ids; the first row of each range is sent to
the range before as well, so that a task finds every neighbour among its own sorted
rows and holds no more than a few hundred thousand code points, or one text, at a time.

Defined cases: a null text counts as empty; the order is by falling id, null ids last,
equal ids by a hash of the text and by the text; the next of the last row is the
first, in a table of one row the row itself; repeated rows count each; extra columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeferry.llm.common import ship
from lakeferry.llm.prefix_hashes import PrefixHashes, common_start, short

SPAN, MARKS = 12, 64
#: Code points worked on at once, unless one text has more.
PIECE = 250_000


@lru_cache(maxsize=1)
def steps(bits: int = 40) -> tuple[int, ...]:
    """1, 2, 3, 4, 5, 6, 8, 9, 11, 13, 16, ...: whole parts of 2**(k/4)."""
    return tuple(sorted({int(2 ** (k / 4)) for k in range(4 * bits)}))


class Fingerprint(NamedTuple):
    length: int
    whole: int
    starts: list[int]
    ends: list[int]
    marks: list[int]

    def __str__(self) -> str:
        lists = (np.array(x, dtype=">u4").tobytes().hex() for x in (self.starts, self.ends, self.marks))
        return "-".join([f"{self.length:x}", f"{self.whole:016x}", *lists])


def parsed(text: str) -> Fingerprint:
    length, whole, *lists = text.split("-")
    return Fingerprint(int(length, 16), int(whole, 16), *(np.frombuffer(bytes.fromhex(x), ">u4").tolist() for x in lists))


def _least(hashes: np.ndarray) -> list[int]:
    """The ``MARKS`` least distinct hashes."""
    if len(hashes) > 8 * MARKS:
        few = np.unique(np.partition(hashes, 4 * MARKS)[: 4 * MARKS])
        if len(few) > MARKS:  # the greatest of them may be cut off among equals, no lesser one is
            return few[:MARKS].tolist()
    return np.unique(hashes)[:MARKS].tolist()


def fingerprints(hashes: PrefixHashes) -> list[Fingerprint]:
    grid = np.array(steps(), dtype=np.int64)
    number = np.searchsorted(grid, hashes.lengths, side="right")
    text = np.repeat(np.arange(len(number)), number)
    cut = np.cumsum(number)
    size = grid[np.arange(len(text)) - np.repeat(cut - number, number)]
    starts = short(hashes.spans(hashes.first[text], hashes.first[text] + size)).tolist()
    ends = short(hashes.spans(hashes.last[text] - size, hashes.last[text])).tolist()
    whole = hashes.spans(hashes.first, hashes.last).tolist()
    runs = short(hashes.runs(SPAN))
    out = []
    for i, (n, first, last) in enumerate(zip(hashes.lengths.tolist(), hashes.first.tolist(), hashes.last.tolist())):
        a, b = int(cut[i] - number[i]), int(cut[i])
        out.append(Fingerprint(n, whole[i], starts[a:b], ends[a:b], _least(runs[first : max(last - SPAN + 1, first)])))
    return out


def _covered(a: list[int], b: list[int]) -> int:
    """The longest kept length at which both agree: equal up to there, so found by binary search."""
    found = bisect_right(range(min(len(a), len(b))), False, key=lambda k: a[k] != b[k])
    return steps()[found - 1] if found else 0


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    if (a.length, a.whole) == (b.length, b.whole):
        return 1.0
    shorter, longer = sorted((a.length, b.length))
    if not shorter:
        return 0.0
    covered = min(_covered(a.starts, b.starts) + _covered(a.ends, b.ends), shorter) / longer
    mine, other = set(a.marks), set(b.marks)
    least = sorted(mine | other)[:MARKS]
    both = sum(x in mine and x in other for x in least)
    return max(covered, 2 * both / (len(least) + both) if least else 0.0)


def edited(text: str, following: str) -> str:
    """``text`` with its last half, rounded down, replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, beyond, id, text), sorted in every task: after each row that is not ``beyond`` comes its next one."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)] or [F.lit(0.5)])
    found = rows.agg(F.percentile_approx("id", shares, F.lit(max(10_000, 20 * parts))).alias("cuts"), F.max("id").alias("top")).first()
    cuts = sorted({c for c in found["cuts"] or [] if c != found["top"]})
    shared = spark.sparkContext.broadcast(np.array(cuts, dtype=np.int64))

    @F.arrow_udf("int")
    def placed(ids: pa.Array) -> pa.Array:
        """Twice the number of the range in the order, plus 1 for the id that begins it."""
        bounds, ids = shared.value, ids.fill_null(-(2**63)).to_numpy(zero_copy_only=False)
        above = np.searchsorted(bounds, ids, side="left")
        begins = above < len(bounds)
        begins[begins] = bounds[above[begins]] == ids[begins]
        return pa.array(2 * (len(bounds) - above) + begins, pa.int32())

    here = F.expr("struct(place div 2 as part, false as beyond)")
    before = F.expr("struct(place div 2 - 1 as part, true as beyond)")
    end = F.struct(F.lit(len(cuts)).cast("bigint").alias("part"), F.lit(True).alias("beyond"))
    copies = F.concat(
        F.array(here),
        F.when(F.expr("place % 2 = 1"), F.array(before)).otherwise(F.array()),
        F.when(F.col("id").eqNullSafe(F.lit(found["top"])), F.array(end)).otherwise(F.array()),
    )
    dealt = rows.withColumn("place", placed("id")).select("id", "text", F.explode(copies).alias("at"))
    ordered = [F.col("part"), F.col("beyond"), F.col("id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    return dealt.select("at.*", "id", "text").repartition("part").sortWithinPartitions(*ordered)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness to it and to the next document.

    ``common_edited`` and ``common_next`` are the numbers of code points that the text
    has in common, from its beginning on, with its edited text and the next document.
    """

    def judged(rows: list[tuple]) -> pa.RecordBatch:
        """For every row but the last, the results it gives with the row after it."""
        texts = [r[3] for r in rows]
        hashes = PrefixHashes(texts)
        prints = fingerprints(hashes)
        at = [i for i in range(len(rows) - 1) if not rows[i][1]]
        changed = [edited(texts[i], texts[i + 1]) for i in at]
        other = PrefixHashes(changed)
        others = fingerprints(other)
        here, after = np.array(at, dtype=np.int64), np.array(at, dtype=np.int64) + 1
        n = hashes.lengths[here]
        to_edited = common_start(hashes, hashes.first[here], other, other.first, np.minimum(n, other.lengths))
        to_next = common_start(hashes, hashes.first[here], hashes, hashes.first[after], np.minimum(n, hashes.lengths[after]))
        columns = [
            pa.array([rows[i][2] for i in at], pa.int64()),
            pa.array(n, pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([str(prints[i]) for i in at], pa.string()),
            pa.array([str(o) for o in others], pa.string()),
            pa.array([likeness(prints[i], o) for i, o in zip(at, others)], pa.float64()),
            pa.array([likeness(prints[i], prints[i + 1]) for i in at], pa.float64()),
            pa.array(to_edited, pa.int64()),
            pa.array(to_next, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(4))):
                rows.append(tuple(x.as_py() for x in row))
                size += len(rows[-1][3])
                if size >= PIECE and len(rows) > 1:
                    yield judged(rows)
                    rows = rows[-1:]
                    size = len(rows[0][3])
        if len(rows) > 1:
            yield judged(rows)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, common_edited long, common_next long"
    )
    names = [field.split()[0] for field in schema.split(", ")]
    return with_next(docs, id_col, text_col).mapInArrow(run, schema)
