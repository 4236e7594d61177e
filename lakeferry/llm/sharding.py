"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows go from each input partition to each shard is drawn first, exactly
as a uniform permutation of all rows would have it: a multivariate
hypergeometric matrix with the partition sizes as row sums and the shard sizes as
column sums. It is drawn by halving: the partitions are split into two halves,
each shard's share of the left half is hypergeometric, and both halves go on
independently, so the matrix takes log2(partitions) steps of one small DataFrame
each. Rows are then permuted within their partition, dealt out by the matrix, and
permuted again within their shard; the second permutation runs in slices of the
shard's hash order, so that no shard has to fit in one task.

Only DataFrame functions are used. The narrow table (id, size, checksum, input
partition) is stored before anything is drawn; the counts and the rows therefore
always agree, also after a lost executor. Shard sizes differ by at most one.

Defined cases: a null text has size 0 (plus ``overhead``) and checksum 0; null or
repeated ids are rows like any other; with fewer rows than shards some shards are
empty; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lakeferry.llm.common import ceil_div, stored, uniform

#: Rows of one slice of a shard in the second permutation; bounds a task's window.
SLICE_ROWS = 100_000
#: Half-width of a draw's window in standard deviations; the mass beyond is under 1e-30.
WIDTH = 12.0


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """Quantile ``u`` of the number of marked balls among ``drawn`` of ``total``.

    Weights relative to the mode follow from the ratio of neighbours; they are
    summed from the mode upwards, then downwards, and the first value at which the
    sum passes ``u`` times the whole is taken.
    """
    low = F.greatest(F.lit(0).cast("long"), drawn - (total - marked))
    high = F.least(marked, drawn)
    share = drawn.cast("double") / F.greatest(total, F.lit(1))
    spread = (F.sqrt(marked * share * (1 - share)) * WIDTH + 30).cast("long")
    centre = F.floor((drawn + 1.0) * (marked + 1.0) / (total + 2.0))
    bounds = F.struct(low.alias("low"), high.alias("high"), centre.alias("mode"), spread.alias("spread"))

    def rise(k: Column) -> Column:
        return (marked - k) * (drawn - k) / ((k + 1.0) * (total - marked - drawn + k + 1.0))

    def up(x: Column) -> Column:
        return rise(x - 1.0)

    def down(x: Column) -> Column:
        return 1.0 / rise(x.cast("double"))

    def whole(steps: Column, ratio) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("weight"))
        return F.aggregate(
            steps,
            start,
            lambda acc, x: let(
                acc["weight"] * ratio(x),
                lambda w: F.struct((acc["sum"] + w).alias("sum"), w.alias("weight")),
            ),
        )["sum"]

    def search(steps: Column, start: Column, goal: Column, ratio) -> Column:
        begin = F.struct(start["sum"].alias("sum"), F.lit(1.0).alias("weight"), start["found"].alias("found"))
        return F.aggregate(
            steps,
            begin,
            lambda acc, x: let(
                acc["weight"] * ratio(x),
                lambda w: F.struct(
                    (acc["sum"] + w).alias("sum"),
                    w.alias("weight"),
                    F.when(acc["found"].isNull() & (acc["sum"] + w > goal), x).otherwise(acc["found"]).alias("found"),
                ),
            ),
        )

    def draw(at: Column) -> Column:
        mode = F.least(at["high"], F.greatest(at["low"], at["mode"]))
        first, last = F.greatest(at["low"], mode - at["spread"]), F.least(at["high"], mode + at["spread"])
        empty = F.array().cast("array<bigint>")
        above = F.when(mode < last, F.sequence(F.least(mode + 1, last), last)).otherwise(empty)
        below = F.when(mode > first, F.sequence(F.greatest(mode - 1, first), first, F.lit(-1).cast("long"))).otherwise(empty)
        steps = F.struct(mode.alias("mode"), above.alias("above"), below.alias("below"))
        return let(steps, lambda s: let(
            u * (whole(s["above"], up) + whole(s["below"], down) + 1.0),
            lambda goal: let(
                search(
                    s["above"],
                    F.struct(F.lit(1.0).alias("sum"), F.when(goal < 1.0, s["mode"]).alias("found")),
                    goal, up,
                ),
                lambda rising: F.coalesce(search(s["below"], rising, goal, down)["found"], s["mode"]),
            ),
        ))

    return let(bounds, draw)


def _left_counts(caps: Column, left: Column, node: Column, level: int, seed: int) -> Column:
    """How many rows of each shard fall into the left half of a node."""
    cells = F.transform(
        caps, lambda cap, j: F.struct(cap.alias("cap"), uniform(seed, level, node, j).alias("u"))
    )
    begin = F.struct(
        left.cast("long").alias("drawn"),
        F.aggregate(caps, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
        F.array().cast("array<bigint>").alias("counts"),
    )

    def one(acc: Column, cell: Column) -> Column:
        return let(
            hypergeometric(cell["u"], acc["total"], cell["cap"], acc["drawn"]),
            lambda x: F.struct(
                (acc["drawn"] - x).alias("drawn"),
                (acc["total"] - cell["cap"]).alias("total"),
                F.concat(acc["counts"], F.array(x)).alias("counts"),
            ),
        )

    return F.aggregate(cells, begin, one)["counts"]


def communication_matrix(sizes: DataFrame, parts: int, shard_sizes: list[int], seed: int) -> DataFrame:
    """(part, counts): rows from each partition to each shard. ``sizes``: (part, n)."""
    spark = sizes.sparkSession
    levels = max(parts - 1, 0).bit_length()
    nodes = spark.range(1).select(
        F.col("id").alias("node"), F.array(*[F.lit(s).cast("long") for s in shard_sizes]).alias("caps")
    )
    for level in range(levels):
        below = levels - level - 1  # bits of a partition's number under the children's
        halves = sizes.groupBy(F.shiftright("part", below + 1).alias("node")).agg(
            F.sum(F.when(F.shiftright("part", below) % 2 == 0, F.col("n")).otherwise(0)).alias("left")
        )
        drawn = nodes.join(halves, "node").select(
            "node", "caps", _left_counts(F.col("caps"), F.col("left"), F.col("node"), level, seed).alias("counts")
        )
        nodes = drawn.select(
            F.explode(
                F.array(
                    F.struct((F.col("node") * 2).alias("node"), F.col("counts").alias("caps")),
                    F.struct(
                        (F.col("node") * 2 + 1).alias("node"),
                        F.zip_with("caps", "counts", lambda a, b: a - b).alias("caps"),
                    ),
                )
            ).alias("child")
        ).select("child.*")
    return nodes.select(F.col("node").alias("part"), F.col("caps").alias("counts"))


def shard(
    docs: DataFrame,
    shards: int = 40,
    seed: int = 20_241,
    overhead: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    ).withColumn("part", F.shiftright("row", 33))
    # Stored: every level of the matrix reads it.
    sizes = stored(rows.groupBy("part").agg(F.count("*").alias("n")), "shard-sizes")
    whole = sizes.agg(F.sum("n").alias("n"), F.max("part").alias("last")).first()
    total, parts = whole["n"] or 0, (whole["last"] or 0) + 1
    shard_sizes = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix(sizes, parts, shard_sizes, seed).select(
        "part",
        # Ends of the shards' stretches in the partition's own order.
        F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda k: F.aggregate(
            F.slice("counts", F.lit(1), k), F.lit(0).cast("long"), lambda a, x: a + x)).alias("ends"),
    )
    local = W.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("local"), F.col("row")), "row")
    dealt = (
        rows.withColumn("rank", F.row_number().over(local) - 1)
        .join(matrix, "part")
        .withColumn("shard", F.size(F.filter("ends", lambda end: end <= F.col("rank"))))
    )
    slices = max(1, ceil_div(total, shards * slice_rows))
    order = F.xxhash64(F.lit(seed), F.lit("shard"), F.col("row"))
    dealt = dealt.select(
        "doc_id", "size", "text_crc32", "row", "shard", order.alias("order"),
        F.floor(uniform(seed, F.lit("slice"), F.col("row")) * slices).alias("slice"),
    )
    starts = dealt.groupBy("shard", "slice").agg(F.count("*").alias("n")).select(
        "shard", "slice",
        (F.sum("n").over(W.partitionBy("shard").orderBy("slice")) - F.col("n")).alias("start"),
    )
    again = W.partitionBy("shard", "slice").orderBy("order", "row")
    return (
        dealt.withColumn("place", F.row_number().over(again) - 1)
        .join(starts, ["shard", "slice"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
            (F.col("start") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
