"""Mix sources to target weights by budgets that flow down a tree.

The tree's levels are expressions (say domain, language, source); each level has a
weight expression. A budget of tokens enters at the root and is shared among the
children of each node by weight. A child that cannot use its share, because its
subtree holds fewer than that many tokens even when read ``max_epochs`` times,
takes all it has, and its siblings share the rest; only when the whole family is
short does the shortage reach the parent's siblings, which is what sharing top
down with the subtree's capacity as limit does.

A leaf with budget b and s tokens is read b div s times whole; of the next epoch
it gives the longest prefix, in that epoch's seeded order, that fits into the
rest. The order is by MD5 of seed, epoch, id and text, so any SQL engine can
repeat it. The prefix is found without sorting a leaf: hash ranges are summed, and
only the one range per leaf in which the budget ends is ordered.

Only DataFrame functions are used. Texts are read once for their token counts and
kept as a narrow stored table. A leaf may hold any share of the rows.

Defined cases: tokens are the words between white space; a null text has none;
null path values count as empty text; a weight that is null or not above 0 gives
no budget; rows that agree in leaf, id and text stand or fall together; a leaf
without tokens gives nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lakeferry.llm.common import SPACES, stored

#: Aimed rows of the one hash range per leaf that is ordered row by row.
RANGE_ROWS = 1_000
_BIG = "decimal(38,0)"


def word_count(text: Column) -> Column:
    words = F.split(F.coalesce(text, F.lit("")), SPACES)
    ends = (F.element_at(words, 1) == "").cast("long") + (
        (F.size(words) > 1) & (F.element_at(words, -1) == "")
    ).cast("long")
    return F.size(words) - ends


def _path(levels: Mapping[str, Column]) -> list[Column]:
    return [F.coalesce(value.cast("string"), F.lit("")).alias(name) for name, value in levels.items()]


def _order(seed: int, epoch: Column, id_: str = "_id", text_md5: str = "_text_md5") -> Column:
    """Place in an epoch's order; 32 hex digits that sort as text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col(id_), F.col(text_md5)))


def budgets(
    leaves: DataFrame,
    levels: list[str],
    weights: Mapping[str, Column],
    target: int | None,
    max_epochs: int,
    percent: int = 100,
) -> DataFrame:
    """``leaves`` (path, supply) with a column ``budget``.

    ``target`` tokens enter at the root; null means ``percent`` of those there are.
    """
    root = "_root"
    tree = leaves.withColumns({"capacity": F.col("supply").cast(_BIG) * max_epochs, root: F.lit(0) * F.col("supply")})
    wanted = F.lit(target).cast(_BIG) if target is not None else F.expr(
        f"cast(cast(sum(supply) as {_BIG}) * {int(percent)} div 100 as {_BIG})"
    )
    budget = tree.groupBy(root).agg(
        F.least(wanted, F.coalesce(F.sum("capacity"), F.lit(0)).cast(_BIG)).cast(_BIG).alias("budget")
    )
    parent = [root]
    for level in levels:
        path = [*parent, level]
        nodes = tree.groupBy(*path).agg(F.sum("capacity").cast(_BIG).alias("capacity"))
        weight = F.greatest(F.coalesce(weights[level].cast("long"), F.lit(0)), F.lit(0))
        nodes = nodes.withColumn("weight", weight.cast(_BIG)).filter("weight > 0")
        nodes = nodes.join(budget, parent)
        family = W.partitionBy(*parent)
        before = family.orderBy(F.col("capacity").cast("double") / F.col("weight").cast("double"), level).rowsBetween(
            W.unboundedPreceding, -1
        )
        nodes = nodes.withColumns(
            {
                "left": F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast(_BIG),
                "open": (F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast(_BIG),
            }
        ).withColumn("full", F.expr("capacity * open <= left * weight"))
        nodes = nodes.withColumns(
            {
                "rest": F.col("budget") - F.sum(F.expr("if(full, capacity, 0)")).over(family).cast(_BIG),
                "sharing": F.sum(F.expr("if(full, 0, weight)")).over(family).cast(_BIG),
            }
        )
        budget = nodes.select(
            *path,
            F.expr(f"cast(if(full, capacity, (cast(rest as {_BIG}) * weight) div sharing) as {_BIG})").alias("budget"),
        )
        parent = path
    return leaves.join(budget, levels).withColumn("budget", F.col("budget").cast("long"))


def plan(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Column],
    target: int | None = None,
    max_epochs: int = 4,
    percent: int = 100,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
    range_rows: int = RANGE_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(rows, leaves): the narrow stored table, and per leaf what it gives.

    rows: path, doc_id, _id, _text_md5, tokens. leaves: path, supply, budget,
    whole (epochs read entirely), rest (tokens wanted of the next), last (greatest
    place in that epoch's order that still fits; null where none does).
    """
    names = list(levels)
    rows = stored(
        docs.select(
            *_path(levels),
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
            F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("_text_md5"),
            word_count(F.col(text_col)).cast("long").alias("tokens"),
        ),
        "mix-rows",
    )
    supply = rows.groupBy(*names).agg(F.sum("tokens").alias("supply"), F.count("*").alias("n"))
    leaves = stored(budgets(supply, names, weights, target, max_epochs, percent), "mix-budgets")
    leaves = leaves.filter("supply > 0").withColumns(
        {"whole": F.expr("budget div supply"), "rest": F.expr("budget % supply")}
    )
    biggest = leaves.agg(F.max("n").alias("n")).first()["n"] or 0
    digits = 0  # hash ranges are told apart by so many leading hex digits
    while digits < 8 and biggest > range_rows * 16**digits:
        digits += 1
    placed = rows.join(leaves.filter("rest > 0").select(*names, "whole", "rest"), names).select(
        *names, "rest", "tokens", _order(seed, F.col("whole")).alias("place")
    )
    # Rows that agree in leaf, id and text share a place: one row from here on.
    placed = placed.groupBy(*names, "rest", "place").agg(F.sum("tokens").alias("tokens"))
    placed = placed.withColumn("range", F.substring("place", 1, digits) if digits else F.lit(""))
    ranges = placed.groupBy(*names, "rest", "range").agg(F.sum("tokens").alias("tokens"))
    upto = W.partitionBy(*names).orderBy("range")
    ranges = ranges.withColumn("start", F.sum("tokens").over(upto) - F.col("tokens")).filter("start <= rest")
    # Of the ranges that begin within the budget, the last one is cut.
    cut = ranges.groupBy(*names).agg(
        F.max("range").alias("range"), F.max("start").alias("start")
    )
    inside = placed.join(cut, [*names, "range"]).withColumn(
        "end", F.col("start") + F.sum("tokens").over(W.partitionBy(*names, "range").orderBy("place"))
    )
    last = inside.groupBy(*names).agg(F.max(F.expr("if(end <= rest, place, null)")).alias("last"), F.max("range").alias("range"))
    # Where the cut range gives nothing, all that precedes it still does.
    last = last.select(*names, F.coalesce("last", "range").alias("last"))
    # Stored, so that its small size is known where rows are joined to it.
    return rows, stored(leaves.join(last, names, "left"), "mix-leaves")


def _copies(seed: int, whole: str, last: str, id_: str, text_md5: str) -> Column:
    """Epochs in which a row is taken, as an array."""
    partial = F.col(last).isNotNull() & (_order(seed, F.col(whole), id_, text_md5) <= F.col(last))
    epochs = F.when(F.col(whole) > 0, F.sequence(F.lit(0).cast("long"), F.col(whole) - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.when(partial, F.concat(epochs, F.array(whole))).otherwise(epochs)


def mix(
    docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Column], seed: int = 11, **options
) -> DataFrame:
    """One row per document and epoch it is taken in: doc_id, path, tokens, epoch."""
    rows, leaves = plan(docs, levels, weights, seed=seed, **options)
    names = list(levels)
    taken = rows.join(leaves.select(*names, "whole", "last"), names)
    copies = _copies(seed, "whole", "last", "_id", "_text_md5")
    copies = F.transform(copies, lambda epoch: epoch.cast("int"))
    return taken.select("doc_id", *names, "tokens", F.explode(copies).alias("epoch"))


def mixed_rows(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Column],
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """The documents themselves, with all their columns, once for each epoch they are taken in."""
    _, leaves = plan(docs, levels, weights, seed=seed, id_col=id_col, text_col=text_col, **options)
    gives = leaves.select(F.struct(*levels).alias("leaf"), F.struct("whole", "last").alias("gives"))
    marked = docs.select(
        F.struct("*").alias("row"),
        F.struct(*_path(levels)).alias("leaf"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_md5"),
    )
    copies = _copies(seed, "gives.whole", "gives.last", "id", "text_md5")
    return marked.join(gives, "leaf").select("row", F.explode(copies)).select("row.*")
