"""Expressions over catalog documents: booleans, rename maps, partition specs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

TEXT_MAP = "map<string,string>"


def to_boolean(value: Column) -> Column:
    """Boolean words and digits to boolean; anything else to null, even under ANSI."""
    return value.try_cast("boolean")


def non_empty(value: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(value, F.lit(""))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once; inside a lambda it would be once per element."""
    return F.transform(F.array(value), body)[0]


def map_last_wins(entries: Column) -> Column:
    """A map of ``array<struct<key,value>>``; a repeated key keeps its last value, at its last place.

    Entries are sorted by key and place, so that an entry counts if another key follows.
    """
    listed = F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>"))
    placed = F.transform(
        listed, lambda e, i: F.struct(e["key"].alias("key"), i.alias("place"), e["value"].alias("value"))
    )
    last = bound(
        F.array_sort(placed),
        lambda s: F.filter(s, lambda e, i: ~F.coalesce(F.get(s, i + 1)["key"] == e["key"], F.lit(False))),
    )
    ordered = F.array_sort(
        F.transform(last, lambda e: F.struct(e["place"].alias("place"), e["key"].alias("key"), e["value"].alias("value")))
    )
    pairs = F.transform(ordered, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    return F.map_from_entries(pairs).cast(TEXT_MAP)


def rename_map(columns: Column) -> Column:
    """``{origName: name}`` of the columns whose name was changed."""
    renamed = F.filter(columns, lambda c: c["origName"] != c["name"])
    return map_last_wins(
        F.transform(
            renamed, lambda c: F.struct(c["origName"].alias("key"), c["name"].alias("value"))
        )
    )


def compose_renames(onprem: Column, target: Column) -> Column:
    """Re-key the target renames by the name each column carries in the landed data.

    A key renamed on-prem is looked up there; a column renamed on-prem only has
    no entry and so keeps its on-prem name. Both maps are sorted into one list by key,
    where a target entry's on-prem one, if there is any, comes just before it.
    """

    def tagged(entries: Column, tag: int) -> Column:
        return F.transform(
            F.coalesce(F.map_entries(entries), F.array().cast("array<struct<key:string,value:string>>")),
            lambda e, i: F.struct(
                e["key"].alias("key"), F.lit(tag).alias("tag"), i.alias("place"), e["value"].alias("value")
            ),
        )

    def landed(s: Column) -> Column:
        def renamed(e: Column, i: Column) -> Column:
            former = F.get(s, i - 1)
            known = (former["key"] == e["key"]) & (former["tag"] == 0)
            key = F.when(known, F.coalesce(former["value"], e["key"])).otherwise(e["key"])
            return F.struct(e["tag"].alias("tag"), e["place"].alias("place"), key.alias("key"), e["value"].alias("value"))

        return F.array_sort(F.filter(F.transform(s, renamed), lambda e: e["tag"] == 1))

    rekeyed = bound(F.array_sort(F.concat(tagged(onprem, 0), tagged(target, 1))), landed)
    return map_last_wins(F.transform(rekeyed, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))


def is_extracted(key: Column) -> Column:
    return F.coalesce(key["partition_key_extract_from_col"], F.lit(False))


def is_regex(key: Column) -> Column:
    return key["partition_key_derive_function"].eqNullSafe("regex")


def partition_spec(keys: Column) -> Column:
    """``struct<normal, drop>`` of a partition key array, in array order."""
    listed = F.coalesce(keys, F.array().cast(PARTITION_KEYS))
    normal = F.transform(
        F.filter(listed, lambda k: ~(is_extracted(k) & is_regex(k))),
        lambda k: F.when(is_extracted(k), k["partition_key_derive_column"]).otherwise(
            k["partition_key_column"]
        ),
    )
    drop = F.transform(
        F.filter(listed, lambda k: is_extracted(k) & is_regex(k)),
        lambda k: k["partition_key_derive_column"],
    )
    return F.struct(normal.alias("normal"), drop.alias("drop"))


PARTITION_KEYS = (
    "array<struct<partition_key_column:string,partition_key_extract_from_col:boolean,"
    "partition_key_derive_function:string,partition_key_derive_column:string>>"
)
