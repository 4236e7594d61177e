"""Conversion of on-prem table and group configurations into target ones.

One projection with conditional columns covers full and incremental loads of
every source type. Rows that cannot be converted come back with a reason; one
bad table never ends the conversion of the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from lakeferry.functions.columns import PARTITION_KEYS, is_extracted, is_regex, non_empty
from lakeferry.functions.dates import derive_format, spaced
from lakeferry.functions.names import quote
from lakeferry.model import FULL_LOAD, INCREMENTAL_SYNC_TYPES, REQUIRED_SOURCE_FIELDS
from lakeferry.operators.catalog import overlay
from lakeferry.operators.joins import join_lookup

# Defaults of a target table and of a target table group.
TABLE_DEFAULTS: Mapping[str, object] = {
    "is_scd2_table": False,
    "is_archive_enabled": False,
    "generate_history_view": False,
    "storage_format": "read",
}
GROUP_DEFAULTS: Mapping[str, object] = {
    "name": "tg1",
    "max_connections": 1,
    "max_parallel_entities": 1,
}
ENGINES = ("SPARK",)
SFDC_WATERMARK = "SystemModstamp"

PARTITION_KEY_STRUCT = (
    "struct<parent_column:string,derive_function:string,derive_format:string,"
    "is_derived_partition:boolean,partition_column:string>"
)
SPLIT_KEY_STRUCT = (
    "struct<parent_column:string,derive_function:string,derive_format:string,"
    "is_derived_split:boolean,split_column:string>"
)

#: A converted table, flat (``convert_tables``).
TABLE_CONFIGURATION = (
    "target_table_name string, target_schema_name string, read_supported_engines array<string>, "
    "write_supported_engines array<string>, sync_type string, is_scd2_table boolean, is_archive_enabled boolean, "
    "generate_history_view boolean, storage_format string, natural_keys array<string>, update_strategy string, "
    "watermark_column string, use_capture_table boolean, fetch_mechanism string, enable_pk_chunk boolean, "
    "use_jdbc boolean, exclude_legacy_audit_columns boolean, "
    f"partition_keys array<{PARTITION_KEY_STRUCT}>, split_by_key {SPLIT_KEY_STRUCT}"
)
_OID = "struct<`$type`:string,`$value`:string>"


def document_schema(connection: Sequence[str]) -> str:
    """The schema of a document whose source has these connection fields."""
    inner = StructType.fromDDL(TABLE_CONFIGURATION).simpleString()
    fields = ",".join(f"{c}:string" for c in connection)
    return (
        f"source struct<hive_schema:string,sourceType:string,sourceSubtype:string,connection:struct<{fields}>>, "
        f"tables array<struct<entity_type:string,entity_id:{_OID},configuration:struct<`table`:string,configuration:{inner}>>>, "
        f"table_groups array<struct<entity_type:string,entity_id:{_OID},configuration:struct<name:string,"
        "max_connections:int,max_parallel_entities:int,cluster_template:struct<cluster_id:string>,"
        f"tables:array<struct<table_id:{_OID},connection_quota:int>>,source:{_OID},job_name:string,"
        "is_table_group_job:boolean>>>"
    )


def ingestion(name: str) -> Column:
    return F.col("ingestion_configuration")[name]


def listed_partition_keys() -> Column:
    keys = F.coalesce(ingestion("partition_key"), F.array().cast(PARTITION_KEYS))
    return F.filter(keys, lambda k: ~(is_extracted(k) & is_regex(k)))


def partition_keys_col() -> Column:
    """Target partition keys; regex ones have no counterpart and are left out."""
    function = "partition_key_derive_function"
    return F.transform(
        listed_partition_keys(),
        lambda k: F.when(
            is_extracted(k),
            F.struct(
                k["partition_key_column"].alias("parent_column"),
                F.trim(spaced(k[function])).alias("derive_function"),
                derive_format(k[function]).alias("derive_format"),
                F.lit(True).alias("is_derived_partition"),
                k["partition_key_derive_column"].alias("partition_column"),
            ).cast(PARTITION_KEY_STRUCT),
        ).otherwise(
            F.struct(
                F.lit(None).alias("parent_column"),
                F.lit(None).alias("derive_function"),
                F.lit(None).alias("derive_format"),
                F.lit(False).alias("is_derived_partition"),
                k["partition_key_column"].alias("partition_column"),
            ).cast(PARTITION_KEY_STRUCT)
        ),
    )


def is_split_derived() -> Column:
    return F.coalesce(ingestion("split_by_key_extract_from_col"), F.lit(False))


def split_key_col() -> Column:
    """Target split key; null for a table without one."""
    function = ingestion("split_by_key_derive_function")
    split = F.when(
        is_split_derived(),
        F.struct(
            ingestion("split_by_key").alias("parent_column"),
            spaced(function).alias("derive_function"),
            derive_format(function).alias("derive_format"),
            F.lit(True).alias("is_derived_split"),
            ingestion("split_by_key_derive_column").alias("split_column"),
        ).cast(SPLIT_KEY_STRUCT),
    ).otherwise(
        F.struct(
            F.lit(None).alias("parent_column"),
            F.lit(None).alias("derive_function"),
            F.lit(None).alias("derive_format"),
            F.lit(False).alias("is_derived_split"),
            ingestion("split_by_key").alias("split_column"),
        ).cast(SPLIT_KEY_STRUCT)
    )
    return F.when(non_empty(split["split_column"]).isNotNull(), split)


def is_incremental() -> Column:
    return ingestion("sync_type").isin(*INCREMENTAL_SYNC_TYPES)


def is_sfdc() -> Column:
    return F.col("source_type").eqNullSafe("sfdc")


def subtype_is(*names: str) -> Column:
    """Subtype rules hold for all sources but Salesforce-like ones."""
    return ~is_sfdc() & F.coalesce(F.col("source_subtype").isin(*names), F.lit(False))


def watermark_col() -> Column:
    """Salesforce's own stamp; else, for incremental tables, batch id before timestamp."""
    return F.when(is_sfdc(), F.lit(SFDC_WATERMARK)).when(
        is_incremental(),
        F.coalesce(
            non_empty(ingestion("batch_id_cdc_column")),
            non_empty(ingestion("timestamp_column_update")),
        ),
    )


def rejection_col() -> Column:
    """Why a table cannot be converted; null when it can."""
    sync = ingestion("sync_type")
    supported = sync.isin(FULL_LOAD, *INCREMENTAL_SYNC_TYPES)
    unknown = F.filter(
        listed_partition_keys(),
        lambda k: is_extracted(k) & derive_format(k["partition_key_derive_function"]).isNull(),
    )
    split_function = ingestion("split_by_key_derive_function")
    kind = F.col("source_type")
    known = kind.isin(*REQUIRED_SOURCE_FIELDS)
    return (
        F.when(
            ~F.coalesce(known, F.lit(False)),
            F.concat(F.lit("unsupported source type: "), F.coalesce(kind, F.lit("none"))),
        )
        .when(
            ~F.coalesce(supported, F.lit(False)),
            F.concat(F.lit("unsupported sync type: "), F.coalesce(sync, F.lit("none"))),
        )
        .when(F.size(unknown) > 0, F.lit("unknown partition derive function"))
        .when(
            is_split_derived() & derive_format(split_function).isNull(),
            F.lit("unknown split derive function"),
        )
    )


def convert_tables(
    tables: DataFrame, defaults: Mapping[str, object] = TABLE_DEFAULTS
) -> tuple[DataFrame, DataFrame]:
    """Target configurations, and the rejected tables with reasons.

    Input rows hold ``table_id, table, hive_schema, source_type, source_subtype,
    ingestion_configuration``.
    """
    annotated = tables.withColumn("reason", rejection_col())
    rejected = annotated.where(F.col("reason").isNotNull()).select("table_id", "table", "reason")
    bulk = subtype_is("teradata", "oracle")
    engines = F.array(*[F.lit(e) for e in ENGINES])
    configs = annotated.where(F.col("reason").isNull()).select(
        F.lit("table").alias("entity_type"),
        "table_id",
        "table",
        ingestion("hive_table_name").alias("target_table_name"),
        F.col("hive_schema").alias("target_schema_name"),
        engines.alias("read_supported_engines"),
        engines.alias("write_supported_engines"),
        F.when(is_incremental(), F.lit("incremental"))
        .otherwise(ingestion("sync_type"))
        .alias("sync_type"),
        *[
            overlay(ingestion(name), defaults[name]).alias(name)
            for name in ("is_scd2_table", "is_archive_enabled", "generate_history_view")
        ],
        F.lit(defaults["storage_format"]).alias("storage_format"),
        F.coalesce(ingestion("natural_key"), F.array().cast("array<string>")).alias(
            "natural_keys"
        ),
        F.when(is_incremental(), F.lit("merge")).alias("update_strategy"),
        watermark_col().alias("watermark_column"),
        F.when(is_incremental() & subtype_is("sqlserver"), F.lit(False)).alias(
            "use_capture_table"
        ),
        F.when(bulk, F.lit("bulk"))
        .when(is_sfdc(), ingestion("fetch_mechanism"))
        .alias("fetch_mechanism"),
        F.when(is_sfdc(), ingestion("pk_chunking_enabled")).alias("enable_pk_chunk"),
        F.when(subtype_is("teradata"), F.lit(False)).alias("use_jdbc"),
        F.when(bulk, F.lit(True)).alias("exclude_legacy_audit_columns"),
        partition_keys_col().alias("partition_keys"),
        split_key_col().alias("split_by_key"),
    )
    return configs, rejected


def bind_clusters(groups: DataFrame, templates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups with the ``cluster_id`` of the template they name, and those that name none there is.

    ``groups`` have ``cluster_name``, ``templates`` have ``cluster_name`` and
    ``cluster_id``; of templates that share a name the first by id is taken. A name that
    most groups use is no hot key (``join_lookup``).
    """
    first = templates.where(F.col("cluster_name").isNotNull()).groupBy("cluster_name").agg(
        F.min("cluster_id").alias("cluster_id")
    )
    found = join_lookup(groups, first, {"cluster_name": "cluster_name"}, ["group_id"], "left")
    missing = F.concat(F.lit("unknown cluster template: "), F.coalesce("cluster_name", F.lit("none")))
    return (
        found.where(F.col("cluster_id").isNotNull()),
        found.where(F.col("cluster_id").isNull()).select("group_id", "name", missing.alias("reason")),
    )


def convert_groups(
    groups: DataFrame,
    cluster_id: str | Column,
    defaults: Mapping[str, object] = GROUP_DEFAULTS,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Target table groups, bound to a cluster template: one for all, or a column (``bind_clusters``).

    ``carried`` names further columns to keep.
    """
    cluster_id = cluster_id if isinstance(cluster_id, Column) else F.lit(cluster_id)
    name = overlay(F.col("name"), defaults["name"])
    return groups.select(
        F.lit("table_group").alias("entity_type"),
        "group_id",
        name.alias("name"),
        *[
            overlay(F.col(c), defaults[c]).alias(c)
            for c in ("max_connections", "max_parallel_entities")
        ],
        "tables",
        "source",
        cluster_id.alias("cluster_id"),
        F.when(is_sfdc(), name).alias("job_name"),
        F.when(is_sfdc(), F.lit(True)).alias("is_table_group_job"),
        *[quote(c) for c in carried],
    )


# --- documents ------------------------------------------------------------------

#: Tables, or table groups, of one document. A source may own millions.
PIECE = 1_000
#: Rows of a source that are numbered in one task, in pieces.
PIECES_PER_TASK = 100


def typed(column: str) -> Column:
    """An id as the documents write it."""
    return F.struct(F.lit("oid").alias("$type"), F.col(column).cast("string").alias("$value"))


def _table_entry() -> Column:
    """A converted table in the nested form of a document."""
    outer = ("entity_type", "table_id", "table")
    inner = [f.name for f in StructType.fromDDL(TABLE_CONFIGURATION).fields]
    return F.struct(
        F.col("entity_type").alias("entity_type"),
        typed("table_id").alias("entity_id"),
        F.struct(
            F.col("table").alias("table"),
            F.struct(*[F.col(quote(c)) for c in inner if c not in outer]).alias("configuration"),
        ).alias("configuration"),
    )


def _group_entry() -> Column:
    """A converted table group in the nested form of a document."""
    return F.struct(
        F.col("entity_type").alias("entity_type"),
        typed("group_id").alias("entity_id"),
        F.struct(
            *[F.col(c) for c in ("name", "max_connections", "max_parallel_entities")],
            F.struct(F.col("cluster_id").alias("cluster_id")).alias("cluster_template"),
            F.transform(
                "tables",
                lambda t: F.struct(
                    F.struct(F.lit("oid").alias("$type"), t["table_id"].alias("$value")).alias("table_id"),
                    t["connection_quota"].alias("connection_quota"),
                ),
            ).alias("tables"),
            typed("source").alias("source"),
            F.col("job_name"),
            F.col("is_table_group_job"),
        ).alias("configuration"),
    )


def _pieces(rows: DataFrame, source: str, entry: Column, id_col: str, name: str, size: int) -> DataFrame:
    """(source, piece, ``name``: at most ``size`` entries in order of id).

    Sources are counted first. One with more rows than a task should number is dealt
    over several by its ids, each of which makes pieces of its own.
    """
    counts = rows.groupBy(source).agg(F.ceil(F.count(F.lit(1)) / (size * PIECES_PER_TASK)).alias("_parts"))
    dealt = join_lookup(rows, counts, {source: source}, [id_col], null_safe=True)
    part = F.pmod(F.xxhash64(id_col), "_parts")
    number = F.row_number().over(Window.partitionBy(source, "_part").orderBy(id_col)) - 1
    placed = dealt.withColumn("_part", part).withColumn("_at", F.floor(number / size))
    entries = placed.select(
        source, F.struct("_part", "_at").alias("piece"), F.struct(F.col(id_col).alias("id"), entry.alias("entry")).alias("e")
    )
    listed = F.transform(F.array_sort(F.collect_list("e")), lambda e: e["entry"])
    return entries.groupBy(source, "piece").agg(listed.alias(name))


def config_documents(sources: DataFrame, tables: DataFrame, groups: DataFrame, size: int = PIECE) -> DataFrame:
    """Target configurations as documents: ``source``, ``tables``, ``table_groups``.

    ``sources`` are complete ones (``convert_sources``), ``tables`` and ``groups``
    converted ones; the last carry the ``hive_schema`` of their source. A document holds
    at most ``size`` tables or groups, so that none grows with its source; a source
    without any has one that is empty. Entries of sources that are not complete stay out.
    """
    connection = [f.name for f in sources.schema.fields if f.name not in ("hive_schema", "source_type", "sourceType", "sourceSubtype")]
    source = F.struct(
        "hive_schema", "sourceType", "sourceSubtype", F.struct(*[F.col(quote(c)) for c in connection]).alias("connection")
    )
    described = sources.select(F.col("hive_schema").alias("_schema"), source.alias("source"))
    table_pieces = _pieces(
        tables.withColumnRenamed("target_schema_name", "_schema").withColumn("target_schema_name", F.col("_schema")),
        "_schema", _table_entry(), "table_id", "tables", size,
    )
    group_pieces = _pieces(
        groups.withColumnRenamed("hive_schema", "_schema"), "_schema", _group_entry(), "group_id", "table_groups", size
    )
    empty = described.select("_schema", F.lit(None).alias("piece"))
    listed = table_pieces.drop("piece").unionByName(group_pieces.drop("piece"), allowMissingColumns=True)
    alone = join_lookup(empty, listed.select("_schema").distinct(), {"_schema": "_schema"}, ["_schema"], "left_anti")
    every = listed.unionByName(alone.select("_schema"), allowMissingColumns=True)
    joined = join_lookup(every, described, {"_schema": "_schema"}, ["tables", "table_groups"])
    nothing = lambda c: F.coalesce(c, F.array().cast(listed.schema[c].dataType)).alias(c)
    return joined.select("source", nothing("tables"), nothing("table_groups"))


def convert_sources(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The strict overlay: every field its kind of source requires must be configured.

    Returns complete sources, and the others with the names missing; a source of
    an unknown kind is not complete.
    """
    known = {
        kind: F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
        for kind, required in REQUIRED_SOURCE_FIELDS.items()
    }
    missing = F.lit("supported source type")
    for kind, names in known.items():
        missing = F.when(F.col("source_type") == kind, names).otherwise(missing)
    checked = sources.withColumn("missing", missing)
    return checked.where(F.col("missing") == "").drop("missing"), checked.where(
        F.col("missing") != ""
    )
