"""Value objects and document schemas shared by all operators."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

# The audit columns of landed rows, after the profile prefix.
DROPPED_AUDIT_COLUMNS = (
    "row_id",
    "scn",
    "source_start_date",
    "source_start_timestamp",
    "target_start_date",
    "source_end_date",
    "source_end_timestamp",
    "target_end_date",
    "target_end_timestamp",
    "active",
    "status_flag",
    "offset",
)
DEFAULT_AUDIT_PREFIX = "ziw_"

# The landed formats and the sync types understood.
LANDED_FORMATS = ("orc", "parquet")
FULL_LOAD = "full-load"
INCREMENTAL_SYNC_TYPES = ("cdc-timestamp-column", "cdc-batch-id")

WRITE_MODES = ("overwrite", "append")


@dataclass(frozen=True)
class AuditProfile:
    """Names of the bookkeeping columns a landed table carries."""

    prefix: str = DEFAULT_AUDIT_PREFIX

    def name(self, suffix: str) -> str:
        return self.prefix + suffix

    @property
    def dropped(self) -> list[str]:
        return [self.name(suffix) for suffix in DROPPED_AUDIT_COLUMNS]


@dataclass(frozen=True)
class PartitionSpec:
    """Partition columns kept (``normal``) and regex-derived ones to remove (``drop``)."""

    normal: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()

    @classmethod
    def from_json(cls, text: str) -> PartitionSpec:
        parsed = json.loads(text)
        return cls(tuple(parsed["normal"]), tuple(parsed["drop"]))

    def to_json(self) -> str:
        return json.dumps({"normal": list(self.normal), "drop": list(self.drop)})

    @property
    def depth(self) -> int:
        return len(self.normal) + len(self.drop)


@dataclass(frozen=True)
class TableSpec:
    """Everything needed to migrate one landed table.

    ``cluster`` chooses how rows reach the write: ``"none"`` keeps the scan's own
    splits (no shuffle; right when the landed tree is already grouped by partition),
    ``"rebalance"`` shuffles by partition value and lets adaptive execution cut hot
    partitions into evenly sized files, ``"auto"`` does so for partitioned tables only.

    ``publish`` is ``"direct"`` (write into ``target_dir``) or ``"swap"``: write a
    new directory below it and point the table there once it is complete, so that
    a failed load leaves the former table as it was. Superseded directories stay
    until nobody reads them; removing them is up to the caller.
    """

    src_dir: str
    target_dir: str
    database: str
    table: str
    fmt: str = "parquet"
    mode: str = "overwrite"
    src_type: str = "rdbms"
    partitions: PartitionSpec = field(default_factory=PartitionSpec)
    renames: Mapping[str, str] = field(default_factory=dict)
    table_format: str | None = None
    audit: AuditProfile = field(default_factory=AuditProfile)
    layout: str = "recursive"
    cluster: str = "auto"
    strict_reference: bool = False
    active_only: bool = False
    register: bool = True
    publish: str = "direct"


@dataclass(frozen=True)
class MigrationResult:
    target_dir: str
    table_name: str
    table_format: str
    rows_written: int
    columns: tuple[str, ...]
    partition_by: tuple[str, ...]


@dataclass(frozen=True)
class MergeSpec:
    """Natural keys, watermark column and tie-break of an incremental table.

    With ``buckets``, stored base versions are also tables ``database.table_v<n>``,
    bucketed by the keys, so that deltas of any size are merged without shuffling
    the base. Use at least as many buckets as shuffle partitions: Spark shuffles
    a table with fewer all the same.

    With ``partition_by``, base versions are partitioned by these columns instead, and
    ``compact`` rewrites only the partitions that the deltas touch. ``keep_hours`` makes
    it remove what no reader that began within that time can need.
    """

    keys: tuple[str, ...]
    watermark: str
    tiebreak: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    keep_hours: float | None = None
    buckets: int = 0
    database: str = ""
    table: str = ""


# Document schemas. Ids and watermarks stay text, so nothing is re-inferred.
INGESTION_CONFIGURATION = (
    "struct<sync_type:string,storage_format:string,hive_table_name:string,"
    "natural_key:array<string>,is_scd2_table:boolean,is_archive_enabled:boolean,"
    "generate_history_view:boolean,timestamp_column_update:string,"
    "batch_id_cdc_column:string,fetch_mechanism:string,pk_chunking_enabled:boolean,"
    "split_by_key:string,split_by_key_extract_from_col:boolean,"
    "split_by_key_derive_function:string,split_by_key_derive_column:string,"
    "partition_key:array<struct<partition_key_column:string,"
    "partition_key_extract_from_col:boolean,partition_key_derive_function:string,"
    "partition_key_derive_column:string>>>"
)
COLUMN_LIST = "array<struct<origName:string,name:string>>"

# No credential field is part of a connection.
CONNECTION_FIELDS = (
    "driver_name",
    "schema",
    "database",
    "connection_method",
    "connection_string",
    "username",
)
CONNECTION = "struct<" + ",".join(f"{name}:string" for name in CONNECTION_FIELDS) + ">"

TABLE_DOCUMENT = (
    "table_id string, source string, `table` string, hive_schema string, state string, "
    "hdfs_path string, last_ingested_cdc_value string, last_merged_timestamp string, "
    f"columns {COLUMN_LIST}, ingestion_configuration {INGESTION_CONFIGURATION}"
)
SOURCE_DOCUMENT = (
    "src_id string, name string, hive_schema string, sourceType string, "
    f"sourceSubtype string, hdfs_path string, isPublic boolean, connection {CONNECTION}"
)

# The fields a converted source must have, per kind of source.
REQUIRED_SOURCE_FIELDS = {
    "rdbms": CONNECTION_FIELDS + ("hive_schema", "sourceType", "sourceSubtype"),
    "sfdc": (
        "fileType",
        "api_version",
        "connection_string",
        "environment",
        "fetch_mechanism",
        "username",
        "hive_schema",
        "sourceType",
        "sourceSubtype",
    ),
}
EXPORTED_CONNECTION_FIELDS = CONNECTION_FIELDS + (
    "fileType",
    "api_version",
    "environment",
    "fetch_mechanism",
)
EXPORTED_CONNECTION = (
    "struct<" + ",".join(f"{name}:string" for name in EXPORTED_CONNECTION_FIELDS) + ">"
)

TYPED_ID = "struct<`$type`:string,`$value`:string>"
CONFIG_ENVELOPE = (
    "source struct<hive_schema:string,sourceType:string,sourceSubtype:string,"
    f"connection:{EXPORTED_CONNECTION}>, "
    f"tables array<struct<entity_type:string,entity_id:{TYPED_ID},"
    "configuration:struct<`table`:string,"
    f"ingestion_configuration:{INGESTION_CONFIGURATION}>>>, "
    f"table_groups array<struct<entity_type:string,entity_id:{TYPED_ID},"
    "configuration:struct<name:string,max_connections:int,max_parallel_entities:int,"
    f"tables:array<struct<table_id:{TYPED_ID},connection_quota:int>>,source:{TYPED_ID}>>>, "
    "export struct<exportedAt:struct<`$date`:bigint>,exportedBy:string>"
)

PLAN_COLUMNS = (
    "table_id",
    "table_name",
    "storage_format",
    "src_dir",
    "source_id",
    "last_ingested_cdc_value",
    "last_merged_timestamp",
    "sync_type",
    "partition_column",
    "override_columns",
    "source_name",
    "hive_schema",
    "source_type",
    "sourceSubtype",
)
PLAN = ", ".join(f"{name} string" for name in PLAN_COLUMNS)

SOURCE_DUMP_COLUMNS = tuple(f"connection.{name}" for name in CONNECTION_FIELDS) + (
    "hive_schema",
    "sourceType",
    "sourceSubtype",
    "name",
    "hdfs_path",
    "isPublic",
)
JOB = "job_id bigint"

SOURCE_DUMP = ", ".join(
    f"`{name}` {'boolean' if name == 'isPublic' else 'string'}" for name in SOURCE_DUMP_COLUMNS
)
