"""Lake migration and incremental ingestion on PySpark."""

from lakeferry.model import AuditProfile, MergeSpec, MigrationResult, PartitionSpec, TableSpec

__all__ = ["AuditProfile", "MergeSpec", "MigrationResult", "PartitionSpec", "TableSpec"]
