"""Migration of one landed table, and of every row of a plan."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from lakeferry.functions.names import qualified
from lakeferry.model import MigrationResult, PartitionSpec, TableSpec
from lakeferry.operators.cleanse import (
    active_rows,
    apply_partition_spec,
    cleanse_audit,
    rename_columns,
)
from lakeferry.operators.incremental import latest_per_key
from lakeferry.operators.state import FAILED, SUCCEEDED
from lakeferry.sinks import storage
from lakeferry.sinks.tables import (
    check_append,
    check_no_overlap,
    default_table_format,
    register_table,
    write_mode,
    write_table,
)
from lakeferry.sources.landed import landed_root, scan_landed

RESULTS = (
    "table_id string, table_name string, status string, rows_written bigint, "
    "target_dir string, error string"
)

# Fixed value: tables migrated at a time.
DEFAULT_CONCURRENCY = 2


def prepare_table(spark: SparkSession, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    """The rows to write and their partition columns; a scan and projections, no shuffle."""
    df = scan_landed(spark, spec.src_dir, spec.fmt, spec.partitions, spec.layout)
    if spec.active_only:
        df = active_rows(df, spec.audit)
    df = cleanse_audit(df, spec.audit, spec.src_type)
    df = rename_columns(df, spec.renames)
    return apply_partition_spec(df, spec.partitions, spec.renames, spec.strict_reference)


def migrate_table(spark: SparkSession, spec: TableSpec) -> MigrationResult:
    """Move one landed table into a registered target table.

    Everything that can be refused is refused before the target is touched. Rows
    are counted while they are written.
    """
    root = landed_root(spec.src_dir, spec.fmt)
    mode = write_mode(spec.mode)
    check_no_overlap(root, spec.target_dir)
    path = publish_path(spec, mode)
    table_format = spec.table_format or default_table_format(spark)
    df, partition_by = prepare_table(spark, spec)
    if mode == "append" and spec.register:
        check_append(spark, spec.database, spec.table, df, partition_by)

    counted = Observation()
    write_table(df, path, mode, table_format, partition_by, clustering(spec, partition_by), counted)
    if spec.register:
        written = [dict(zip(partition_by, values)) for values in counted.get["partitions"]]
        register_table(
            spark,
            spec.database,
            spec.table,
            path,
            table_format,
            df.schema.toDDL(),
            partition_by,
            mode,
            written,
        )
    return MigrationResult(
        target_dir=path,
        table_name=qualified(spec.database, spec.table),
        table_format=table_format,
        rows_written=counted.get["rows"],
        columns=tuple(df.columns),
        partition_by=tuple(partition_by),
    )


def clustering(spec: TableSpec, partition_by: Sequence[str]) -> str:
    """``auto`` rebalances a partitioned write: else every task leaves a file in every partition it meets."""
    if spec.cluster != "auto":
        return spec.cluster
    return "rebalance" if partition_by else "none"


def publish_path(spec: TableSpec, mode: str) -> str:
    if spec.publish == "direct":
        return spec.target_dir
    if spec.publish != "swap":
        raise ValueError(f"unknown publishing {spec.publish!r}")
    if mode != "overwrite" or not spec.register:
        raise ValueError("only a registered table that is overwritten can be swapped")
    return f"{spec.target_dir.rstrip('/')}/load={uuid.uuid4().hex}"


def spec_from_plan(row: Row, **options: object) -> TableSpec:
    """The table spec of one resolved plan row (see ``catalog.resolve_targets``)."""
    return TableSpec(
        src_dir=row["src_dir"],
        target_dir=row["target_dir"],
        database=row["hive_schema"],
        table=row["table_name"],
        fmt=row["storage_format"],
        src_type=row["source_type"],
        partitions=PartitionSpec.from_json(row["partition_column"]),
        renames=json.loads(row["override_columns"]),
        **options,
    )


def migrate_batch(
    spark: SparkSession,
    plan: DataFrame,
    concurrency: int = DEFAULT_CONCURRENCY,
    log: str | None = None,
    **options: object,
) -> DataFrame:
    """Migrate every row of a resolved plan; one result row per table.

    Tables are independent: a failed one is reported and the others go on. Only
    plan rows pass through the driver, a partition of them at a time, and each
    table is a Spark job of its own. ``options`` override ``TableSpec`` fields.

    With ``log``, a folder that names the batch, each outcome is written there as its
    table ends. A batch that was broken off goes on where it stopped: tables that
    succeeded are left out, failed ones are tried again, and the result holds the last
    outcome of every table of the plan. A table that ended without its outcome being
    noted is migrated once more, which an overwrite does not show.
    """

    def run(row: Row) -> tuple:
        try:
            result = migrate_table(spark, spec_from_plan(row, **options))
            outcome = (row["table_id"], row["table_name"], SUCCEEDED, result.rows_written, result.target_dir, None)
        except Exception as failure:  # noqa: BLE001 - reported in the result row
            outcome = (row["table_id"], row["table_name"], FAILED, None, row["target_dir"], str(failure))
        if log:
            note_outcome(spark, log, outcome)
        return outcome

    if log is None:
        results = list(_concurrently(run, plan.toLocalIterator(), concurrency))
        return spark.createDataFrame(results, RESULTS)
    pending = plan.join(succeeded(outcomes(spark, log)), "table_id", "left_anti")
    for _ in _concurrently(run, pending.toLocalIterator(), concurrency):
        pass
    return last_outcomes(outcomes(spark, log)).join(plan.select("table_id"), "table_id", "left_semi")


# --- the log of a batch ---------------------------------------------------------

OUTCOMES = f"{RESULTS}, ended_at double"


def note_outcome(spark: SparkSession, log: str, outcome: tuple) -> None:
    """Add one outcome: a folder of its own, since tables that end together write together."""
    row = spark.createDataFrame([(*outcome, time.time())], OUTCOMES)
    row.coalesce(1).write.parquet(f"{log}/outcome={uuid.uuid4().hex}")


def outcomes(spark: SparkSession, log: str) -> DataFrame:
    """All outcomes noted so far; none before the first."""
    if not storage.names(spark, log):
        return spark.createDataFrame([], OUTCOMES)
    return spark.read.schema(OUTCOMES).option("recursiveFileLookup", "true").parquet(log)


def succeeded(noted: DataFrame) -> DataFrame:
    return noted.where(F.col("status") == SUCCEEDED).select("table_id").distinct()


def last_outcomes(noted: DataFrame) -> DataFrame:
    """The last outcome of every table."""
    return latest_per_key(noted, ["table_id"], "ended_at").drop("ended_at")


def _concurrently(run: Callable[[Row], tuple], rows: Iterable[Row], width: int) -> Iterator[tuple]:
    """``run`` over ``rows`` with ``width`` calls at a time, without reading rows ahead."""
    with ThreadPoolExecutor(max_workers=width) as pool:
        running: set[Future] = set()
        for row in rows:
            if len(running) >= width:
                done, running = wait(running, return_when=FIRST_COMPLETED)
                yield from (future.result() for future in done)
            running.add(pool.submit(run, row))
        yield from (future.result() for future in running)
