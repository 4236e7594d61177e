"""State of migrated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"

STATE = (
    "table_id string, full_load_performed boolean, state string, "
    "last_ingested_cdc_value string, last_merged_watermark string, "
    "state_export_data boolean, state_fetch_delta boolean, "
    "state_merge_delta boolean, state_reconcile_data boolean"
)
FLAGS = ("state_export_data", "state_fetch_delta", "state_merge_delta", "state_reconcile_data")


def apply_state(state: DataFrame, plan: DataFrame, results: DataFrame) -> DataFrame:
    """The state table after a batch: a succeeded table becomes ready with the plan's watermarks.

    A resolved plan moves the state of the target's document (``target_id``), a plain
    one that of the table itself. Tables that failed, or were not in the batch, keep
    their state. Repeated results count once, and of several plan rows of one
    document the one with the later watermarks.
    """
    done = results.where(F.col("status") == SUCCEEDED).select("table_id").distinct()
    document = "target_id" if "target_id" in plan.columns else "table_id"
    carried = (
        plan.join(done, "table_id", "left_semi")
        .groupBy(F.col(document).alias("_id"))
        .agg(F.max(F.struct(F.col("last_merged_timestamp").alias("m"), F.col("last_ingested_cdc_value").alias("c"))).alias("_last"))
        .select("_id", F.col("_last.c").alias("_cdc"), F.col("_last.m").alias("_merged"))
    )
    joined = state.join(carried, state["table_id"] == carried["_id"], "left")
    moved = F.col("_id").isNotNull()
    return joined.select(
        "table_id",
        F.when(moved, F.lit(True))
        .otherwise(F.col("full_load_performed"))
        .alias("full_load_performed"),
        F.when(moved, F.lit("ready")).otherwise(F.col("state")).alias("state"),
        F.when(moved, F.col("_cdc"))
        .otherwise(F.col("last_ingested_cdc_value"))
        .alias("last_ingested_cdc_value"),
        F.when(moved, F.col("_merged"))
        .otherwise(F.col("last_merged_watermark"))
        .alias("last_merged_watermark"),
        *[F.when(moved, F.lit(False)).otherwise(F.col(flag)).alias(flag) for flag in FLAGS],
    )
