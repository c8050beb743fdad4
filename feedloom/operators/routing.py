"""Routing by confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits on the scale from 0 to 1.
REVIEW_FROM, APPROVE_FROM = 0.50, 0.86


def route(
    score: Column, bypass: Column | None = None, review_from: float = REVIEW_FROM, approve_from: float = APPROVE_FROM
) -> Column:
    """REJECTED, MANUAL_REVIEW or ACTIVE from a score in percent; no score means review.

    ``bypass`` marks rows of feeds that skip the filters; they are always ACTIVE.
    """
    share = score / 100
    routed = (
        F.when(share.isNull(), "MANUAL_REVIEW")
        .when(share < review_from, "REJECTED")
        .when(share < approve_from, "MANUAL_REVIEW")
        .otherwise("ACTIVE")
    )
    return routed if bypass is None else F.when(F.coalesce(bypass, F.lit(False)), "ACTIVE").otherwise(routed)


def approve_or_review(share: Column, approve_from: float = APPROVE_FROM) -> Column:
    """The two-way form for a score between 0 and 1; no score means review."""
    return F.when(F.coalesce(share >= approve_from, F.lit(False)), "approve").otherwise("review")


def with_route(rows: DataFrame, bypass: bool | Column = False) -> DataFrame:
    mark = F.lit(bypass) if isinstance(bypass, bool) else bypass
    return rows.withColumn("status", route(F.col("ai_confidence_score"), mark))


def by_state(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(approved, review, rejected)``."""
    return tuple(rows.filter(F.col("status") == s) for s in ("ACTIVE", "MANUAL_REVIEW", "REJECTED"))


def review_items(rows: DataFrame, added_at: Column) -> DataFrame:
    """Review queue entries: a pending state, the time and the posting as a struct."""
    return rows.select(
        F.lit("pending").alias("review_status"), added_at.alias("added_to_queue_at"), F.struct(*rows.columns).alias("job_data")
    )


def send_to_review(rows: DataFrame, added_at: Column, path: str) -> None:
    review_items(rows, added_at).write.mode("append").parquet(path)


def queue_status(queue: DataFrame) -> DataFrame:
    return queue.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(F.col("review_status") == "pending").alias("pending_items"),
    )
