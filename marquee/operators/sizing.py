"""Size checks behind the choice of a join."""

from __future__ import annotations

from pyspark.sql import DataFrame


def planned_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a frame, after pruning; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark would broadcast the frame under its configured threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return planned_bytes(df) <= limit
