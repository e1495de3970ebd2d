"""Conversations that got stuck on empty messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.operators.relational import join_per_key

# Fixed value: what a message without text is rendered as.
EMPTY_MARKER = "[no text content]"


def is_empty_message(text: str = "text", marker: str = EMPTY_MARKER) -> Column:
    return F.coalesce(F.contains(F.col(text), F.lit(marker)), F.lit(False))


def stuck_conversations(
    events: DataFrame, limit: int = 1, is_empty: Column | None = None
) -> DataFrame:
    """Conversations with more than ``limit`` empty messages, and the turn of the
    message that went over it.

    Only empty messages are kept, and of those the first ``limit + 1`` of a
    conversation.  Spark applies that rank limit in each task before the shuffle
    and again after it, so a conversation of any length sends a few rows (up to
    the limit set by ``spark.sql.optimizer.windowGroupLimitThreshold``).
    """
    empty = is_empty_message() if is_empty is None else is_empty
    in_order = W.partitionBy("conv_id").orderBy("turn")
    ranked = events.where(empty).select(
        "conv_id", "turn", F.row_number().over(in_order).alias("__n")
    )
    return ranked.where(F.col("__n") == limit + 1).select(
        "conv_id", F.col("turn").alias("stuck_turn")
    )


def until_stuck(
    events: DataFrame, limit: int = 1, is_empty: Column | None = None
) -> DataFrame:
    """The events that took place: all up to and including the one that got stuck."""
    stuck = stuck_conversations(events, limit, is_empty)
    kept = F.col("stuck_turn").isNull() | (F.col("turn") <= F.col("stuck_turn"))
    return join_per_key(events, stuck, "conv_id", "left").where(kept).drop("stuck_turn")
