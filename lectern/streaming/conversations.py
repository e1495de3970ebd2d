"""Stuck conversations found while they run."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lectern.operators.conversations import is_empty_message

_ALERTS = "conv_id long, empty_messages long, batch_id long"


def stream_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A child session whose streams keep their state in that many parts, for as long as a checkpoint lives."""
    child = spark.newSession()
    child.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    child.conf.set("spark.sql.shuffle.partitions", state_partitions)
    return child


def empty_message_counts(
    events: DataFrame, limit: int = 1, is_empty: Column | None = None
) -> DataFrame:
    """Running count per conversation, of those over the limit; for update mode.

    State is kept only for conversations with an empty message.  Counts are
    added up in each task before the shuffle, so a busy conversation sends one
    row per task.
    """
    empty = is_empty_message() if is_empty is None else is_empty
    counts = events.where(empty).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("empty_messages")
    )
    return counts.where(F.col("empty_messages") > limit)


def _added_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation and Arrow batch, so that a busy one sends few rows to its state."""
    for batch in batches:
        sums = batch.groupby("conv_id", dropna=False).size()
        yield pd.DataFrame({"conv_id": sums.index.astype("Int64"), "n": sums.to_numpy()})


def new_alerts(
    events: DataFrame, limit: int = 1, is_empty: Column | None = None, forget_after_ms: int | None = None
) -> DataFrame:
    """``conv_id`` and ``empty_messages`` of each conversation once, when it first goes over the limit.

    The state of a conversation is its count and whether it has been told of.
    ``forget_after_ms``, if given, drops it when no empty message has come for
    that long (processing time): the state then holds the conversations of that
    span alone, and one that goes on later starts from zero.  Events without a
    conversation id belong to none and are left out.
    """
    empty = is_empty_message() if is_empty is None else is_empty
    counts = events.where(empty & F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id")).mapInPandas(
        _added_up, "conv_id long, n long")

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, told = state.get if state.exists else (0, False)
        seen += sum(int(batch["n"].sum()) for batch in batches)
        if seen > limit and not told:
            told = True
            yield pd.DataFrame({"conv_id": [key[0]], "empty_messages": [seen]})
        state.update((seen, told))
        if forget_after_ms is not None:
            state.setTimeoutDuration(forget_after_ms)

    timeout = GroupStateTimeout.NoTimeout if forget_after_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return counts.groupBy("conv_id").applyInPandasWithState(
        follow, "conv_id long, empty_messages long", "seen long, told boolean", "append", timeout)


def alert_once(
    events: DataFrame,
    alerts_path: str,
    checkpoint: str,
    limit: int = 1,
    is_empty: Column | None = None,
    available_now: bool = False,
    forget_after_ms: int | None = None,
) -> StreamingQuery:
    """Write each stuck conversation once to ``alerts_path``.

    Whether a conversation has been told of is part of the query's state, so no
    micro-batch reads earlier alerts.  A micro-batch writes its own folder; one
    that is run again after a failure starts from the state before it, gives the
    same rows and writes them over.  For another number of state partitions than
    the session's shuffle setting read the events in a `stream_session`.

    A query that forgets goes on looking for conversations to forget, so it
    does not end by itself and takes no ``available_now``.
    """
    if available_now and forget_after_ms is not None:
        raise ValueError("a query that forgets conversations does not end: use no available_now")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{alerts_path}/batch_id={batch_id}")

    writer = (
        new_alerts(events, limit, is_empty, forget_after_ms)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_alerts(spark: SparkSession, alerts_path: str) -> DataFrame:
    return spark.read.schema(_ALERTS).parquet(alerts_path)
