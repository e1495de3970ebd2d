"""Rollouts of exams: fan-out, rewards, advantages, length limits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.structured import fail_unless
from lectern.operators.relational import join_per_key

# Rollouts per task and length limits of the trainers.
ROLLOUTS_PER_TASK = 4
MAX_PROMPT_LENGTH = 30_000
MAX_RESPONSE_LENGTH = 10_000
MAX_TRAINING_LENGTH = 20_480


def fan_out(tasks: DataFrame, n: int = ROLLOUTS_PER_TASK) -> DataFrame:
    """n attempts per task, numbered from 1."""
    return tasks.withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(n))))


def rollout_rewards(
    tasks: DataFrame,
    outcomes: DataFrame,
    key: str,
    n: int = ROLLOUTS_PER_TASK,
    outside: str = "error",
) -> DataFrame:
    """Reward 1.0 for a successful attempt, else 0.0, for every outcome of a task.

    Attempts without outcome give no row.  An outcome whose attempt is not one of
    1..n stops the job; with ``outside="drop"`` it is left out, with ``"keep"``
    it counts like the others.  A ``response`` of the outcomes is handed on.
    """
    handed = [c for c in ("response",) if c in outcomes.columns]
    results = outcomes.select(key, "attempt", F.col("success").cast("double").alias("reward"), *handed)
    within = F.coalesce(F.col("attempt").between(1, n), F.lit(False))
    if outside == "error":
        message = F.concat(
            F.lit(f"outcome outside 1..{n}: {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")),
            F.lit(", attempt "), F.coalesce(F.col("attempt").cast("string"), F.lit("null")),
        )
        results = fail_unless(results, within, message)
    elif outside == "drop":
        results = results.where(within)
    elif outside != "keep":
        raise ValueError(f"unknown way to handle attempts outside 1..n: {outside!r}")
    return tasks.join(results, key).select(key, "attempt", *[c for c in tasks.columns if c != key], "reward", *handed)


def group_advantage(rewards: DataFrame, key: str) -> DataFrame:
    """Add ``advantage``: reward minus the task mean, over the task's sample deviation.

    Equal rewards, or a single attempt, give exactly 0.  The statistics are aggregated
    and joined back; a window would pull all attempts of a task into one task.
    """
    stats = rewards.groupBy(key).agg(
        F.avg("reward").alias("__mean"),
        F.stddev_samp("reward").alias("__std"),
        (F.min("reward") == F.max("reward")).alias("__equal"),
    )
    advantage = F.when(F.col("__equal") | (F.col("__std") == 0), F.lit(0.0)).otherwise(
        (F.col("reward") - F.col("__mean")) / F.col("__std")
    )
    scored = join_per_key(rewards, stats, key)
    return scored.withColumn("advantage", advantage).drop("__mean", "__std", "__equal")


def word_count(text: Column) -> Column:
    """Whitespace-separated words, the default measure of length."""
    trimmed = F.trim(text)
    return F.when(F.length(trimmed) == 0, F.lit(0)).otherwise(F.size(F.split(trimmed, r"\s+")))


def leading_words(text: Column, limit: int) -> Column:
    """The text up to the end of its ``limit``-th word."""
    if limit <= 0:
        return F.lit("")
    # Each word with the space before it; no pattern has to match more than one.
    words = F.regexp_extract_all(text, F.lit(r"\s*\S+"), F.lit(0))
    return F.array_join(F.slice(words, 1, limit), "")


def length_budget(
    df: DataFrame,
    text: str,
    limit: int | None,
    key: str,
    on_exceed: str = "error",
    measure: Callable[[Column], Column] = word_count,
    cut: Callable[[Column, int], Column] = leading_words,
) -> DataFrame:
    """Hold texts to a length.

    ``error`` stops the job and names the key and size, ``drop`` leaves the row
    out, ``truncate`` shortens with ``cut``.  A tokenizer can be given as
    ``measure`` and ``cut``.  No limit keeps every row, and a null text has no
    length to hold it to.
    """
    if limit is None:
        return df
    size = measure(F.col(text))
    fits = F.coalesce(size <= F.lit(limit), F.lit(True))
    if on_exceed == "error":
        message = F.concat(
            F.lit(f"{text} too long for {key} "), F.col(key).cast("string"),
            F.lit(": "), size.cast("string"), F.lit(f" > {limit}"),
        )
        return fail_unless(df, fits, message)
    if on_exceed == "drop":
        return df.where(fits)
    if on_exceed == "truncate":
        return df.withColumn(text, F.when(fits, F.col(text)).otherwise(cut(F.col(text), limit)))
    raise ValueError(f"unknown way to handle long texts: {on_exceed!r}")
