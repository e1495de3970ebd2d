"""Training sets and rollout tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import DEFAULT_SYSTEM_PROMPT, thinking_message
from lectern.operators.exams import load_exams
from lectern.operators.records import as_conversational
from lectern.operators.rollouts import (
    MAX_PROMPT_LENGTH,
    MAX_RESPONSE_LENGTH,
    MAX_TRAINING_LENGTH,
    ROLLOUTS_PER_TASK,
    group_advantage,
    length_budget,
    rollout_rewards,
    word_count,
)


def training_set(
    records: DataFrame,
    key: str,
    limit: int = MAX_TRAINING_LENGTH,
    on_exceed: str = "error",
    system_prompt: str = DEFAULT_SYSTEM_PROMPT,
    measure: Callable[[Column], Column] = word_count,
) -> DataFrame:
    """Conversations of three messages whose joint text keeps to the limit.

    A longer one stops the job, unless ``on_exceed="drop"`` asks to leave it out.
    """
    if on_exceed == "truncate":
        raise ValueError("a conversation is not cut: use drop or error")
    joint = F.concat_ws(
        "\n", F.lit(system_prompt), "question", thinking_message("reasoning", "answer")
    )
    within = length_budget(
        records.withColumn("__joint", joint), "__joint", limit, key, on_exceed, measure
    )
    return as_conversational(within, key, system_prompt=system_prompt)


def rollout_set(
    rows: DataFrame,
    outcomes: DataFrame,
    image_name: str,
    project_dir: str,
    library_dir: str,
    key: str = "id",
    n: int = ROLLOUTS_PER_TASK,
    prompt_limit: int = MAX_PROMPT_LENGTH,
    response_limit: int = MAX_RESPONSE_LENGTH,
    on_long_response: str = "error",
    outside: str = "error",
) -> DataFrame:
    """Exams as tasks, n attempts each, with reward and advantage within the task.

    Outcomes may carry the ``response`` of the attempt; it is held to
    ``response_limit`` words, by default by stopping the job, and handed on with
    its own outcome.
    """
    tasks = length_budget(
        load_exams(rows, image_name, project_dir, library_dir), "question", prompt_limit, key
    )
    rewards = rollout_rewards(tasks, outcomes, key, n, outside)
    if "response" in outcomes.columns:
        rewards = length_budget(rewards, "response", response_limit, key, on_long_response)
    return group_advantage(rewards, key)
