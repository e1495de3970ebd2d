"""Records assembled onto rows, and the training layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import DEFAULT_SYSTEM_PROMPT, chat_messages, thinking_completion


def topic_entities(topics: DataFrame) -> DataFrame:
    """Flat topic rows with the topic fields as one struct."""
    kept = [c for c in topics.columns if c not in ("title", "description")]
    return topics.select(*kept, F.struct("title", "description").alias("topic"))


def solve_results(judged: DataFrame) -> DataFrame:
    """Judged answers in the nested layout of the evaluation file."""
    return judged.select(
        F.struct("question", "answer", "reasoning").alias("qra"),
        "agent_reasoning", "agent_answer", "is_correct",
    )


def as_prompt_completion(records: DataFrame, *keep: str) -> DataFrame:
    return records.select(
        *keep,
        F.col("question").alias("prompt"),
        thinking_completion("reasoning", "answer").alias("completion"),
    )


def as_conversational(
    records: DataFrame, *keep: str, system_prompt: str = DEFAULT_SYSTEM_PROMPT
) -> DataFrame:
    return records.select(
        *keep, chat_messages("question", "reasoning", "answer", system_prompt).alias("messages")
    )
