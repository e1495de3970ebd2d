"""Topics to a table of coding exams, and the queue of topics that wait for one.

Exams are generated outside (an agent and a test run per topic); what came of it
enters as a table of outcomes by topic key.  A topic without an outcome is in the
queue, so the next run of the generator takes it up and the next run of the plan
finds its outcome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators import curation as C
from lectern.operators.exams import exam_rows
from lectern.operators.model_stage import AnswerStore, apply_error_policy
from lectern.operators.positions import with_position
from lectern.operators.relational import input_prefix, join_per_key, zip_by_key

OUTCOME = ("question", "exit_code", "solution_commit", "problem_commit", "error")


def keyed_topics(topics: DataFrame, work: str) -> DataFrame:
    """``topic_pos`` and ``topic_key`` (path and place within the file) for topics that have a file_path and
    a place ``file_pos``, ``pos`` in some listing, as extraction from the documents gives them.

    Places come from one global order and the first place of each file, so a file
    with very many topics is not ranked by one task.
    """
    placed = with_position(topics, ["file_path", "file_pos", "pos"], f"{work}/topic_order", "__at")
    first = placed.groupBy("file_path").agg(F.min("__at").alias("__first"))
    within = join_per_key(placed, first, "file_path").withColumn("topic_pos", (F.col("__at") - F.col("__first")).cast("int"))
    return within.withColumn("topic_key", F.concat_ws(":", "file_path", F.col("topic_pos").cast("string"))).drop("__at", "__first")


def useful_topics(
    topics: DataFrame,
    judge: C.Model,
    work: str,
    max_topics: int | None = None,
    concurrency: int | None = None,
    store: AnswerStore | None = None,
) -> DataFrame:
    """Topics worth an exam, of the first ``max_topics`` if given.  A failed call stops the run."""
    chosen = input_prefix(topics, max_topics, "file_pos", "topic_pos")
    judged = C.judge_topics(chosen, judge, f"{work}/judged", concurrency=concurrency, store=store)
    return C.drop_audit(apply_error_policy(judged, "fail")).where("is_useful").drop("is_useful", "reason")


def exams_of(useful: DataFrame, outcomes: DataFrame, image_name: Column) -> DataFrame:
    """Exam rows of the useful topics that have an outcome."""
    named = useful.select(
        "topic_key", "file_path", F.col("title").alias("topic_title"), F.col("description").alias("topic_description"))
    return exam_rows(zip_by_key(named, outcomes.select("topic_key", *OUTCOME), "topic_key"), image_name)


def waiting_topics(useful: DataFrame, outcomes: DataFrame, work: str, batch_size: int) -> DataFrame:
    """Useful topics without an outcome, in input order, numbered in batches (``batch_id``) for the generator."""
    known = outcomes.where("topic_key is not null").select("topic_key").distinct()
    waiting = useful.join(known, "topic_key", "left_anti").select(
        "file_pos", "topic_pos", "topic_key", "file_path", "title", "description")
    placed = with_position(waiting, ["file_pos", "topic_pos", "topic_key"], f"{work}/waiting_order", "__at")
    return placed.withColumn("batch_id", F.floor(F.col("__at") / F.lit(batch_size)).cast("int")).drop("__at")


def unknown_outcomes(topics: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Outcomes whose key no topic has; they make no exam."""
    return outcomes.join(topics.select("topic_key").distinct(), "topic_key", "left_anti")


def exam_set(
    topics: DataFrame,
    outcomes: DataFrame,
    judge: C.Model,
    image_name: Column,
    work: str,
    max_topics: int | None = None,
    concurrency: int | None = None,
) -> DataFrame:
    """Exam rows of the useful topics, of the first ``max_topics`` if given.

    ``outcomes`` has what came of generating an exam for a topic: ``topic_key``,
    ``question``, ``exit_code``, ``solution_commit``, ``problem_commit``,
    ``error``.  A failed usefulness call stops the run.
    """
    return exams_of(useful_topics(topics, judge, work, max_topics, concurrency), outcomes, image_name)
