"""Coding-exam tables: gates, rows, loading, solve rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.scalars import (
    default_when_absent,
    default_when_empty,
    generation_status,
    path_basename,
    prefixed_id,
)
from lectern.operators.relational import lookup_by_id, with_status


def exam_gate(candidates: DataFrame) -> DataFrame:
    """Add ``reject_reason``, the first gate a candidate does not pass, else null.

    The gates are in order: its tests passed, a solution commit exists, a
    problem commit exists.
    """
    failed_tests = F.coalesce(F.col("exit_code") != 0, F.lit(True))
    reason = (
        F.when(failed_tests, F.lit("tests failed"))
        .when(F.col("solution_commit").isNull(), F.lit("no solution commit"))
        .when(F.col("problem_commit").isNull(), F.lit("no problem commit"))
    )
    return candidates.withColumn("reject_reason", reason)


def exam_rows(candidates: DataFrame, image_name: Column) -> DataFrame:
    """Exam rows: ``generated`` for candidates through all gates, ``failed: ...`` for
    those whose generation raised an error, none for those a gate rejected.

    A failed row keeps its topic fields and has the rest blank.
    """
    failed = F.col("error").isNotNull()
    gated = exam_gate(candidates).where(failed | F.col("reject_reason").isNull())

    def blank_if_failed(column: str) -> Column:
        return F.when(failed, F.lit("")).otherwise(F.coalesce(F.col(column), F.lit("")))

    exam_id = F.when(failed, prefixed_id("topic_key")).otherwise(prefixed_id("topic_key", "exam"))
    return gated.select(
        "topic_key",
        exam_id.alias("id"),
        "topic_title",
        "topic_description",
        "file_path",
        blank_if_failed("question").alias("question"),
        blank_if_failed("solution_commit").alias("solution_commit"),
        blank_if_failed("problem_commit").alias("problem_commit"),
        image_name.alias("image_name"),
        generation_status("error").alias("status"),
    )


def _typed_exams(
    rows: DataFrame, image: Column, project_dir: str, library_dir: str, project_name: str | None
) -> DataFrame:
    def repository(folder: str, name: str | None) -> Column:
        given = path_basename(F.lit(folder)) if name is None else F.lit(name)
        return F.struct(given.alias("name"), F.lit(folder).alias("local_dir"))

    return rows.select(
        "id",
        image.alias("image_name"),
        repository(project_dir, project_name).alias("project"),
        repository(library_dir, None).alias("library"),
        "solution_commit",
        "problem_commit",
        "question",
    )


def load_exams(
    rows: DataFrame,
    image_name: str,
    project_dir: str,
    library_dir: str,
    project_name: str | None = None,
    include_failed: bool = False,
) -> DataFrame:
    """Typed exams from exam rows, with the repositories attached.

    A missing or empty image name takes the default.  Failed rows are left out
    unless asked for: they have no commit to start an attempt from.
    """
    usable = rows if include_failed else with_status(rows)
    image = default_when_absent(rows, "image_name", image_name)
    return _typed_exams(
        usable, default_when_empty(image, image_name), project_dir, library_dir, project_name
    )


def load_exam(
    rows: DataFrame,
    exam_id: str,
    image_name: str,
    project_dir: str,
    library_dir: str,
    project_name: str | None = None,
) -> DataFrame:
    """One exam by id, whatever its status; ``ValueError`` if it is not there.

    Here the default image is taken only when the table has no such column.
    """
    found = lookup_by_id(rows, exam_id)
    image = default_when_absent(rows, "image_name", image_name)
    return _typed_exams(found, image, project_dir, library_dir, project_name)


def solve_rate(attempts: DataFrame, by: str = "with_library") -> DataFrame:
    """Attempts, successes and their share, with and without access to the library."""
    return attempts.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("success").alias("successes"),
        F.avg(F.col("success").cast("double")).alias("solve_rate"),
    )
